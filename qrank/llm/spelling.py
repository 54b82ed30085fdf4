"""Groups of spelling variants: words at one edit from each other, by FM-index search schemes.

A word w at one inserted, deleted or replaced letter from u leaves either the
first or the second half of w unchanged.  So the vocabulary is dealt by halves:
a word stands as a *query* under each of its own halves, and as an *indexed*
word under the halves that a query of its length, one less or one more could
share with it.  Halves go to buckets of about ``CHARS`` letters by hash; a half
with more is dealt over a grid of pieces (indexed words by piece, its queries
to every piece), so no task holds more, however common a half is.

In a bucket the indexed words, each between delimiters, form one text with a
bidirectional FM-index.  A query matches the delimiter and its exact half
backwards, which keeps the intervals of the text and of the reversed text in
step; then it goes on forwards over the other half and allows one error.  For
the second half the same runs on reversed words.  All queries of a bucket go
forward together: a step is a few numpy operations over their suffix-rank
intervals.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, broadcast_if_small, materialize

#: Letters of indexed words in one bucket, at most (one longer word may stand alone).
CHARS = 1 << 18
#: Queries that go through an index together.
CHUNK = 4096
#: Characters of a text that are searched at a time, and words counted before a partial count is returned.
TEXT_BLOCK, HELD = 1 << 20, 200_000
DELIMITER = "\x01"


# ------------------------------------------------------------ words
def text_blocks(text: str, size: int = TEXT_BLOCK):
    """The text in parts of about ``size`` characters that cut no run of letters."""
    letter = re.compile("[A-Za-zÀ-ÿ]*")
    at = 0
    while at < len(text):
        end = letter.match(text, min(at + size, len(text))).end()
        yield text[at:end]
        at = end


def word_counts(docs: DataFrame, id_col: str, text_col: str, shortest: int, every: int) -> DataFrame:
    """(word, n) of the whole table: runs of letters, A-Z in lower case, of at least ``shortest``
    letters after the deletion that a run's crc32 asks for when ``every`` divides it."""

    def run(batches):
        runs = re.compile("[a-zÀ-ÿ]{%d,}" % shortest)
        held: dict[str, int] = {}

        def partial():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                raw = t.as_py()
                if not raw:
                    continue
                start = zlib.crc32(((i.as_py() or "") + ":").encode())
                for block in text_blocks(raw.translate(LOWER).decode("utf-8", "replace")):
                    seen: dict[str, int] = {}
                    for w in runs.findall(block):
                        seen[w] = seen.get(w, 0) + 1
                    for w, n in seen.items():
                        h = zlib.crc32(w.encode(), start)
                        if h % every == 0:
                            k = h % len(w)
                            w = w[:k] + w[k + 1:]
                            if len(w) < shortest:
                                continue
                        held[w] = held.get(w, 0) + n
                    if len(held) > HELD:
                        yield partial()
        if held:
            yield partial()

    part = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------ FM-index
def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of each suffix in order; the last symbol is the least and occurs once."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    width = max(1, 62 // bits)  # symbols that fit into the first key
    key = np.zeros(n, np.int64)
    for j in range(width):
        key <<= bits
        key[:max(0, n - j)] |= text[j:]
    k = width
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[1, 1 + np.cumsum(key[order][1:] != key[order][:-1])]
        if rank[order[-1]] == n:
            return order
        key = rank * (n + 1)
        key[:n - k] += rank[k:] if k < n else 0
        k *= 2


class Ranks:
    """How often a symbol, or a smaller one, stands in a prefix of a sequence: a wavelet matrix."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = []
        symbols = np.arange(sigma)
        start = np.zeros(sigma, np.int64)  # where each symbol's node begins
        for level in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> level & 1).astype(bool)
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(seq) - int(ones[-1])
            own = symbols >> level & 1 == 1
            self.levels.append((ones, zeros, own, start - ones[start]))
            start = np.where(own, zeros + ones[start], start - ones[start])
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.base = start

    def count(self, symbol: np.ndarray, end: np.ndarray, smaller: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        less = np.zeros(len(end), np.int64) if smaller else None
        for ones, zeros, own, before in self.levels:
            one, up = ones[end], own[symbol]
            rest = end - one
            if smaller:
                less += np.where(up, rest - before[symbol], 0)
            end = np.where(up, zeros + one, rest)
        return end - self.base[symbol], less


class Bidirectional:
    """FM-index of distinct words between delimiters, read in both directions.

    Symbols: 0 ends the text, 1 is the delimiter, letters follow.  ``left`` has
    the symbols before the sorted suffixes, ``right`` those of the reversed
    text, that is the symbols behind a match.
    """

    def __init__(self, words: list[str], alphabet: np.ndarray):
        text = symbols(DELIMITER + DELIMITER.join(words) + DELIMITER, alphabet)
        self.sigma, self.size = len(alphabet) + 1, len(text) + 1
        self.left, _, _ = self._direction(text)
        self.right, self.behind, self.places = self._direction(text[::-1])
        self.first = np.r_[0, np.cumsum(np.r_[1, np.bincount(text, minlength=self.sigma)[1:]])][:-1]
        self.delimiters = np.flatnonzero(text == 1)

    def _direction(self, text: np.ndarray):
        ended = np.r_[text, 0]
        order = suffix_array(ended)
        before = ended[order - 1]
        return Ranks(before, self.sigma), before, order

    def backward(self, symbol, lo, other, size):
        """Intervals (text, reversed text, size) of the matches with ``symbol`` before them."""
        a, less_a = self.left.count(symbol, lo, True)
        b, less_b = self.left.count(symbol, lo + size, True)
        return self.first[symbol] + a, other + less_b - less_a, b - a

    def forward(self, symbol, other, size):
        """Interval in the reversed text of the matches with ``symbol`` behind them."""
        a, _ = self.right.count(symbol, other)
        b, _ = self.right.count(symbol, other + size)
        return self.first[symbol] + a, b - a

    def next_letters(self, other, size):
        """(row, letter): the letters that stand behind the matches of each row."""
        wide = np.flatnonzero(size > self.sigma)
        few = np.flatnonzero(size <= self.sigma)
        n = size[few]
        row = np.repeat(few, n)
        at = np.repeat(other[few], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        code = np.unique(row * self.sigma + self.behind[at])
        row, letter = code // self.sigma, code % self.sigma
        row = np.r_[row, np.repeat(wide, self.sigma - 2)]
        letter = np.r_[letter, np.tile(np.arange(2, self.sigma), len(wide))]
        return row[letter > 1], letter[letter > 1]

    def word_of(self, other):
        """Index of the word whose match, delimiters included, is the one row ``other``."""
        end = len(self.places) - 2 - self.places[other]
        return np.searchsorted(self.delimiters, end) - 1


def symbols(text: str, alphabet: np.ndarray) -> np.ndarray:
    return np.searchsorted(alphabet, np.frombuffer(text.encode("utf-32-le"), np.uint32)) + 1


def one_error(index: Bidirectional, words: list[str], exact: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, indexed word) of every pair that agrees in the query's first ``exact`` letters and
    differs by one edit behind them; each pair once."""
    text = symbols("".join(words), alphabet)
    length = np.array([len(w) for w in words], np.int64)
    off = np.cumsum(length) - length
    letter = lambda q, at: np.where(at < length[q], text[np.minimum(off[q] + at, len(text) - 1)], 1)
    # the exact half and the delimiter before it, backwards
    q = np.arange(len(words))
    lo, other, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), index.size)
    done = []
    step = 0
    while len(q):
        symbol = np.where(step < exact[q], text[np.maximum(off[q] + exact[q] - 1 - step, 0)], 1)
        lo, other, size = index.backward(symbol, lo, other, size)
        last = step == exact[q]
        done.append((q[last & (size > 0)], other[last & (size > 0)], size[last & (size > 0)]))
        go = ~last & (size > 0)
        q, lo, other, size = q[go], lo[go], other[go], size[go]
        step += 1
    q, other, size = (np.concatenate(x) for x in zip(*done))
    none = np.zeros(0, np.int64)
    wq, wo, ws = none, none, none  # states that have made their error
    found = [(none, none)]
    step = 0
    while len(q) or len(wq):
        at = exact[q] + step
        here, behind = letter(q, at), letter(q, at + 1)
        inside = at < length[q]
        # delete: go on as if the letter had been there; in a run of equal letters only the last
        skip = inside & ((here != behind) | (at + 1 == length[q]))
        nq, no, ns = [q[skip]], [other[skip]], [size[skip]]
        # replace and insert: any other letter that follows a match
        row, c = index.next_letters(other, size)
        differs = c != here[row]
        row, c = row[differs], c[differs]
        eo, es = index.forward(c, other[row], size[row])
        swap = inside[row]
        nq.append(q[row][swap]), no.append(eo[swap]), ns.append(es[swap])
        wq, wo, ws = np.r_[wq, q[row]], np.r_[wo, eo], np.r_[ws, es]
        # everything goes on with the query's next letter, at last with the delimiter
        wat = exact[wq] + step
        wo, ws = index.forward(letter(wq, wat), wo, ws)
        alive, over = ws > 0, wat == length[wq]
        found.append((wq[alive & over], index.word_of(wo[alive & over])))
        alive &= ~over
        wq, wo, ws = (np.concatenate(x) for x in zip((wq[alive], wo[alive], ws[alive]), *zip(nq, no, ns)))
        q, other, size, here = q[inside], other[inside], size[inside], here[inside]
        other, size = index.forward(here, other, size)
        go = size > 0
        q, other, size = q[go], other[go], size[go]
        step += 1
    return tuple(np.concatenate(x) for x in zip(*found))


def near_in_bucket(side: int, indexed: list[str], queries: list[str]) -> list[tuple[int, int]]:
    """(query, indexed word) at one edit, of the queries whose first half (side 0) is unchanged,
    or whose second half (side 1) is unchanged and the first is not."""
    turn = (lambda w: w) if side == 0 else (lambda w: w[::-1])
    words, asked = [turn(w) for w in indexed], [turn(w) for w in queries]
    alphabet = np.unique(np.frombuffer((DELIMITER + "".join(indexed) + "".join(queries)).encode("utf-32-le"), np.uint32))
    index = Bidirectional(words, alphabet)
    out = []
    for s in range(0, len(asked), CHUNK):
        part = asked[s:s + CHUNK]
        exact = np.array([len(w) // 2 if side == 0 else len(w) - len(w) // 2 for w in part], np.int64)
        for q, u in zip(*(x.tolist() for x in one_error(index, part, exact, alphabet))):
            h = len(part[q]) // 2
            if side == 0 or indexed[u][:h] != queries[s + q][:h]:
                out.append((s + q, u))
    return out


# ------------------------------------------------------------ dealing
def _half(side: int, length: Column) -> Column:
    """The half of the word that a query of ``length`` letters would match exactly."""
    h = F.floor(length / 2).cast("int")
    return F.substring("word", F.lit(1), h) if side == 0 else F.expr("word").substr(F.length("word") - (length - h) + 1, length - h)


def dealt(vocabulary: DataFrame, shortest: int, chars: int) -> DataFrame:
    """(gid, side, asked, word, n): indexed words (asked false) and queries of every bucket."""
    long = F.length("word")
    both = lambda f: F.explode(F.concat(*(f(side) for side in (0, 1))))
    entry = lambda side, length: F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), _half(side, length)).alias("key"))
    indexed = vocabulary.select("word", "n", both(lambda s: F.array_distinct(F.array(
        *(entry(s, F.greatest(long + d, F.lit(shortest))) for d in (-1, 0, 1))))).alias("e")).select("e.side", "e.key", "word", "n")
    asked = vocabulary.select("word", "n", both(lambda s: F.array(entry(s, long))).alias("e")).select("e.side", "e.key", "word", "n")
    sizes = materialize(indexed.groupBy("key").agg(F.sum(long + 1).alias("chars")), "halves")
    total = sizes.agg(F.sum("chars")).first()[0] or 0
    buckets = max(1, -(-2 * total // chars))
    large = broadcast_if_small(
        sizes.where(F.col("chars") > chars).select("key", F.ceil(F.col("chars") / chars).alias("pieces")), 200_000, 16)
    piece = F.pmod(F.xxhash64(F.lit("piece"), "word"), "pieces")
    every = F.expr("sequence(0L, pieces - 1)")
    small = (F.pmod("key", F.lit(buckets)) * 2 + F.col("side")).alias("gid")

    def rows(df, kind):
        df = df.join(large, "key", "left")
        few = df.where("pieces is null").select(small, "side", F.lit(kind).alias("asked"), "word", "n")
        grid = df.where("pieces is not null").withColumn("own", piece).withColumn("other", F.explode(every))
        i, j = ("own", "other") if not kind else ("other", "own")
        return few.union(grid.select(F.xxhash64("key", i, j).alias("gid"), "side", F.lit(kind).alias("asked"), "word", "n"))

    return rows(indexed, False).union(rows(asked, True))


def near_words(vocabulary: DataFrame, shortest: int = 7, chars: int = CHARS) -> DataFrame:
    """(word, near, near_n): each ordered pair of words at exactly one edit, once."""

    def run(t: pa.Table) -> pa.Table:
        asked = t["asked"].to_pylist()
        word, n = t["word"].to_pylist(), t["n"].to_pylist()
        indexed = sorted({(w, c) for w, c, a in zip(word, n, asked) if not a})  # a word under two halves counts once
        queries = sorted({w for w, a in zip(word, asked) if a})
        pairs = near_in_bucket(t["side"][0].as_py(), [w for w, _ in indexed], queries) if indexed and queries else []
        return pa.table([pa.array([queries[q] for q, _ in pairs], pa.string()), pa.array([indexed[u][0] for _, u in pairs], pa.string()),
                         pa.array([indexed[u][1] for _, u in pairs], pa.int64())], names=["word", "near", "near_n"])

    return dealt(vocabulary, shortest, chars).groupBy("gid").applyInArrow(run, "word string, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain word -> form, by doubling the steps each round."""
    links = materialize(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.join(links.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        onward = materialize(onward.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        links = onward.select("word", "root")
        if onward.where("moved").isEmpty():
            return links


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2,
                   ratio: int = 10, every: int = 31, chars: int = CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of at least ``shortest`` letters and ``least`` occurrences.

    Words are runs of Latin letters with A-Z in lower case; where ``every``
    divides the crc32 of ``<id>:<run>``, the run loses one letter.  ``n_near``
    counts the words at exactly one edit.  ``form`` is the commonest of them
    (ties: the smallest) if it is ``ratio`` times as common as the word, else
    null; ``root`` follows the forms to the last.  Null and empty texts have no
    words, a null id counts as empty, repeated rows count as often as they
    stand, an empty table has no rows.  Texts and words may be of any length.
    Other columns are not read.
    """
    if shortest < 2:
        raise ValueError("words need two halves")
    vocabulary = materialize(word_counts(docs, id_col, text_col, shortest, every).where(F.col("n") >= least), "vocabulary")
    best = near_words(vocabulary, shortest, chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b"))
    out = materialize(
        vocabulary.join(best, "word", "left")
        .withColumn("ok", F.coalesce(-F.col("b.less") >= ratio * F.col("n"), F.lit(False)))
        .select("word", F.when(F.col("ok"), F.col("b.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(F.col("ok"), -F.col("b.less")).alias("form_n")), "variants")
    ends = roots(out.where("form is not null"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
