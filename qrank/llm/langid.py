"""Language identification: averaged hashed subword embeddings and a linear softmax.

Texts become byte n-grams of 2 to 4 bytes inside space-padded words, hashed to
buckets.  The model averages bucket embeddings over a text and applies a linear
softmax; it is trained by stochastic gradient descent in numpy on a bounded
sample of pieces of every language's labelled rows.  Both steps are linear, so
with few languages scoring needs only one table of class scores per bucket;
with more than ``DIM`` it averages the embeddings, whose size is fixed.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, slices

BUCKETS, DIM = 1 << 16, 16
#: Bytes of a piece (at most twice as many), least pieces of a language, and rows from which a fifth of a language only calibrates.
PIECE, MIN_PIECES, CALIBRATE = 240, 256, 10
#: Temperatures that calibration tries.
WARMTHS = np.geomspace(0.02, 20, 61)
#: ASCII letters lower-cased, bytes of non-ASCII characters as they are, all else a space.
TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every n-gram of the texts."""
    body = b"\0".join(b" " + t.translate(TABLE) + b" " for t in texts)
    a = np.frombuffer(body, np.uint8)
    of = np.cumsum(a == 0).astype(np.int32)
    gap, stop = a == 32, a == 0
    out_b, out_t = [], []
    h = a.astype(np.uint32) + np.uint32(1)
    inside = np.ones(len(a), bool)  # no space or end strictly inside so far
    for n in range(2, 5):
        if len(a) < n:
            break
        size = len(a) - n + 1
        h = h[:size] * np.uint32(0x01000193) + a[n - 1:] + np.uint32(1)
        if n > 2:
            inside = inside[:size] & ~(gap | stop)[n - 2:len(a) - 1]
        else:
            inside = inside[:size]
        ok = inside & ~stop[:size] & ~stop[n - 1:] & ~(gap[:size] & gap[n - 1:] & (n == 2))
        mixed = h[ok] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        out_b.append((mixed >> np.uint32(16)).astype(np.int32))
        out_t.append(of[:size][ok])
    return np.concatenate(out_b), np.concatenate(out_t)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages): class scores of a bucket; with ``out`` (BUCKETS, DIM): embeddings
    bias: np.ndarray
    out: np.ndarray | None = None  # (DIM, languages)
    warmth: float = 1.0
    cut: float = 0.0

    def logits(self, texts: list[bytes]) -> np.ndarray:
        b, t = ngrams(texts)
        n = np.maximum(np.bincount(t, minlength=len(texts)), 1)
        score = np.column_stack([np.bincount(t, c[b], len(texts)) for c in self.table.T]) / n[:, None]
        return (score if self.out is None else score @ self.out) + self.bias

    def rows_at_once(self) -> int:
        return max(1, (1 << 20) // max(1, len(self.langs)))

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(language number, calibrated probability) of each text."""
        z = self.logits(texts) / self.warmth
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(best)), best]


def pieces_of(text: bytes, size: int = PIECE) -> list[bytes]:
    """A text cut at spaces into pieces of ``size`` to twice as many bytes (the last: fewer);
    words of more bytes are cut between characters."""
    words, out, held, n = text.split(), [], [], 0
    for w in words:
        at = 0
        while at < len(w):
            end = min(len(w), at + size)
            while at + size - 4 < end < len(w) and w[end] & 0xC0 == 0x80:
                end -= 1
            held.append(w[at:end])
            n += end - at + 1
            at = end
            if n >= size:
                out.append(b" ".join(held))
                held, n = [], 0
    return out + [b" ".join(held)] * (n > 0)


def train(pieces: list[bytes], langs: list[str], seen: int = 24_000, rate: float = 2.0, batch: int = 32, seed: int = 5) -> Model:
    """Fit on pieces of texts, all of them: four times, or more often until ``seen`` pieces have passed (at most 60 times)."""
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    if len(names) < 2:
        return Model(names, np.zeros((BUCKETS, len(names)), np.float32), np.zeros(len(names)))
    rng = np.random.default_rng(seed)
    cut = [(p, number[x]) for p, x in sorted(zip(pieces, langs))]
    epochs = max(4, min(60, seen // len(cut)))
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    share = np.bincount([k for _, k in cut], minlength=len(names))
    weight = (len(cut) / (len(names) * np.maximum(share, 1))).astype(np.float32)
    cut = [x for x in cut for _ in range(int(weight[x[1]].clip(1, 20)))]  # rare languages: repeats, as large weights diverge
    weight = weight.clip(max=1)
    steps = max(1, epochs * -(-len(cut) // batch))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(cut))
        for lo in range(0, len(cut), batch):
            some = [cut[i] for i in order[lo:lo + batch]]
            want = np.array([k for _, k in some])
            b, t = ngrams([p for p, _ in some])
            n = np.maximum(np.bincount(t, minlength=len(some)), 1).astype(np.float32)
            mean = np.column_stack([np.bincount(t, e, len(some)) for e in emb[b].T]).astype(np.float32) / n[:, None]
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), want] -= 1
            p *= weight[want][:, None]
            lr = rate * (1 - step / steps) / len(some)
            back = (p @ out.T) / n[:, None]
            out -= lr * (mean.T @ p) * DIM
            bias -= lr * p.sum(axis=0)
            np.add.at(emb, b, -(lr * len(some)) * back[t])
            step += 1
    if len(names) > DIM:
        return Model(names, emb, bias.astype(float), out)
    return Model(names, (emb @ out).astype(np.float32), bias.astype(float))


def trials(model: Model, texts: list[bytes], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log loss, probability of the best class) by text and ``WARMTHS``, and whether the best class is right."""
    z = model.logits(texts)
    z -= z.max(axis=1, keepdims=True)
    whole = np.column_stack([np.log(np.exp(z / w).sum(axis=1)) for w in WARMTHS])
    return whole - z[np.arange(len(y)), y][:, None] / WARMTHS, np.exp(-whole), z.argmax(axis=1) == y


def calibrate(model: Model, loss: np.ndarray, best: np.ndarray, right: np.ndarray) -> None:
    """Temperature with the least log loss, and the rejection cut: the score that
    all but one in a hundred right predictions reach."""
    i = int(loss.mean(axis=0).argmin())
    model.warmth = float(WARMTHS[i])
    model.cut = float(np.quantile(best[right, i], 0.01)) if right.any() else 1.0


def fold(id_col) -> F.Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = 400, all_pieces: int = 24_000,
                  max_pieces: int = 4_000) -> DataFrame:
    """A written sample (t, lang, take, only) of every language's rows outside the held-out fold.

    Of a language's distinct rows with a letter about ``per_lang`` (fewer with many languages) are chosen by hash of id and
    text, all if it has no more; ``all_pieces`` are aimed at over all languages, ``max_pieces`` for one at most.  ``take``: pieces to draw from a row, so that few rows give as many pieces as many do;
    ``only``: the row only calibrates.
    """
    t, lang = F.col(text_col).cast("binary"), F.col(lang_col).cast("string")
    rows = docs.where(F.col(text_col).isNotNull() & lang.isNotNull() & (fold(id_col) != 1) & F.col(text_col).cast("string").rlike(r"\p{L}")) \
        .select(t.alias("t"), lang.alias("lang"), F.xxhash64(F.col(id_col).cast("string"), t, F.lit(17)).alias("_h"))
    sizes = materialize(rows.groupBy("lang").agg(F.approx_count_distinct("_h").alias("_n")), "languages")
    n = sizes.count()
    pieces = min(max_pieces, max(MIN_PIECES, all_pieces // max(1, n)))
    want = min(per_lang, pieces)
    u = F.pmod("_h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    only = (F.col("_n") >= CALIBRATE) & (F.pmod(F.xxhash64("_h"), F.lit(5)) == 4)
    some = (rows.join(broadcast_if_small(sizes, 100_000), "lang").where(u * F.col("_n") < want)
            .select("t", "lang", F.ceil(F.lit(float(pieces)) / F.least("_n", F.lit(want))).cast("int").alias("take"), only.alias("only")))
    return materialize(some, "sample")


def sampled_pieces(sample: DataFrame) -> tuple[list[bytes], list[str]]:
    """Distinct pieces with a letter, ``take`` by hash from each row that does not only calibrate, and their languages."""

    def run(batches):
        from xxhash import xxh64_intdigest

        for b in batches:
            for t, lang, take in zip(*(c.to_pylist() for c in b.columns)):
                some = [p for p in set(pieces_of(t)) if has_letter(p)]
                some = heapq.nsmallest(take, some, key=lambda p: (xxh64_intdigest(p, 3), p))
                for i in range(0, len(some), 4096):
                    part = some[i:i + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([lang] * len(part), pa.string())], ["p", "lang"])

    got = sample.where(~F.col("only")).select("t", "lang", "take").mapInArrow(run, "p binary, lang string").distinct().toArrow()
    return got["p"].to_pylist(), got["lang"].to_pylist()


def calibrated(model: Model, sample: DataFrame) -> Model:
    """``model`` calibrated on the whole texts of the sample's other rows, which stay on the executors."""
    shared = sample.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches):
        m = Model(*shared.value)
        number = {x: i for i, x in enumerate(m.langs)}
        for b in batches:
            known = [(t, x) for t, x in zip(*(c.to_pylist() for c in b.columns)) if x in number]
            texts, langs = [t for t, _ in known], [x for _, x in known]
            for lo, hi in slices(texts, 1 << 20):
                for i in range(lo, hi, m.rows_at_once()):
                    j = min(hi, i + m.rows_at_once())
                    loss, best, right = trials(m, texts[i:j], np.array([number[x] for x in langs[i:j]]))
                    yield pa.RecordBatch.from_arrays([pa.array(list(loss), pa.list_(pa.float64())), pa.array(list(best), pa.list_(pa.float64())),
                                                      pa.array(right)], ["loss", "best", "right"])

    got = (sample.where("only").select("t", "lang").mapInArrow(run, "loss array<double>, best array<double>, right boolean").toArrow())
    if len(got):
        loss, best = (np.array(got[c].to_pylist()) for c in ("loss", "best"))
        calibrate(model, loss, best, got["right"].to_numpy())
    return model


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400,
             all_pieces: int = 24_000, max_pieces: int = 4_000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of each row of ``docs``.

    Learns every non-null ``lang_col`` value that a text with a letter carries
    in a row whose crc32(id as text) mod 3 is not 1, however many values there
    are, from a sample of pieces of each, bounded by the last three arguments
    (see :func:`training_rows`); predicts from the text alone.  lang_pred is a learned
    value, or ``und`` (score 0) if the text is null or has no letter or nothing
    was learned.  score: the calibrated probability of lang_pred.  rejected:
    the score is below the calibrated cut, or lang_pred is ``und``.  A null id
    is in no fold: never held out, never learned from.  With one language it is
    always predicted.  Repeated rows each get a row; other columns are unread.
    """
    sample = training_rows(docs, id_col, text_col, lang_col, per_lang, all_pieces, max_pieces)
    model = train(*sampled_pieces(sample))
    if len(model.langs) > 1:
        model = calibrated(model, sample)
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # at most 4 MB, and 72 bytes per language

    def run(batches):
        m = Model(*shared.value)
        names = np.array(m.langs, object)
        for b in batches:
            texts = [t.as_py() for t in b.column(2)]
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            for lo, hi in slices(texts, 1 << 20):
                some = [i for i in range(lo, hi) if m.langs and texts[i] is not None and has_letter(texts[i])]
                for k in range(0, len(some), m.rows_at_once()):
                    part = some[k:k + m.rows_at_once()]
                    best, p = m.predict([texts[i] for i in part])
                    lang[part], score[part] = names[best], p
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)),
                 pa.array((score < m.cut) | (lang == "und"))], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"),
                        F.col(text_col).cast("binary").alias("t"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"))
