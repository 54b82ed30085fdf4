"""SimHash near-duplicate groups by a self-join of binary tries.

Fingerprints within ``budget`` differing bits agree on at least one of any
``budget + 1`` parts of the 64 bits.  So the fingerprints are dealt into groups
that agree on a whole part (a subtrie whose leading bits are that part), once
for each part.  A group larger than ``GROUP`` is dealt again by the parts of
its remaining bits, and so on: at the last level, where some part leaves 8 bits
or fewer, the others leave up to 10, so a group holds at most 1,024 distinct
fingerprints.  No group is unbounded, however
many near copies there are, and no pair is lost.

Inside a group the binary trie is joined with itself: starting from the pair
(root, root), node pairs descend together bit by bit, add up differing bits,
and a pair over the budget is dropped with all below it.  Each group reports a
spanning forest of its links, not all pairs; the forests of all groups are
joined into components with :mod:`components`.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, broadcast_if_small, content_key, materialize
from .components import stars

#: Largest group of distinct fingerprints that one trie holds, unless few bits are left.
GROUP = 512
LEFT_BITS = 8
#: Shingle hashes that are counted at a time, and bytes of text split into words at a time.
BLOCK = 1 << 15
TEXT_BLOCK = 1 << 20


# ------------------------------------------------------------ fingerprints
def word_blocks(text: bytes, size: int = TEXT_BLOCK):
    """The words of a text in lists, cut at white space after about ``size`` bytes."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """Unsigned SimHash: bit b is 1 if set in over half of the hashes of all word
    ``n``-shingles, repeats included; fewer words: of the whole; none: 0."""
    from xxhash import xxh64_intdigest

    votes, total, tail = np.zeros(64, np.int64), 0, []
    blocks = word_blocks(text.translate(LOWER)) if text else ()
    for words in blocks:
        words = tail + words
        for i in range(0, max(0, len(words) - n + 1), BLOCK):
            part = words[i:i + BLOCK + n - 1]
            h = np.array([xxh64_intdigest(s, 42) for s in map(b" ".join, zip(*(part[k:] for k in range(n))))],
                         dtype="<u8")
            votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(h)
        tail = words[max(0, len(words) - n + 1):]
    if not total:
        if not tail:
            return 0
        return xxh64_intdigest(b" ".join(tail), 42)
    return int.from_bytes(np.packbits(2 * votes > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(doc_id, _k1, _k2, fp): each row's fingerprint as a signed long. Null text: no words."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), n) for t in b.column(3)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fp, pa.int64())],
                                             ["doc_id", "_k1", "_k2", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), *content_key(id_col, text_col),
                        F.col(text_col).cast("binary").alias("t"))
            .mapInArrow(run, "doc_id long, _k1 long, _k2 long, fp long"))


# ------------------------------------------------------------ trie join
def part_masks(mask: int, budget: int) -> list[int]:
    """``mask`` with each of the ``budget + 1`` parts of its free bits added."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    k = budget + 1
    cut = [len(free) * i // k for i in range(k + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in pairwise(cut)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def trie_links(group: np.ndarray, code: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of distinct codes (uint64) within ``budget`` bits in the same group.

    Rows are sorted by (group, code).  A trie node is a range of rows; a pair
    of nodes is (lo, hi, lo2, hi2, differing bits so far).
    """
    n = len(code)
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    lo, hi = edges[:-1], edges[1:]
    big = hi - lo > 1
    own_lo, own_hi = lo[big], hi[big]  # pairs of a node with itself
    a = b = c = d = e = np.zeros(0, np.int64)
    found_i, found_j = [], []
    for bit in range(63, -1, -1):
        if not len(own_lo) and not len(a):
            break
        ones = np.r_[0, np.cumsum((code >> np.uint64(bit) & np.uint64(1)).astype(np.int64))]
        split = lambda x, y: y - (ones[y] - ones[x])  # noqa: E731  zeros come first in a node's range
        mid, ma, mc = split(own_lo, own_hi), split(a, b), split(c, d)
        na = np.concatenate([a, ma, a, ma, own_lo])
        nb = np.concatenate([ma, b, ma, b, mid])
        nc = np.concatenate([c, mc, mc, c, mid])
        nd = np.concatenate([mc, d, d, mc, own_hi])
        ne = np.concatenate([e, e, e + 1, e + 1, np.ones(len(mid), np.int64)])
        keep = (na < nb) & (nc < nd) & (ne <= budget)
        a, b, c, d, e = na[keep], nb[keep], nc[keep], nd[keep], ne[keep]
        leaf = (b - a == 1) & (d - c == 1)
        if leaf.any():
            i, j = a[leaf], c[leaf]
            near = np.bitwise_count(code[i] ^ code[j]) <= budget
            found_i.append(i[near])
            found_j.append(j[near])
            a, b, c, d, e = (x[~leaf] for x in (a, b, c, d, e))
        own_lo, own_hi = np.concatenate([own_lo, mid]), np.concatenate([mid, own_hi])
        big = own_hi - own_lo > 1
        own_lo, own_hi = own_lo[big], own_hi[big]
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least row index that each of ``n`` rows reaches over the links."""
    root = np.arange(n)
    while True:
        ri, rj = root[i], root[j]
        low = np.minimum(ri, rj)
        new = root.copy()
        np.minimum.at(new, ri, low)
        np.minimum.at(new, rj, low)
        new = new[new]
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _link_groups(budget: int):
    def links(group: np.ndarray, code: np.ndarray):
        i, j = trie_links(group, code, budget)
        if len(i):
            root = forest(len(code), i, j)
            moved = np.flatnonzero(root != np.arange(len(code)))
            fp = code.view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["a", "b"])

    def run(batches):
        held = None  # rows of groups that may go on in the next batch
        for batch in batches:
            m, v, f = (batch.column(k).to_numpy() for k in range(3))
            if held is not None:
                m, v, f = (np.concatenate(x) for x in zip(held, (m, v, f)))
            if not len(m):
                continue
            last = int(np.flatnonzero((m != m[-1]) | (v != v[-1]))[-1]) + 1 if (m != m[-1]).any() or (v != v[-1]).any() else 0
            held = (m[last:], v[last:], f[last:])
            yield from ranges(m[:last], v[:last], f[:last])
        if held is not None:
            yield from ranges(*held)

    def ranges(m, v, f, rows: int = 1 << 14):
        if not len(m):
            return
        gid = np.r_[0, np.cumsum((m[1:] != m[:-1]) | (v[1:] != v[:-1]))]
        code = f.view("<u8")
        order = np.lexsort((code, gid))
        code = code[order]
        starts, lo = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]]), 0
        while lo < len(gid):  # whole groups, about ``rows`` rows at a time
            k = np.searchsorted(starts, lo + rows)
            hi = int(starts[k]) if k < len(starts) else len(gid)
            yield from links(gid[lo:hi], code[lo:hi])
            lo = hi

    return run


def near_links(distinct: DataFrame, budget: int = 2, group: int = GROUP) -> DataFrame:
    """(a, b) links whose components are those of all pairs of distinct
    fingerprints (column ``fp``) within ``budget`` differing bits."""
    level = [0]
    rows = distinct.select("fp", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"))
    ready = []
    while True:
        deeper = {signed(m): [signed(x) for x in part_masks(m, budget)] for m in level}
        level = sorted({x for m in level for x in part_masks(m, budget)})
        children = F.create_map(*(F.lit(x) for m, kids in deeper.items() for x in (m, kids)))
        rows = (rows.select("fp", F.explode(F.element_at(children, F.col("mask"))).alias("mask"))
                .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")).distinct())
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        dealt = materialize(rows.join(sizes, ["mask", "value"]), "tries")
        last = min(64 - m.bit_count() for m in level) <= LEFT_BITS
        ready.append(dealt if last else dealt.where(F.col("n") <= group))
        rows = dealt.where(F.col("n") > group).select("fp", "mask", "value")
        if last or rows.isEmpty():
            break
    found = None
    for d in ready:
        part = (d.select("mask", "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
                .mapInArrow(_link_groups(budget), "a long, b long"))
        found = part if found is None else found.union(part)
    return found


# ------------------------------------------------------------ operator
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, budget: int = 2) -> DataFrame:
    """(doc_id, _k1, _k2, fp, component_id, root) of every row; root is the component's fingerprint.

    Rows whose fingerprints a chain of steps of at most ``budget`` differing
    bits connects share a component, named by its smallest doc_id (nulls are
    passed over; a component of null ids alone has a null name).  Repeated rows
    are rows of their own; null and empty texts have fingerprint 0, linked like
    any other.  An empty table gives no row.  Other columns are not read.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, n), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    star = stars(near_links(distinct, budget))
    named = distinct.join(star.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = materialize(named.join(least, "root").select("fp", "component_id", "root"), "components")
    return marked.join(of, "fp").select("doc_id", "_k1", "_k2", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, budget: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, columns as they came.

    The row with the smallest id stays (of equal ids the smallest content key;
    of wholly repeated rows one).  A component of null ids alone keeps one row.
    """
    from pyspark.sql import Window

    found = near_duplicates(docs, id_col, text_col, n, budget)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "_k1", "_k2")).alias("s"))
    stay = materialize(first.select("s._k1", "s._k2").distinct(), "stay")
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *content_key(id_col, text_col))
    w = Window.partitionBy("_k1", "_k2").orderBy(F.lit(0))  # rows of one id and one text
    return (keyed.join(broadcast_if_small(stay, 200_000, 16), ["_k1", "_k2"])
            .withColumn("_n", F.row_number().over(w)).where("_n = 1").select("_row.*"))
