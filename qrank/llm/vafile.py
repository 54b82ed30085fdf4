"""Exact top-k inner products with a vector-approximation file.

Vectors are integers, floor(64 x) of each component.  Equal vectors become one
entry with the ids of its ``k + 1`` first rows, so a vector that a third of all
rows share costs no more than any other.  The approximation of an entry holds a
cell number per component; the cell's least and greatest value bound the inner
product from both sides.  Entries are dealt into blocks of ``BLOCK`` by a hash,
query vectors into blocks of ``QUERIES``, and each pair of blocks is a task of
its own: it scans the cells of the block, which gives every pair's upper bound,
then reads exact vectors in the order of the bounds until the ``k + 1``-th best
score found is above the bound of all that were not read.  Each task returns at
most ``k + 1`` rows per query, whatever the data; a last window merges them.

Nothing is approximate in the result: the cells only decide what is read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Numbers (entries times components) of one block of entries, and of one of queries: a task holds one of each.
BLOCK, QUERIES = 1 << 19, 1 << 18
#: Queries whose bounds are held at once in a task.
SLAB = 128
#: Sums of products below this are exact in double arithmetic.
EXACT = 2.0 ** 52


def entries(vectors: DataFrame, id_col: str, vec_col: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """(rows, distinct): rows (id, v) that take part, and one row (v, vid, ids) per distinct
    vector, with the ids of its ``keep`` first rows in ascending order, nulls last."""
    whole = f"`{vec_col}` is not null and forall(`{vec_col}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = vectors.where(whole).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * 64)).alias("v"))
    first = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    distinct = (rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep)
                .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("_n", "id"))).alias("ids"))
                .select("v", F.monotonically_increasing_id().alias("vid"), F.col("ids.id").alias("ids")))
    return rows, materialize(distinct, "vectors")


def cell_marks(distinct: DataFrame, bits: int) -> np.ndarray:
    """Cell borders, (components, 2 ** bits + 1): from the least value to the greatest, and
    evenly between the 0.1 % and the 99.9 % quantile, so that outliers widen the end cells only.
    Zero always lies inside, for the components that shorter vectors lack."""
    found = (distinct.select(F.posexplode("v").alias("c", "x")).groupBy("c")
             .agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                  F.percentile_approx("x", [0.001, 0.999], 2000).alias("q")).orderBy("c").toPandas())
    cells = 1 << bits
    marks = np.empty((len(found), cells + 1))
    for i, (lo, hi, (a, b)) in enumerate(zip(found.lo, found.hi, found.q)):
        marks[i] = np.r_[min(lo, 0), np.ceil(np.linspace(a, b, cells + 1))[1:-1], max(float(hi), 0.0) + 1]
    return np.maximum.accumulate(marks, axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of number lists as a (rows, width) array; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def cell_codes(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The cell of every component, one byte each."""
    out = np.empty(x.shape, np.uint8)
    for c in range(x.shape[1]):
        out[:, c] = np.clip(np.searchsorted(marks[c], x[:, c], side="right") - 1, 0, marks.shape[1] - 2)
    return out


def approximations(distinct: DataFrame, marks: np.ndarray) -> DataFrame:
    """The approximation file: ``distinct`` with ``code``, a byte per component."""

    def run(batches):
        for b in batches:
            codes = cell_codes(matrix(b.column(0), len(marks)), marks)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([c.tobytes() for c in codes], pa.binary())], ["v", "vid", "ids", "code"])

    return distinct.mapInArrow(run, "v array<long>, vid long, ids array<long>, code binary")


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows as longs: exact, held at the ends of the long range."""
    if not len(q):
        return np.zeros(0, np.int64)
    if (np.abs(q).max(axis=0) * np.abs(x).max(axis=0)).sum() < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    ends = np.iinfo(np.int64)
    return np.array([min(max(sum(int(a) * int(b) for a, b in zip(r, s)), ends.min), ends.max) for r, s in zip(q, x)], np.int64)


def kth_best(qi: np.ndarray, score: np.ndarray, queries: int, k: int) -> np.ndarray:
    """The k-th best score of each query, or the least long where fewer are known."""
    order = np.lexsort((-score, qi))
    qi, score = qi[order], score[order]
    start = np.searchsorted(qi, np.arange(queries))
    at = start + k - 1
    out = np.full(queries, np.iinfo(np.int64).min)
    known = at < np.r_[start[1:], len(qi)]
    out[known] = score[at[known]]
    return out


def search_block(q: np.ndarray, x: np.ndarray, code: np.ndarray, marks: np.ndarray, k: int) -> tuple:
    """(query, entry, score) of at least the ``k`` best entries of each query, all ties
    included, and the number of exact vectors read.

    The scan touches the cells only.  Exact vectors are read in waves, in
    descending order of the upper bounds, until no unread bound reaches the
    ``k``-th best score.
    """
    width, code = np.arange(x.shape[1]), code.astype(np.intp)
    low, high = marks[width, code], np.maximum(marks[width, code + 1] - 1, marks[width, code])
    middle, half = (low + high) / 2, (high - low) / 2
    least = np.iinfo(np.int64).min
    found, read = [(np.zeros(0, np.int64),) * 3], 0
    for s in range(0, len(q), SLAB):
        part = q[s:s + SLAB]
        bound = part @ middle.T + np.abs(part) @ half.T
        size = np.abs(part).max(axis=0, initial=0) @ np.maximum(np.abs(low), np.abs(high)).max(axis=0, initial=0)
        if not size < EXACT:  # rounded sums bound nothing: read everything
            bound[:] = np.inf
        qi_all, ci_all, sc_all = (np.zeros(0, np.int64) for _ in range(3))
        wave, unread = min(2 * k, bound.shape[1]), bound
        limit = np.full(len(part), least)
        while True:
            top = np.argpartition(unread, -wave, axis=1)[:, -wave:] if wave < unread.shape[1] else np.broadcast_to(
                np.arange(unread.shape[1]), unread.shape)
            rows = np.broadcast_to(np.arange(len(part))[:, None], top.shape)
            best = unread[rows, top]
            need = (best > -np.inf) & (best >= limit[:, None])
            qi, ci = rows[need].astype(np.int64), top[need].astype(np.int64)
            if not len(qi):
                break
            read += len(qi)
            sc = inner(part[qi], x[ci])
            unread[qi, ci] = -np.inf
            qi_all, ci_all, sc_all = np.r_[qi_all, qi], np.r_[ci_all, ci], np.r_[sc_all, sc]
            limit = kth_best(qi_all, sc_all, len(part), k)
            good = sc_all >= limit[qi_all]
            qi_all, ci_all, sc_all = qi_all[good], ci_all[good], sc_all[good]
            if wave >= unread.shape[1]:
                break
            wave = min(2 * wave, unread.shape[1])
        found.append((qi_all + s, ci_all, sc_all))
    return *(np.concatenate(z) for z in zip(*found)), read


def _first_rows(qi, ci, score, ids: pa.Array, k: int):
    """Rows (query, entry, id, null, score): the first ``k`` of each query by score descending, id ascending, nulls last."""
    lengths = np.diff(ids.offsets.to_numpy())
    values = ids.flatten()
    null = values.is_null().to_numpy(zero_copy_only=False)
    number = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.r_[0, np.cumsum(lengths)]
    lead = start[ci]  # an entry's first id is its least
    order = np.lexsort((number[lead], null[lead], -score, qi))
    order = order[_rank(qi[order]) < k]
    qi, ci, score = qi[order], ci[order], score[order]
    n = lengths[ci]
    at = np.repeat(start[ci], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    qi, ci, score = np.repeat(qi, n), np.repeat(ci, n), np.repeat(score, n)
    order = np.lexsort((number[at], null[at], -score, qi))
    order = order[_rank(qi[order]) < k]
    return qi[order], ci[order], number[at][order], null[at][order], score[order]


def _rank(sorted_keys: np.ndarray) -> np.ndarray:
    """Place from 0 within each run of equal keys."""
    n = len(sorted_keys)
    if not n:
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))


def search(file: DataFrame, queries: DataFrame, marks: np.ndarray, keep: int, n_entries: int, n_queries: int) -> DataFrame:
    """(qvid, vid, id, score): the first ``keep`` rows of each distinct query vector in each block."""
    blocks = lambda n, numbers: math.ceil(n / max(256, numbers // max(1, len(marks))))
    c_blocks, q_blocks = blocks(n_entries, BLOCK), blocks(n_queries, QUERIES)
    deal = lambda n: F.pmod(F.xxhash64("vid"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = queries.select("vid", "v", deal(q_blocks).alias("qb")).withColumn("cb", every(c_blocks))
    right = file.select("vid", "v", "ids", "code", deal(c_blocks).alias("cb")).withColumn("qb", every(q_blocks))
    schema = pa.schema([("qvid", pa.int64()), ("vid", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        width = len(marks)
        q, x = matrix(left["v"], width), matrix(right["v"], width)
        code = np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8).reshape(len(x), width)
        qi, ci, score, _ = search_block(q, x, code, marks, keep)
        qi, ci, number, null, score = _first_rows(qi, ci, score, right["ids"].combine_chunks(), keep)
        return pa.table([left["vid"].to_numpy()[qi], right["vid"].to_numpy()[ci],
                         pa.array(number, mask=null), score], schema=schema)

    return (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
            .applyInArrow(run, "qvid long, vid long, id long, score long"))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, every: int = 20,
          bits: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query row, exactly.

    Query rows are those whose id ``every`` divides; candidates are all rows
    but the query row itself.  Scores are integer inner products of
    floor(64 x), ties go to the smaller id; a null id is no query and comes
    last among ties.  Vectors that are null or hold a null, NaN or infinite
    component take no part.  A shorter vector counts as ending in zeros (an
    empty one scores 0).  Repeated rows are rows of their own: each is a query
    and a candidate of the others.  Scores beyond a long stay at its end, and
    so do components.  No query or no candidate: no rows.  Other columns are not read.

    ``bits`` sets the cells per component, 2 ** bits (at most 8): fewer make a
    smaller file and more exact reads.
    """
    if not 1 <= bits <= 8 or k < 1 or every < 1:
        raise ValueError("bits must be 1 to 8, k and every at least 1")
    spark = vectors.sparkSession
    keep = k + 1  # one of them may be the query row itself
    rows, distinct = entries(vectors, id_col, vec_col, keep)
    asked = rows.where(F.col("id") % every == 0)
    lookup = materialize(asked.select("v").distinct().join(distinct, "v").select("v", "vid"), "queries")
    n_entries, n_queries = distinct.count(), lookup.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    marks = cell_marks(distinct, bits)
    file = materialize(approximations(distinct, marks), "approximations")
    part = search(file, lookup, marks, keep, n_entries, n_queries)
    best = Window.partitionBy("qvid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    merged = (part.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= keep)
              .groupBy(F.col("qvid").alias("vid")).agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score", F.col("vid").alias("of")))).alias("all")))
    answers = materialize(merged.join(lookup, "vid"), "answers")
    # each query row leaves itself out: one row of its own vector with its id
    own = F.expr("array_position(transform(all, x -> x.id <=> id and x.of = vid), true)").cast("int")
    others = F.expr("slice(if(_own > 0, filter(all, (x, i) -> i != _own - 1), all), 1, %d)" % k)
    return (asked.join(answers, "v").withColumn("_own", own)
            .select(F.col("id").alias("query_id"), F.posexplode(others).alias("_r", "_x"))
            .select("query_id", (F.col("_r") + 1).alias("rank"), F.col("_x.id").alias("vec_id"), F.col("_x.score").alias("score")))
