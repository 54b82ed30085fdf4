"""Ordered pair counts inside blocks of rankings, in numpy.

A task receives rows (keys, classes, at) sorted by its keys and ``at``, all of
a block of a ranking together.  Blocks are bounded, so the running counts of a
block's classes are a matrix of bounded size; blocks with few rows and classes
share one.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents of a block, and cells (documents x classes) of the matrix that blocks share.
BLOCK, CELLS = 2048, 2048 * 2048


def codes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """A number per row, equal for equal values of ``columns`` (nulls are equal)."""
    code = np.zeros(table.num_rows, np.int64)
    for c in columns:
        d = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        d = d if isinstance(d, pa.DictionaryArray) else d.combine_chunks()
        code = np.unique(code * len(d.dictionary) + d.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return code


def earlier(first: np.ndarray, at: np.ndarray, cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of u, row of v, count): of two classes of a block, the pairs in which the document of u
    stands before that of v; a class is named by one of its rows.  Row ``first[b]`` begins block b."""
    n = len(at)
    block = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
    _, row, pair, size = np.unique(block * (int(cls.max()) + 1) + cls, return_index=True, return_inverse=True, return_counts=True)
    start = np.searchsorted(block[row], np.arange(len(first) + 1))  # where a block's classes begin
    local = pair - start[block]
    many = np.diff(start)
    rows = np.diff(np.r_[first, n])
    a = 0
    while a < len(first):
        # as many blocks as fit the matrix, one at least
        cells = np.cumsum(rows[a:a + CELLS]) * np.maximum.accumulate(many[a:a + CELLS])
        b = a + max(1, int(np.searchsorted(cells, CELLS, side="right")))
        lo, hi = first[a], n if b == len(first) else first[b]
        one = np.zeros((hi - lo, int(many[a:b].max())), np.int32)
        one[np.arange(hi - lo), local[lo:hi]] = 1
        before = np.cumsum(one, axis=0, dtype=np.int32) - one
        new = np.r_[True, (at[lo + 1:hi] != at[lo:hi - 1]) | (block[lo + 1:hi] != block[lo:hi - 1])]
        if not new.all():  # documents of one place do not precede each other
            before = before[np.maximum.accumulate(np.where(new, np.arange(hi - lo), 0))]
        p = slice(start[a], start[b])
        order = np.argsort(pair[lo:hi], kind="stable")
        total = np.add.reduceat(before[order], np.r_[0, np.cumsum(size[p])[:-1]], axis=0, dtype=np.int64)
        of = block[row[p]]
        total -= size[p, None] * before[first[of] - lo].astype(np.int64)
        v, u = np.nonzero((total > 0) & (np.arange(one.shape[1]) < many[of][:, None]))
        yield row[start[of[v]] + u], row[start[a] + v], total[v, u]
        a = b


def pairs_of_blocks(keys: list[str], classes: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches (keys, block, classes, at) in order -> batches (keys, u, v, pr), u and v structs of the classes."""

    def counted(table):
        key = codes(table, [*keys, "block"])
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = table.column("at").to_numpy()
        struct = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in classes], classes)
        for u, v, n in earlier(first, at, codes(table, classes)):
            for i in range(0, len(n), 200_000):
                k = slice(i, i + 200_000)
                named = table.select(keys).take(pa.array(v[k])).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [*(named.column(c).combine_chunks() for c in keys), struct.take(pa.array(u[k])), struct.take(pa.array(v[k])), pa.array(n[k])],
                    [*keys, "u", "v", "pr"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            if not table.num_rows:
                continue
            key = codes(table, [*keys, "block"])
            whole = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            rest = table.slice(whole)  # the last block may go on in the next batch
            if whole:
                yield from counted(table.slice(0, whole).combine_chunks())
        if rest is not None and rest.num_rows:
            yield from counted(rest.combine_chunks())

    return run
