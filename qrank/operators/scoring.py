"""Sums of a document's matches for every query, in numpy, and the best documents of a task.

A task receives postings (docno, tid, s) sorted by document, all of a document
together; ``s`` is the similarity of the posting, which no query changes.  A
term's queries and weights are a table of bounded size (:class:`Weights`).  A
block of documents is expanded to its matches, these are summed per document
and query, and what ``k`` documents of the task certainly precede is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Matches, and cells of documents x queries, that a block holds about; scored rows that are kept
#: until they are cut.
BLOCK, KEPT = 2_000_000, 6_000_000
#: More than rounding to six decimals moves a score.
SLACK = 2e-6
SCHEMA = "q int, docno string, score double"


class Weights(NamedTuple):
    """Queries of the terms: those of term t are ``query[start[t]:start[t + 1]]``, numbered below ``queries``."""

    start: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    queries: int


def weights_of(tid: np.ndarray, query: np.ndarray, weight: np.ndarray) -> tuple:
    """The fields of :class:`Weights`, for a broadcast."""
    order = np.argsort(tid, kind="stable")
    n = int(tid.max()) + 1 if len(tid) else 0
    start = np.concatenate([[0], np.cumsum(np.bincount(tid, minlength=n))]).astype(np.int64)
    return (start, query[order].astype(np.int64), weight[order].astype(float), int(query.max()) + 1 if len(query) else 0)


def block_scores(w: Weights, doc: np.ndarray, tid: np.ndarray, s: np.ndarray, keep_zero: bool):
    """(document, query, score) of the documents and queries that meet; ``doc`` counts from 0."""
    many = w.start[tid + 1] - w.start[tid]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(w.start[tid] - (ends - many), many)
    cell = np.repeat(doc * w.queries, many) + w.query[at]
    value = np.repeat(s, many) * w.weight[at]
    cells = (int(doc[-1]) + 1) * w.queries if len(doc) else 0
    if cells > 8 * total:
        met, cell = np.unique(cell, return_inverse=True)
        score = np.bincount(cell, value, minlength=len(met))
    else:
        score = np.bincount(cell, value, minlength=cells)
        met = np.flatnonzero(np.bincount(cell, minlength=cells)) if keep_zero else np.flatnonzero(score != 0)
        score = score[met]
    if not keep_zero:
        positive = ~(score <= 0)  # not a number counts as the highest score, as in Spark
        met, score = met[positive], score[positive]
    return met // w.queries, met % w.queries, score


def first_k(query: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int, descending: bool):
    """Places of the rows that fewer than ``k`` others of their query precede whatever way scores
    are rounded, and the ``k``-th best score of each query that has as many."""
    key = np.where(np.isnan(score), np.inf, score)
    order = np.lexsort((-doc if descending else doc, -key, query))
    q, x = query[order], key[order]
    n = np.arange(len(q))
    new = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
    run = new | np.r_[True, x[1:] != x[:-1]] if len(q) else new
    first = np.flatnonzero(new)
    head, place = first[np.cumsum(new) - 1], n - np.maximum.accumulate(np.where(run, n, 0))
    size = np.diff(np.r_[first, len(q)])
    last = x[np.minimum(first + k - 1, len(q) - 1)] if len(q) else x
    limit = np.where(size >= k, last, -np.inf)
    stay = (n - head < k) | ((x >= limit[np.cumsum(new) - 1] - SLACK) & (place < k))
    return order[stay], q[first], limit


def best_of_task(weights, k: int, keep_zero: bool, descending: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches (docno, tid, s) in order of docno -> batches (q, docno, score); ``weights`` is the broadcast."""

    def run(batches):
        w = Weights(*weights.value)
        names, queries, docs, scores = [], [], [], []
        floor = np.full(w.queries, -np.inf)
        held = base = 0

        def rows(q, d, x):
            for i in range(0, len(q), 200_000):
                part = slice(i, i + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(q[part].astype(np.int32)), pa.array([names[j] for j in d[part]], pa.string()),
                                                  pa.array(x[part])], ["q", "docno", "score"])

        def cut():
            nonlocal queries, docs, scores, names, held
            q, d, x = (np.concatenate(a) if a else np.zeros(0, t) for a, t in ((queries, np.int64), (docs, np.int64), (scores, float)))
            stay, has, limit = first_k(q, d, x, k, descending)
            floor[has] = np.maximum(floor[has], limit - SLACK)
            used, d = np.unique(d[stay], return_inverse=True)  # names of the documents that are left
            names = [names[j] for j in used]
            queries, docs, scores = [q[stay]], [d], [x[stay]]
            held = len(stay)

        def scored(ids, doc, tid, s):
            nonlocal held
            at = np.cumsum(np.bincount(doc, w.start[tid + 1] - w.start[tid], minlength=len(ids)))
            load = at + np.minimum(w.queries, 8 * np.diff(np.r_[0, at])).cumsum()
            edge = np.r_[0, np.flatnonzero(np.diff((load // BLOCK).astype(np.int64))) + 1, len(ids)]
            row = np.searchsorted(doc, edge)
            for a, b, i, j in zip(edge[:-1], edge[1:], row[:-1], row[1:]):
                d, q, x = block_scores(w, doc[i:j] - a, tid[i:j], s[i:j], keep_zero)
                high = ~(x < floor[q])
                queries.append(q[high])
                docs.append(d[high] + len(names))
                scores.append(x[high])
                names.extend(ids[a:b])
                held += int(high.sum())
                if held > KEPT:
                    cut()
                    if held > KEPT // 2:  # more than a task should hold: later steps cut them
                        yield from rows(queries[0], docs[0], scores[0])
                        names.clear(), queries.clear(), docs.clear(), scores.clear()
                        held = 0

        def numbered(table):
            """A batch's documents by number; equal ones are neighbours."""
            code = table.column("docno").combine_chunks().dictionary_encode(null_encoding="encode")
            code = code if isinstance(code, pa.DictionaryArray) else code.combine_chunks()
            return code.dictionary.to_pylist(), *(np.asarray(c) for c in (
                code.indices.to_numpy(zero_copy_only=False), table.column("tid").to_numpy(), table.column("s").to_numpy()))

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ids, doc, tid, s = numbered(table)
            if not len(doc):
                continue
            whole = int(np.searchsorted(doc, doc[-1]))  # the last document may go on in the next batch
            rest = table.slice(whole)
            if whole:
                yield from scored(ids[:-1], doc[:whole].astype(np.int64), tid[:whole].astype(np.int64), s[:whole])
        if rest is not None:
            ids, doc, tid, s = numbered(rest)
            yield from scored(ids, doc.astype(np.int64), tid.astype(np.int64), s)
        cut()
        yield from rows(queries[0], docs[0], scores[0])

    return run
