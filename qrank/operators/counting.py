"""Occurrences of terms in token lists, counted in Arrow batches inside tasks.

A task receives rows (field, docno, tokens), a text each.  For given queries
the distinct tokens of a batch take their final form once, those of an earlier
batch are remembered, and what no query wants is left out before anything is a
row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens whose form a task remembers, tokens counted at once, and rows of a batch that it returns.
KNOWN, TOKENS, ROWS = 500_000, 2_000_000, 100_000


def counts_of_task(wanted, final: Callable[[str], str] | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches (field, docno, tokens) -> batches (field, term, docno, tf, dl).

    ``wanted``: the broadcast list of distinct terms; ``final``: the form that
    a token is counted in (None: as it is).  ``dl`` is the number of tokens; a
    row with a null term stands for each text that has any.
    """

    def run(batches):
        terms = pa.array([*wanted.value, None], pa.string())
        number = {t: i for i, t in enumerate(wanted.value)}
        known = {}

        def place(token):
            at = known.get(token)
            if at is None:
                at = known[token] = number.get(final(token), -1)
            return at

        def counted(field, docno, offsets, flat):
            """Rows of the texts whose tokens are ``flat[offsets[0]:offsets[-1]]``."""
            size = np.diff(offsets)
            text = np.repeat(np.arange(len(size)), size)
            coded = flat.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            if len(known) > KNOWN:
                known.clear()
            find = number.get if final is None else place
            form = np.fromiter((-1 if (at := find(t)) is None else at for t in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            at = form[coded.indices.to_numpy(zero_copy_only=False)] if len(form) else np.zeros(0, np.int64)
            here = at >= 0
            cell, tf = np.unique(text[here] * len(terms) + at[here], return_counts=True)
            some = np.flatnonzero(size)  # the null at the end of the terms brings a text's length along
            row = np.concatenate([cell // len(terms), some])
            term = np.concatenate([cell % len(terms), np.full(len(some), len(terms) - 1)])
            tf = np.concatenate([tf, np.ones(len(some), np.int64)])
            for i in range(0, len(row), ROWS):
                r = pa.array(row[i:i + ROWS])
                yield pa.RecordBatch.from_arrays(
                    [field.take(r), terms.take(pa.array(term[i:i + ROWS])), docno.take(r), pa.array(tf[i:i + ROWS].astype(np.int64)),
                     pa.array(size[row[i:i + ROWS]].astype(np.int64))], ["field", "term", "docno", "tf", "dl"])

        yield from by_part(batches, counted)

    return run


def by_part(batches: Iterable[pa.RecordBatch], counted: Callable) -> Iterator[pa.RecordBatch]:
    """What ``counted`` makes of (field, docno, offsets, tokens), for some whole texts of about ``TOKENS`` tokens at a time."""
    for batch in batches:
        tokens = batch.column("tokens")
        offsets, flat = tokens.offsets.to_numpy().astype(np.int64), tokens.values
        part = (offsets[:-1] - offsets[0]) // TOKENS if len(offsets) > 1 else np.zeros(0, np.int64)
        edge = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)] if len(part) else np.zeros(1, np.int64)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield from counted(batch.column("field").slice(a, b - a), batch.column("docno").slice(a, b - a), offsets[a:b + 1], flat)


def all_counts_of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (field, docno, tokens) -> batches (field, docno, dl, term, tf), a row per text and distinct token."""

    def counted(field, docno, offsets, flat):
        size = np.diff(offsets)
        coded = flat.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        at = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        n = max(1, len(coded.dictionary))
        cell, tf = np.unique((np.repeat(np.arange(len(size)), size) * n + at)[at >= 0], return_counts=True)
        for i in range(0, len(cell), ROWS):
            row = cell[i:i + ROWS] // n
            r = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [field.take(r), docno.take(r), pa.array(size[row].astype(np.int64)), coded.dictionary.take(pa.array(cell[i:i + ROWS] % n)),
                 pa.array(tf[i:i + ROWS].astype(np.int64))], ["field", "docno", "dl", "term", "tf"])

    yield from by_part(batches, counted)
