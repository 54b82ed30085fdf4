"""Ordered pair counts of classes in rankings, by brute force."""
import random

import pytest

from qrank.operators import pairblocks, prefclosure
from pyspark.sql import functions as F

DOCS = "run string, topic int, c int, kept boolean, rank int"


def rankings(rng):
    """Groups of a few and of 300 documents, with gaps between places; a null key, a null class and no place."""
    rows = []
    for run, topic, n, classes in (("a", 1, 300, 4), ("a", 2, 3, 2), ("b", 1, 40, 60), ("b", 3, 1, 1), (None, 1, 9, 2)):
        places = sorted(rng.sample(range(1, 2 * n + 1), n))
        rows += [(run, topic, rng.choice([None, *range(classes)]), rng.random() < 0.5, p) for p in places]
    return rows + [("a", 1, 1, True, None)]


def brute(rows):
    out = {}
    for run, topic, c, kept, p in rows:
        for run2, topic2, c2, kept2, p2 in rows:
            if run is not None and (run, topic) == (run2, topic2) and None not in (p, p2) and p < p2:
                key = (run, topic, (c, kept), (c2, kept2))
                out[key] = out.get(key, 0) + 1
    return out


@pytest.mark.parametrize("block, batch", [(16, 7), (2048, 10_000)])
def test_pairs_by_brute_force(spark, monkeypatch, block, batch):
    monkeypatch.setattr(pairblocks, "BLOCK", block)
    rows = rankings(random.Random(block))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)  # blocks go on in the next batch
    try:
        got = prefclosure.ordered_pairs(spark.createDataFrame(rows, DOCS), ["run", "topic"], ["c", "kept"], F.col("rank")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.run, r.topic, tuple(r.u), tuple(r.v)): r.pr for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_only_some_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairblocks, "BLOCK", 16)
    rows = [r for r in rankings(random.Random(3)) if r[2] is not None]
    got = prefclosure.ordered_pairs(spark.createDataFrame(rows, DOCS), ["run", "topic"], ["c"], F.col("rank"), F.expr("u.c < v.c"))
    want = {}
    for (run, topic, u, v), n in brute(rows).items():
        if u[0] < v[0]:
            want[run, topic, u[0], v[0]] = want.get((run, topic, u[0], v[0]), 0) + n
    assert {(r.run, r.topic, r.u.c, r.v.c): r.pr for r in got.collect()} == want


def test_documents_of_one_place(spark):
    rows = [("a", 1, c, True, p) for p, c in ((1, 0), (1, 1), (2, 0), (2, 1), (2, 2))]
    got = prefclosure.ordered_pairs(spark.createDataFrame(rows, DOCS), ["run", "topic"], ["c"], F.col("rank"))
    assert sorted((r.u.c, r.v.c, r.pr) for r in got.collect()) == [(u, v, 1) for u in (0, 1) for v in (0, 1, 2)]


def test_rows_do_not_multiply_with_the_places(spark, monkeypatch):
    """What is written between the steps has a row per block, class and digit of the block, not per document."""
    sizes, write = [], prefclosure.written

    def counted(df, tag):
        out = write(df, tag)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(prefclosure, "written", counted)
    docs = spark.range(1, 5001).selectExpr("'a' run", "1 topic", "int(id % 3) c", "int(id) rank")
    got = prefclosure.ordered_pairs(docs, ["run", "topic"], ["c"], F.col("rank")).collect()
    assert sum(r.pr for r in got) == 5000 * 4999 // 2 and len(got) == 9
    assert sum(sizes) <= 3 * 3 * 2
