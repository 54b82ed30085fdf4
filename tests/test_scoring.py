"""The scores and the cut of a search's tasks, against sums row by row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qrank.functions import similarity as S
from qrank.functions.analysis import Analyzer
from qrank.operators import index as I
from qrank.operators import query as Q
from qrank.operators import scoring
from qrank.operators import search as SE


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [50, 2_000_000])
def test_a_task_returns_what_can_be_among_the_first_k(monkeypatch, descending, limit):
    monkeypatch.setattr(scoring, "BLOCK", limit)
    monkeypatch.setattr(scoring, "KEPT", limit)
    rng = np.random.default_rng(5)
    tid, query = (a.ravel() for a in np.meshgrid(np.arange(6), np.arange(9), indexing="ij"))
    some = rng.random(len(tid)) < 0.4
    tid, query, weight = tid[some], query[some], rng.integers(1, 4, some.sum()) / 2
    names = [None, *(f"d{i:03d}" for i in range(150))]
    doc = np.sort(rng.integers(0, len(names), 600))
    at = rng.integers(0, tid.max() + 1, len(doc))
    s = rng.integers(-1, 4, len(doc)) / 4
    table = pa.table({"docno": pa.array([names[i] for i in doc], pa.string()), "tid": pa.array(at, pa.int32()), "s": s})
    run = scoring.best_of_task(Sent(scoring.weights_of(tid, query, weight)), 5, False, descending)
    got = {(q, d): x for b in run(table.to_batches(max_chunksize=37)) for q, d, x in zip(*(c.to_pylist() for c in b.columns))}
    want = {}
    for i, t, x in zip(doc, at, s):
        for q, w in zip(query[tid == t], weight[tid == t]):
            want[q, names[i]] = want.get((q, names[i]), 0.0) + w * x
    want = {key: x for key, x in want.items() if x > 0}
    assert set(got) <= set(want) and all(abs(got[key] - want[key]) < 1e-9 for key in got)
    for q in range(9):
        rows = sorted((d or "" for p, d in want if p == q), reverse=descending)
        rows = sorted(rows, key=lambda d: -want[q, d or None])[:5]
        assert all((q, d or None) in got for d in rows)


def test_a_search_makes_no_row_per_match(spark):
    a = Analyzer("standard", ("lowercase",))
    docs = spark.createDataFrame([(f"d{i:03d}", "alpha", "1990", "alpha beta " + f"w{i % 5} " * (i % 3)) for i in range(60)],
                                 "docno string, headline string, date string, text string")
    qt = Q.flat_query_terms(spark.createDataFrame([(str(i), "alpha beta w1") for i in range(40)], "qid string, text string"), a)
    index = I.build_index(docs, a)
    want = SE.top_k(SE.score(qt, index, S.bm25()), 7).select("qid", "docno", "score", "rank")
    got = SE.search(qt, index, S.bm25(), k=7).select("qid", "docno", F.col("sim").alias("score"), "rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()


def test_subsets_that_mean_the_same_are_searched_once(spark, monkeypatch):
    from qrank.plans import sweep as SW
    docs = spark.createDataFrame([(f"d{i:02d}", "c", "Alpha news", "1990", f"alpha Beta w{i % 5} l'alpha") for i in range(30)],
                                 "docno string, collection string, headline string, date string, text string")
    topics = spark.createDataFrame([("1", "alpha w1", "beta", "w2", "1990"), ("2", "Beta w3", "x", "w4", "null")],
                                   "qid string, title string, desc string, narr string, date string")
    qrels = spark.createDataFrame([("1", f"d{i:02d}", 1) for i in range(0, 30, 4)] + [("2", "d03", 1), ("2", "d08", 1)],
                                  "qid string, docno string, rel bigint")
    subsets = [(), ("apostrophe",), ("asciifolding",), ("lowercase",), ("lowercase", "asciifolding")]
    seen, best = [], SE.best
    monkeypatch.setattr(SE, "best", lambda postings, side, *a, **kw: seen.append(side) or best(postings, side, *a, **kw))
    got = {r.run_id: r.map for r in SW.sweep_filters(docs, topics, qrels, subsets).collect()}
    assert len(seen) == 1 and sorted(r.like for r in seen[0].select("like").distinct().collect()) == [0, 3]
    assert set(got) == {"none", "apostrophe", "asciifolding", "lowercase", "lowercase-asciifolding"}
    assert got["none"] == got["asciifolding"] == got["apostrophe"] and got["lowercase"] == got["lowercase-asciifolding"]
    alone = {r.run_id: r.map for r in SW.sweep_filters(docs, topics, qrels, [("lowercase",)]).collect()}
    assert alone == {"lowercase": got["lowercase"]}
