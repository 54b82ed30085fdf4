import pytest
from pyspark.sql import functions as F

from qrank.functions import similarity as S
from qrank.functions.analysis import Analyzer
from qrank.operators import index as I
from qrank.operators import query as Q
from qrank.operators import search as SE


@pytest.mark.parametrize("saved", [False, True])
def test_tasks_grow_with_the_matches_and_each_holds_whole_documents(spark, monkeypatch, tmp_path, saved):
    a = Analyzer("standard", ("lowercase",))
    docs = spark.createDataFrame([(f"d{i:03d}", f"alpha w{i % 7}", "1990", "alpha beta " + f"w{i % 5} " * (i % 3)) for i in range(200)],
                                 "docno string, headline string, date string, text string")
    queries = spark.createDataFrame([("1", "alpha beta w1"), ("2", "alpha w2 w3")], "qid string, text string")
    qt = Q.flat_query_terms(queries, a)
    index = I.build_index(docs, a)
    if saved:
        I.save_index(index, str(tmp_path / "index"), buckets=4)
        index = I.load_index(spark, str(tmp_path / "index"))
    cols = ["qid", "docno", "field", "term", "tf", "dl", "df", "weight"]
    want = sorted(map(tuple, SE.matches(qt, index).select(*cols).collect()))
    monkeypatch.setattr(SE, "TASK_MATCHES", 20)
    got = SE.matches(qt, index, by_document=True)
    assert sorted(map(tuple, got.select(*cols).collect())) == want
    assert got.rdd.getNumPartitions() >= -(-len(want) // 20)
    parts = got.select("docno", F.spark_partition_id().alias("part")).distinct()
    assert parts.count() == parts.select("docno").distinct().count()
    plan = SE.score(qt, index, S.bm25())._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(docno" in plan and "hashpartitioning(qid" not in plan
