"""Registered queries on the smallest driver tables: against SQL, and the pipeline by its stages."""
import os

import duckdb
import pytest

import corpus_pipeline
from checks.compare import rows_of
from qrank.llm import catalog
from qrank.llm.common import materialize, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows_of(catalog.QUERIES[name](spark, SF).toPandas()) == rows_of(con.sql(catalog.ORACLES[name]).df())


def test_pipeline_stages(spark):
    from qrank.llm import decontam, lines, resample, simhash
    docs = table(spark, SF, "documents")
    cols = docs.columns
    labels, bench = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, before, SF), "stage")
        assert docs.columns == cols, name
        if name == "quality classifier":
            want = {r.doc_id for r in resample.importance_resample(before, labels).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == want
        elif name == "line dedup":
            want = {r.doc_id: r.text for r in lines.dedup_lines(before, catalog.MIN_SITES).collect()}
            assert {r.doc_id: r.text for r in docs.collect()} == want and all(len(r.text) == r.n_chars for r in docs.collect())
        elif name == "simhash near-dedup":
            found = simhash.near_duplicates(before).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r.component_id for r in found})
        else:
            bad = {r.doc_id for r in decontam.contamination(before, bench).where("contaminated").collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - bad
        before = docs
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_take_awkward_rows(spark):
    """Every stage on nulls, empty and very long texts, repeated rows and clashing columns: columns stay, and
    no row appears that was not there."""
    from . import data
    docs = data.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            got = out.groupBy("doc_id").count().collect()
            assert {r.doc_id for r in got} == {r[0] for r in data.rows()}
            continue
        assert out.columns == docs.columns, name
        rows, before = [tuple(r) for r in out.collect()], data.rows()
        assert rows and len(rows) <= len(before), name
        if name != "line dedup":
            assert set(rows) <= set(before), name
        else:
            assert sorted(r[0] or -1 for r in rows) == sorted(r[0] or -1 for r in before)
        assert stage(spark, data.empty(spark), SF).count() == 0, name
