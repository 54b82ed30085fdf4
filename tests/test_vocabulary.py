"""Vocabulary filters see each distinct term, not each token."""

from pyspark.sql import functions as F

from qrank.functions import analysis as A


def test_each_distinct_term_is_stemmed_once(spark):
    terms = spark.range(6000).select(F.concat(F.lit("running"), (F.col("id") % 3).cast("string")).alias("term"))
    mapped = A.term_map(terms, A.Analyzer())
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "ArrowEvalPython" in plan
    assert mapped.count() == 3
