"""Readers and writers for whitespace-separated evaluation files.

* run:        ``qid iter docno rank sim run_id [ignored...]`` (rank ignored)
* qrels:      ``qid iter docno rel``
* qrels_jg:   ``qid judge_group docno rel``
* prefs:      ``qid judge_group sub_group docno rel_level``
* qrels_prefs: qrels read as preferences (sub-group '0', level as double)
* zscores:    ``qid measure mean stddev``

All readers are line-parallel ``spark.read.text`` jobs (gzip/bzip2 inputs
are decompressed by the reader), so many files or large files load in
parallel.  A malformed line (wrong number of fields, no number where one
belongs) ends the job that reads it; the check is part of the same pass.
``validate=False`` drops such lines instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path, comments: bool = True) -> DataFrame:
    return split_lines(spark.read.text(path), comments)


def split_lines(df: DataFrame, comments: bool = True) -> DataFrame:
    """Whitespace-split text lines (batch or streaming DataFrame of ``value``)."""
    df = df.withColumn("_file", F.input_file_name())
    f = F.split(F.trim(F.col("value")), r"\s+")
    df = df.withColumn("_f", f).withColumn("_n", F.when(F.trim("value") == "", 0).otherwise(F.size(f)))
    if comments:
        df = df.where(~F.trim("value").startswith("#"))
    return df


def _check(df: DataFrame, good: F.Column, what: str, validate: bool) -> DataFrame:
    """Rows that are ``good``; others raise when the row is read, or are dropped."""
    good = F.coalesce(good, F.lit(False))
    if not validate:
        return df.where(good)
    bad = F.raise_error(F.concat(F.lit(f"malformed {what} line in "), F.col("_file"), F.lit(": "), F.col("value")))
    return df.where(F.when(good, F.lit(True)).otherwise(bad.cast("boolean")))


def _is_int(i: int) -> F.Column:
    return F.get(F.col("_f"), F.lit(i)).try_cast("bigint").isNotNull()


def _is_number(i: int) -> F.Column:
    return F.get(F.col("_f"), F.lit(i)).try_cast("double").isNotNull()


def read_run(spark: SparkSession, path, validate: bool = True, run_id_from_file: bool = False) -> DataFrame:
    """Run rows (run_id, qid, docno, sim); blank and '#' lines skipped.

    With ``run_id_from_file`` every file is one run named by its path
    (useful when many runs with equal tags are read at once).
    """
    df = _lines(spark, path).where(F.col("_n") > 0)
    return run_rows(df, run_id_from_file, validate)


def run_rows(df: DataFrame, run_id_from_file: bool = False, validate: bool = True) -> DataFrame:
    """Typed run rows from split lines (see ``split_lines``)."""
    rid = F.col("_file") if run_id_from_file else F.col("_f")[5]
    return _check(df, (F.col("_n") >= 6) & _is_number(4), "run", validate).select(
        rid.alias("run_id"), F.col("_f")[0].alias("qid"), F.col("_f")[2].alias("docno"),
        F.col("_f")[4].cast("double").alias("sim"))


def last_run_tag(spark: SparkSession, path) -> DataFrame:
    """(run_id, tag): the tag on the last line of each run file, run_id being the file's path.

    Lines are placed by their split's start and their order in it, so the
    answer does not depend on how files are cut or packed into tasks.
    """
    df = spark.read.text(path).select("value", F.input_file_name().alias("run_id"),
                                      F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    f = F.split(F.trim("value"), r"\s+")
    df = df.where((F.size(f) >= 6) & ~F.trim("value").startswith("#"))
    return df.groupBy("run_id").agg(F.max_by(F.get(f, F.lit(5)), F.struct("start", "at")).alias("tag"))


def read_qrels(spark: SparkSession, path, validate: bool = True) -> DataFrame:
    """Judgments (qid, docno, rel bigint); '#' lines skipped."""
    df = _lines(spark, path)
    df = _check(df, (F.col("_n") == 4) & _is_int(3), "qrels", validate)
    return df.select(
        F.col("_f")[0].alias("qid"), F.col("_f")[2].alias("docno"), F.col("_f")[3].cast("bigint").alias("rel"))


def read_qrels_jg(spark: SparkSession, path, validate: bool = True) -> DataFrame:
    """Judgments per judge group (qid, jg, docno, rel)."""
    df = _lines(spark, path)
    df = _check(df, (F.col("_n") == 4) & _is_int(3), "qrels_jg", validate)
    out = df.select(
        F.col("_f")[0].alias("qid"), F.col("_f")[1].alias("jg"), F.col("_f")[2].alias("docno"),
        F.col("_f")[3].cast("bigint").alias("rel"))
    if validate:
        dup = out.groupBy("qid", "jg", "docno").count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError("duplicate (qid, jg, docno) in qrels_jg")
    return out


def read_prefs(spark: SparkSession, path, validate: bool = True) -> DataFrame:
    """Preferences (qid, jg, jsg, docno, rel_level double)."""
    df = _lines(spark, path, comments=False).where(F.col("_n") > 0)
    df = _check(df, (F.col("_n") == 5) & _is_number(4), "prefs", validate)
    return df.select(
        F.col("_f")[0].alias("qid"), F.col("_f")[1].alias("jg"), F.col("_f")[2].alias("jsg"),
        F.col("_f")[3].alias("docno"), F.col("_f")[4].cast("double").alias("rel_level"))


def read_qrels_prefs(spark: SparkSession, path, validate: bool = True) -> DataFrame:
    """Qrels read as preferences: sub-group '0', level kept as a double
    (so -1 is a level below 0)."""
    df = _lines(spark, path)
    df = _check(df, (F.col("_n") == 4) & _is_int(3), "qrels", validate)
    return df.select(
        F.col("_f")[0].alias("qid"), F.col("_f")[1].alias("jg"), F.lit("0").alias("jsg"),
        F.col("_f")[2].alias("docno"), F.col("_f")[3].cast("double").alias("rel_level"))


def read_zscores(spark: SparkSession, path, validate: bool = True) -> DataFrame:
    """Z-score reference (qid, measure, mean, stddev)."""
    df = _lines(spark, path).where(F.col("_n") > 0)
    df = _check(df, (F.col("_n") == 4) & _is_number(2) & _is_number(3), "zscores", validate)
    return df.select(
        F.col("_f")[0].alias("qid"), F.col("_f")[1].alias("measure"),
        F.col("_f")[2].cast("double").alias("mean"), F.col("_f")[3].cast("double").alias("stddev"))
