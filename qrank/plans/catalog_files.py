"""Registered evaluation-file readers: files are written from the fixtures and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import measures as M
from ..operators.judge import EvalOptions
from ..operators.groups import evaluate_group
from ..sources import fixtures as fx
from ..sources import runfiles as R
from .registry import r6, register
from .tables import shared_path


def _o(name, *args, **kw):
    def o():
        from checks import oracle_files as OF
        return getattr(OF, name)(*args, **kw)
    return o


def text_files(rows: DataFrame, line: Column, order: list[str], head: str = "# a comment\n", compression: str = "none") -> str:
    """A folder of text files with one line per row, behind ``head`` in each part."""
    path = shared_path(rows.sparkSession, "files")
    lines = rows.select(line.alias("value"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(order)))
    lines = lines.repartitionByRange(4, *(f"_{i}" for i in range(len(order)))).sortWithinPartitions(*(f"_{i}" for i in range(len(order))))
    tagged = lines.withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    tagged.select(F.when(F.col("_at") == 0, F.concat(F.lit(head), "value")).otherwise(F.col("value")).alias("value")) \
        .write.option("compression", compression).text(path)
    return path


def spaced(*cols) -> Column:
    return F.concat_ws(" \t", *(c if isinstance(c, Column) else F.col(c).cast("string") for c in cols))


@register("read_run", _o("run_sql"))
def q_read_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files, gzip-compressed."""
    rows = fx.runs(spark, sf_dir)
    path = text_files(rows, spaced("qid", F.lit("Q0"), "docno", F.lit("7"), "sim", "run_id", F.lit("more")), ["run_id", "qid", "docno"],
                      "# a comment\n  \n", "gzip")
    return R.read_run(spark, path)


@register("read_qrels", _o("qrels_sql"))
def q_read_qrels(spark, sf_dir):
    path = text_files(fx.qrels(spark, sf_dir), spaced("qid", F.lit("0"), "docno", "rel"), ["qid", "docno"])
    return R.read_qrels(spark, [path])


@register("read_qrels_jg", _o("qrels_jg_sql"))
def q_read_qrels_jg(spark, sf_dir):
    path = text_files(fx.qrels_jg(spark, sf_dir), spaced("qid", "jg", "docno", "rel"), ["qid", "jg", "docno"], compression="bzip2")
    return R.read_qrels_jg(spark, path)


@register("read_prefs", _o("prefs_sql"))
def q_read_prefs(spark, sf_dir):
    path = text_files(fx.prefs(spark, sf_dir), spaced("qid", "jg", "jsg", "docno", "rel_level"), ["qid", "jg", "jsg", "docno"], " \n")
    return R.read_prefs(spark, path)


@register("read_qrels_prefs", _o("qrels_prefs_sql"))
def q_read_qrels_prefs(spark, sf_dir):
    path = text_files(fx.qrels_jg(spark, sf_dir), spaced("qid", "jg", "docno", "rel"), ["qid", "jg", "docno"])
    return R.read_qrels_prefs(spark, path)


@register("read_zscores", _o("zscores_sql"))
def q_read_zscores(spark, sf_dir):
    """The z-score reference of the three runs, written with six decimals and read back."""
    from .catalog_eval import _zref
    z = _zref(spark, sf_dir)
    number = lambda c: F.format_string("%.6f", F.round(c, 6))
    path = text_files(z, spaced("qid", "measure", number("mean"), number("stddev")), ["qid", "measure"], "\n# a comment\n")
    return R.read_zscores(spark, path)


@register("m_runid", _o("runid_sql"))
def q_runid(spark, sf_dir):
    """The tag on the last line of each run file; the lines of a run carry different tags."""
    runs = fx.runs(spark, sf_dir)
    tag = F.concat_ws("_", "run_id", (F.substring("docno", 2, 9).cast("int") % 5).cast("string"))
    lines = runs.select(spaced("qid", F.lit("Q0"), "docno", F.lit("1"), "sim", tag).alias("value"), "run_id", "qid", "docno")
    path = shared_path(spark, "runs")
    lines.repartition("run_id").sortWithinPartitions("run_id", "qid", "docno").select("value", "run_id").write.partitionBy("run_id").text(path)
    tags = R.last_run_tag(spark, f"{path}/*/*")
    return tags.select(F.regexp_extract("run_id", "run_id=([^/]+)/", 1).alias("run_id"), F.col("tag").alias("runid"))


#: A gain table beside the levels themselves.
GAINS = {1: 2.0, 2: 5.0, 3: 9.0}


@register("m_gains", _o("gains_sql", GAINS))
def q_gains(spark, sf_dir):
    """Gain measures under a gain table for the levels."""
    ev = M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), ["dcg", "ndcg", "ideal_dcg", "ndcg_rel", "Rndcg", "G"], EvalOptions(gains=GAINS))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("eval_one_topic", _o("one_topic_sql", "7"))
def q_one_topic(spark, sf_dir):
    """The official measures of a single topic."""
    ev = M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), M.OFFICIAL, EvalOptions(topic="7"))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("eval_group_set", _o("group_set_sql"))
def q_group_set(spark, sf_dir):
    """The named group of set measures."""
    ev = evaluate_group(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), "set")
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("leaderboard", _o("leaderboard_sql"))
def q_leaderboard(spark, sf_dir):
    """Runs by MAP to four decimals, equal ones in one place; a copy of a run under another tag ties with it."""
    from ..sinks import ranked
    from .sweep import leaderboard
    runs = fx.runs(spark, sf_dir)
    runs = runs.unionByName(runs.where("run_id = 'runB'").withColumn("run_id", F.lit("runD")))
    return ranked(leaderboard(M.evaluate(runs, fx.qrels(spark, sf_dir), ["map"], per_topic=False)))


@register("m_params", _o("params_sql"))
def q_params(spark, sf_dir):
    """Measures with parameters of their own, and a collection size for the utility of what was not retrieved."""
    specs = [("utility", (2.0, -1.0, 0.5, -0.25)), ("set_F", (3.0,)), ("rbp", (0.5,)), ("rbp_resid", (0.5,))]
    ev = M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), specs, EvalOptions(num_docs_in_coll=50_000))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))
