"""Sinks: run files, evaluation tables, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_lines(run: DataFrame, tag_col: str = "run_id") -> DataFrame:
    """Six-column run lines ``qid Q0 docno rank score tag`` (rank from 1; scores,
    which searches round to six decimals, with six decimals)."""
    return run.select("qid", "rank", F.concat_ws(" ", "qid", F.lit("Q0"), F.trim("docno"), F.col("rank").cast("string"),
                                                 F.format_string("%.6f", F.col("sim")), F.col(tag_col)).alias("value"))


def write_run(run: DataFrame, path: str) -> None:
    """Write a run as text, range-partitioned and sorted by (qid, rank) so
    every output file is an ordered slice of the run."""
    lines = run_lines(run)
    n = int(run.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartitionByRange(n, "qid", "rank").sortWithinPartitions("qid", "rank")
          .select("value").write.mode("overwrite").text(path))


def eval_text(ev: DataFrame) -> DataFrame:
    """Evaluation rows with a 4-decimal text value (counts as integers)."""
    counts = ["num_q", "num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret",
              "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret"]
    txt = F.when(F.col("measure").isin(counts) | F.col("measure").isin([f"Z{c}" for c in counts]),
                 F.format_string("%d", F.round("value").cast("long"))) \
           .otherwise(F.format_string("%.4f", F.col("value")))
    return ev.withColumn("text", txt)


def write_eval(ev: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the long evaluation table (run_id, qid, measure, value, text)."""
    out = eval_text(ev)
    if fmt == "csv":
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").parquet(path)


def ranked(lb: DataFrame, measure: str = "map", digits: int = 4) -> DataFrame:
    """A leaderboard with ``place``, from 1: configurations that agree to ``digits`` decimals, as
    evaluations print them, share a place; the value is rounded to these."""
    value = F.round(F.coalesce(F.col(measure), F.lit(0.0)), digits)
    values = lb.select(value.alias(measure)).distinct()
    # one row per distinct value: bounded by the decimals
    values = values.withColumn("place", F.row_number().over(Window.orderBy(F.desc(measure))))
    return lb.withColumn(measure, value).join(F.broadcast(values), measure).select("place", *lb.columns)


def write_leaderboard(lb: DataFrame, path: str, measure: str = "map") -> None:
    """CSV ``config,<measure>`` sorted best first; equal places together, in the order of names."""
    key = lb.columns[0]
    (ranked(lb, measure).orderBy("place", F.asc(key)).select(*lb.columns).coalesce(1)
       .write.mode("overwrite").option("header", True).csv(path))
