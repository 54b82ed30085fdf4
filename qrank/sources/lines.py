"""Lines of text files with a place that survives re-execution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.sizing import bounded_broadcast
from ..plans.tables import written


def placed_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_no, value): the lines of all files, numbered from 0 in file order.

    A line's place is its file, the start of its split and its order there, so
    the numbers do not depend on how files are cut into splits or packed into
    tasks.  The lines are written once, because the order inside a split is
    that of one reading; splits are counted, and a line's number is its
    split's offset plus its place in it.
    """
    df = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                      F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    df = written(df, "lines")
    splits = df.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = splits.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return df.join(bounded_broadcast(splits, 1_000_000), ["file", "start"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "value")
