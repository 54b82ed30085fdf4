"""Size checks that guard broadcast joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written


#: Largest table that is broadcast, whatever its row count.
MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` takes: 8 for a number, the text's own length else."""
    numbers = ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint", "date", "timestamp")
    size = F.lit(16 + 8 * len(df.columns))
    for c, kind in df.dtypes:
        if kind not in numbers:
            size = size + F.coalesce(F.octet_length(F.col(c) if kind in ("string", "binary") else F.to_json(F.struct(c))), F.lit(0))
    return size


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and ``max_bytes`` bytes.

    The side is written to the shared folder and measured there; beyond either
    bound the plain table is returned and Spark plans a shuffle join.
    """
    df = written(df, "side")
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a written table has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def sequential_index(df: DataFrame, order_col: str, out: str = "idx") -> DataFrame:
    """1-based position of each row in ``order_col`` order, where
    ``order_col`` comes from ``monotonically_increasing_id`` (partition id in
    the upper bits).  Uses per-partition counts and offsets, never a
    single-partition window over the rows."""
    part = F.shiftright(F.col(order_col), 33)
    d = df.withColumn("_part", part)
    counts = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    from pyspark.sql import Window
    w_all = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w_all), F.lit(0))).select("_part", "_off")
    w = Window.partitionBy("_part").orderBy(order_col)
    return (d.join(F.broadcast(offs), "_part")  # one row per input partition
             .withColumn(out, F.col("_off") + F.row_number().over(w)).drop("_part", "_off"))
