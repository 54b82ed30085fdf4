"""Helpers shared by the operators: row keys, shared-folder tables, size checks, text slices."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A-Z to a-z, all other bytes unchanged (UTF-8 safe).
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the session's shared checkpoint folder.

    The folder is removed when the driver's JVM ends, as nothing can read
    lazily from it after that.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int, row_bytes: int = 64) -> bool:
    """Whether a materialized ``df`` has at most ``max_rows`` counted rows that
    also stay within 32 MB at ``row_bytes`` each."""
    n = df.count()
    return n <= max_rows and n * row_bytes <= 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int, row_bytes: int = 64) -> DataFrame:
    """Broadcast hint for ``df`` if :func:`is_small`; else ``df`` as it is, so
    that Spark plans a shuffled join (same rows)."""
    return F.broadcast(df) if is_small(df, max_rows, row_bytes) else df


def content_key(id_col: str, text_col: str) -> list[Column]:
    """Two long columns that name a document row by its content.

    Rows that agree on id and text share a key (they get the same treatment);
    nulls are kept apart from every value.  Computed from content alone, so a
    re-read of the same table after a failure gives the same keys.
    """
    i, t = F.col(id_col), F.col(text_col)
    flags = F.when(i.isNull(), 1).otherwise(0) + F.when(t.isNull(), 2).otherwise(0)
    return [F.xxhash64(flags, i.cast("string"), F.octet_length(t)).alias("_k1"),
            F.xxhash64(t, flags, i.cast("string")).alias("_k2")]


def slices(texts: list, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) ranges of ``texts`` (bytes or None) with about ``limit`` bytes
    each, so that word lists stay small whatever the Arrow batch holds."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def column_slices(column, limit: int = 2 << 20) -> Iterator[tuple[int, list]]:
    """(offset, Python values) of an Arrow string or binary column, about ``limit``
    bytes at a time, so that only a slice of a batch exists twice."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, column.slice(start).to_pylist()


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (models and word caches
    survive from one task to the next; losing it only costs time)."""
    return sys.modules.setdefault("_qrank_worker", types.ModuleType("_qrank_worker")).__dict__


def columns_of(batches: Iterable, *names: str) -> Iterator[tuple]:
    """Python lists of the named columns of each Arrow batch."""
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)
