"""Token ids as length-delimited binary records with a separate offset index.

Record layout (all little-endian)::

    length   uint64   bytes of the payload
    check    uint32   masked CRC-32 of the eight length bytes
    payload           flag uint8 (1: id is null), id int64, width uint8, ids
    check    uint32   masked CRC-32 of the payload
    0x0A              record end

``width`` is 2 when every id of the vocabulary fits 16 bits, else 4.  A masked
checksum is the CRC rotated right by 15 bits plus 0xA282EAD8, so that a
checksum stored beside data it covers does not look like a checksum of it.

Records stand in ascending id order: over files by the number in their name,
and within each file.  Files are committed by Spark's own writer, so a lost
executor leaves no half file behind.  The index (Parquet) has a row per
record: file number, position, byte offset and length, ids before it in its
file; a reader can shuffle the index and fetch records by offset.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, column_slices, materialize
from .tokens import encoder

#: Fixed value of the record format (checksum masking).
MASK_DELTA = 0xA282EAD8
INDEX = ("part int, pos int, byte_offset long, byte_length long, doc_id long, n_tokens long, "
         "ids_crc32 long, before long")


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17 & 0xFFFFFFFF)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return b"".join((n, struct.pack("<I", masked(zlib.crc32(n))), payload,
                     struct.pack("<I", masked(zlib.crc32(payload))), b"\n"))


def frames(data: bytes) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record; ValueError where a checksum fails or the file is cut."""
    at, view = 0, memoryview(data)
    while at < len(view):
        head = bytes(view[at:at + 12])
        if len(head) < 12 or struct.unpack_from("<I", head, 8)[0] != masked(zlib.crc32(head[:8])):
            raise ValueError(f"bad record length at byte {at}")
        n = struct.unpack_from("<Q", head)[0]
        payload, end = view[at + 12:at + 12 + n], bytes(view[at + 12 + n:at + 17 + n])
        if len(end) < 5 or struct.unpack_from("<I", end)[0] != masked(zlib.crc32(payload)):
            raise ValueError(f"bad record payload at byte {at}")
        yield at, payload
        at += 17 + n


def pack_ids(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """Payload for ids given as uint32 bytes."""
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return struct.pack("<BqB", doc_id is None, doc_id or 0, width) + body


def unpack_ids(payload) -> tuple[int | None, np.ndarray]:
    null, doc_id, width = struct.unpack_from("<BqB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10).astype("<u4")


def read_at(data: bytes, byte_offset: int) -> tuple[int | None, np.ndarray]:
    """The record at an offset that the index names."""
    return unpack_ids(next(frames(memoryview(data)[byte_offset:]))[1])


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", file_bytes: int | None = None) -> None:
    """Encode every text and write its ids, in ascending id order, as records.

    Null text counts as empty (its record holds the end id alone); null ids
    come first; rows with equal ids keep their order in the table; no row is
    dropped.  Other columns are not read.  An empty table gives no record.

    The rows are range-partitioned by (id, row number), so that even one id
    with a third of all rows is split; ``file_bytes`` is the text that a
    file's records are made from (a single longer text gets a longer file).
    Without it that is 16 MB, more for a table of over 4,096 such files, and
    128 MB at most, as files are read back whole.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    d = d.withColumn("row", F.monotonically_increasing_id())
    file_bytes = file_bytes or min(128 << 20, max(16 << 20, total // 4096))
    parts = max(1, -(-total // file_bytes))
    ordered = d.repartitionByRange(parts, "id", "row").sortWithinPartitions(F.asc_nulls_first("id"), "row")
    end = struct.pack("<I", end_id)

    def encode(batches):
        enc = encoder(tokenizer_path)
        width = 2 if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo, texts in column_slices(b.column(1)):
                got = enc.encode([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([frame(pack_ids(i, x + end, width))[:-1] for i, x in zip(ids[lo:], got)],
                              pa.binary())],  # the writer adds the record end
                    ["value"])

    (ordered.select("id", "text").mapInArrow(encode, "value binary")
     .select(F.col("value").cast("string").alias("value"))  # the bytes as they are, valid UTF-8 or not
     .write.option("lineSep", "\n").option("compression", "none").text(path))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the files in ``path`` (columns of ``INDEX``), checksums verified."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select(F.regexp_extract("path", r"part-(\d+)-", 1).cast("int").alias("part"), "content"))

    def scan(batches):
        for b in batches:
            for part, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows, before = [], 0
                for pos, (at, payload) in enumerate(frames(data.as_buffer())):
                    doc_id, ids = unpack_ids(payload)
                    rows.append((part, pos, at, 17 + len(payload), doc_id, len(ids), zlib.crc32(ids.tobytes()), before))
                    before += len(ids)
                cols = list(zip(*rows)) or [[]] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i < 2 else pa.int64()) for i, c in enumerate(cols)],
                    [x.split()[0] for x in INDEX.split(", ")])

    # One file is one row and is bounded by file_bytes; few per task.
    return files.mapInArrow(scan, INDEX)


def build_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Write the offset index of the record files and return it."""
    scan_records(spark, path).write.parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all records before it, over all files.

    Files are added up in runs of 1,024, and the runs by themselves, so no
    window holds a row per file; the files' offsets are broadcast only if few.
    """
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("run", F.floor(F.col("part") / 1024))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = files.groupBy("run").agg(F.sum("n").alias("n")).select("run", before(Window.orderBy("run")).alias("base"))
    firsts = files.select("part", "run", before(Window.partitionBy("run").orderBy("part")).alias("inside")).join(runs, "run")
    firsts = materialize(firsts.select("part", (F.col("base") + F.col("inside")).alias("first")), "file-starts")
    return index.join(broadcast_if_small(firsts, 1_000_000, 16), "part").withColumn("start", F.col("first") + F.col("before")).drop("first")
