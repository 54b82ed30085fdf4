"""First-fit-decreasing packing of token sequences with a tournament tree.

Documents are dealt at random into groups of about ``group_docs``.  Within a
group each document is cut every ``capacity`` ids; a full piece is a sequence
by itself.  The last pieces, longest first, go to the first open sequence with
room.  A tournament tree over the sequences' free room finds it: each inner
node holds the larger room of its children, so a search follows the leftmost
branch with enough room from the root.  Groups are independent tasks, so the
work is linear in the corpus and no task sees more than a group's lengths.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_slices
from .tokens import encoder

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


class Tournament:
    """Open bins in a complete binary tree of their free room."""

    def __init__(self, bins: int, capacity: int):
        self.half = 1
        while self.half < max(1, bins):
            self.half *= 2
        self.room = [capacity] * (2 * self.half)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``, whose room shrinks by it."""
        room, node = self.room, 1
        while node < self.half:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        leaf = node - self.half
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return leaf


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size (0 < size <= capacity); ties keep their order."""
    tree, placed = Tournament(len(sizes), capacity), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        leaf = tree.place(sizes[i])
        placed[i] = (leaf, capacity - tree.room[tree.half + leaf] - sizes[i])
    return placed


def token_lengths(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, crcs of each ``capacity`` ids[, ids]) of each row; null text is empty."""
    end = struct.pack("<I", end_id)
    step = 4 * capacity

    def encode(batches):
        enc = encoder(tokenizer_path)
        for b in batches:
            for lo, texts in column_slices(b.column(1)):
                got = [x + end for x in enc.encode([t or "" for t in texts])]
                out = [b.column(0).slice(lo, len(got)), b.column(2).slice(lo, len(got)),
                       pa.array([len(x) // 4 for x in got], pa.int64()),
                       pa.array([[zlib.crc32(x[i:i + step]) for i in range(0, len(x), step)] for x in got],
                                pa.list_(pa.int64()))]
                names = ["doc_id", "row", "n_tokens", "crcs"]
                if with_ids:
                    out.append(pa.array(got, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, row long, n_tokens long, crcs array<long>" + ", ids binary" * with_ids
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
            .mapInArrow(encode, schema))


def pack(lengths: DataFrame, n_docs: int, capacity: int = 2048, group_docs: int = 2048, seed: int = 7) -> DataFrame:
    """A row per piece of each row of ``token_lengths`` (columns of ``PIECES``).

    Every id lies in exactly one piece; pieces of a sequence stand without gap
    from offset 0.  Repeated rows, equal ids and null ids are packed as rows of
    their own.  Groups are dealt by a hash of id and row number, so equal ids
    spread too.  ``n_docs`` (a count) sets the number of groups; sequence ids
    are group * 2^40 + number within the group.
    """
    groups = max(1, -(-n_docs // group_docs))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        base = int(pdf["grp"].iloc[0]) << 40
        tails = [n % capacity for n in pdf["n_tokens"]]
        some = [i for i, t in enumerate(tails) if t]
        placed = dict(zip(some, first_fit_decreasing([tails[i] for i in some], capacity)))
        own = 1 + max((leaf for leaf, _ in placed.values()), default=-1)
        rows = []
        for i, (doc, n, crcs) in enumerate(zip(pdf["doc_id"], pdf["n_tokens"], pdf["crcs"])):
            doc = int(doc) if doc else None
            for k, crc in enumerate(crcs):
                size = min(capacity, n - k * capacity)
                if size == capacity:
                    at, own = (own, 0), own + 1
                else:
                    at = placed[i]
                rows.append((doc, k * capacity, size, crc, n, base + at[0], at[1]))
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in PIECES.split(", ")])
        return out.astype({"doc_id": "Int64"})

    dealt = lengths.select(F.col("doc_id").cast("string").alias("doc_id"), "row", "n_tokens", "crcs",
                           F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(fit, PIECES)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048,
                   group_docs: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every row of ``docs``; see :func:`pack`.  An empty table gives no piece;
    an empty or null text is a document of the end id alone."""
    n = docs.count()
    return pack(token_lengths(docs, tokenizer_path, end_id, capacity, id_col, text_col), n, capacity, group_docs)


def sequences(lengths_with_ids: DataFrame, pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """(sequence_id, n_ids, ids): the packed id sequences themselves, as uint32 bytes.

    ``lengths_with_ids`` needs a unique doc_id per row.  A sequence's pieces
    are at most ``capacity`` ids, so no group is unbounded.
    """
    parts = (pieces.join(lengths_with_ids.select("doc_id", "ids"), "doc_id")
             .select("sequence_id", "offset", "length",
                     F.substring("ids", (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int")).alias("ids")))
    return (parts.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_ids"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", "n_ids", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("hex"))
            .select("sequence_id", "n_ids", F.unhex("hex").alias("ids")))
