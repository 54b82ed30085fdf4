"""Prefix trie of conversations, rolled up by depth bands.

A node is a distinct sequence of first turns.  It is named by its depth and its
smallest member, the smallest conversation that begins with it; a conversation
*owns* the nodes that it names, which are a run at the end of its path.

Subtree totals come from a depth-band rollup.  Depths are cut into bands of
``HEIGHT``.  Inside a band each node adds its value to its ancestors of that
band only, at most ``HEIGHT`` rows for a conversation (values that take the same
path are summed on the way).  That completes the nodes of the lowest bands.  The
roots of all bands form a trie of their own, ``HEIGHT`` times flatter, which is
rolled up the same way; then each completed band root adds its total to its
ancestors in the band above.  A trie of depth D takes about log(D) / log(HEIGHT)
levels, and no step makes more than ``HEIGHT`` rows of one row.

Nothing is collected by key: turns are placed by a range sort, sums run over
pieces of bounded length whose totals are carried on, and the ids that end at a
node are joined in runs of bounded length before one task hashes them in order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Depths of a band: most rows that one row makes, and most rows of one window.
HEIGHT = 32
#: Turns of a conversation that are summed in one piece; ids that are joined to one text.
PIECE, RUN = 1024, 4096
#: A prefix is known by its length and the sums of four 32-bit hashes of its (place, turn) pairs.
KEY = ["s0", "s1", "s2", "s3"]


def place_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, at, turn_key, bytes): each turn's place in its conversation, from 1.

    Order is turn (null first), then role, then text.  The rows are sorted by
    range, so that a conversation of any length is spread over the partitions;
    the row numbers of its parts are added up afterwards.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("t"), role.alias("r"), text.alias("x"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.unhex(F.md5(F.concat(F.octet_length("r").cast("string"), F.lit(":"), F.col("r"), F.col("x")).cast("binary")))
    ordered = materialize(
        rows.repartitionByRange(n, F.col("c"), F.col("t").asc_nulls_first())
        .sortWithinPartitions(F.col("c"), F.col("t").asc_nulls_first(), "r", "x")
        .select("c", F.monotonically_increasing_id().alias("i"), key.alias("turn_key"), F.octet_length("x").cast("long").alias("bytes")),
        "turns").withColumn("p", F.shiftright("i", 33))
    parts = ordered.groupBy("c", "p").agg(F.min("i").alias("lo"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("c", "p", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo") + 1).alias("shift"))
    return ordered.join(parts, ["c", "p"]).select("c", (F.col("i") + F.col("shift")).alias("at"), "turn_key", "bytes")


def rebuild(placed: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(c, at, turn_key, bytes) of every rebuilt conversation.

    Conversation c takes the first h turns of conversation c - c % ``group``
    and goes on with its own turns after its first h; h is the unsigned crc32
    of the decimal c modulo ``most``.
    """
    base, h = F.col("c") - F.col("c") % group, F.crc32(F.col("c").cast("string").cast("binary")) % most
    sizes = placed.groupBy("c").agg(F.max("at").alias("n"))
    wanted = sizes.select("c", base.alias("base"), h.alias("h"))
    had = sizes.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    wanted = materialize(wanted.join(had, "base", "left").select(
        "c", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "rebuilt")
    heads = placed.where((F.col("at") < most) & (F.col("c") % group == 0)).withColumnRenamed("c", "base")
    heads = heads.join(wanted.where("taken > 0"), "base").where("at <= taken").select("c", "at", "turn_key", "bytes")
    own = placed.join(wanted.select("c", "h", "taken"), "c").where("at > h").select(
        "c", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "turn_key", "bytes")
    return heads.union(own)


def prefix_keys(turns: DataFrame) -> DataFrame:
    """(c, at, s0..s3, bytes): the sums over a conversation's first ``at`` turns."""
    halves = [e for a in (F.xxhash64("at", "turn_key"), F.xxhash64("turn_key", "at"))
              for e in (a.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(a, 32))]
    turns = turns.select("c", "at", "bytes", F.floor((F.col("at") - 1) / PIECE).alias("piece"), *(e.alias(k) for e, k in zip(halves, KEY)))
    inside = Window.partitionBy("c", "piece").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = turns.select("c", "at", "bytes", "piece", *(F.sum(k).over(inside).alias(k) for k in KEY))
    before = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (turns.groupBy("c", "piece").agg(*(F.sum(k).alias(k) for k in KEY))
               .select("c", "piece", *(F.sum(k).over(before).alias("b" + k) for k in KEY)).where("piece > 0"))
    return summed.join(carried, ["c", "piece"], "left").select(
        "c", "at", "bytes", *((F.col(k) + F.coalesce("b" + k, F.lit(0))).alias(k) for k in KEY))


def subtree_totals(path: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """(rep, d, *values): sums over the subtree of each node.

    ``path`` holds (c, d, rep) for every depth d from 0 of each conversation
    that owns a node, and the values of the nodes that it owns (rep = c, else 0).
    """
    band = F.floor(F.col("d") / height).alias("band")
    deeper = Window.partitionBy("c", "band").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = path.select("c", "d", "rep", band, *values)
    inside = (rows.select("rep", "d", *(F.sum(v).over(deeper).alias(v) for v in values))
              .where(" or ".join(f"{v} <> 0" for v in values))
              .groupBy("rep", "d").agg(*(F.sum(v).alias(v) for v in values)))
    deepest = path.agg(F.max("d")).first()[0]
    if deepest is None or deepest < height:
        return inside
    inside = materialize(inside, "bands")
    heads = path.where(F.col("d") % height == 0).select("c", "d", "rep")
    mine = inside.where(F.col("d") % height == 0).withColumn("c", F.col("rep"))
    flat = materialize(heads.join(mine, ["c", "d", "rep"], "left").select(
        "c", (F.col("d") / height).cast("long").alias("d"), "rep", *(F.coalesce(v, F.lit(0)).alias(v) for v in values)), "band-roots")
    done = subtree_totals(flat, values, height)
    above = (done.where("d > 0").select(F.col("rep").alias("c"), (F.col("d") - 1).alias("band"), *values)
             .join(rows.select("c", "d", "rep", "band"), ["c", "band"]).select("rep", "d", *values))
    return inside.select("rep", "d", *values).union(above).groupBy("rep", "d").agg(*(F.sum(v).alias(v) for v in values))


def _hash_runs(batches):
    """sha256 of each node's texts in a row, comma-joined; rows sorted by node."""
    node, h = None, None
    for b in batches:
        out = []
        for rep, depth, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            if (rep, depth) != node:
                if node is not None:
                    out.append((*node, h.hexdigest()))
                node, h = (rep, depth), hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
        yield _ends(out)
    if node is not None:
        yield _ends([(*node, h.hexdigest())])


def _ends(rows) -> pa.RecordBatch:
    rep, depth, digest = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())],
                                      ["conv_id", "depth", "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes (conv_id, depth) where ids ``c`` end.

    Ids are joined in ascending runs of at most ``RUN`` values of id; nodes of
    several runs are hashed run by run, as a hash has to be, in one row's memory.
    """
    runs = (ends.groupBy("conv_id", "depth", F.floor(F.col("c") / RUN).alias("run"))
            .agg(F.concat_ws(",", F.sort_array(F.collect_list("c")).cast("array<string>")).alias("ids")))
    runs = materialize(runs, "ends")
    many = runs.groupBy("conv_id", "depth").agg(F.count(F.lit(1)).alias("n"))
    one = runs.join(many.where("n = 1"), ["conv_id", "depth"]).select("conv_id", "depth", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    more = (runs.join(many.where("n > 1"), ["conv_id", "depth"]).repartition("conv_id", "depth")
            .sortWithinPartitions("conv_id", "depth", "run").select("conv_id", "depth", "ids")
            .mapInArrow(_hash_runs, "conv_id long, depth long, ends_sha256 string"))
    return one.union(more)


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", group: int = 5, most: int = 9, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see :func:`rebuild`).

    conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves (childless nodes in the subtree),
    saved_tokens (sum over the subtree of (n_convs - 1) times the UTF-8 bytes of
    the last text) and ends_sha256 (of the ids that end at the node).

    Null role and text are empty.  Equal turn numbers are ordered by role, then
    text; repeated rows are turns of their own.  Rows without a conversation id
    belong to none and are left out; a rebuilt conversation without turns is a
    member of the root alone.  An empty table has no nodes.  Other columns are
    not read.
    """
    spark = conversations.sparkSession
    placed = materialize(place_turns(conversations, id_col, turn_col, role_col, text_col), "placed")
    all_ids = placed.select("c").distinct()
    least, members = all_ids.agg(F.min("c"), F.count(F.lit(1))).first()
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved_tokens long, ends_sha256 string")
    if not members:
        return spark.createDataFrame([], schema)
    keyed = materialize(prefix_keys(rebuild(placed, group, most)), "prefixes")
    node = keyed.groupBy("at", *KEY).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("n_convs"))
    # a common first turn is a skewed join key that adaptive execution splits
    path = materialize(keyed.join(node, ["at", *KEY]).select("c", "at", "rep", "n_convs", "bytes"), "paths")
    steps = path.select("c", (F.col("at") + 1).alias("at"), F.col("rep").alias("parent"))
    owned = path.where("rep = c").join(steps, ["c", "at"], "left").select(
        "c", "at", F.coalesce("parent", F.lit(least)).alias("parent"), "n_convs", "bytes")
    children = owned.groupBy(F.col("parent").alias("c"), (F.col("at") - 1).alias("at")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(
        owned.join(children, ["c", "at"], "left").select(
            "c", "at", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")), "nodes")
    values = ["n_leaves", "saved_tokens"]
    owners = nodes.select("c").distinct()
    steps = materialize(
        path.join(owners, "c", "left_semi").join(nodes.select("c", "at", *values), ["c", "at"], "left")
        .select("c", (F.col("at") - 1).alias("d"), "rep", *(F.when(F.col("rep") == F.col("c"), F.col(v)).otherwise(0).alias(v) for v in values)),
        "values")
    totals = subtree_totals(steps, values, height).select(F.col("rep").alias("c"), (F.col("d") + 1).alias("at"), *values)
    ended = path.groupBy("c").agg(F.max(F.struct("at", "rep")).alias("e"))
    ended = all_ids.join(ended, "c", "left").select(
        F.coalesce("e.rep", F.lit(least)).alias("conv_id"), F.coalesce("e.at", F.lit(0)).cast("long").alias("depth"), "c")
    below = materialize(nodes.drop(*values).join(totals, ["c", "at"], "left").select(
        F.col("c").alias("conv_id"), F.col("at").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        *(F.coalesce(v, F.lit(0)).alias(v) for v in values)), "totals")
    tops = below.where("depth = 1")
    root = tops.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values)).select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(members).cast("long").alias("n_convs"), F.col("n").alias("n_children"),
        F.when(F.col("n") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), "saved_tokens")
    out = root.union(below).join(end_hashes(ended), ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))

