"""Chat records: tool calls linked to their results, ordered, checked and serialised.

DataFrame functions only.  Calls and results meet by a hash join on
(conversation, identifier) after each side is reduced to one row per
identifier, so an identifier that a third of all rows share never makes pairs.
The order follows the reference from a call to the call whose result it needs:
depths come from pointer doubling (each round joins every call with the call
that its pointer names and doubles its reach), so a conversation of n calls in
one chain takes log2(n) rounds and no conversation is collected.  Positions
come from a range-partitioned sort and per-partition counts, not from a window
over a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize

#: Depth of calls whose references run in a circle: they stand last.
CIRCLE = (1 << 31) - 1
#: Bytes of arguments up to which they are parsed at once: Spark's JSON functions end at strings of
#: 20 million characters, and a parsed text takes at most about three times its own length.
PARSED = 4 << 20
#: Bytes of arguments that fit a variant (128 MiB) whatever they hold, and how longer ones than ``PARSED`` are read.
WHOLE = 40 << 20
LONG = {"maxStringLen": str((1 << 31) - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def depths(calls: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(conv_id, call_id, depth) from (conv_id, call_id, parent_id), one row per identifier.

    A call without a parent, with an unknown one or with itself as parent has
    depth 0; a call on or behind a circle has depth ``CIRCLE``.
    """
    up = calls.select("conv_id", F.col("call_id").alias("parent_id"))
    linked = (calls.where(F.col("parent_id") != F.col("call_id")).select("conv_id", "call_id", "parent_id")
              .join(up, ["conv_id", "parent_id"], "left_semi").select("conv_id", "call_id", F.col("parent_id").alias("jump")))
    cur = materialize(calls.select("conv_id", "call_id").join(linked, ["conv_id", "call_id"], "left")
                      .withColumn("depth", F.when(F.col("jump").isNull(), 0).otherwise(1).cast("long")), "depths")
    n = cur.count()
    for k in range(max_rounds):
        if cur.where(F.col("jump").isNotNull()).isEmpty() or 1 << k > max(1, n):
            break
        far = cur.select("conv_id", F.col("call_id").alias("jump"), F.col("jump").alias("next"), F.col("depth").alias("more"))
        moved = (cur.where(F.col("jump").isNotNull()).join(far, ["conv_id", "jump"])
                 .select("conv_id", "call_id", F.col("next").alias("jump"), (F.col("depth") + F.col("more")).alias("depth")))
        cur = materialize(moved.unionByName(cur.where(F.col("jump").isNull())), "depths")
    return cur.select("conv_id", "call_id", F.when(F.col("jump").isNull(), F.col("depth")).otherwise(CIRCLE).alias("depth"))


def quoted(text: Column) -> Column:
    """A text of any length as a JSON string; null as ``null``."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def record(**parts: Column) -> Column:
    """A JSON object of ready JSON texts, given in the order of their names."""
    pairs = [x for i, (k, v) in enumerate(parts.items()) for x in (F.lit(f'{"," if i else "{"}"{k}":'), v)]
    return F.concat(*pairs, F.lit("}")).alias("record")


def tool_rules(tools: DataFrame) -> DataFrame:
    """(name, _rules): a map of field to rule per tool.  Rows without a tool or field name say
    nothing; of several rules for one field the first by type, required, low and high counts."""
    one = (tools.where("name is not null and field is not null").groupBy("name", "field")
           .agg(F.min(F.struct("type", "required", "low", "high")).alias("rule")))
    return one.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("field", "rule"))).alias("_rules"))


def validate(calls: DataFrame, tools: DataFrame, whole: bool = False) -> DataFrame:
    """``calls`` with ``canonical`` (sorted keys, no spaces; null: not a JSON object) and ``errors``.

    ``tools``: (name, field, type, required, low, high), types string, integer,
    number, boolean (any other: every value fits); low and high bound numbers,
    and the length of strings.  Names may hold any character; see
    :func:`tool_rules` for null and repeated ones.  ``errors`` is a sorted array
    of texts: ``json`` for arguments that are no JSON object, ``tool`` for an
    unknown tool, else ``missing:f``, ``type:f``, ``range:f``, ``unknown:f``.
    Arguments of more than ``PARSED`` bytes are not parsed: their only error is
    ``size``, and ``canonical`` holds their whole text as one JSON string.  With
    ``whole`` they are parsed as well; ``size`` is then left for arguments of
    more than ``WHOLE`` bytes that Spark cannot hold parsed (or that are no JSON).
    The tools are one row per tool after aggregation, broadcast where their
    counted size allows.
    """
    rules = materialize(tool_rules(tools), "tools")
    large = F.coalesce(F.octet_length("arguments") > PARSED, F.lit(False))
    d = calls.withColumn("_large", large).withColumn("_v", F.when(~large, F.try_parse_json("arguments")))
    if whole:
        d = d.withColumn("_v", F.when(large, F.from_json("arguments", "variant", LONG)).otherwise(F.col("_v")))
        d = d.withColumn("_large", large & (F.octet_length("arguments") > WHOLE) & F.col("_v").isNull())
    d = (d
         .withColumn("canonical", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.to_json("_v")))
         .join(broadcast_if_small(rules, 100_000, 256), "name", "left")
         .withColumn("_raw", F.from_json("canonical", "map<string,string>", LONG))
         .withColumn("_fields", F.when(F.col("canonical").isNotNull(), F.try_variant_get("_v", F.lit("$"), "map<string,variant>"))))

    def check(field, rule):
        value = F.try_element_at("_fields", field)
        kind, text = F.schema_of_variant(value), F.try_element_at("_raw", field)
        string, number = kind == "STRING", F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"), text.try_cast("double"))
        fits = F.when(rule["type"] == "string", string).when(rule["type"] == "boolean", kind == "BOOLEAN") \
            .when(rule["type"] == "integer", number.isNotNull() & (number == F.floor(number))) \
            .when(rule["type"] == "number", number.isNotNull()).otherwise(True)
        size = F.when(rule["type"] == "string", F.length(text).cast("double")).otherwise(number)
        inside = F.coalesce(size >= rule["low"], F.lit(True)) & F.coalesce(size <= rule["high"], F.lit(True))
        return F.when(value.isNull(), F.when(rule["required"], F.concat(F.lit("missing:"), field))) \
            .when(~F.coalesce(fits, F.lit(False)), F.concat(F.lit("type:"), field)) \
            .when(~inside, F.concat(F.lit("range:"), field))

    known = F.transform(F.map_entries("_rules"), lambda e: check(e["key"], e["value"]))
    extra = F.transform(F.array_except(F.map_keys("_raw"), F.map_keys("_rules")), lambda f: F.concat(F.lit("unknown:"), f))
    errors = F.when(F.col("_large"), F.array(F.lit("size"))).when(F.col("canonical").isNull(), F.array(F.lit("json"))) \
        .when(F.col("_rules").isNull(), F.array(F.lit("tool"))).otherwise(F.array_sort(F.array_compact(F.concat(known, extra))))
    canonical = F.when(F.col("_large"), quoted(F.col("arguments"))).otherwise(F.col("canonical"))
    return d.withColumn("errors", errors).withColumn("canonical", canonical).drop("_rules", "_raw", "_v", "_fields", "_large")


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``position``, from 0 in each group by ``order`` (nulls first).

    A range-partitioned sort is written once; a row's place is its partition's
    offset plus its place there, less the first place of its group.
    """
    keys = [group, *order]
    ranged = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    placed = (ranged.withColumn("_part", part).join(F.broadcast(offset), "_part")
              .withColumn("_at", F.col("_off") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_off"))
    first = placed.groupBy(F.col(group).alias("_group")).agg(F.min("_at").alias("_first"))
    return (placed.join(first, F.col(group).eqNullSafe(F.col("_group")))
            .withColumn("position", F.col("_at") - F.col("_first")).drop("_at", "_first", "_group"))


def format_chat(calls: DataFrame, results: DataFrame, tools: DataFrame, messages: DataFrame | None = None,
                whole: bool = False) -> DataFrame:
    """A row per call, per result and per message, in order: conv_id, position, kind, call_id, turn,
    depth, status, errors, record.

    calls: (conv_id, turn, call_id, parent_id, name, arguments); results:
    (conv_id, turn, call_id, content); messages, turns that are neither:
    (conv_id, turn, role, content).  Wholly repeated rows count once.  Of
    calls (results) with one identifier in a conversation the first by turn is
    linked and others have status ``duplicate``; a call without a result has
    status ``no_result``, a result without a call ``no_call``, linked ones
    ``linked``; rows with a null conversation or identifier link to nothing
    (status ``no_id``).  A message waits for nothing: depth 0, no identifier,
    status ``message`` (``no_id`` with a null conversation).  A result has its
    call's depth and stands behind it; order: depth, turn, call before message
    before result, identifier.  ``errors`` joins the argument errors with
    commas (results and messages: empty).  ``record`` is canonical
    JSON: keys sorted at every level, no spaces; it holds every content whole,
    and the arguments as an object, null where they are no JSON object, or one
    string where they are too long to parse (error ``size``; ``whole`` as in
    :func:`validate`).  Empty tables give no rows; other columns are not read.
    """
    c = calls.select("conv_id", "turn", "call_id", "parent_id", "name", "arguments").distinct()
    r = results.select("conv_id", "turn", "call_id", "content").distinct()
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    key = ["conv_id", "call_id"]
    c = materialize(validate(c, tools, whole), "calls")
    first_call = c.where(named).groupBy(key).agg(F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("call"))
    first_result = r.where(named).groupBy(key).agg(F.min(F.struct("turn", "content")).alias("result"))
    linked = materialize(first_call.join(first_result, key, "full"), "links")
    depth = depths(linked.where("call is not null").select(*key, F.col("call.parent_id").alias("parent_id")))
    facts = materialize(linked.select(*key, "call", "result").join(depth, key, "left"), "facts")

    def status(mine, other, missing):
        return F.when(~named, "no_id").when(~mine, "duplicate").when(other.isNull(), missing).otherwise("linked")

    same_call = F.struct("turn", "name", "arguments", "parent_id").eqNullSafe(F.col("call"))
    call_rows = (c.join(facts, key, "left").withColumn("status", status(same_call, F.col("result"), "no_result"))
                 .select("conv_id", F.lit("call").alias("kind"), "call_id", "turn", "depth", "status",
                         F.array_join("errors", ",").alias("errors"),
                         record(arguments=F.coalesce("canonical", F.lit("null")), id=quoted(F.col("call_id")), name=quoted(F.col("name")),
                                result=quoted(F.when(F.col("status") == "linked", F.col("result.content"))), type=F.lit('"call"'),
                                valid=(F.size("errors") == 0).cast("string"))))
    same_result = F.struct("turn", "content").eqNullSafe(F.col("result"))
    result_rows = (r.join(facts, key, "left").withColumn("status", status(same_result, F.col("call"), "no_call"))
                   .select("conv_id", F.lit("result").alias("kind"), "call_id", "turn", "depth", "status", F.lit("").alias("errors"),
                           record(content=quoted(F.col("content")), id=quoted(F.col("call_id")), type=F.lit('"result"'))))
    rows = call_rows.unionByName(result_rows)
    if messages is not None:
        m = messages.select("conv_id", "turn", "role", "content").distinct()
        rows = rows.unionByName(m.select(
            "conv_id", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), "turn",
            F.lit(0).cast("long").alias("depth"), F.when(F.col("conv_id").isNull(), "no_id").otherwise("message").alias("status"),
            F.lit("").alias("errors"), record(content=quoted(F.col("content")), role=quoted(F.col("role")), type=F.lit('"message"'))))
    rows = rows.withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    placed = positions(rows, "conv_id", ["depth", "turn", "kind", "call_id", "record"])
    return placed.select("conv_id", "position", "kind", "call_id", "turn", "depth", "status", "errors", "record")
