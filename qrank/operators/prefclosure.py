"""Preference relations between classes of documents, and ordered pair counts.

Judge groups with several sub-groups prefer document a to document b when a
chain of sub-groups does.  Documents that have the same levels in the same
sub-groups form a class: they prefer the same documents.

The closure needs no pairs.  If a class is preferred to some document of level
b in sub-group s, it is preferred to every document below b in s, since that
document is.  So what a class reaches in a sub-group is "everything below a
threshold", and the closure is one threshold per (class, sub-group).  Between
sub-groups the thresholds move by a table (sub-group, level) -> (sub-group,
level): the highest level there of any class that is below the level here.
That table is closed by joining it with itself until nothing rises, each round
doubling the length of the chains; it has one row per level and sub-group, not
per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import shuffled, written
from . import pairblocks

GROUP = ["qid", "jg"]


def numbered(df: DataFrame, keys: list[str], by: str, out: str) -> DataFrame:
    """``df`` with ``out``, the number from 0 of each distinct ``by`` within ``keys``."""
    names = df.select(*keys, by).distinct()
    names = names.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(by)) - 1)
    return df.join(names, [*keys, by])


def document_classes(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno, vec, level, cls): each judged document's class in each judge group.

    ``vec`` holds its (jsg, rel_level) pairs in order, repeated rows once;
    ``level`` is that of its last sub-group.  A document at two levels of one
    sub-group, or at 0 in one and above 0 in another, ends the job.
    """
    docs = prefs.groupBy(*GROUP, "docno").agg(
        F.array_sort(F.collect_set(F.struct("jsg", F.col("rel_level").alias("level")))).alias("vec"))
    levels = F.col("vec.level")
    said = lambda what: F.raise_error(F.concat(
        F.lit("document "), "docno", F.lit(" of topic "), "qid", F.lit(", judge group "), "jg", F.lit(what)))
    two = F.size("vec") > F.size(F.array_distinct(F.col("vec.jsg")))
    mixed = F.exists(levels, lambda x: x == 0) & F.exists(levels, lambda x: x > 0)
    checked = F.when(two, said(" has two levels in one sub-group")).when(
        mixed, said(" has level 0 and a level above 0")).otherwise(F.col("vec"))
    return numbered(docs.withColumn("vec", checked), GROUP, "vec", "cls").withColumn("level", F.element_at("vec.level", -1))


def class_levels(classes: DataFrame) -> DataFrame:
    """(qid, jg, cls, jsg, level): the levels of each class."""
    return classes.select(*GROUP, "cls", "vec").distinct().select(
        *GROUP, "cls", F.explode("vec").alias("v")).select(*GROUP, "cls", "v.jsg", "v.level")


def lifts(levels: DataFrame) -> DataFrame:
    """(qid, jg, jsg, level, to_jsg, to_level), closed: whoever is preferred to all below
    ``level`` in ``jsg`` is preferred to all below ``to_level`` in ``to_jsg``.

    A chain that comes back to its sub-group at or above the level it left is
    a contradiction and ends the job.
    """
    nodes = levels.select(*GROUP, "jsg", "level").distinct()
    other = levels.select(*GROUP, "cls", F.col("jsg").alias("to_jsg"), F.col("level").alias("to_level"))
    met = levels.join(other, [*GROUP, "cls"]).where("jsg != to_jsg").groupBy(*GROUP, "jsg", "level", "to_jsg").agg(
        F.max("to_level").alias("to_level"))
    grid = nodes.join(met.select(*GROUP, "jsg", "to_jsg").distinct(), [*GROUP, "jsg"])
    below = Window.partitionBy(*GROUP, "jsg", "to_jsg").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    step = shuffled(written(
        grid.join(met, [*GROUP, "jsg", "level", "to_jsg"], "left")
        .withColumn("to_level", F.max("to_level").over(below)).where("to_level is not null"), "lifts"))
    while True:
        onward = step.select(*GROUP, F.col("jsg").alias("to_jsg"), F.col("level").alias("to_level"),
                             F.col("to_jsg").alias("last_jsg"), F.col("to_level").alias("last_level"))
        longer = step.join(onward, [*GROUP, "to_jsg", "to_level"]).select(
            *GROUP, "jsg", "level", F.col("last_jsg").alias("to_jsg"), F.col("last_level").alias("to_level"))
        back = (F.col("jsg") == F.col("to_jsg")) & (F.col("to_level") >= F.col("level"))
        said = F.raise_error(F.concat(F.lit("contradictory preferences in topic "), "qid", F.lit(", judge group "), "jg")).cast("boolean")
        longer = longer.where(F.when(back, said).otherwise(F.col("jsg") != F.col("to_jsg")))
        rise = step.withColumn("old", F.col("to_level")).unionByName(longer.withColumn("old", F.lit(None).cast("double")))
        rise = written(rise.groupBy(*GROUP, "jsg", "level", "to_jsg").agg(
            F.max("to_level").alias("to_level"), F.max("old").alias("old")), "lifts")
        step = shuffled(rise.drop("old"))
        if rise.where("old is null or to_level > old").isEmpty():
            return step


def thresholds(levels: DataFrame, several: bool = True) -> DataFrame:
    """(qid, jg, cls, jsg, below): a class is preferred to all documents of lower level than ``below`` in ``jsg``."""
    own = levels.withColumnRenamed("level", "below")
    if several:
        lifted = levels.join(lifts(levels), [*GROUP, "jsg", "level"]).select(
            *GROUP, "cls", F.col("to_jsg").alias("jsg"), F.col("to_level").alias("below"))
        own = own.unionByName(lifted).groupBy(*GROUP, "cls", "jsg").agg(F.max("below").alias("below"))
    return own


def preferred(levels: DataFrame, several: bool = True) -> DataFrame:
    """(qid, jg, u, v): every ordered pair of classes of which the first is preferred."""
    lower = levels.select(*GROUP, "jsg", F.col("cls").alias("v"), "level")
    return (thresholds(levels, several).withColumnRenamed("cls", "u").join(lower, [*GROUP, "jsg"])
            .where("level < below").select(*GROUP, "u", "v").distinct())


def ordered_pairs(docs: DataFrame, keys: list[str], classes: list[str], rank: Column, only: Column | None = None) -> DataFrame:
    """(keys, u, v, pr): for two classes of a group, how many documents of u stand before one of v.

    A ranking is cut into blocks of ``pairblocks.BLOCK`` places.  Inside a
    block, one task counts from running counts per class; a document is one row
    of one shuffle.  Between blocks only the sizes of their classes count: two
    blocks' numbers differ first at some binary digit, above which they agree,
    and the earlier has 0 there and the later 1.  So per digit and leading
    digits the classes in the first half are counted against those in the
    second.  ``only`` restricts the pairs (over columns ``u`` and ``v``); u and
    v are structs of the class columns.
    """
    at = docs.select(*keys, *classes, (rank.cast("long") - 1).alias("at")).dropna(subset=[*keys, "at"])
    at = at.withColumn("block", F.expr(f"at div {pairblocks.BLOCK}"))
    struct = T.StructType([at.schema[c] for c in classes])
    schema = T.StructType([*(at.schema[k] for k in keys), T.StructField("u", struct), T.StructField("v", struct), T.StructField("pr", T.LongType())])
    inside = (at.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "at")
              .mapInArrow(pairblocks.pairs_of_blocks(keys, classes), schema))
    if only is not None:
        inside = inside.where(only)
    digits = int(at.agg(F.max("block")).first()[0] or 0).bit_length()
    if not digits:  # every ranking is one block
        return inside
    sizes = at.groupBy(*keys, "block", F.struct(*classes).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    halves = sizes.select(*keys, "cls", "block", "n", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("digit"))
    halves = (halves.select(*keys, "cls", "n", "digit", F.expr("shiftright(block, digit + 1)").alias("node"),
                            F.expr("shiftright(block, digit) & 1").alias("late"))
              .groupBy(*keys, "digit", "node", "late", "cls").agg(F.sum("n").alias("n")))
    halves = shuffled(written(halves, "halves"))
    early = halves.where("late = 0").select(*keys, "digit", "node", F.col("cls").alias("u"), F.col("n").alias("nu"))
    late = halves.where("late = 1").select(*keys, "digit", "node", F.col("cls").alias("v"), F.col("n").alias("nv"))
    pairs = early.join(late, [*keys, "digit", "node"])
    if only is not None:
        pairs = pairs.where(only)
    pairs = pairs.select(*keys, "u", "v", (F.col("nu") * F.col("nv")).alias("pr")).unionByName(inside)
    return pairs.groupBy(*keys, "u", "v").agg(F.sum("pr").alias("pr"))
