"""Removal of lines that spread over many sites.

Each line hash gets a HyperLogLog sketch of its sites; sketches merge by
aggregation, so a line with a third of all rows is pre-aggregated before the
shuffle.  A line whose estimate lies clearly over the threshold is boilerplate,
clearly under it is not, and lines near it get an exact distinct count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, content_key, materialize

#: Sketch precision: 2^12 registers, a relative standard error of 1.6 %.
LG_K = 12


def near_band(min_sites: int, sigmas: float = 4.0) -> tuple[float, float]:
    """Estimates strictly between these need an exact count."""
    slack = max(1.0, sigmas * 1.04 / math.sqrt(1 << LG_K) * min_sites)
    return min_sites - slack, min_sites + slack


def numbered_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    r"""(_k1, _k2, doc_id, site, pos, line hash pair) of each \n-split line with a word."""
    d = docs.select(*content_key(id_col, text_col), F.col(id_col).cast("long").alias("doc_id"),
                    F.col(site_col).cast("string").alias("site"), F.split(F.col(text_col), "\n", -1).alias("lines"))
    return (d.select("_k1", "_k2", "doc_id", "site", F.posexplode_outer("lines").alias("pos", "line"))
            .where(F.trim(F.translate("line", "\t\r\x0b\x0c", "    ")) != "")
            .select("_k1", "_k2", "doc_id", "site", "pos", F.xxhash64("line").alias("h"),
                    F.hash("line", F.octet_length("line")).alias("h2")))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """(h, h2, first_id) of the lines on at least ``min_sites`` distinct sites (null is no site)."""
    low, high = near_band(min_sites)
    stats = materialize(
        lines.groupBy("h", "h2").agg(F.hll_sketch_agg(F.col("site"), F.lit(LG_K)).alias("sketch"),
                                     F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .where(F.col("n") >= min_sites)  # a line needs as many rows as sites
        .select("h", "h2", "first_id", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") > low),
        "line-spread")
    near = stats.where(F.col("sites") < high)
    exact = (lines.select("h", "h2", "site").where(F.col("site").isNotNull())
             .join(broadcast_if_small(materialize(near.select("h", "h2", "first_id"), "near-lines"), 500_000, 32), ["h", "h2"])
             .groupBy("h", "h2", "first_id", "site").agg(F.lit(1).alias("one"))
             .groupBy("h", "h2", "first_id").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    return stats.where(F.col("sites") >= high).select("h", "h2", "first_id").union(exact.select("h", "h2", "first_id"))


def dedup_lines(docs: DataFrame, min_sites: int = 4, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source", keep_first: bool = True, counts: bool = False) -> DataFrame:
    r"""``docs`` with cross-site lines taken out of ``text_col``; no row is dropped.

    A line is the text between two \n, compared whole.  A line on at least
    ``min_sites`` distinct sites is removed everywhere, but with ``keep_first``
    its first place in the document of smallest id stays, so that of many
    copies one remains.  Lines without a word are never removed.  Null text
    stays null, a text that loses all lines becomes empty, a null site counts
    as no site, a null id comes after all others (a line of null ids alone
    keeps no first place).  Rows that agree on id and text are treated alike;
    rows of one id with different texts each keep the line's first place.
    Other columns pass through.  ``counts`` adds n_lines and n_removed.
    """
    lines = numbered_lines(docs, id_col, text_col, site_col)
    spread = materialize(boilerplate(lines, min_sites), "boilerplate")
    hit = lines.join(broadcast_if_small(spread, 500_000, 32), ["h", "h2"])
    mine = F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull() & F.lit(keep_first)
    first = F.min(F.struct("pos"))
    per_line = hit.groupBy("_k1", "_k2", "h", "h2", mine.alias("mine")).agg(
        first.alias("first"), F.collect_set("pos").alias("at"))  # bounded by one document's lines
    gone = (per_line.select("_k1", "_k2", F.when(F.col("mine"), F.array_remove("at", F.col("first.pos"))).otherwise(F.col("at")).alias("at"))
            .groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("at")).alias("_gone")))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *content_key(id_col, text_col))
    joined = keyed.join(gone, ["_k1", "_k2"], "left")
    text = F.col("_row").getField(text_col)
    parts = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    cut = F.when(F.col("_gone").isNull() | (F.size("_gone") == 0), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(F.col("_parts"), i + 1)), "\n"))
    out = joined.withColumn("_parts", F.when(F.size("_gone") > 0, parts)).withColumn("_text", cut)
    cols = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    if counts:
        cols += [F.coalesce(F.when(text.isNotNull(), F.size(parts)), F.lit(0)).cast("long").alias("n_lines"),
                 F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed")]
    return out.select(*cols)


def length_of(text_col: str):
    """Characters of a text column, as in ``n_chars`` (null text: null)."""
    return F.length(F.col(text_col)).cast("long")
