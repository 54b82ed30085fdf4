"""Query formation: sectioned topics -> weighted query-term table.

A topic has sections (title, desc, narr, date).  Every token of a section
is searched in every document field with weight ``w[section][field]`` times
the section boost (the date section uses the ``noDate`` boost when the topic
has no date).  Because scoring is linear in these weights, the query is the
table ``query_terms(qid, field, term, weight)`` with duplicate tokens and
sections summed - no query tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import Analyzer
from ..functions.text import drop_negated, sanitize_query, topic_dates
from .index import map_terms

SECTIONS = ("title", "desc", "narr", "date")
DOC_FIELDS = ("headline", "date", "text")

# Tuned field weights per section and section boosts of the
# default run (fields: headline, date, text).
TUNED_WEIGHTS = {
    "title": {"headline": 0.1, "date": 0.2, "text": 0.9},
    "desc": {"headline": 0.2, "date": 0.0, "text": 0.7},
    "narr": {"headline": 0.2, "date": 0.8, "text": 0.7},
    "date": {"headline": 0.2, "date": 1.0, "text": 0.2},
}
TUNED_BOOSTS = {"title": 1.0, "desc": 0.4, "narr": 0.2, "noDate": 0.0, "date": 2.0}
UNIFORM_WEIGHTS = {s: {f: 1.0 for f in DOC_FIELDS} for s in SECTIONS}
UNIFORM_BOOSTS = {"title": 1.0, "desc": 1.0, "narr": 1.0, "noDate": 1.0, "date": 1.0}


def prepare_topics(topics: DataFrame, negation_filter: bool = False) -> DataFrame:
    """Fixture-style topics (qid, title, desc_text, narr, date_text) ->
    (qid, title, desc, narr, date) with the date section expanded."""
    narr = drop_negated(F.col("narr")) if negation_filter else F.col("narr")
    return topics.select("qid", F.col("title"), F.col("desc_text").alias("desc"), narr.alias("narr"),
                         topic_dates(F.col("date_text")).alias("date"))


def section_tokens(topics: DataFrame, analyzer: Analyzer, sections=SECTIONS) -> DataFrame:
    """(qid, section, has_date, term) - one row per query token occurrence."""
    present = [s for s in sections if s in topics.columns]
    rows = topics.select("qid", (F.col("date") != "null").alias("has_date") if "date" in topics.columns
                         else F.lit(False).alias("has_date"),
                         F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.col(s).alias("text"))
                                             for s in present])).alias("_s"))
    rows = rows.where(F.col("_s.text").isNotNull())
    toks = analyzer.tokens(sanitize_query(F.col("_s.text")))
    return rows.select("qid", F.col("_s.section").alias("section"), "has_date", F.explode(toks).alias("term"))


def query_terms(topics: DataFrame, analyzer: Analyzer = Analyzer(), weights: dict = TUNED_WEIGHTS,
                boosts: dict = TUNED_BOOSTS, sections=SECTIONS, keep_zero: bool = False,
                per_section: bool = False) -> DataFrame:
    """(qid, field, term, weight) [+ section when ``per_section``]."""
    toks = section_tokens(topics, analyzer, sections)
    wmap = F.create_map(*[x for s, fw in weights.items() for f, w in fw.items()
                          for x in (F.lit(f"{s}|{f}"), F.lit(float(w)))])
    bmap = F.create_map(*[x for s, b in boosts.items() for x in (F.lit(s), F.lit(float(b)))])
    boost = F.when((F.col("section") == "date") & ~F.col("has_date"), bmap[F.lit("noDate")]) \
             .otherwise(bmap[F.col("section")])
    fields = F.array(*[F.lit(f) for f in DOC_FIELDS])
    q = (toks.withColumn("field", F.explode(fields))
             .withColumn("weight", F.coalesce(wmap[F.concat_ws("|", "section", "field")], F.lit(0.0))
                         * F.coalesce(boost, F.lit(0.0))))
    if not keep_zero:
        q = q.where(F.col("weight") != 0)
    keys = ["qid", "section", "field"] if per_section else ["qid", "field"]
    q = q.groupBy(*keys, "term").agg(F.sum("weight").alias("weight"))
    return map_terms(q, analyzer, keys, ["weight"])


def flat_query_terms(queries: DataFrame, analyzer: Analyzer, text_col: str = "text",
                     fields=DOC_FIELDS) -> DataFrame:
    """Single-text queries searched in every field with weight 1 (the
    externally expanded query form)."""
    toks = queries.select("qid", F.explode(analyzer.tokens(sanitize_query(F.col(text_col)))).alias("term"))
    q = (toks.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
             .groupBy("qid", "field", "term").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    return map_terms(q, analyzer, ["qid", "field"], ["weight"])


def usable(text: Column) -> Column:
    """Whether a raw query text can be searched as it stands.

    It cannot if a double quote, a parenthesis, a bracket or a brace is left
    open or closed without being opened, if it begins with AND, OR, ``*`` or
    ``?``, or if it ends with AND, OR, NOT, ``+``, ``-``, ``!`` or ``^``.  A
    character behind a backslash and what stands in quotes are plain text.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\.", "x")
    plain = F.regexp_replace(plain, r'"[^"]*"', " x ")
    depth = lambda a, b: F.length(F.regexp_replace(plain, f"[^{a}]", "")) == F.length(F.regexp_replace(plain, f"[^{b}]", ""))
    closed = depth(r"\(", r"\)") & depth(r"\[", r"\]") & depth(r"\{", r"\}") & ~plain.contains('"')
    ends = plain.rlike(r"(^|\s)(AND|OR|NOT)\s*$|[+\-!^]\s*$") | plain.rlike(r"^\s*((AND|OR)(\s|$)|[*?])")
    return closed & ~ends & ~plain.rlike(r"^[^(]*\)|^[^\[]*\]|^[^{]*\}")
