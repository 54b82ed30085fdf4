"""Judgment, run and text fixtures derived from the driver tables.

The driver ships generic tables (``events``, ``documents``, ``benchmark``,
``labels``).  These builders turn them into the inputs the evaluation and
retrieval operators expect, so every query's work grows with the tables:

* ``run``/``runs``: ranked lists with many score ties, one topic per user.
* ``qrels``: graded judgments (levels -1..3) covering part of the run.
* ``qrels_jg``: three judges who disagree and judge different subsets.
* ``prefs``/``qrels_prefs``: preference judgments.
* ``corpus``: fielded documents (headline, text, date).
* ``topics``: sectioned queries (title, desc, narr, date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _docno(id_col: str, prefix: str) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(id_col).cast("string"), 9, "0"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded scores with many ties: one topic per user, one doc per event."""
    ev = table(spark, sf_dir, "events")
    return (ev.where((F.col("event_type") != "error") | (F.col("event_id") % 2 == 0))
              .select(F.col("user_id").cast("string").alias("qid"),
                      _docno("event_id", "D").alias("docno"),
                      (F.round(F.col("value") / 5) * 5).alias("sim"),
                      F.lit("runA").alias("run_id")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the same documents (for z-scores and comparisons)."""
    a = run(spark, sf_dir)
    b = a.select("qid", "docno", (F.lit(500) - F.col("sim")).alias("sim"), F.lit("runB").alias("run_id"))
    c = a.select("qid", "docno",
                 ((F.substring("docno", 2, 100).cast("bigint") * 7919) % 101).cast("double").alias("sim"),
                 F.lit("runC").alias("run_id"))
    return a.unionByName(b).unionByName(c)


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded judgments: -1 pooled-unjudged, 0..3 relevance levels."""
    ev = table(spark, sf_dir, "events")
    rel = (F.when(F.col("event_id") % 7 == 3, -1)
            .when(F.col("event_type") == "purchase", 3)
            .when(F.col("event_type") == "signup", 2)
            .when(F.col("event_type") == "click", 1)
            .otherwise(0)).cast("bigint")
    return (ev.where(F.col("event_id") % 5 != 0)
              .select(F.col("user_id").cast("string").alias("qid"),
                      _docno("event_id", "D").alias("docno"), rel.alias("rel")))


def _each(n: int) -> F.Column:
    # One output row per value 0..n-1 (a generator, not a join).
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def qrels_jg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three judges with shifted grades, each skipping a different quarter."""
    q = (qrels(spark, sf_dir).withColumn("n", F.substring("docno", 2, 100).cast("bigint"))
         .withColumn("jg", _each(3)))
    return (q.where((F.col("n") + F.col("jg")) % 4 != 0)
              .select("qid", F.col("jg").cast("string").alias("jg"), "docno",
                      F.when(F.col("rel") < 0, F.col("rel"))
                       .otherwise((F.col("rel") + F.col("jg")) % 4).cast("bigint").alias("rel")))


def prefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judges, two overlapping sub-groups each (closure adds pairs)."""
    q = (qrels(spark, sf_dir).where(F.col("rel") >= 0)
         .withColumn("n", F.substring("docno", 2, 100).cast("bigint")))
    n = F.col("n")
    out = (q.withColumn("jg", _each(2)).withColumn("jsg", _each(2))
            .where(((n % 4) != 1) & (((n + 2 * F.col("jg")) % 5) != 0) & (((n + F.col("jsg")) % 3) != 0)))
    lvl = F.when((F.col("jg") == 1) & F.col("rel").isin(1, 2), 3 - F.col("rel")).otherwise(F.col("rel"))
    return out.select("qid", F.concat(F.lit("u"), F.col("jg").cast("string")).alias("jg"),
                      F.col("jsg").cast("string").alias("jsg"), "docno", lvl.cast("double").alias("rel_level"))


def qrels_prefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge-group qrels read as preferences: one sub-group, -1 below 0."""
    return qrels_jg(spark, sf_dir).select("qid", "jg", F.lit("0").alias("jsg"), "docno",
                                          F.col("rel").cast("double").alias("rel_level"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fielded documents: first line as headline, whole text, a year."""
    d = table(spark, sf_dir, "documents")
    return d.select(_docno("doc_id", "T").alias("docno"), F.col("source").alias("collection"),
                    F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("headline"),
                    F.col("text"), (F.lit(1900) + F.col("doc_id") % 100).cast("string").alias("date"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectioned queries from ``benchmark`` items."""
    b = table(spark, sf_dir, "benchmark")
    part = lambda i: F.split_part(F.col("text"), F.lit("."), F.lit(i))
    return b.select((F.lit(401) + F.col("item_id")).cast("string").alias("qid"),
                    part(1).alias("title"), part(2).alias("desc_text"),
                    # the rest of the text, whole, after the first two sentences
                    F.concat(F.regexp_replace("text", "^[^.]*[.]?[^.]*[.]?", ""),
                             F.lit(" Reports on other matters are not relevant. Kept sentence.")).alias("narr"),
                    F.when(F.col("item_id") % 3 == 0, F.lit("during the 1990s"))
                     .when(F.col("item_id") % 3 == 1, F.lit("In the 2010s and 2015, room 1234, 1980S"))
                     .otherwise(F.lit("")).alias("date_text"))


# Fixed value: words per shingle when matching passages to documents.
SHINGLE_WORDS = 5


def _words(df: DataFrame) -> DataFrame:
    """``df`` with ``_w``, the words of its text; a column first, so that the shingles' lambda does not split per place."""
    return df.withColumn("_w", F.regexp_extract_all(F.col("text"), F.lit(r"[\p{L}\p{N}]+"), 0))


def _shingles(words: F.Column, n) -> F.Column:
    """Distinct hashed shingles of ``n`` words (a number or a column); of fewer words none."""
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)),
                        lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))
    return F.when(F.size(words) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<bigint>"))


def passage_pairs(items: DataFrame, docs: DataFrame, max_broadcast_shingles: int = 5_000_000) -> DataFrame:
    """(item_id, doc_id) wherever a document's text contains an item's whole text, as often as the rows stand.

    An item's first and last word may be parts of longer words in a document, the words between them are words
    there too.  So a document with the text has all shingles of these; candidates come from an equi-join on them,
    in shingles as long as the item allows, up to ``SHINGLE_WORDS``, and are verified with ``contains`` on the
    whole texts.  Items of fewer than three words have no such shingle and meet every document.
    """
    from ..plans.sizing import bounded_broadcast
    from ..plans.tables import written

    items = items.where("item_id is not null and text is not null").select("item_id", "text")
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    inner = F.size("_w") - 2
    texts = _words(items.select("text").distinct().withColumn("no", F.monotonically_increasing_id()))
    texts = written(texts.select("no", "text", F.least(F.greatest(inner, F.lit(0)), F.lit(SHINGLE_WORDS)).alias("n"),
                                 F.when(inner > 0, F.slice("_w", F.lit(2), F.greatest(inner, F.lit(1)))).alias("_w")), "passages")
    named = items.join(texts.select("no", "text"), "text").select("item_id", "no", F.col("text").alias("itext"))
    sizes = sorted(r.n for r in texts.select("n").distinct().collect())  # six values at most
    pairs = docs.crossJoin(texts.where("n = 0").select("no", F.col("text").alias("itext"))).where(
        F.col("text").contains(F.col("itext"))).select("doc_id", "no").join(named.select("item_id", "no"), "no") if 0 in sizes else None
    sizes = [n for n in sizes if n]
    if sizes:
        # explode_outer: a plain explode makes the optimizer re-evaluate the
        # shingle expression inside an inferred size() > 0 filter.
        ish = texts.where("n > 0").withColumn("sh", _shingles(F.col("_w"), F.col("n"))).select(
            "no", F.size("sh").alias("n_sh"), F.explode_outer("sh").alias("h"))
        ish = bounded_broadcast(ish, max_broadcast_shingles)
        hashed = _words(docs).select("doc_id", F.xxhash64("text").alias("_k"),
                                     F.flatten(F.array(*[_shingles(F.col("_w"), n) for n in sizes])).alias("sh"))
        hits = hashed.select("doc_id", "_k", F.explode_outer("sh").alias("h")).where(F.col("h").isNotNull()).join(ish, "h")
        cand = (hits.groupBy("no", "doc_id", "_k").agg(F.count_distinct("h").alias("hits"), F.first("n_sh").alias("n_sh"))
                    .where("hits = n_sh").select("no", "doc_id", "_k"))
        met = (docs.withColumn("_k", F.xxhash64("text")).join(bounded_broadcast(cand, 1_000_000), ["doc_id", "_k"])
                   .join(bounded_broadcast(named, 1_000_000), "no").where(F.col("text").contains(F.col("itext"))).select("item_id", "doc_id"))
        pairs = met if pairs is None else met.unionByName(pairs.select("item_id", "doc_id"))
    return items.crossJoin(docs.select("doc_id")).where("false").select("item_id", "doc_id") if pairs is None else pairs.select("item_id", "doc_id")


def passage_qrels(spark: SparkSession, sf_dir: str, max_broadcast_shingles: int = 5_000_000) -> DataFrame:
    """Topic-specific judgments: a document is relevant to a benchmark item
    when it contains the item's whole text (graded 2 when its label says
    good quality, else 1).  Repeated rows judge repeatedly; see :func:`passage_pairs`.
    """
    pairs = passage_pairs(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), max_broadcast_shingles)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (pairs.join(labels, "doc_id", "left")
                 .select((F.lit(401) + F.col("item_id")).cast("string").alias("qid"),
                         _docno("doc_id", "T").alias("docno"),
                         (F.lit(1) + F.coalesce(F.col("quality"), F.lit(0))).cast("bigint").alias("rel")))
