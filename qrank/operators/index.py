"""Fielded inverted index as tables.

* postings(field, term, docno, tf, dl)
* dictionary(field, term, df, cf)
* field_stats(field, N, sum_dl, avgdl)  - documents having the field

``build_index`` indexes a whole corpus; vocabulary filters (stemming,
folding) are applied to the distinct vocabulary and joined back to the raw
postings.  ``query_index`` answers given queries from raw text: one pass over
the texts counts the query terms alone, inside tasks, and takes the lengths of
all documents.  ``save_index`` writes postings and dictionary in buckets of
terms, sorted, so that a search reads only the buckets of its terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.analysis import PER_TOKEN, Analyzer, analyze, final_form, term_map
from ..plans.sizing import bounded_broadcast, fits
from ..plans.tables import written
from . import counting

FIELDS = ("headline", "date", "text")
# Vocabulary maps up to this many terms are broadcast; larger ones shuffle.
MAX_BROADCAST_TERMS = 5_000_000


@dataclass
class Index:
    """``buckets``: number of term buckets that a saved index is partitioned by, else None."""

    postings: DataFrame
    dictionary: DataFrame
    field_stats: DataFrame
    analyzer: Analyzer
    buckets: int | None = None


def bucket_of(term: str, buckets: int) -> Column:
    """The bucket (a partition of a saved index) that holds a term."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def map_terms(df: DataFrame, analyzer: Analyzer, keys: list[str], sum_cols: list[str],
              term_col: str = "term") -> DataFrame:
    """Apply the analyzer's vocabulary filters to ``term_col`` and merge rows
    that collapse onto the same output term (summing ``sum_cols``)."""
    if not analyzer.vocab_filters():
        return df
    tm = term_map(df.select(term_col), analyzer, term_col)
    tm = bounded_broadcast(tm, MAX_BROADCAST_TERMS)
    mapped = (df.join(tm, df[term_col] == tm["term"], "inner").drop(tm["term"])
                .drop(term_col).withColumnRenamed("out_term", term_col))
    return mapped.groupBy(*keys, term_col).agg(*[F.sum(c).alias(c) for c in sum_cols])


def token_counts(docs: DataFrame, analyzer: Analyzer, keys: list[str], fields=FIELDS, id_col: str = "docno") -> DataFrame:
    """(keys, tf): how often each token stands in each text, before vocabulary filters; keys: field, docno, term, perhaps dl.

    A text's tokens are counted where they are made; only repeated identifiers need a shuffle.
    """
    toks = analyze(docs, id_col, list(fields), analyzer).select("field", F.col(id_col).alias("docno"), "tokens")
    raw = toks.mapInArrow(counting.all_counts_of_task, f"field string, docno {dict(toks.dtypes)['docno']}, dl long, term string, tf long")
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return raw.select(*keys, "tf")
    return raw.groupBy(*keys).agg(F.sum("tf").alias("tf"))


def build_postings(docs: DataFrame, analyzer: Analyzer, fields=FIELDS, id_col: str = "docno") -> DataFrame:
    """(field, term, docno, tf, dl) for every token of every field."""
    raw = token_counts(docs, analyzer, ["field", "docno", "dl", "term"], fields, id_col)
    out = map_terms(raw, analyzer, ["field", "docno", "dl"], ["tf"])
    if "stop" in analyzer.vocab_filters():  # tokens went after the lengths were taken
        kept = out.groupBy("field", "docno").agg(F.sum("tf").alias("dl"))
        out = out.drop("dl").join(kept, ["field", "docno"])
    return out.select("field", "term", "docno", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"))


def build_dictionary(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def field_totals(lengths: DataFrame) -> DataFrame:
    """One row per field: N (documents with the field), sum_dl, avgdl."""
    return lengths.groupBy("field").agg(F.count(F.lit(1)).alias("N"), F.sum("dl").alias("sum_dl")) \
                  .withColumn("avgdl", F.col("sum_dl") / F.col("N"))


def build_field_stats(postings: DataFrame) -> DataFrame:
    return field_totals(postings.select("field", "docno", "dl").distinct())


def build_index(docs: DataFrame, analyzer: Analyzer = Analyzer(), fields=FIELDS, id_col: str = "docno") -> Index:
    """The index of the whole corpus; postings are written once to the shared folder."""
    p = written(build_postings(docs, analyzer, fields, id_col), "postings")
    return Index(p, build_dictionary(p), build_field_stats(p), analyzer)


def query_index(docs: DataFrame, analyzer: Analyzer, query_terms: DataFrame, fields=FIELDS, id_col: str = "docno") -> Index:
    """The part of the index that ``query_terms`` (a ``term`` column) can touch.

    Tokens meet the query vocabulary before anything is grouped; what is kept
    grows with the query terms' own postings, plus one row per document and
    field that carries its length, so that N, lengths and averages are those
    of the whole corpus.  Same scores as with :func:`build_index`.
    """
    wanted = query_terms.select("term").distinct()
    if "stop" in analyzer.vocab_filters():  # lengths follow only when every token has its final form
        whole = build_index(docs, analyzer, fields, id_col)
        p = written(whole.postings.join(bounded_broadcast(wanted, MAX_BROADCAST_TERMS), "term", "left_semi"), "postings")
        return Index(p, build_dictionary(p), whole.field_stats, analyzer)
    wanted = written(wanted, "wanted-terms")
    if set(analyzer.vocab_filters()) <= PER_TOKEN and fits(wanted, MAX_BROADCAST_TERMS):
        found = counted(docs, analyzer, wanted, fields, id_col)
    else:
        found = joined(docs, analyzer, wanted, fields, id_col)
    found = written(found, "postings")
    postings = found.where(F.col("term").isNotNull())
    lengths = found.where(F.col("term").isNull() & (F.col("dl") > 0))
    return Index(postings, build_dictionary(postings), field_totals(lengths), analyzer)


def counted(docs: DataFrame, analyzer: Analyzer, wanted: DataFrame, fields, id_col: str) -> DataFrame:
    """(field, term, docno, tf, dl) of the ``wanted`` terms, few enough to be broadcast; a null term brings each text's length.

    A text's tokens are counted where they are made, in one pass (``counting``).
    Only where an identifier stands on several rows are counts added in a shuffle.
    """
    terms = docs.sparkSession.sparkContext.broadcast([r.term for r in wanted.where("term is not null").collect()])
    toks = analyze(docs, id_col, list(fields), analyzer).select("field", F.col(id_col).alias("docno"), "tokens")
    found = toks.mapInArrow(counting.counts_of_task(terms, final_form(analyzer.vocab_filters())),
                            f"field string, term string, docno {dict(toks.dtypes)['docno']}, tf long, dl long")
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return found
    return found.groupBy("field", "term", "docno", "dl").agg(F.sum("tf").alias("tf")).select("field", "term", "docno", "tf", "dl")


def joined(docs: DataFrame, analyzer: Analyzer, wanted: DataFrame, fields, id_col: str) -> DataFrame:
    """:func:`counted` for any number of terms and any filters: tokens as rows meet the terms in a join."""
    toks = analyze(docs, id_col, list(fields), analyzer).withColumn("dl", F.size("tokens"))
    # explode_outer: a plain explode makes the optimizer run the tokenizer again in a size() > 0 filter
    rows = lambda tokens: toks.select("field", F.col(id_col).alias("docno"), "dl", F.explode_outer(tokens).alias("raw"))
    if analyzer.vocab_filters():
        vocabulary = rows("tokens").where(F.col("raw").isNotNull())
        kept = term_map(vocabulary, analyzer, "raw").select(F.col("term").alias("raw"), F.col("out_term").alias("term")) \
            .join(wanted, "term", "left_semi").select("raw", "term")
    else:
        kept = wanted.select(F.col("term").alias("raw"), "term")
    # the null at the end of each document's tokens brings its length along
    marked = rows(F.array_append("tokens", F.lit(None).cast("string")))
    found = (marked.join(bounded_broadcast(kept, MAX_BROADCAST_TERMS), "raw", "left")
             .where(F.col("raw").isNull() | F.col("term").isNotNull())
             .groupBy("field", "docno", "dl", "term").agg(F.count(F.lit(1)).alias("tf")))
    return found.select("field", "term", "docno", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"))


def save_index(index: Index, path: str, buckets: int | None = None) -> None:
    """Write the index (overwrite) in ``buckets`` partitions of terms.

    Rows are dealt to their bucket's files by field and term and sorted, so a
    search reads the buckets of its terms and of these only the row groups
    that hold them.  Without a number there are as many buckets as shuffle
    partitions; about the number of executors' cores suits a large index.
    """
    spark = index.postings.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df, order in (("postings", index.postings, ["field", "term", "docno"]), ("dictionary", index.dictionary, ["field", "term"])):
        (df.withColumn("bucket", bucket_of("term", n))
         # by range: a term that a third of all postings hold spreads over the bucket's files
         .repartitionByRange(max(n, shuffles), "bucket", *order).sortWithinPartitions("bucket", *order)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}"))
    index.field_stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/field_stats")
    spark.createDataFrame([(index.analyzer.tokenizer, ",".join(index.analyzer.filters), n)],
                          "tokenizer string, filters string, buckets int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/analyzer")


def load_index(spark: SparkSession, path: str) -> Index:
    a = spark.read.parquet(f"{path}/analyzer").first()
    analyzer = Analyzer(a.tokenizer, tuple(x for x in a.filters.split(",") if x))
    return Index(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/dictionary"),
                 spark.read.parquet(f"{path}/field_stats"), analyzer, a.buckets)
