"""Registered source/sink queries: SGML ingest, topic files, query lists,
synonym expansion, sampling and run-file lines.

Raw text inputs are rendered from the driver tables (bounded files of at
most 50 documents / 25 topics) and parsed back by the library readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_negated
from ..sinks import run_lines
from ..sources import fixtures as fx
from ..sources import sgml as SG
from ..sources import topics as TP
from .registry import register


def _o(name, *args):
    def o():
        from checks import oracle_sources as OS
        return getattr(OS, name)(*args)
    return o


def sgml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, value): documents rendered as SGML, at most 50 per file."""
    from ..sources.render import sgml_docs_sql
    docs = spark.sql(sgml_docs_sql("{documents}"), documents=fx.table(spark, sf_dir, "documents"))
    files = docs.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("doc_id", "doc"))).alias("d"))
    return files.select("path", F.array_join(F.transform("d", lambda x: x["doc"]), "\n").alias("value"))


def parsed_collections(spark: SparkSession, sf_dir: str, null_text: str = "") -> DataFrame:
    docs = SG.split_docs(sgml_files(spark, sf_dir))
    out = None
    for coll in SG.COLLECTIONS:
        part = SG.ingest(docs.where(F.col("path").startswith(coll + "/")), coll, null_text)
        out = part if out is None else out.unionByName(part)
    return out


@register("sgml_ingest", _o("sgml_ingest_sql"))
def q_sgml_ingest(spark, sf_dir):
    return parsed_collections(spark, sf_dir).select("docno", "collection", "subfolder", "headline", "text", "date")


@register("sample_every", _o("sample_sql", "every", 3))
def q_sample_every(spark, sf_dir):
    return SG.sample_every(parsed_collections(spark, sf_dir), 3).select("docno", "collection", "subfolder")


@register("sample_head", _o("sample_sql", "head", 50))
def q_sample_head(spark, sf_dir):
    return SG.sample_head(parsed_collections(spark, sf_dir), 50).select("docno", "collection", "subfolder", "ordinal")


@register("collection_counts", _o("collection_counts_sql"))
def q_collection_counts(spark, sf_dir):
    return SG.collection_counts(parsed_collections(spark, sf_dir))


def topic_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.render import topic_blocks_sql
    t = spark.sql(topic_blocks_sql("{benchmark}"), benchmark=fx.table(spark, sf_dir, "benchmark"))
    files = t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("item_id", "block"))).alias("b"))
    return files.select(F.array_join(F.transform("b", lambda x: x["block"]), "\n\n").alias("value"))


@register("topics_parse", _o("topics_parse_sql"))
def q_topics_parse(spark, sf_dir):
    return TP.parse_topics(topic_files(spark, sf_dir))


@register("topic_dates", _o("topic_dates_sql"))
def q_topic_dates(spark, sf_dir):
    return TP.parse_topics(topic_files(spark, sf_dir)).select("qid", "date")


@register("negation_filter", _o("negation_sql"))
def q_negation(spark, sf_dir):
    t = TP.parse_topics(topic_files(spark, sf_dir))
    return t.select("qid", drop_negated(F.col("narr")).alias("narr"))


@register("numbered_queries", _o("numbered_queries_sql"))
def q_numbered(spark, sf_dir):
    b = fx.table(spark, sf_dir, "benchmark")
    # One line per item ("n. text"), an empty line after every fifth item.
    lines = b.select((F.col("item_id") * 2).alias("line_no"),
                     F.concat((F.col("item_id") + 1).cast("string"), F.lit(". "), F.regexp_replace("text", r"\n", " ")).alias("value")) \
             .unionByName(b.where(F.col("item_id") % 5 == 4).select((F.col("item_id") * 2 + 1).alias("line_no"), F.lit("   ").alias("value")))
    # File order as the reader produces it: increasing ids with the partition in the upper bits.
    ordered = lines.orderBy("line_no").withColumn("line_no", F.monotonically_increasing_id())
    return TP.numbered_queries(ordered, 401)


def synonym_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noun facts grouping benchmark words that share their first four
    letters (plus a verb fact per group that must be ignored)."""
    b = fx.table(spark, sf_dir, "benchmark")
    words = (b.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{5,}"), 0)).alias("w")).distinct()
              .withColumn("grp", F.substring("w", 1, 4)))
    ids = sum((F.ascii(F.substring("grp", i + 1, 1)).cast("bigint") * (1000 ** (3 - i)) for i in range(4)), F.lit(0))
    facts = words.select(ids.alias("sid"), "w", F.concat(F.lit("s("), ids.cast("string"), F.lit(",1,'"), F.col("w"),
                                                          F.lit("',n,1,0).")).alias("value"))
    verbs = words.select(ids.alias("sid"), "w", F.concat(F.lit("s("), ids.cast("string"), F.lit(",1,'"), F.col("w"),
                                                          F.lit("',v,1,0).")).alias("value"))
    return facts.unionByName(verbs).withColumn("line_no", F.col("sid") * 1000 + F.length("w"))


@register("synonym_expand", _o("synonym_expand_sql"))
def q_synonym_expand(spark, sf_dir):
    from ..sources.render import topic_blocks_sql
    blocks = spark.sql(topic_blocks_sql("{benchmark}"), benchmark=fx.table(spark, sf_dir, "benchmark")) \
                  .select(F.col("item_id").alias("block_id"), F.col("block").alias("raw"))
    syn = TP.synsets(synonym_facts(spark, sf_dir))
    return TP.expand_synonyms(blocks, syn)


def _run_lines_sql() -> str:
    from checks import oracle_search as OS
    return OS.run_lines_sql()


@register("run_lines", _run_lines_sql)
def q_run_lines(spark, sf_dir):
    """Six-column lines of the multi-field BM25 run."""
    from .catalog_search import _search
    from ..functions import similarity as S
    run = _search(lambda: S.bm25(0.6, 0.7), "mf", sectioned=True)(spark, sf_dir)
    return run_lines(run)
