"""Registered text-analysis, index and search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.analysis import Analyzer
from ..operators import index as I
from ..operators import query as Q
from ..operators import search as SE
from ..sources import fixtures as fx
from .registry import r6, register
from .tables import shared_path

# Lower case and stop words only.
PLAIN = Analyzer("standard", ("lowercase", "stop"))
FULL = Analyzer()  # standard, lowercase, stop, porterstem, asciifolding


def _oracle(fn_name: str, *args, **kw):
    def o():
        from checks import oracle_search as OS
        return getattr(OS, fn_name)(*args, **kw)
    return o


def plain_index(spark: SparkSession, sf_dir: str, analyzer: Analyzer = PLAIN) -> I.Index:
    return I.build_index(fx.corpus(spark, sf_dir), analyzer)


def flat_queries(spark: SparkSession, sf_dir: str, analyzer: Analyzer = PLAIN) -> DataFrame:
    b = fx.table(spark, sf_dir, "benchmark").select((F.lit(401) + F.col("item_id")).cast("string").alias("qid"), "text")
    return Q.flat_query_terms(b, analyzer)


@register("postings", _oracle("postings_sql"))
def q_postings(spark, sf_dir):
    return plain_index(spark, sf_dir).postings


def _postings_of(tokenizer: str):
    def q(spark, sf_dir):
        return plain_index(spark, sf_dir, Analyzer(tokenizer, ())).postings
    return q


for _t in ("standard", "whitespace", "classic", "wikipedia"):
    register(f"tokenize_{_t}", _oracle("postings_sql", _t))(_postings_of(_t))


@register("dictionary", _oracle("dictionary_sql"))
def q_dictionary(spark, sf_dir):
    return plain_index(spark, sf_dir).dictionary.select("field", "term", F.col("df").cast("long"), F.col("cf").cast("long"))


@register("field_stats", _oracle("field_stats_sql"))
def q_field_stats(spark, sf_dir):
    fs = plain_index(spark, sf_dir).field_stats
    return fs.select("field", F.col("N").cast("long"), F.col("sum_dl").cast("long"), r6("avgdl").alias("avgdl"))


def _search(sim_col, run_id, sectioned=False, analyzer=PLAIN, k=1000):
    def q(spark, sf_dir):
        if sectioned:
            qt = Q.query_terms(Q.prepare_topics(fx.topics(spark, sf_dir)), analyzer)
        else:
            qt = flat_queries(spark, sf_dir, analyzer)
        return SE.search_text(qt, fx.corpus(spark, sf_dir), analyzer, sim_col(), k=k, run_id=run_id)
    return q


register("search_bm25", _oracle("search_sql", "bm25", {"k1": 0.6, "b": 0.7}, run_id="bm25"))(
    _search(lambda: S.bm25(0.6, 0.7), "bm25"))
register("search_bm25_default", _oracle("search_sql", "bm25", {"k1": 1.2, "b": 0.75}, run_id="bm25d"))(
    _search(lambda: S.bm25(1.2, 0.75), "bm25d"))
register("search_tfidf", _oracle("search_sql", "tfidf", {}, run_id="tfidf"))(
    _search(lambda: S.tfidf(), "tfidf"))
register("search_lmd", _oracle("search_sql", "lmd", {"mu": 500.0}, run_id="lmd"))(
    _search(lambda: S.lm_dirichlet(500.0), "lmd"))
register("search_lmj", _oracle("search_sql", "lmj", {"lam": 0.5}, run_id="lmj"))(
    _search(lambda: S.lm_jelinek_mercer(0.5), "lmj"))
register("search_multifield", _oracle("search_sql", "bm25", {"k1": 0.6, "b": 0.7}, sectioned=True, run_id="mf"))(
    _search(lambda: S.bm25(0.6, 0.7), "mf", sectioned=True))


@register("search_saved", _oracle("search_sql", "bm25", {"k1": 0.6, "b": 0.7}, sectioned=True, run_id="saved"))
def q_search_saved(spark, sf_dir):
    """The multi-field search over an index that was saved and loaded again."""
    path = shared_path(spark, "saved-index")
    I.save_index(plain_index(spark, sf_dir), path, buckets=64)
    qt = Q.query_terms(Q.prepare_topics(fx.topics(spark, sf_dir)), PLAIN)
    return SE.search(qt, I.load_index(spark, path), S.bm25(0.6, 0.7), run_id="saved")


# Full analyzer (Porter stemming + folding).
register("search_stemmed", _oracle("search_stemmed_sql"))(_search(lambda: S.bm25(0.6, 0.7), "stem", sectioned=True, analyzer=FULL))


# Query-side analyzer of the expanded-query search: no ASCII folding, while
# the index is built with the full chain (as in the original setup).
EXPANDED_QUERY = Analyzer("standard", ("lowercase", "stop", "porterstem"))


@register("search_expanded", _oracle("search_expanded_sql"))
def q_search_expanded(spark, sf_dir):
    """Numbered query list (one line per benchmark item) searched in every
    field with weight 1, default BM25 (1.2, 0.75), top 1000."""
    from .catalog_sources import q_numbered
    queries = q_numbered(spark, sf_dir)
    return SE.search_expanded(queries, fx.corpus(spark, sf_dir), FULL, EXPANDED_QUERY, S.bm25(*S.BM25_DEFAULT), k=1000, run_id="expanded")


@register("search_match_all", _oracle("match_all_sql"))
def q_search_match_all(spark, sf_dir):
    """The query list with an open quote or a dangling operator in some lines: these match all documents."""
    b = fx.table(spark, sf_dir, "benchmark")
    text = F.when(F.col("item_id") % 7 == 3, F.concat(F.lit('"'), "text")).when(F.col("item_id") % 11 == 5, F.concat("text", F.lit(" AND"))) \
        .otherwise(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " "))
    queries = b.select((F.lit(401) + F.col("item_id")).cast("string").alias("qid"), text.alias("text"))
    return SE.search_expanded(queries, fx.corpus(spark, sf_dir), PLAIN, PLAIN, S.bm25(*S.BM25_DEFAULT), k=1000, run_id="all")


@register("search_synonyms", _oracle("search_synonyms_sql"))
def q_search_synonyms(spark, sf_dir):
    """Topics whose raw text is expanded with noun synonyms before parsing,
    searched with the tuned multi-field BM25."""
    from ..sources import topics as TP
    from ..sources.render import topic_blocks_sql
    from .catalog_sources import synonym_facts
    blocks = spark.sql(topic_blocks_sql("{benchmark}"), benchmark=fx.table(spark, sf_dir, "benchmark")) \
                  .select(F.col("item_id").alias("block_id"), F.col("block").alias("raw"))
    expanded = TP.expand_synonyms(blocks, TP.synsets(synonym_facts(spark, sf_dir)))
    # expanded blocks still carry their <top> wrapper; parse sections from them
    inner = expanded.select(F.regexp_extract("raw", r"<top>\s([\s\S]*?)</top>", 1).alias("raw"))
    topics = TP.topics_from_blocks(inner)
    qt = Q.query_terms(topics, FULL)
    return SE.search_text(qt, fx.corpus(spark, sf_dir), FULL, S.bm25(*S.BM25_TUNED), k=1000, run_id="synonyms")


@register("search_missing_sections", _oracle("missing_sections_sql"))
def q_search_missing_sections(spark, sf_dir):
    """Topics some of which lack a title, a narrative or every section but the date: what is missing adds nothing."""
    t = fx.topics(spark, sf_dir)
    n = F.col("qid").cast("int")
    gone = lambda c, m, r: F.when(n % m != r, F.col(c)).alias(c)
    t = t.select("qid", gone("title", 3, 1), gone("desc_text", 6, 1), gone("narr", 2, 1), "date_text")
    qt = Q.query_terms(Q.prepare_topics(t), PLAIN)
    return SE.search_text(qt, fx.corpus(spark, sf_dir), PLAIN, S.bm25(0.6, 0.7), run_id="missing")
