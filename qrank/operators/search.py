"""Scoring and top-k retrieval as joins and aggregations.

score(q, d) = sum over (field, term) of weight(q, field, term) * sim(tf, dl, df, ...)

Plan: the query side (query terms joined with their dictionary rows and the
per-field statistics) is written once and broadcast if it is small; the
postings are read once and joined to it.  Postings of a saved index are
partitioned by buckets of terms, and the join on the bucket prunes the
partitions that no query term falls into.  A query side beyond the broadcast
bound meets the postings in a shuffle, in which a term with many postings is
split by a hash of the document and its query rows are copied once per part.
For sums per (qid, docno) the wanted postings are dealt by document first, into
as many tasks as they need (known from the dictionary): a document's matches are
made, summed and cut to each query's top k in one task, whose memory does not
grow with the corpus, and are never shuffled.  A search takes each posting's
similarity once, in Spark, and sums the matches of blocks of documents in numpy
(``scoring``), so no match is a row.  The top k per query use ``row_number() <= k``, which Spark plans as a partial
per-partition limit before the shuffle (WindowGroupLimit), so a query matching
every document never ships all of them to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.analysis import Analyzer
from ..plans import sizing
from ..plans.sizing import bounded_broadcast
from ..plans.tables import written
from . import scoring
from .index import Index, bucket_of, query_index

# Query sides up to this many (qid, field, term) rows are broadcast.
MAX_BROADCAST_QUERY_TERMS = 2_000_000
# Postings of a term that one part of a shuffled join holds about.
TERM_PART = 2_000_000
# Matches of the documents that one task scores about.
TASK_MATCHES = 4_000_000
# Postings that one task of a search holds about.
TASK_POSTINGS = 4_000_000
SCORE_DIGITS = 6


def query_side(query_terms: DataFrame, index: Index) -> DataFrame:
    """(qid, field, term, weight, df, cf, N, avgdl, sum_dl) for the query terms; with
    ``bucket`` for a saved index, whose dictionary is read in the terms' buckets only."""
    on = ["field", "term"]
    if index.buckets:
        # weights are never 0: the filter tells the optimizer that this side is worth pruning by
        query_terms = query_terms.where(F.col("weight") != 0).withColumn("bucket", bucket_of("term", index.buckets))
        on = ["bucket", *on]
    fs = F.broadcast(index.field_stats)  # one row per field
    return index.dictionary.join(bounded_broadcast(query_terms, MAX_BROADCAST_QUERY_TERMS), on).join(fs, "field")


def numbered_rows(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """The distinct ``cols`` of a table that is small enough to be broadcast, numbered from 0."""
    w = Window.orderBy(*cols)
    return written(df.select(*cols).distinct().withColumn(out, F.row_number().over(w) - 1), out)


def may_broadcast(side: DataFrame) -> bool:
    """Whether a written query side is small enough in rows and bytes."""
    n, size = side.agg(F.count(F.lit(1)), F.sum(sizing.row_bytes(side))).first()
    return n <= MAX_BROADCAST_QUERY_TERMS and (size or 0) <= sizing.MAX_BROADCAST_BYTES


def same_keys(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, which is broadcast; nulls are equal."""
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols]
    return left.alias("l").join(F.broadcast(right.alias("r")), keys).select("l.*", *(f"r.{c}" for c in right.columns if c not in cols))


def best(postings: DataFrame, side: DataFrame, on: list[str], query: list[str], sim: Column, k: int, keep_zero: bool = False,
         docno_desc: bool = False) -> DataFrame:
    """(query, docno, score): the sums of the documents that can be among the first ``k`` of a query.

    ``side``: a written table, small enough to be broadcast, with a row per
    term (columns ``on``) and query, the term's statistics ``df``, ``cf``,
    ``N``, ``avgdl``, ``sum_dl`` and the ``weight``.  Of a query's documents
    only those go that ``k`` others of the same task certainly precede.
    """
    spark = side.sparkSession
    # the filter, always true, tells the optimizer that the terms are worth pruning a saved index by
    terms = numbered_rows(side, [*on, "df", "cf", "N", "avgdl", "sum_dl"], "tid").where("tid >= 0")
    queries = numbered_rows(side, query, "q")
    found = terms.agg(F.sum("df")).first()[0]
    rows = same_keys(side.join(F.broadcast(terms.select(*on, "tid")), on), queries, query).select("tid", "q", "weight").toArrow()
    w = spark.sparkContext.broadcast(scoring.weights_of(*(rows.column(c).to_numpy() for c in ("tid", "q", "weight"))))
    tasks = max(spark.sparkContext.defaultParallelism, -(-(found or 0) // TASK_POSTINGS))
    s = postings.join(F.broadcast(terms), on).select("docno", "tid", sim.cast("double").alias("s")).where("s is not null")
    s = s.repartition(tasks, "docno").sortWithinPartitions("docno")
    scored = s.mapInArrow(scoring.best_of_task(w, k, keep_zero, docno_desc), scoring.SCHEMA)
    return scored.join(F.broadcast(queries), "q").drop("q")


def matches(query_terms: DataFrame, index: Index, by_document: bool = False) -> DataFrame:
    """Unaggregated matches: one row per (query term, posting) with every
    column a similarity needs.  ``by_document`` keeps those of a document in one
    task, for sums over its matches, in as many tasks as the matches need."""
    return side_matches(*written_side(query_terms, index), index, by_document)


def written_side(query_terms: DataFrame, index: Index) -> tuple[DataFrame, list[str], int, bool]:
    """The query side, written, the columns that it meets postings on, its matches, and whether it may be broadcast."""
    qs = written(query_side(query_terms, index), "query-side")
    on = ["field", "term"]
    if index.buckets:
        qs, on = qs.where(F.col("weight") != 0), ["bucket", *on]
    return qs, on, qs.agg(F.sum("df")).first()[0], may_broadcast(qs)


def side_matches(qs: DataFrame, on: list[str], found: int, small: bool, index: Index, by_document: bool) -> DataFrame:
    """:func:`matches` of a written query side."""
    if small:
        if not by_document:
            return index.postings.join(F.broadcast(qs), on)
        # what no query term wants does not travel
        wanted = index.postings.join(F.broadcast(qs.select(on).distinct()), on, "left_semi")
        tasks = max(qs.sparkSession.sparkContext.defaultParallelism, -(-(found or 0) // TASK_MATCHES))
        return wanted.repartition(tasks, "docno").join(F.broadcast(qs), on)
    qs = qs.withColumn("_parts", F.ceil(F.col("df") / TERM_PART))
    # one row per term with more than TERM_PART postings
    often = bounded_broadcast(qs.where("_parts > 1").select("field", "term", "_parts").distinct(), 1_000_000)
    postings = index.postings.join(often, ["field", "term"], "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("docno"), F.col("_parts")), F.lit(0))).drop("_parts")
    qs = qs.withColumn("_part", F.explode(F.expr("sequence(0L, _parts - 1)"))).drop("_parts")
    return postings.join(qs, [*on, "_part"]).drop("_part")


def score(query_terms: DataFrame, index: Index, sim: Column, keep_zero: bool = False) -> DataFrame:
    """(qid, docno, score) summed over matching terms and fields."""
    return summed(matches(query_terms, index, by_document=True), sim, keep_zero)


def summed(m: DataFrame, sim: Column, keep_zero: bool) -> DataFrame:
    s = m.groupBy("qid", "docno").agg(F.sum(F.col("weight") * sim).alias("score"))
    if not keep_zero:
        s = s.where(F.col("score") > 0)
    return s


def top_k(scores: DataFrame, k: int = 1000, keys=("qid",), digits: int = SCORE_DIGITS,
          docno_desc: bool = False) -> DataFrame:
    """Best k documents per query: score desc (rounded), then docno asc
    (search order) or desc (the evaluation order, which lets a following
    evaluation reuse this sort)."""
    s = scores.withColumn("score", F.round("score", digits))
    tie = F.desc("docno") if docno_desc else F.asc("docno")
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), tie)
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(query_terms: DataFrame, index: Index, sim: Column, k: int = 1000, run_id: str = "run",
           keep_zero: bool = False) -> DataFrame:
    """Run table (run_id, qid, docno, rank, sim)."""
    qs, on, found, small = written_side(query_terms, index)
    if small:
        scores = best(index.postings, qs, on, ["qid"], sim, k, keep_zero)
    else:
        scores = summed(side_matches(qs, on, found, small, index, True), sim, keep_zero)
    t = top_k(scores, k)
    return t.select(F.lit(run_id).alias("run_id"), "qid", "docno", "rank", F.col("score").alias("sim"))


def search_text(query_terms: DataFrame, docs: DataFrame, analyzer: Analyzer, sim: Column, k: int = 1000, run_id: str = "run",
                keep_zero: bool = False) -> DataFrame:
    """:func:`search` over raw text: the corpus is read for the query terms, no index stays behind."""
    query_terms = written(query_terms, "query-terms")
    return search(query_terms, query_index(docs, analyzer, query_terms), sim, k, run_id, keep_zero)


def match_all(queries: DataFrame, docs: DataFrame, k: int = 1000, run_id: str = "run", id_col: str = "docno") -> DataFrame:
    """Run rows for queries (qid) that match every document alike: the ``k`` smallest docnos, score 1.

    The documents are cut to ``k`` once, by a top-k of each partition; only
    those meet the queries, joined on the rank.
    """
    first = docs.select(F.col(id_col).alias("docno")).distinct().orderBy("docno").limit(k)
    first = written(first, "first-documents")
    ranked = first.withColumn("rank", F.row_number().over(Window.orderBy("docno")))  # at most k rows
    every = queries.select("qid", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    return every.join(F.broadcast(ranked), "rank").select(F.lit(run_id).alias("run_id"), "qid", "docno", "rank", F.lit(1.0).alias("sim"))


def search_expanded(queries: DataFrame, docs: DataFrame, analyzer: Analyzer, query_analyzer: Analyzer, sim: Column, k: int = 1000,
                    run_id: str = "run") -> DataFrame:
    """Runs of single-text queries (qid, text) over raw text, every field with weight 1.

    A query that cannot be parsed (see :func:`query.usable`) matches all documents.
    """
    from .query import flat_query_terms, usable

    queries = written(queries.select("qid", "text", usable(F.col("text")).alias("usable")), "queries")
    found = search_text(flat_query_terms(queries.where("usable"), query_analyzer), docs, analyzer, sim, k, run_id)
    return found.unionByName(match_all(queries.where("not usable"), docs, k, run_id))
