"""Topic files, numbered query lists and synonym facts.

* topics: ``<top> <num> Number: n <title> ... <desc> Description: ...
  <narr> Narrative: ... </top>`` blocks -> (qid, title, desc, narr, date)
* numbered queries: ``n. text`` lines -> (qid, text), qid = first + position
* synonym facts: ``s(synset,w_num,'word',pos,sense,tag).`` lines -> nouns
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import QUERY_SPECIAL, topic_dates
from ..plans.sizing import sequential_index
from ..plans.tables import written
from .lines import placed_lines

# The formats of topic blocks, section labels and synonym facts.
TOP_RE = r"<top>\s([\s\S]*?)</top>"
LABEL_RE = r"^\s*(Number:|Description:|Narrative:)\s*"
SYNSET_RE = r"s\((\d+),\d+,'(.*?)',n,\d+,\d+\)\."


def sanitize_block(c: F.Column) -> F.Column:
    """Newlines/tabs to spaces; query-syntax characters removed."""
    return F.regexp_replace(F.regexp_replace(c, r"[\n\t]", " "), QUERY_SPECIAL, "")


def _section(block: F.Column, tag: str, nxt: str | None) -> F.Column:
    pat = f"<{tag}>([\\s\\S]*?)(?=<{nxt}>)" if nxt else f"<{tag}>([\\s\\S]*?)$"
    has = block.rlike(f"<{tag}>")
    body = F.regexp_replace(F.regexp_extract(block, pat, 1), LABEL_RE, "")
    return F.when(has & ((F.lit(nxt is None)) | block.rlike(f"<{tag}>[\\s\\S]*?<{nxt}>" if nxt else ".")), body)


def parse_topics(files: DataFrame, value_col: str = "value") -> DataFrame:
    """Topic blocks of whole-file rows -> (qid, title, desc, narr, date)."""
    blocks = files.select(F.explode(F.regexp_extract_all(F.col(value_col), F.lit(TOP_RE), 1)).alias("raw"))
    return topics_from_blocks(blocks)


def topics_from_blocks(blocks: DataFrame, raw_col: str = "raw") -> DataFrame:
    b = blocks.withColumn("_b", sanitize_block(F.col(raw_col)))
    blk = F.col("_b")
    return b.select(F.trim(_section(blk, "num", "title")).alias("qid"),
                    _section(blk, "title", "desc").alias("title"),
                    _section(blk, "desc", "narr").alias("desc"),
                    _section(blk, "narr", None).alias("narr"),
                    topic_dates(blk).alias("date"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    return parse_topics(files)


def numbered_queries(lines: DataFrame, first_qid: int = 401, order_col: str = "line_no",
                     text_col: str = "value") -> DataFrame:
    """Numbered lines ('n. text') -> (qid, text): numbering stripped,
    blank lines dropped, qid = first_qid + position among kept lines.

    ``order_col`` is any order of the lines.  Positions come from a range sort
    that is written once and the sizes of its parts.
    """
    t = F.regexp_replace(F.trim(F.col(text_col)), r"^\d+\.\s*", "")
    kept = lines.select(F.col(order_col).alias("_o"), t.alias("text")).where(F.col("text") != "")
    kept = written(kept.repartitionByRange("_o").sortWithinPartitions("_o").select("text", F.monotonically_increasing_id().alias("_at")), "numbered")
    kept = sequential_index(kept, "_at")
    return kept.select((F.lit(first_qid - 1) + F.col("idx")).cast("string").alias("qid"), "text")


def read_numbered_queries(spark: SparkSession, path: str, first_qid: int = 401) -> DataFrame:
    return numbered_queries(placed_lines(spark, path), first_qid)


def synsets(lines: DataFrame, order_col: str = "line_no", text_col: str = "value") -> DataFrame:
    """Noun synonym facts -> (synset_id, seq, word); seq keeps file order."""
    m = F.regexp_extract(F.col(text_col), SYNSET_RE, 1)
    return (lines.where(F.col(text_col).rlike(SYNSET_RE))
                 .select(m.alias("synset_id"), F.col(order_col).alias("seq"),
                         F.regexp_extract(F.col(text_col), SYNSET_RE, 2).alias("word")))


def read_synsets(spark: SparkSession, path: str) -> DataFrame:
    return synsets(placed_lines(spark, path))


def synset_of(syn: DataFrame) -> DataFrame:
    """(wl, synset_id): for each lower-cased word the first synset (in file order) that contains it."""
    first_seen = syn.groupBy("synset_id").agg(F.min("seq").alias("first"))
    return (syn.select("synset_id", F.lower("word").alias("wl")).distinct().join(first_seen, "synset_id")
            .groupBy("wl").agg(F.min_by("synset_id", F.struct("first", "synset_id")).alias("synset_id")))


def expand_synonyms(blocks: DataFrame, syn: DataFrame, raw_col: str = "raw", key: str = "block_id") -> DataFrame:
    """Raw topic text with each whitespace-separated word followed by its
    synonyms: the other members of its synset, in file order.

    Words meet synsets, and synsets their members, in equi-joins: a synset of
    any size stays a table of one row per member, and only a text that uses it
    is as long as its members.
    """
    words = blocks.select(key, F.posexplode(F.split(F.col(raw_col), r"\s+")).alias("pos", "word"))
    named = words.select(key, "pos", F.lower("word").alias("wl")).join(synset_of(syn), "wl")
    members = syn.select("synset_id", "seq", "word")
    added = named.join(members, "synset_id").where(F.lower("word") != F.col("wl")).select(key, "pos", "seq", "word")
    rows = words.select(key, "pos", F.lit(None).cast(dict(syn.dtypes)["seq"]).alias("seq"), "word").unionByName(added)
    return (rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("seq").isNotNull().alias("more"), "seq", "word"))).alias("parts"))
            .select(key, F.array_join(F.col("parts.word"), " ").alias(raw_col)))
