"""SGML news collections -> fielded document table.

Each file holds several ``<DOC> ... </DOC>`` records.  Files are read a record
at a time and large files in several splits; a record's position in its file
comes from its split's start and its place there.  Every collection's tag map
extracts docno, headline, text and a year.  Collections are unioned.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import extract_tag, extract_year, ft_year, remove_pjg
from ..plans.sizing import bounded_broadcast

# Fixed value: the record format.
DOC_RE = r"<DOC>\s([\s\S]*?)</DOC>"

# Tag map per collection (headline tags, text tags in
# concatenation order, date tag, date rule, PJG comment removal).
COLLECTIONS = {
    "latimes": {"headline": "HEADLINE", "text": ("TEXT",), "date": "DATE", "rule": "year", "pjg": False},
    "ft": {"headline": "HEADLINE", "text": ("TEXT",), "date": "DATE", "rule": "ft", "pjg": False},
    "fr94": {"headline": "DOCTITLE", "text": ("SUMMARY", "SUPPLEM", "TEXT"), "date": "DATE", "rule": "year", "pjg": True},
    "fbis": {"headline": "TI", "text": ("TEXT",), "date": "DATE1", "rule": "year", "pjg": False},
}


def subfolder_of(path: F.Column, root: str | None = None) -> F.Column:
    """The direct child of the collection's ``root`` that a file lies below, at any
    depth (without a root: of the path's first part)."""
    return F.regexp_extract(path, (re.escape(root) if root else "^[^/]+") + "/([^/]+)/", 1)


def read_docs(spark: SparkSession, root: str) -> DataFrame:
    """(path, subfolder, pos, raw): the documents of all files below sub-folders of ``root``.

    The record end is the line separator, so Spark cuts large files into
    splits.  Rows of a split are numbered in one task; a file's splits are
    offset by their counts (one row per split), so no file becomes one task.
    """
    rows = (spark.read.option("recursiveFileLookup", True).option("lineSep", "</DOC>").text(root)
            .select(F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("start"),
                    F.regexp_extract("value", r"<DOC>\s([\s\S]*)$", 1).alias("raw"), F.col("value").rlike(r"<DOC>\s").alias("whole")))
    # Only files inside a sub-folder of the collection root are documents.
    rows = rows.where(F.col("whole") & F.col("path").rlike(re.escape(root) + r"/[^/]+/.+$"))
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    splits = rows.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    w = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = splits.withColumn("off", F.coalesce(F.sum("n").over(w), F.lit(0))).select("path", "start", "first", "off")
    return rows.join(splits, ["path", "start"]).select(
        "path", subfolder_of(F.col("path"), root).alias("subfolder"), (F.col("off") + F.col("at") - F.col("first")).alias("pos"), "raw")


def split_docs(files: DataFrame) -> DataFrame:
    """(path, subfolder, pos, raw): documents of whole-file rows (path, value), in file order."""
    return files.select("path", subfolder_of(F.col("path")).alias("subfolder"),
                        F.posexplode(F.regexp_extract_all("value", F.lit(DOC_RE), 1)).alias("pos", "raw"))


def ingest(docs: DataFrame, collection: str, null_text: str = "") -> DataFrame:
    """Fielded documents of one collection from raw document rows.

    Missing headline/text tags give NULL fields; a missing date gives the
    string 'null'.  For multi-part texts a missing part is replaced by
    ``null_text`` ('null' reproduces the original concatenation).
    """
    spec = COLLECTIONS[collection]
    raw = remove_pjg(F.col("raw")) if spec["pjg"] else F.col("raw")
    d = docs.withColumn("_doc", raw)
    doc = F.col("_doc")
    if len(spec["text"]) == 1:
        text = extract_tag(doc, spec["text"][0])
    else:
        text = F.concat(*[F.coalesce(extract_tag(doc, t), F.lit(null_text)) for t in spec["text"]])
    date = extract_tag(doc, spec["date"])
    year = ft_year(date) if spec["rule"] == "ft" else extract_year(date)
    year = F.when(date.isNull(), F.lit("null")).otherwise(year)
    return d.select(F.trim(extract_tag(doc, "DOCNO")).alias("docno"), F.lit(collection).alias("collection"),
                    *[c for c in ("path", "subfolder", "pos") if c in docs.columns],
                    extract_tag(doc, spec["headline"]).alias("headline"), text.alias("text"), year.alias("date"))


def read_collection(spark: SparkSession, root: str, collection: str, null_text: str = "") -> DataFrame:
    """All documents below the sub-folders of ``root`` (files directly in
    ``root`` are not read)."""
    return ingest(read_docs(spark, root.rstrip("/")), collection, null_text)


def read_all(spark: SparkSession, roots: dict[str, str], null_text: str = "") -> DataFrame:
    """Union of several collections ({collection: root folder})."""
    out = None
    for coll, root in roots.items():
        df = read_collection(spark, root, coll, null_text)
        out = df if out is None else out.unionByName(df)
    return out


def doc_ordinal(docs: DataFrame) -> DataFrame:
    """Add ``ordinal``: 1-based position of each document in its sub-folder
    (files in path order, documents in file order).

    Computed from a one-row-per-file table (document counts and running
    offsets), so a huge sub-folder never becomes one window task.
    """
    keys = ["collection", "subfolder"]
    files = docs.groupBy(*keys, "path").agg((F.max("pos") + 1).alias("n"))
    w = Window.partitionBy(*keys).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    offs = files.withColumn("offset", F.coalesce(F.sum("n").over(w), F.lit(0))).select(*keys, "path", "offset")
    offs = bounded_broadcast(offs, 5_000_000)
    return docs.join(offs, keys + ["path"]).withColumn("ordinal", F.col("offset") + F.col("pos") + 1).drop("offset")


def sample_every(docs: DataFrame, step: int) -> DataFrame:
    """Every ``step``-th document of each sub-folder in file order."""
    if step <= 1:
        return docs
    return doc_ordinal(docs).where((F.col("ordinal") - 1) % step == 0).drop("ordinal")


def sample_head(docs: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` documents of each sub-folder (sample dump)."""
    return doc_ordinal(docs).where(F.col("ordinal") <= n)


def collection_counts(docs: DataFrame, step: int = 1) -> DataFrame:
    """Documents per collection (after sampling every ``step``-th)."""
    return sample_every(docs, step).groupBy("collection").agg(F.count(F.lit(1)).alias("n_docs"))
