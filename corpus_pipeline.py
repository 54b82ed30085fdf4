"""Corpus pipeline: classifier, line dedup, near-dedup, decontamination, packing.

Each stage takes all rows its predecessor kept and, but for the last, returns
the columns of ``documents``; stages are written once and reread.  Columns
beside those, with whatever names, travel along; an empty table stays empty in
every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qrank.llm import catalog, decontam, lines, packing, resample, simhash
from qrank.llm.common import materialize, table

#: No SQL: trained scores, XXH64 fingerprints and a tokenizer have none.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps.  Null and empty texts weigh 0 and are judged
    by that; repeated rows stay or go together; ties at the border go by content."""
    return resample.keep_resampled(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that spread over many sites; n_chars follows the text.  A null
    text stays null, a null source is no site; the smallest doc_id keeps the line's first place."""
    out = lines.dedup_lines(docs, catalog.MIN_SITES)
    return out.withColumn("n_chars", lines.length_of("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id, of equal ids the smallest
    content key, of wholly repeated rows one.  Null and empty texts form one component."""
    return simhash.keep_one(docs, n=3, budget=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage; null and empty texts have none."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; a null text is empty, its
    piece holds the end token alone; repeated rows are packed as often as they stand."""
    return packing.pack_documents(docs, catalog.tokenizer_file(), end_id=1)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written once and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
