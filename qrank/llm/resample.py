"""Quality classifier by importance resampling.

Two generative models of hashed word unigrams and bigrams: of the target
(labelled good, not toxic) and of all raw text.  A document's weight is the
log ratio of the two over its n-grams; documents are sampled without
replacement by Gumbel top-k: the k largest of weight + Gumbel noise.

Counts run over every document and merge by aggregation into tables of fixed
size.  A bucket counts only where target and raw differ by more than chance
(``Z`` standard errors), since over long texts the noise of millions of rare
buckets would drown the evidence; each weight is divided by the square root of
the text's n-grams for the same reason.  k is not a constant: it is the number
of documents that a cut is expected to keep, noise included.  The cut is set on
labelled rows that the target model has not seen, low quality and toxic ones
weighed apart, so that the expected share of clean rows stays above a bound.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, broadcast_if_small, content_key, materialize, slices
from .rules import label_rows

#: Buckets of unigrams and of bigrams.
UNI, BI = 1 << 20, 1 << 16
SMOOTH, Z = 0.5, 2.5
#: Share of labelled documents kept out of the target model for the threshold: one of this many.
HOLD_OUT = 4
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")


def buckets(text: bytes | None, known: dict[bytes, int]) -> np.ndarray:
    """Bucket of each word (or run of signs) and each pair of neighbours."""
    from xxhash import xxh64_intdigest

    words = TOKEN.findall((text or b"").translate(LOWER))
    if len(known) > 300_000:
        known.clear()
    h = []
    for w in words:
        x = known.get(w)
        if x is None:
            x = known[w] = xxh64_intdigest(w)
        h.append(x)
    h = np.array(h, np.uint64)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    pair ^= pair >> np.uint64(29)
    return np.concatenate([h & np.uint64(UNI - 1), UNI + (pair & np.uint64(BI - 1))]).astype(np.int64)


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, raw, target) over ``rows`` (text, good); partial counts per task, then a sum."""

    def run(batches):
        raw, good, known = np.zeros(UNI + BI, np.int64), np.zeros(UNI + BI, np.int64), {}
        for b in batches:
            texts, flags = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                for table, some in ((raw, texts[lo:hi]), (good, [t for t, x in zip(texts[lo:hi], flags[lo:hi]) if x])):
                    if some:
                        table += np.bincount(np.concatenate([buckets(t, known) for t in some]), minlength=UNI + BI)
        some = np.flatnonzero(raw)
        for i in range(0, len(some), 1 << 17):
            k = some[i:i + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(raw[k]), pa.array(good[k])],
                                             ["bucket", "raw", "target"])

    part = rows.mapInArrow(run, "bucket int, raw long, target long")
    return part.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def bucket_weights(counts: DataFrame) -> np.ndarray:
    """Log of target to raw probability per bucket, 0 where the counts agree within chance.

    ``counts`` is a written table.  Only buckets that count come to the driver,
    at most UNI + BI rows whatever the corpus.
    """
    bi = F.col("bucket") >= UNI
    out = np.zeros(UNI + BI, np.float32)
    for part, (raw, target) in {r[0]: r[1:] for r in counts.groupBy(bi).agg(F.sum("raw"), F.sum("target")).collect()}.items():
        if not target:
            continue
        want = F.col("raw") * F.lit(target / raw)
        some = (counts.where((bi == part) & (F.abs(F.col("target") - want) > Z * F.sqrt(want + 1)))
                .select("bucket", F.log((F.col("target") + SMOOTH) / (want + SMOOTH)).cast("float").alias("w")).toArrow())
        out[some["bucket"].to_numpy()] = some["w"].to_numpy()
    return out


def kth_largest(keys: DataFrame, k: int, column: str = "key") -> tuple[float, int]:
    """The k-th largest value of a double column and how many rows are larger.

    Exact, by narrowing a range in 1,024 steps per pass: each pass is one small
    aggregation, whatever the number of rows.
    """
    lo, hi, above = *keys.agg(F.min(column), F.max(column)).first(), 0
    while lo < hi:
        width = (hi - lo) / 1024
        if lo + width <= lo:
            break
        step = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(1023))
        bins = {r[0]: (r[1], r[2], r[3]) for r in keys.where(F.col(column).between(lo, hi)).groupBy(step.alias("s"))
                .agg(F.count(F.lit(1)), F.min(column), F.max(column)).collect()}  # at most 1,024 rows
        for s in sorted(bins, reverse=True):
            n, low, high = bins[s]
            if above + n >= k:
                break
            above += n
        lo, hi = low, high
    return hi if lo == hi else lo, above


def importance_resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        temperature: float = 0.05, clean_share: float = 0.99, max_calibration: int = 20_000,
                        seed: int = 11) -> DataFrame:
    """(doc_id, _k1, _k2, log_weight, gumbel_key, kept) of each row of ``docs``.

    kept: the row is among the k largest Gumbel keys (weight / temperature +
    noise).  k is the sum, over all rows, of the chance that the key passes
    cut / temperature; the cut is the one that keeps least of the held-out low
    quality rows and of the toxic ones (two shares, added) among those that
    are expected to keep ``clean_share`` of the held-out clean rows.  It is set
    on at most ``max_calibration`` held-out rows, drawn by a hash of the id;
    counts, weights and k cover all rows.  Equal keys at the border go by content key, and wholly repeated
    rows are kept or dropped together.  The noise is a hash of the row's
    content, so a re-run task draws the same.  Null, empty and unknown texts
    have weight 0.  Without any target label every row is kept.  Of repeated
    labels the worst counts.  An empty table gives no row; other columns are
    not read.
    """
    known = materialize(label_rows(labels).where(F.col("quality").isNotNull())
                        .select("doc_id", ((F.col("quality") >= 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"),
                                (F.coalesce("toxic", F.lit(0)) != 0).alias("toxic")), "labels")
    held = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(HOLD_OUT)) == 0
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    marked = d.join(broadcast_if_small(known.where("good").where(~held).select("doc_id", "good"), 2_000_000, 16), "doc_id", "left")
    counts = materialize(bucket_counts(marked.select("t", F.coalesce("good", F.lit(False)).alias("good"))), "buckets")
    learned = counts.where("target > 0").limit(1).count() > 0
    ratio = docs.sparkSession.sparkContext.broadcast(bucket_weights(counts))  # fixed size, 4 MB

    def run(batches):
        words: dict[bytes, int] = {}
        w = ratio.value
        for b in batches:
            out = []
            for t in b.column(3):
                x = buckets(t.as_py(), words)
                out.append(float(w[x].sum(dtype=np.float64)) / np.sqrt(len(x)) if len(x) else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.float64())], ["doc_id", "_k1", "_k2", "log_weight"])

    scored = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), *content_key(id_col, text_col),
                                     F.col(text_col).cast("binary").alias("t"))
                         .mapInArrow(run, "doc_id long, _k1 long, _k2 long, log_weight double"), "weights")
    u = (F.pmod(F.xxhash64("_k1", "_k2", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = scored.withColumn("gumbel_key", F.col("log_weight") / temperature - F.log(-F.log(u)))
    if not learned:
        return keyed.withColumn("kept", F.lit(True))
    cal = (scored.join(known, "doc_id").where(held).orderBy(F.xxhash64("doc_id", F.lit(seed + 1))).limit(max_calibration)
           .select("log_weight", "good", "toxic").toArrow())
    w, good, toxic = (cal[c].to_numpy() for c in ("log_weight", "good", "toxic"))
    cut = choose_cut(w, good.astype(bool), toxic.astype(bool), temperature, clean_share)
    chance = 1 - F.exp(-F.exp((F.col("log_weight") - cut) / temperature))
    return _top(keyed, chance)


def choose_cut(w: np.ndarray, good: np.ndarray, toxic: np.ndarray, temperature: float, clean_share: float) -> float:
    """The cut that is expected to keep least of the bad and of the toxic weights, two shares, while
    it keeps ``clean_share`` of the good ones; 0 without good or without other weights."""
    parts = [good, ~good & ~toxic, ~good & toxic]
    if not good.any() or good.all():
        return 0.0
    grid = np.r_[w.min() - 10 * temperature, np.unique(np.quantile(w, np.linspace(0, 1, 513)))]
    kept = np.zeros((3, len(grid)))
    for i, part in enumerate(parts):
        if part.any():
            power = np.minimum((w[part][None, :] - grid[:, None]) / temperature, 50)
            kept[i] = (1 - np.exp(-np.exp(power))).mean(axis=1)
    fine = kept[0] >= clean_share
    return float(grid[np.argmin(np.where(fine, kept[1] + kept[2], np.inf))]) if fine.any() else float(grid[0])


def _top(keyed: DataFrame, chance: Column) -> DataFrame:
    """``kept`` for the k rows of the largest key, k the sum of the rows' chances."""
    keyed = materialize(keyed, "gumbel")
    k = round(keyed.agg(F.sum(chance)).first()[0] or 0)
    if not k:
        return keyed.withColumn("kept", F.lit(False))
    edge, above = kth_largest(keyed, k, "gumbel_key")
    tied = keyed.where(F.col("gumbel_key") == edge).select("_k1", "_k2").distinct().orderBy("_k1", "_k2").limit(max(1, k - above))
    inside = F.col("gumbel_key") > edge
    at = F.broadcast(tied.withColumn("_in", F.lit(True)))  # rows of one 52-bit noise value and one weight
    return (keyed.join(at, ["_k1", "_k2"], "left")
            .withColumn("kept", inside | F.coalesce("_in", F.lit(False))).drop("_in"))


def keep_resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the resampling keeps, columns as they came (names that clash with
    internal ones too).  Null and empty texts are rows like others, of weight 0; repeated rows stay
    or go together, rows of one id and different texts each by its own text; an empty table stays
    empty, and without any target label every row stays."""
    kept = importance_resample(docs, labels, id_col, text_col).where("kept").select("_k1", "_k2").distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *content_key(id_col, text_col))
    return keyed.join(kept, ["_k1", "_k2"], "left_semi").select("_row.*")
