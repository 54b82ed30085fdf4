r"""Benchmark decontamination by winnowing, in DataFrame functions only.

A fingerprint is the hash of ``K`` consecutive words; of every ``W``
consecutive fingerprints the smallest are kept (all of equal smallest ones).
Any span of K + W - 1 words that a document shares with an item therefore
leaves a kept fingerprint in both: with K = 5 and W = 6 that is every window
of 10 words, and no shared window is missed.  Kept fingerprints of documents
meet those of the items; each hit is extended to the windows around it, which
are compared word for word.  Items shorter than a window are one window of m
words, found by the same steps with K = (m + 1) // 2 and W = m - K + 1.

Only positions whose fingerprint the benchmark has leave the stage that reads
the documents.  The benchmark side is broadcast where its counted size allows,
else Spark shuffles slim (fingerprint, position) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, content_key, is_small, materialize

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of the benchmark's tables that may be broadcast (also bounded by 32 MB).
SMALL = 500_000


def words(text: Column) -> Column:
    r"""Lower-cased A-Z, then runs of digits, a-z and non-ASCII characters; null: none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def sizes(m: int) -> tuple[int, int]:
    """(K, W) that find every shared span of ``m`` words."""
    k = (m + 1) // 2
    return k, m - k + 1


def winnowed(d: DataFrame, m: int, hashes: str = "hw") -> DataFrame:
    """Kept fingerprints (pos, fp) of array column ``hashes`` for spans of ``m`` words; other columns stay.

    A fingerprint is the smallest of some whole window if the run of larger or
    equal neighbours around it, itself included, is at least W long.
    """
    k, w = sizes(m)
    grams = F.when(F.size(hashes) >= m, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*(F.get(F.col(hashes), i + j) for j in range(k)))))
    # Not a plain explode: its inferred size filter would be pushed down and repeat the hashing per word.
    out = d.withColumn("_g", grams).drop(hashes).select("*", F.posexplode_outer("_g").alias("pos", "fp"))

    def run(step: int) -> Column:
        length = F.lit(0)
        for off in range(w - 1, 0, -1):
            length = F.when(F.get(F.col("_g"), F.col("pos") + step * off) >= F.col("fp"), length + 1).otherwise(0)
        return length

    return out.where(F.col("fp").isNotNull() & (run(-1) + run(1) >= w - 1)).drop("_g")


def item_windows(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, m, words of the window): windows of each item, repeats once."""
    d = bench.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    m = F.least(F.size("w"), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), F.size("w") - m)
    return (d.select("item_id", m.alias("m"), "w", F.explode(starts).alias("s"))
            .select("item_id", "m", F.array_join(F.slice("w", F.col("s") + 1, F.col("m")), " ").alias("window")).distinct())


def find_windows(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, small: int = SMALL) -> DataFrame:
    """(_k1, _k2, start, m, window) of every occurrence of a window in the documents."""
    d = (docs.select(*content_key(id_col, text_col), words(F.col(text_col)).alias("w"))
         .withColumn("hw", word_hashes(F.col("w"))))
    found = None
    for m in sorted(r[0] for r in windows.select("m").distinct().collect()):  # at most WINDOW values
        k, w = sizes(m)
        mine = windows.where(F.col("m") == m).select("window").distinct()
        marks = winnowed(mine.select(word_hashes(F.split("window", " ")).alias("hw")), m)
        marks = materialize(marks.select("fp").distinct(), "marks")
        mine = broadcast_if_small(materialize(mine, "windows"), small, 200)
        low, high = F.greatest(F.col("pos") - (w - 1), F.lit(0)), F.least(F.col("pos"), F.col("n") - m)
        if is_small(marks, small, 16):  # the words are still in the row where a hit is found
            hits = winnowed(d.withColumn("n", F.size("w")), m).join(F.broadcast(marks), "fp", "left_semi")
        else:  # slim rows are shuffled; texts with hits are read again
            spots = winnowed(d.select("_k1", "_k2", "hw"), m).join(marks, "fp", "left_semi")
            spots = spots.groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("at"))  # of one document
            hits = (d.select("_k1", "_k2", "w", F.size("w").alias("n")).join(spots, ["_k1", "_k2"])
                    .select("_k1", "_k2", "w", "n", F.explode("at").alias("pos")))
        near = (hits.select("_k1", "_k2", "w", F.explode(F.sequence(low, high)).alias("start"))
                .select("_k1", "_k2", "start", F.array_join(F.slice("w", F.col("start") + 1, m), " ").alias("window"))
                .join(mine, "window").withColumn("m", F.lit(m)))
        found = near if found is None else found.unionByName(near)
    return found


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, _k1, _k2.

    n_hit: words inside an occurrence of a window of any item; n_items and
    items_sha256: the items with a window there (ids sorted as strings, comma
    joined, SHA-256 in hex; of none: of the empty string).  Null and empty
    texts have no words, null and empty items no window.  Item rows with a null
    id count towards n_hit alone; repeated item ids are one item.  Repeated
    document rows each get their row.  Other columns are not read.
    """
    windows = materialize(item_windows(bench, item_id_col, item_text_col), "item-windows")
    base = docs.select(F.col(id_col).alias("doc_id"), *content_key(id_col, text_col),
                       F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.sha2(F.lit(""), 256)
    found = find_windows(docs, windows, id_col, text_col) if not windows.isEmpty() else None
    if found is None:
        return base.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           none.alias("items_sha256"), F.lit(False).alias("contaminated"), "_k1", "_k2")
    # Windows with the same items form a class; documents hold class numbers, not items.
    of_window = windows.groupBy("m", "window").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    of_window = materialize(of_window.withColumn("cls", F.xxhash64("items")), "window-classes")
    per_doc = (found.join(broadcast_if_small(of_window.select("m", "window", "cls"), SMALL, 200), ["m", "window"])
               .groupBy("_k1", "_k2").agg(
                   F.array_sort(F.collect_set(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("m")).alias("e")))).alias("spans"),
                   F.array_sort(F.collect_set("cls")).alias("classes")))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, x: F.struct(
        F.greatest(a["end"], x["e"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n")))["n"]
    per_doc = materialize(per_doc.select("_k1", "_k2", covered.cast("long").alias("n_hit"), "classes"), "contaminated")
    # Each distinct set of classes is expanded to items once, however many documents share it.
    sets = per_doc.select("classes").distinct()
    members = of_window.groupBy("cls").agg(F.first("items").alias("items"))
    items = (sets.select("classes", F.explode("classes").alias("cls")).join(members, "cls")
             .select("classes", F.explode("items").alias("item")).distinct()
             .groupBy("classes").agg(F.array_sort(F.collect_list("item")).alias("items"))
             .select("classes", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    hit = per_doc.join(items, "classes", "left").select("_k1", "_k2", "n_hit", "n_items", "items_sha256")
    return base.join(hit, ["_k1", "_k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "_k1", "_k2")


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, columns as they came."""
    bad = contamination(docs, bench, id_col, text_col, item_id_col, item_text_col).where("contaminated")
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *content_key(id_col, text_col))
    return keyed.join(bad.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_anti").select("_row.*")
