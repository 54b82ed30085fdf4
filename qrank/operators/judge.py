"""Judged rankings: a run joined with its judgments (one row per retrieved doc).

Every effectiveness measure is a function of the ordered relevance list of a
topic plus per-topic judgment counts, so this table is built once and all
measures are window/aggregate columns over it (see ``measures``).

Relevance codes on judged rows follow the usual convention:
``-1`` retrieved but not in the judgment pool, ``-2`` pooled but unjudged
(a judgment below zero), otherwise the judged level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import bounded_broadcast
from ..plans.tables import written

NONPOOL = -1
UNJUDGED = -2
# Judgments up to this many rows are broadcast to the run side.
MAX_QRELS_BROADCAST = 5_000_000
# Fixed value: chunk length when summing rank discounts over long ranges.
DISCOUNT_CHUNK = 4096


@dataclass(frozen=True)
class EvalOptions:
    """Evaluation options (relevance level, truncation, judged-only, ...)."""

    level: int = 1                       # minimum level counted as relevant
    max_docs: int | None = None          # keep only the top M docs per topic
    judged_only: bool = False            # drop unjudged docs, then re-rank
    complete: bool = False               # average over all judged topics
    num_docs_in_coll: int = 0            # collection size (utility measure)
    gains: dict = field(default_factory=dict)  # level -> gain overrides
    skew_safe: bool | None = None        # ranking plan: None = chosen from the largest topic
    topic: str | None = None             # evaluate this one topic only
    validate: bool = True                # a document twice in a topic, of the run or the judgments, ends the job


def rank_run(run: DataFrame, docno_desc: bool = True) -> DataFrame:
    """Rank documents per (run_id, qid) by score desc, then docno.

    The judgment path breaks score ties by docno descending, the
    preference path by docno ascending.
    """
    tie = F.desc("docno") if docno_desc else F.asc("docno")
    w = Window.partitionBy("run_id", "qid").orderBy(F.desc("sim"), tie)
    return run.withColumn("rank", F.row_number().over(w))


def gain_expr(rel: F.Column, gains: dict) -> F.Column:
    """Gain of a judged level: the level itself unless overridden; 0 below 0."""
    g = F.when(rel >= 0, rel.cast("double")).otherwise(F.lit(0.0))
    for lvl, val in sorted(gains.items()):
        g = F.when(rel == F.lit(int(lvl)), F.lit(float(val))).otherwise(g)
    return g


def discount_sums(ranges: DataFrame, keys: list[str], lo: str, hi: str,
                  out: str = "dsum") -> DataFrame:
    """Sum of 1/log2(p+1) for p in [lo, hi] per row of ``ranges``.

    Long ranges are cut into fixed-size chunks that are spread over tasks,
    so a topic with a huge number of judged documents never lands in one
    array or one task.
    """
    c = DISCOUNT_CHUNK
    chunks = (ranges.where(F.col(hi) >= F.col(lo))
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(hi) - F.col(lo)) / c))))
              .withColumn("_a", F.col(lo) + F.col("_chunk") * c)
              .withColumn("_b", F.least(F.col(hi), F.col("_a") + (c - 1)))
              .repartition(*keys, "_chunk"))
    part = chunks.select(*keys, F.aggregate(F.sequence("_a", "_b"), F.lit(0.0),
                                            lambda acc, p: acc + 1.0 / F.log2(p + 1)).alias("_d"))
    return part.groupBy(*keys).agg(F.sum("_d").alias(out))


def topic_stats(qrels: DataFrame, opts: EvalOptions = EvalOptions(), keys: tuple = ("qid",),
                with_ideal: bool = True) -> DataFrame:
    """Per-topic judgment counts and the ideal ranking as gain segments.

    Columns: qid, num_rel, num_nonrel, num_judged, num_rel_pos, max_level,
    ideal_n (judged docs with positive gain), ideal_gain_sum, ideal_dcg,
    segs (array of (g, start, end, icum) in ideal order, equal gains merged;
    icum = ideal DCG at the segment end) and lsegs (same for raw positive
    levels, used by the cut-off nDCG which ignores gain overrides).
    """
    L = opts.level
    rel = F.col("rel")
    keys = list(keys)
    counts = qrels.groupBy(*keys).agg(
        F.count_if(rel >= L).alias("num_rel"),
        F.count_if((rel >= 0) & (rel < L)).alias("num_nonrel"),
        F.count_if(rel >= 0).alias("num_judged"),
        F.count_if(rel > 0).alias("num_rel_pos"),
        F.max(F.when(rel >= 0, rel)).alias("max_level"))

    levels = qrels.where(rel >= 0).groupBy(*keys, "rel").agg(F.count(F.lit(1)).alias("n"))

    def segments(df: DataFrame, prefix: str) -> DataFrame:
        # df: (keys, g, n) with g > 0 -> ordered segments with cumulative ideal DCG.
        w = Window.partitionBy(*keys).orderBy(F.desc("g"))
        seg = (df.withColumn("end", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("start", F.col("end") - F.col("n") + 1))
        d = discount_sums(seg, keys + ["g"], "start", "end")
        seg = (seg.join(d, keys + ["g"], "left")
                  .withColumn("contrib", F.col("g") * F.coalesce("dsum", F.lit(0.0)))
                  .withColumn("icum", F.sum("contrib").over(w.rowsBetween(Window.unboundedPreceding, 0))))
        return seg.groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct(F.col("start"), F.col("end"), F.col("g"), F.col("icum"))))
             .alias(f"{prefix}segs"),
            F.sum("n").alias(f"{prefix}ideal_n"),
            F.sum(F.col("g") * F.col("n")).alias(f"{prefix}ideal_gain_sum"),
            F.sum("contrib").alias(f"{prefix}ideal_dcg"))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,g:double,icum:double>>")
    if not with_ideal:
        # Measures without gains need no ideal ranking.
        out = (counts.withColumn("segs", empty).withColumn("lsegs", empty)
                     .withColumn("ideal_n", F.lit(0).cast("bigint")).withColumn("ideal_gain_sum", F.lit(0.0))
                     .withColumn("ideal_dcg", F.lit(0.0)))
        return out.select(*keys, "num_rel", "num_nonrel", "num_judged", "num_rel_pos", "max_level",
                          "segs", "lsegs", "ideal_n", "ideal_gain_sum", "ideal_dcg")
    gained = (levels.withColumn("g", gain_expr(rel, opts.gains)).where(F.col("g") > 0)
              .groupBy(*keys, "g").agg(F.sum("n").alias("n")))
    raw = levels.where(rel > 0).select(*keys, rel.cast("double").alias("g"), "n")
    out = (counts.join(segments(gained, ""), keys, "left")
                 .join(segments(raw, "l").select(*keys, "lsegs"), keys, "left"))
    return out.select(
        *keys, "num_rel", "num_nonrel", "num_judged", "num_rel_pos", "max_level",
        F.coalesce("segs", empty).alias("segs"), F.coalesce("lsegs", empty).alias("lsegs"),
        F.coalesce("ideal_n", F.lit(0)).cast("bigint").alias("ideal_n"),
        F.coalesce("ideal_gain_sum", F.lit(0.0)).alias("ideal_gain_sum"),
        F.coalesce("ideal_dcg", F.lit(0.0)).alias("ideal_dcg"))


def unique_judgments(qrels: DataFrame, keys=("qid",)) -> DataFrame:
    """(keys, docno, rel): the judgments; a document judged twice ends the job that reads them."""
    said = F.raise_error(F.concat(F.lit("duplicate document for a topic in the judgments: "), *keys_text(keys), "docno"))
    return (qrels.groupBy(*keys, "docno").agg(F.count(F.lit(1)).alias("_n"), F.max("rel").alias("rel"))
            .withColumn("rel", F.when(F.col("_n") > 1, said.cast("bigint")).otherwise(F.col("rel"))).select(*keys, "docno", "rel"))


def keys_text(keys) -> list[F.Column]:
    return [x for k in keys for x in (F.coalesce(F.col(k).cast("string"), F.lit("null")), F.lit(" "))]


def unique_documents(ranked: DataFrame, keys=("qid",), skew_safe: bool | None = False) -> DataFrame:
    """``ranked`` as it is; a document twice in a topic of a run ends the job that reads it.

    The rows of a topic lie together already, to be ranked, so a sort by docno
    brings equal ones next to each other without a shuffle; where topics are
    too large for that (``skew_safe``) the documents are dealt out by name.
    """
    group = ["run_id", *keys]
    if skew_safe:
        again = F.row_number().over(Window.partitionBy(*group, "docno").orderBy("docno")) > 1
    else:
        again = F.coalesce(F.lag("docno").over(Window.partitionBy(*group).orderBy("docno")) == F.col("docno"), F.lit(False))
    said = F.raise_error(F.concat(F.lit("duplicate document for a topic in the run: "), *keys_text(group), "docno")).cast("boolean")
    return ranked.withColumn("_again", again).where(F.when(F.col("_again"), said).otherwise(F.lit(True))).drop("_again")


def restrict(run: DataFrame, qrels: DataFrame, opts: EvalOptions) -> tuple[DataFrame, DataFrame]:
    """Apply the one-topic filter of ``opts``."""
    if opts.topic is not None:
        run = run.where(F.col("qid") == opts.topic)
        qrels = qrels.where(F.col("qid") == opts.topic)
    return run, qrels


def judge(run: DataFrame, qrels: DataFrame, opts: EvalOptions = EvalOptions(),
          stats: DataFrame | None = None, max_topics_broadcast: int = 2_000_000,
          keys: tuple = ("qid",)) -> DataFrame:
    """Build the judged ranking with running counts.

    Output columns: run_id, qid, docno, sim, rank, rel (coded), gain,
    isrel, k (relevant so far), nj (judged non-relevant so far), u (pooled
    but unjudged so far), plus every column of ``topic_stats``.  Only topics
    that have judgments are kept.  Running counts include the current row.
    """
    keys = list(keys)
    run, qrels = restrict(run, qrels, opts)
    if opts.validate and stats is None:  # who gives the statistics has looked at the judgments
        qrels = written(unique_judgments(qrels, keys), "judgments")
    if opts.skew_safe is None:
        from dataclasses import replace
        from .ranking import decide
        flag, run = decide(run, ["run_id", *keys], None)
        opts = replace(opts, skew_safe=flag)
    if stats is None:
        stats = topic_stats(qrels, opts, keys)
    stats = bounded_broadcast(stats, max_topics_broadcast)
    q = qrels.select(*keys, "docno", F.col("rel").alias("_qrel"))
    # Judgments are usually far smaller than the runs they judge: broadcast
    # them after a size check so the runs keep their partitioning (no
    # shuffle of run rows); beyond the bound it is a shuffle join.
    q = bounded_broadcast(q, MAX_QRELS_BROADCAST)
    j = (run.select("run_id", *keys, "docno", "sim")
            .join(q, keys + ["docno"], "left")
            .withColumn("rel", F.when(F.col("_qrel").isNull(), F.lit(NONPOOL))
                                .when(F.col("_qrel") < 0, F.lit(UNJUDGED))
                                .otherwise(F.col("_qrel")).cast("bigint"))
            .drop("_qrel")
            .join(stats, keys, "inner"))
    j = _with_running(j, opts, keys)
    if opts.max_docs is not None:
        j = j.where(F.col("rank") <= opts.max_docs)
    if opts.validate:  # among the rows kept after the top-M cut
        j = unique_documents(j, keys, opts.skew_safe)
    if opts.judged_only:
        j = _with_running(j.where(F.col("rel") >= 0).drop("rank", "isrel", "k", "nj", "u", "gain"), opts, keys)
    return j


def _with_running(j: DataFrame, opts: EvalOptions, keys=("qid",)) -> DataFrame:
    from .ranking import running
    rel = F.col("rel")
    isrel = rel >= opts.level
    order = [F.desc("sim"), F.desc("docno")]
    sums = {"k": isrel.cast("long"), "nj": ((rel >= 0) & ~isrel).cast("long"),
            "u": (rel == UNJUDGED).cast("long")}
    out = running(j, ["run_id", *keys], order, sums, skew_safe=opts.skew_safe)
    return out.withColumn("isrel", isrel).withColumn("gain", gain_expr(rel, opts.gains))


def judged_topics(run: DataFrame, stats: DataFrame, keys=("qid",)) -> DataFrame:
    """(run_id, qid) pairs evaluated: topics of the run that have judgments."""
    keys = list(keys)
    return run.select("run_id", *keys).distinct().join(stats.select(*keys), keys, "left_semi")


def judge_groups(run: DataFrame, qrels_jg: DataFrame) -> DataFrame:
    """Run rows repeated once per judge group of their topic (equi-join on
    qid with the topic's distinct judge groups)."""
    jgs = qrels_jg.select("qid", "jg").distinct()
    return run.join(jgs, "qid")


def judge_jg(run: DataFrame, qrels_jg: DataFrame, opts: EvalOptions = EvalOptions()) -> DataFrame:
    """Judged ranking per (run, topic, judge group)."""
    return judge(judge_groups(run, qrels_jg), qrels_jg, opts, keys=("qid", "jg"))


def decorate_run(run: DataFrame, qrels: DataFrame, opts: EvalOptions = EvalOptions()) -> DataFrame:
    """Judged-run listing: each retrieved doc with its relevance, and at each
    relevant doc the precision and recall reached there."""
    j = judge(run, qrels, opts)
    prec = F.when(F.col("isrel"), F.col("k") / F.col("rank"))
    rec = F.when(F.col("isrel") & (F.col("num_rel") > 0), F.col("k") / F.col("num_rel"))
    return j.select("run_id", "qid", "rank", "docno", "sim", "rel",
                    F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"))
