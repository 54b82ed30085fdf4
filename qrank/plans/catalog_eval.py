"""Registered evaluation queries beyond single measures, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.analysis import Analyzer
from ..operators import measures as M
from ..operators import query as Q
from ..operators import search as SE
from ..sources import fixtures as fx
from .registry import r6, register
from .tables import written


def _o(expr_fn):
    def o():
        from checks import oracle as O
        return expr_fn(O)
    return o


def text_run(spark: SparkSession, sf_dir: str, analyzer: Analyzer = Analyzer(), k: int = 1000) -> DataFrame:
    """BM25 (tuned) multi-field run of the sectioned topics over the corpus."""
    qt = Q.query_terms(Q.prepare_topics(fx.topics(spark, sf_dir)), analyzer)
    return SE.search_text(qt, fx.corpus(spark, sf_dir), analyzer, S.bm25(*S.BM25_TUNED), k=k, run_id="bm25_tuned")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-topic MAP, nDCG and P@10 of the BM25 run (plus 'all' summary)."""
    run = text_run(spark, sf_dir)
    # Derived judgments (a shingle join) are read twice by the evaluation; repeated rows judge once.
    qrels = written(fx.passage_qrels(spark, sf_dir).distinct(), "qrels")
    # The run is a top-1000 search result: topic groups are bounded by k.
    ev = M.evaluate(run, qrels, ["map", "ndcg", ("P", (10,))], EvalOptions(skew_safe=False))
    wide = ev.groupBy("run_id", "qid").pivot("measure", ["map", "ndcg", "P_10"]).agg(F.first("value"))
    return wide.select("run_id", "qid", r6("map").alias("map"), r6("ndcg").alias("ndcg"), r6("P_10").alias("P_10"))


def _flagship_sql() -> str:
    from checks import oracle_search as OS
    return OS.flagship_sql()


register("flagship_eval", _flagship_sql)(flagship)


@register("passage_qrels", _o(lambda O: O.PASSAGE_QRELS))
def q_passage_qrels(spark, sf_dir):
    return fx.passage_qrels(spark, sf_dir)


from ..operators.judge import EvalOptions, decorate_run, judge, topic_stats  # noqa: E402
from ..operators import summary as SU  # noqa: E402

OFFICIAL = M.OFFICIAL


def _eval_summary(opts: EvalOptions, measures=OFFICIAL, per_topic=False):
    def q(spark, sf_dir):
        ev = M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), measures, opts, per_topic=per_topic)
        return ev.select("run_id", "qid", "measure", r6("value").alias("value"))
    return q


register("eval_summary", _o(lambda O: O.eval_union(O.OFFICIAL)))(_eval_summary(EvalOptions()))
register("eval_summary_complete", _o(lambda O: O.eval_union(O.OFFICIAL, complete=True)))(
    _eval_summary(EvalOptions(complete=True)))
register("eval_judged_only", _o(lambda O: O.eval_union(O.OFFICIAL, per_topic=True, judged_only=True)))(
    _eval_summary(EvalOptions(judged_only=True), per_topic=True))
register("eval_topM", _o(lambda O: O.eval_union(O.OFFICIAL, per_topic=True, max_docs=20)))(
    _eval_summary(EvalOptions(max_docs=20), per_topic=True))
register("eval_level2", _o(lambda O: O.eval_union(O.OFFICIAL + ["ndcg", "infAP"], per_topic=True, level=2)))(
    _eval_summary(EvalOptions(level=2), OFFICIAL + ["ndcg", "infAP"], per_topic=True))


@register("judged_run", _o(lambda O: O.judged_run_sql()))
def q_judged_run(spark, sf_dir):
    j = judge(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir))
    return j.select("run_id", "qid", "docno", F.col("rank").cast("long"), "rel")


@register("topic_stats", _o(lambda O: O.topic_stats_sql()))
def q_topic_stats(spark, sf_dir):
    st = topic_stats(fx.qrels(spark, sf_dir))
    return st.select("qid", "num_rel", "num_nonrel", "ideal_n", r6("ideal_dcg").alias("ideal_dcg"))


@register("rel_levels", _o(lambda O: O.rel_levels_sql()))
def q_rel_levels(spark, sf_dir):
    q = fx.qrels(spark, sf_dir)
    return q.where(F.col("rel") >= 0).groupBy("qid", "rel").agg(F.count(F.lit(1)).alias("n"))


@register("relstring", _o(lambda O: O.relstring_sql()))
def q_relstring(spark, sf_dir):
    return M.relstring(judge(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir)))


@register("decorate_run", _o(lambda O: O.decorate_sql()))
def q_decorate(spark, sf_dir):
    return decorate_run(fx.run(spark, sf_dir), fx.qrels(spark, sf_dir))


ZREF_MEASURES = ["map", "P", "ndcg", "bpref"]


def _zref(spark, sf_dir):
    per = M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), ZREF_MEASURES, summary=False)
    return SU.build_zref(per)


@register("zref", _o(lambda O: O.zref_sql()))
def q_zref(spark, sf_dir):
    z = _zref(spark, sf_dir)
    return z.select("qid", "measure", r6("mean").alias("mean"), r6("stddev").alias("stddev"))


@register("zscores", _o(lambda O: O.zscores_sql()))
def q_zscores(spark, sf_dir):
    """Each run's per-topic values as z-scores against the three-run
    reference, averaged per run (rows with qid='all')."""
    z = SU.evaluate_z(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), _zref(spark, sf_dir), ZREF_MEASURES)
    return z.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("eval_avgjg", _o(lambda O: O.avgjg_sql()))
def q_avgjg(spark, sf_dir):
    ev = M.evaluate_jg(fx.runs(spark, sf_dir), fx.qrels_jg(spark, sf_dir))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


from ..operators import prefs as PR  # noqa: E402


@register("prefs_counts", _o(lambda O: O.prefs_counts_sql()))
def q_prefs_counts(spark, sf_dir):
    c = PR.prefs_counts(fx.runs(spark, sf_dir), fx.qrels_prefs(spark, sf_dir))
    return c.select("run_id", "qid", "jg", "ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur")


@register("m_prefs", _o(lambda O: O.prefs_measures_sql(False)))
def q_prefs(spark, sf_dir):
    ev = PR.evaluate_prefs(fx.runs(spark, sf_dir), fx.qrels_prefs(spark, sf_dir),
                           [m for m in PR.PREFS_MEASURES if m not in PR.PAIR])
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("m_prefs_pair", _o(lambda O: O.prefs_measures_sql(True)))
def q_prefs_pair(spark, sf_dir):
    """Pair measures of every judge group by itself: each (topic, judge) is a topic of its own."""
    prefs = fx.qrels_prefs(spark, sf_dir)
    own = F.concat_ws("|", "qid", "jg")
    run = fx.runs(spark, sf_dir).join(prefs.select("qid", "jg").distinct(), "qid").withColumn("qid", own).drop("jg")
    ev = PR.evaluate_prefs(run, prefs.withColumn("qid", own), sorted(PR.PAIR))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("m_prefs_pair_multi", _o(lambda O: O.prefs_pair_multi_sql()))
def q_prefs_pair_multi(spark, sf_dir):
    """Pair vote shares across the three judge groups."""
    ev = PR.evaluate_prefs(fx.runs(spark, sf_dir), fx.qrels_prefs(spark, sf_dir), sorted(PR.PAIR))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("prefs_closure", _o(lambda O: O.prefs_closure_sql()))
def q_prefs_closure(spark, sf_dir):
    """Preference counts of judge groups with two sub-groups each: the closed relation of both."""
    c = PR.prefs_counts(fx.runs(spark, sf_dir), fx.prefs(spark, sf_dir))
    return c.select("run_id", "qid", "jg", *PR.COUNTS[:9])


@register("m_prefs_multi", _o(lambda O: O.prefs_measures_sql(closed=True)))
def q_prefs_multi(spark, sf_dir):
    ev = PR.evaluate_prefs(fx.runs(spark, sf_dir), fx.prefs(spark, sf_dir), [m for m in PR.PREFS_MEASURES if m not in PR.PAIR])
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))


@register("m_prefs_pair_closure", _o(lambda O: O.prefs_pair_multi_sql(closed=True)))
def q_prefs_pair_closure(spark, sf_dir):
    """Pair vote shares across judge groups whose votes come from closed relations."""
    ev = PR.evaluate_prefs(fx.runs(spark, sf_dir), fx.prefs(spark, sf_dir), sorted(PR.PAIR))
    return ev.select("run_id", "qid", "measure", r6("value").alias("value"))
