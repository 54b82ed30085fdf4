"""Named measure groups over every kind of judgments, in one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import measures as M
from . import prefs as P
from .judge import EvalOptions

# The groups that a measure name may stand for, in output order.
# ``runid`` and ``relstring`` are text and come from ``text_measures``.
GROUPS = {
    "official": ["runid", *M.OFFICIAL],
    "all_trec": ["runid", "relstring", *M.ALL_TREC],
    "set": ["runid", *M.SET_MEASURES],
    "prefs": ["runid", "num_q", "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret", "prefs_simp",
              "prefs_pair", "prefs_avgjg"],
    "all_prefs": ["runid", "num_q", "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret", "prefs_simp",
                  "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel", "prefs_simp_ret", "prefs_pair_ret", "prefs_avgjg_ret",
                  "prefs_avgjg_Rnonrel_ret", "prefs_simp_imp", "prefs_pair_imp", "prefs_avgjg_imp"],
    "qrels_jg": ["runid", "num_q", "map_avgjg", "P_avgjg", "Rprec_mult_avgjg"],
}
TEXT = {"runid", "relstring"}


def _with_num_q(ev: DataFrame) -> DataFrame:
    """Adds num_q: the topics that the rows of each run cover (one row per topic and measure)."""
    topics = ev.where(F.col("qid") != "all")
    n = topics.groupBy("run_id").agg(F.countDistinct("qid").cast("double").alias("value"))
    return ev.unionByName(n.select("run_id", F.lit("all").alias("qid"), F.lit("num_q").alias("measure"), "value"))


def evaluate_group(run: DataFrame, judgments: DataFrame, group: str, opts: EvalOptions = EvalOptions()) -> DataFrame:
    """(run_id, qid, measure, value) of a group's numeric measures, topics and summary (qid 'all').

    ``judgments`` has the columns that the group's measures need: qrels,
    judge-group qrels (``qrels_jg``) or preferences (``prefs``, ``all_prefs``).
    """
    if group not in GROUPS:
        raise ValueError(f"unknown measure group {group!r}")
    names = [m for m in GROUPS[group] if m not in TEXT]
    if group in ("prefs", "all_prefs"):
        return _with_num_q(P.evaluate_prefs(run, judgments, [m for m in names if m != "num_q"], opts))
    if group == "qrels_jg":
        return _with_num_q(M.evaluate_jg(run, judgments, tuple(m for m in names if m != "num_q"), opts))
    return M.evaluate(run, judgments, names, opts)


def text_measures(judged: DataFrame, tags: DataFrame | None = None, relstring_length: int = M.RELSTRING_LEN) -> DataFrame:
    """(run_id, qid, measure, text): relstring per topic, and runid per run.

    ``tags`` (run_id, tag) names the run's own tag, as of its last line
    (``runfiles.last_run_tag``); without it the run_id is the tag.
    """
    rel = M.relstring(judged, relstring_length).select("run_id", "qid", F.lit("relstring").alias("measure"),
                                                       F.col("relstring").alias("text"))
    runs = judged.select("run_id").distinct()
    named = runs.join(tags, "run_id", "left").select("run_id", F.coalesce("tag", "run_id").alias("tag")) if tags is not None \
        else runs.withColumn("tag", F.col("run_id"))
    return rel.unionByName(named.select("run_id", F.lit("all").alias("qid"), F.lit("runid").alias("measure"),
                                        F.col("tag").alias("text")))
