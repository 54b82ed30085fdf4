"""Effectiveness measures as Column expressions over the judged ranking.

Each measure contributes (a) aggregate columns computed in ONE
``groupBy(run_id, qid)`` over the judged rows and (b) final per-topic value
expressions over those aggregates and the topic statistics.  ``evaluate``
stacks the results into the long table ``(run_id, qid, measure, value)``
and appends per-run summaries under ``qid = 'all'``.

Judged-row columns available (see ``judge``): rank, rel, gain, isrel,
k (relevant so far), nj (judged non-relevant so far), u (unjudged so far),
and topic statistics num_rel, num_nonrel, segs, lsegs, ideal_*.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .judge import EvalOptions, UNJUDGED, judge, topic_stats

# Default cut-offs and parameters of the standard measures.
DOC_CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
RECALL_POINTS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
RPREC_MULTS = (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)
SUCCESS_CUTOFFS = (1, 5, 10)
UNJ_CUTOFFS = (5, 10, 20)
UTILITY_DEFAULT = (1.0, -1.0, 0.0, 0.0)
SET_F_BETA = 1.0
RBP_P = 0.9
RELSTRING_LEN = 10
MIN_GEO_MEAN = 0.00001
INFAP_EPSILON = 0.00001

col = F.col


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def _cnt(c: Column) -> Column:
    return F.count_if(c)


def _div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the evaluator leaves such values at zero)."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _fmt2(x: float) -> str:
    return f"{x:3.2f}"


@dataclass
class Measure:
    """A registered measure: aggregates + final expressions + summary kind."""

    name: str
    summary: str                     # avg | sum | gm | num_q
    build: Callable[["Measure"], tuple[dict, list]]
    params: tuple = ()
    needs_window: bool = False
    per_topic: bool = True
    gains: dict = field(default_factory=dict)
    doc: str = ""

    def parts(self) -> tuple[dict, list]:
        return self.build(self)


REGISTRY: dict[str, Callable[..., Measure]] = {}


def register_measure(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- basic counts

def base_aggs() -> dict:
    return {"ret": F.count(F.lit(1)), "rr": _cnt(col("isrel")),
            "nonpool": _cnt(col("rel") == -1), "unj": _cnt(col("rel") == UNJUDGED)}


@register_measure("num_q")
def num_q(params=()):
    return Measure("num_q", "num_q", lambda m: ({}, [("num_q", F.lit(1.0))]))


@register_measure("num_ret")
def num_ret(params=()):
    return Measure("num_ret", "sum", lambda m: ({}, [("num_ret", col("ret").cast("double"))]))


@register_measure("num_rel")
def num_rel(params=()):
    return Measure("num_rel", "num_rel", lambda m: ({}, [("num_rel", col("num_rel").cast("double"))]))


@register_measure("num_rel_ret")
def num_rel_ret(params=()):
    return Measure("num_rel_ret", "sum", lambda m: ({}, [("num_rel_ret", col("rr").cast("double"))]))


@register_measure("num_nonrel_judged_ret")
def num_nonrel_judged_ret(params=()):
    v = (col("ret") - col("nonpool") - col("unj") - col("rr")).cast("double")
    return Measure("num_nonrel_judged_ret", "sum", lambda m: ({}, [("num_nonrel_judged_ret", v)]))


# ---------------------------------------------------------- precision family

def AP_SUM() -> Column:
    return _sum(F.when(col("isrel"), col("k") / col("rank")))


@register_measure("map")
def map_(params=()):
    return Measure("map", "avg", lambda m: ({"ap_sum": AP_SUM()},
                                            [("map", _div(col("ap_sum"), col("num_rel")))]))


@register_measure("gm_map")
def gm_map(params=()):
    v = F.log(F.greatest(_div(col("ap_sum"), col("num_rel")), F.lit(MIN_GEO_MEAN)))
    return Measure("gm_map", "gm", lambda m: ({"ap_sum": AP_SUM()}, [("gm_map", v)]), per_topic=False)


@register_measure("Rprec")
def rprec(params=()):
    aggs = {"rel_in_R": _cnt(col("isrel") & (col("rank") <= col("num_rel")))}
    return Measure("Rprec", "avg", lambda m: (aggs, [("Rprec", _div(col("rel_in_R"), col("num_rel")))]))


def BPREF_SUM() -> Column:
    return _sum(F.when(col("isrel"), F.when(
        col("nj") > 0,
        1.0 - F.least(col("nj"), col("num_rel")) / F.least(col("num_nonrel"), col("num_rel"))).otherwise(1.0)))


@register_measure("bpref")
def bpref(params=()):
    return Measure("bpref", "avg", lambda m: ({"bpref_sum": BPREF_SUM()},
                                              [("bpref", _div(col("bpref_sum"), col("num_rel")))]))


@register_measure("gm_bpref")
def gm_bpref(params=()):
    v = F.log(F.greatest(_div(col("bpref_sum"), col("num_rel")), F.lit(MIN_GEO_MEAN)))
    return Measure("gm_bpref", "gm", lambda m: ({"bpref_sum": BPREF_SUM()}, [("gm_bpref", v)]), per_topic=False)


@register_measure("recip_rank")
def recip_rank(params=()):
    aggs = {"first_rel": F.min(F.when(col("isrel"), col("rank")))}
    return Measure("recip_rank", "avg",
                   lambda m: (aggs, [("recip_rank", F.coalesce(1.0 / col("first_rel"), F.lit(0.0)))]))


def _iprec_parts(points):
    aggs, vals = {}, []
    for x in points:
        c = F.round(F.lit(float(x)) * col("num_rel"), 0)   # lround
        key = f"ip_{_fmt2(x)}".replace(".", "_")
        aggs[key] = F.max(F.when(col("isrel") & (col("k") >= F.round(F.lit(float(x)) * col("num_rel"), 0)),
                                 col("k") / col("rank")))
        vals.append((f"iprec_at_recall_{_fmt2(x)}",
                     F.when(c > col("rr"), F.lit(0.0)).otherwise(F.coalesce(col(key), F.lit(0.0)))))
    return aggs, vals


@register_measure("iprec_at_recall")
def iprec_at_recall(params=RECALL_POINTS):
    return Measure("iprec_at_recall", "avg", lambda m: _iprec_parts(m.params), tuple(params))


@register_measure("11pt_avg")
def pt11_avg(params=RECALL_POINTS):
    def build(m):
        aggs, vals = _iprec_parts(m.params)
        name = "11pt_avg" if tuple(m.params) == RECALL_POINTS else "11pt_avg_" + ",".join(_short(p) for p in m.params)
        if getattr(m, "display", None):
            name = m.display
        total = sum((v for _, v in vals[1:]), vals[0][1])
        return aggs, [(name, total / len(vals))]
    return Measure("11pt_avg", "avg", build, tuple(params))


def _short(p: float) -> str:
    s = f"{p:g}"
    return s[1:] if s.startswith("0.") else s


def _rel_at(n) -> tuple[str, Column]:
    return f"rel_at_{n}", _cnt(col("isrel") & (col("rank") <= n))


@register_measure("P")
def precision(params=DOC_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            k, a = _rel_at(n)
            aggs[k] = a
            vals.append((f"P_{n}", col(k) / float(n)))
        return aggs, vals
    return Measure("P", "avg", build, tuple(params))


@register_measure("recall")
def recall(params=DOC_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            k, a = _rel_at(n)
            aggs[k] = a
            vals.append((f"recall_{n}", _div(col(k), col("num_rel"))))
        return aggs, vals
    return Measure("recall", "avg", build, tuple(params))


@register_measure("relative_P")
def relative_p(params=DOC_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            k, a = _rel_at(n)
            aggs[k] = a
            vals.append((f"relative_P_{n}", _div(col(k), F.least(F.lit(n), col("num_rel")))))
        return aggs, vals
    return Measure("relative_P", "avg", build, tuple(params))


@register_measure("success")
def success(params=SUCCESS_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            k, a = _rel_at(n)
            aggs[k] = a
            vals.append((f"success_{n}", F.when(col(k) > 0, 1.0).otherwise(0.0)))
        return aggs, vals
    return Measure("success", "avg", build, tuple(params))


@register_measure("map_cut")
def map_cut(params=DOC_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            aggs[f"ap_at_{n}"] = _sum(F.when(col("isrel") & (col("rank") <= n), col("k") / col("rank")))
            vals.append((f"map_cut_{n}", _div(col(f"ap_at_{n}"), col("num_rel"))))
        return aggs, vals
    return Measure("map_cut", "avg", build, tuple(params))


@register_measure("Rprec_mult")
def rprec_mult(params=RPREC_MULTS):
    def build(m):
        aggs, vals = {}, []
        for x in m.params:
            c = F.floor(F.lit(float(x)) * col("num_rel") + 0.9)
            key = f"rm_{_fmt2(x)}".replace(".", "_")
            aggs[key] = _cnt(col("isrel") & (col("rank") <= F.floor(F.lit(float(x)) * col("num_rel") + 0.9)))
            vals.append((f"Rprec_mult_{_fmt2(x)}", _div(col(key), c)))
        return aggs, vals
    return Measure("Rprec_mult", "avg", build, tuple(params))


@register_measure("unj")
def unjudged(params=UNJ_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            aggs[f"unj_at_{n}"] = _cnt((col("rel") < 0) & (col("rank") <= n))
            vals.append((f"unj_{n}", col(f"unj_at_{n}") / float(n)))
        return aggs, vals
    return Measure("unj", "avg", build, tuple(params))


def INFAP_TERM() -> Column:
    return F.when(col("rank") == 1, F.lit(1.0)).otherwise(
        1.0 / col("rank")
        + ((col("rank") - 1) / col("rank"))
        * ((col("k") - 1 + col("nj") + col("u")) / (col("rank") - 1))
        * ((col("k") - 1 + INFAP_EPSILON) / (col("k") - 1 + col("nj") + 2 * INFAP_EPSILON)))


@register_measure("infAP")
def infap(params=()):
    aggs = {"infap_sum": _sum(F.when(col("isrel"), INFAP_TERM()))}
    return Measure("infAP", "avg", lambda m: (aggs, [("infAP", _div(col("infap_sum"), col("num_rel")))]))


@register_measure("binG")
def bin_g(params=()):
    aggs = {"bing_sum": _sum(F.when(col("isrel"), 1.0 / F.log2(2 + col("rank") - col("k"))))}
    return Measure("binG", "avg", lambda m: (aggs, [("binG", _div(col("bing_sum"), col("num_rel")))]))


@register_measure("yaap")
def yaap(params=()):
    v = F.log((1.0 + col("ap_sum")) / (1.0 + col("num_rel") - col("ap_sum")))
    return Measure("yaap", "avg", lambda m: ({"ap_sum": AP_SUM()}, [("yaap", v)]))


# ------------------------------------------------------------- set measures

@register_measure("set_P")
def set_p(params=()):
    return Measure("set_P", "avg", lambda m: ({}, [("set_P", _div(col("rr"), col("ret")))]))


@register_measure("set_relative_P")
def set_relative_p(params=()):
    return Measure("set_relative_P", "avg",
                   lambda m: ({}, [("set_relative_P", _div(col("rr"), F.least(col("ret"), col("num_rel"))))]))


@register_measure("set_recall")
def set_recall(params=()):
    return Measure("set_recall", "avg", lambda m: ({}, [("set_recall", _div(col("rr"), col("num_rel")))]))


@register_measure("set_map")
def set_map(params=()):
    v = _div(col("rr") * col("rr"), col("ret") * col("num_rel"))
    return Measure("set_map", "avg", lambda m: ({}, [("set_map", v)]))


@register_measure("set_F")
def set_f(params=(SET_F_BETA,)):
    def build(m):
        x = float(m.params[0])
        p = col("rr") / col("ret")
        r = col("rr") / col("num_rel")
        name = "set_F" if m.params == (SET_F_BETA,) else f"set_F_{_short(x)}"
        return {}, [(name, F.when(col("rr") > 0, (x + 1.0) * p * r / (x * p + r)).otherwise(0.0))]
    return Measure("set_F", "avg", build, tuple(params))


@register_measure("utility")
def utility(params=UTILITY_DEFAULT):
    def build(m):
        a, b, c, d = (float(p) for p in m.params)
        n = col("num_docs_in_coll")
        v = (a * col("rr") + b * (col("ret") - col("rr")) + c * (col("num_rel") - col("rr"))
             + d * (n + col("rr") - col("ret") - col("num_rel")))
        name = "utility" if tuple(m.params) == UTILITY_DEFAULT else "utility_" + ",".join(f"{p:g}" for p in m.params)
        return {}, [(name, v.cast("double"))]
    return Measure("utility", "avg", build, tuple(params))


# ----------------------------------------------------------- gain measures

def DISC() -> Column:
    return 1.0 / F.log2(col("rank") + 1)


@register_measure("dcg")
def dcg(params=()):
    aggs = {"dcg_sum": _sum(F.when(col("gain") != 0, col("gain") * DISC()))}
    return Measure("dcg", "avg", lambda m: (aggs, [("dcg", col("dcg_sum"))]))


@register_measure("ideal_dcg")
def ideal_dcg(params=()):
    return Measure("ideal_dcg", "avg", lambda m: ({}, [("ideal_dcg", col("ideal_dcg"))]))


@register_measure("ndcg")
def ndcg(params=()):
    aggs = {"dcg_sum": _sum(F.when(col("gain") != 0, col("gain") * DISC()))}
    return Measure("ndcg", "avg", lambda m: (aggs, [("ndcg", _div(col("dcg_sum"), col("ideal_dcg")))]))


@register_measure("ndcg_cut")
def ndcg_cut(params=DOC_CUTOFFS):
    def build(m):
        aggs, vals = {}, []
        for n in m.params:
            aggs[f"dcg_at_{n}"] = _sum(F.when((col("rel") > 0) & (col("rank") <= n), col("rel") * DISC()))
            ideal = _ideal_at(n)
            vals.append((f"ndcg_cut_{n}", _div(col(f"dcg_at_{n}"), ideal)))
        return aggs, vals
    return Measure("ndcg_cut", "avg", build, tuple(params))


def _ideal_at(n: int) -> Column:
    """Ideal DCG of the first n ranks from the raw-level segments."""
    def add(acc, s):
        return acc + s["g"] * _disc_range(s["start"], F.least(s["end"], F.lit(n).cast("bigint")))
    return F.aggregate(col("lsegs"), F.lit(0.0), add)


def _disc_range(a: Column, b: Column) -> Column:
    """Sum of 1/log2(p+1) for p in [a, b] (0 when empty); b is a small cut-off."""
    return F.when(b >= a, F.aggregate(F.sequence(a, b), F.lit(0.0), lambda acc, p: acc + 1.0 / F.log2(p + 1))) \
            .otherwise(F.lit(0.0))


# Window columns on judged rows for measures comparing each rank with the
# ideal ranking at the same rank (G, ndcg_rel, Rndcg).
def with_ideal_window(j: DataFrame, keys=("qid",), skew_safe: bool | None = None) -> DataFrame:
    from .ranking import running
    seg = F.filter(col("segs"), lambda s: (s["start"] <= col("rank")) & (col("rank") <= s["end"]))
    ig = F.coalesce(F.try_element_at(seg, F.lit(1))["g"], F.lit(0.0))
    j = j.withColumn("ig", ig)
    sums = {"dcum": col("gain") * DISC(), "icum": col("ig") * DISC(), "sg": col("gain"),
            "cost": F.greatest(col("ig"), F.lit(1.0))}
    return running(j, ["run_id", *keys], [F.desc("sim"), F.desc("docno")], sums,
                   skew_safe=skew_safe, rank_col=None)


@register_measure("G")
def g_measure(params=()):
    aggs = {"g_sum": _sum(F.when(col("gain") != 0, col("gain") / F.log2(2 + col("cost") - col("sg"))))}
    return Measure("G", "avg", lambda m: (aggs, [("G", _div(col("g_sum"), col("ideal_gain_sum")))]),
                   needs_window=True)


@register_measure("ndcg_rel")
def ndcg_rel(params=()):
    aggs = {"ndr_sum": _sum(F.when(col("gain") > 0, col("dcum") / col("icum"))),
            "ndr_hits": _cnt(col("gain") > 0),
            "dcg_sum": _sum(F.when(col("gain") != 0, col("gain") * DISC()))}
    total = col("ndr_sum") + (col("ideal_n") - col("ndr_hits")) * _div(col("dcg_sum"), col("ideal_dcg"))
    v = F.when((col("ideal_n") > 0) & (total > 0), total / col("ideal_n")).otherwise(0.0)
    return Measure("ndcg_rel", "avg", lambda m: (aggs, [("ndcg_rel", v)]), needs_window=True)


@register_measure("Rndcg")
def rndcg(params=()):
    # Terms at segment ends inside the ranking come from the row at that rank.
    ends = F.filter(col("segs"), lambda s: s["end"] == col("rank"))
    aggs = {"rn_in_sum": _sum(F.aggregate(ends, F.lit(0.0), lambda a, s: a + col("dcum") / s["icum"])),
            "rn_in_cnt": F.coalesce(F.sum(F.size(ends)), F.lit(0)),
            "dcg_sum": _sum(F.when(col("gain") != 0, col("gain") * DISC()))}

    def build(m):
        tail = F.filter(col("segs"), lambda s: s["end"] > col("ret"))
        tail_sum = F.aggregate(tail, F.lit(0.0), lambda a, s: a + col("dcg_sum") / s["icum"])
        extra = col("ret") > col("ideal_n") + 1
        total = col("rn_in_sum") + tail_sum + F.when(extra, _div(col("dcg_sum"), col("ideal_dcg"))).otherwise(0.0)
        cnt = col("rn_in_cnt") + F.size(tail) + F.when(extra & (col("ideal_dcg") > 0), 1).otherwise(0)
        v = F.when((col("num_rel") > 0) & (cnt > 0), total / cnt).otherwise(0.0)
        return aggs, [("Rndcg", v)]
    return Measure("Rndcg", "avg", build, needs_window=True)


@register_measure("rbp")
def rbp(params=(RBP_P,)):
    def build(m):
        p = float(m.params[0])
        # Gains are rescaled to [0, 1] when any gain of the topic's levels
        # (0..max judged level, with overrides) falls outside it.
        gmax = col("g_max")
        gmin = col("g_min")
        scaled = F.when((gmin < 0) | (gmax > 1), (col("rbp_gain_sum") - gmin * col("rbp_w_sum")) / (gmax - gmin)) \
                  .otherwise(col("rbp_gain_sum"))
        name = "rbp" if tuple(m.params) == (RBP_P,) else f"rbp_p={p:g}"
        listed = (col("rel") >= 0) | col("rel").isin(*[int(x) for x in m.gains]) if m.gains else (col("rel") >= 0)
        return ({"rbp_gain_sum": _sum(F.when(col("gain") != 0, col("gain") * F.pow(F.lit(p), col("rank") - 1))),
                 "rbp_w_sum": _sum(F.when(listed, F.pow(F.lit(p), col("rank") - 1)))},
                [(name, (1.0 - p) * scaled)])
    return Measure("rbp", "avg", build, tuple(params))


@register_measure("rbp_resid")
def rbp_resid(params=(RBP_P,)):
    def build(m):
        p = float(m.params[0])
        aggs = {"rr_unj_w": _sum(F.when(col("rel") < 0, F.pow(F.lit(p), col("rank") - 1))),
                "unj_any": _cnt(col("rel") < 0)}
        v = F.when(col("unj_any") > 0, F.pow(F.lit(p), col("ret")) + (1 - p) * col("rr_unj_w")).otherwise(0.0)
        name = "rbp_resid" if tuple(m.params) == (RBP_P,) else f"rbp_resid_p={p:g}"
        return aggs, [(name, v)]
    return Measure("rbp_resid", "avg", build, tuple(params))


# ------------------------------------------------------------ measure sets

# Named measure groups, in output order.
OFFICIAL = ["num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map", "Rprec", "bpref",
            "recip_rank", "iprec_at_recall", "P"]
ALL_TREC = ["num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map", "Rprec", "bpref",
            "recip_rank", "iprec_at_recall", "P", "recall", "infAP", "gm_bpref", "Rprec_mult",
            "utility", "11pt_avg", "binG", "G", "ndcg", "ndcg_rel", "Rndcg", "ndcg_cut", "map_cut",
            "relative_P", "success", "set_P", "set_relative_P", "set_recall", "set_map", "set_F",
            "num_nonrel_judged_ret", "rbp", "rbp_resid", "unj"]
SET_MEASURES = ["num_q", "num_ret", "num_rel", "num_rel_ret", "set_P", "set_recall",
                "set_relative_P", "set_map", "set_F", "utility"]
EXTRA = ["dcg", "ideal_dcg", "yaap"]
NICKNAMES = {"official": OFFICIAL, "all_trec": ALL_TREC, "set": SET_MEASURES}


def resolve(measures) -> list[Measure]:
    """Measure list from names, nicknames, or (name, params) pairs."""
    if isinstance(measures, str):
        measures = [measures]
    out: list[Measure] = []
    for m in measures:
        if isinstance(m, Measure):
            out.append(m)
            continue
        name, params = (m, None) if isinstance(m, str) else (m[0], tuple(m[1]))
        if name in NICKNAMES:
            out.extend(resolve(NICKNAMES[name]))
            continue
        if name not in REGISTRY:
            raise ValueError(f"unknown measure {name!r}")
        out.append(REGISTRY[name]() if params is None else REGISTRY[name](params))
    seen, uniq = set(), []
    for m in out:
        key = (m.name, m.params)
        if key not in seen:
            seen.add(key)
            uniq.append(m)
    return uniq


# Measures reading the ideal ranking (segments / ideal DCG) of a topic.
IDEAL_MEASURES = {"ideal_dcg", "ndcg", "ndcg_cut", "G", "ndcg_rel", "Rndcg"}

STAT_COLS = ["num_rel", "num_nonrel", "num_judged", "num_rel_pos", "max_level", "segs", "lsegs",
             "ideal_n", "ideal_gain_sum", "ideal_dcg"]


def topic_values(judged: DataFrame, measures, opts: EvalOptions = EvalOptions(), keys=("qid",)) -> DataFrame:
    """Per-topic measure values, wide: (run_id, qid, <measure columns>)."""
    keys = list(keys)
    ms = resolve(measures)
    for m in ms:
        m.gains = dict(opts.gains)
    aggs: dict[str, Column] = base_aggs()
    vals: list[tuple[str, Column, Measure]] = []
    for m in ms:
        a, v = m.parts()
        aggs.update(a)
        vals.extend((n, e, m) for n, e in v)
    j = judged
    if any(m.needs_window for m in ms):
        j = with_ideal_window(j, keys, opts.skew_safe)
    stat = [F.any_value(c).alias(c) for c in STAT_COLS]
    per = j.groupBy("run_id", *keys).agg(*[a.alias(k) for k, a in aggs.items()], *stat)
    per = per.withColumn("num_docs_in_coll", F.lit(int(opts.num_docs_in_coll)))
    if any(m.name == "rbp" for m in ms):
        per = _with_gain_range(per, opts)
    return per.select("run_id", *keys, *[e.cast("double").alias(n) for n, e, _ in vals])


def _with_gain_range(per: DataFrame, opts: EvalOptions) -> DataFrame:
    levels = F.sequence(F.lit(0), F.coalesce(col("max_level"), F.lit(-1)).cast("int"))
    gains = F.transform(levels, lambda lv: _gain_of(lv, opts.gains))
    extra = [F.lit(float(v)) for v in opts.gains.values()]
    allg = F.concat(gains, F.array(*extra)) if extra else gains
    return (per.withColumn("g_max", F.coalesce(F.array_max(allg), F.lit(0.0)))
               .withColumn("g_min", F.coalesce(F.array_min(allg), F.lit(0.0))))


def _gain_of(lv: Column, gains: dict) -> Column:
    g = lv.cast("double")
    for k, v in sorted(gains.items()):
        g = F.when(lv == int(k), F.lit(float(v))).otherwise(g)
    return g


def measure_summaries(ms: list[Measure]) -> dict[str, str]:
    out = {}
    for m in ms:
        _, v = m.parts()
        for n, _e in v:
            out[n] = m.summary
    return out


def evaluate(run: DataFrame, qrels: DataFrame, measures="official",
             opts: EvalOptions = EvalOptions(), per_topic: bool = True,
             summary: bool = True) -> DataFrame:
    """Evaluate one or many runs: long table (run_id, qid, measure, value).

    Summary rows use qid = 'all'.  Measures whose per-topic values are not
    reported (geometric means) only appear in the summary.
    """
    from .summary import summarize  # local import: summary uses this module

    ms = resolve(measures)
    from ..plans.tables import written
    from .judge import restrict, unique_judgments
    run, qrels = restrict(run, qrels, opts)
    if opts.validate:
        qrels = written(unique_judgments(qrels), "judgments")
    if opts.skew_safe is None:
        from dataclasses import replace
        from .ranking import decide
        flag, run = decide(run, ["run_id", "qid"], None)
        opts = replace(opts, skew_safe=flag)
    stats = topic_stats(qrels, opts, with_ideal=any(m.name in IDEAL_MEASURES for m in ms))
    judged = judge(run, qrels, opts, stats=stats)
    wide = topic_values(judged, ms, opts)
    if opts.judged_only:
        # Topics whose retrieved docs are all unjudged still count (with ret = 0).
        wide = _fill_empty_topics(run, stats, wide, ms, opts)
    names = measure_summaries(ms)
    if per_topic and summary:
        # Both outputs read the per-topic table (one row per run and topic):
        # written once instead of computing the judged ranking for each branch.
        wide = written(wide, "topic-values")
    long = stack_long(wide, list(names))
    parts = []
    hidden = [n for m in ms if not m.per_topic for n, _ in m.parts()[1]]
    if per_topic:
        parts.append(long.where(~col("measure").isin(hidden)) if hidden else long)
    if summary:
        parts.append(summarize(long, names, qrels, opts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fill_empty_topics(run, stats, wide, ms, opts):
    from .judge import judged_topics
    topics = judged_topics(run, stats)
    missing = topics.join(wide.select("run_id", "qid"), ["run_id", "qid"], "left_anti")
    empty = missing.join(stats, "qid")
    for c, v in {"ret": 0, "rr": 0, "nonpool": 0, "unj": 0}.items():
        empty = empty.withColumn(c, F.lit(v).cast("long"))
    # Evaluate measures over an empty ranking: every aggregate is its empty value.
    vals = []
    for m in ms:
        a, v = m.parts()
        for n, e in v:
            vals.append((n, e, a))
    filler = empty
    for m in ms:
        a, _ = m.parts()
        for k in a:
            if k not in filler.columns:
                filler = filler.withColumn(k, F.lit(None).cast("double"))
    filler = filler.withColumn("num_docs_in_coll", F.lit(int(opts.num_docs_in_coll)))
    if any(m.name == "rbp" for m in ms):
        filler = _with_gain_range(filler, opts)
    filler = filler.select("run_id", "qid", *[F.coalesce(e.cast("double"), F.lit(0.0)).alias(n) for n, e, _ in vals])
    return wide.unionByName(filler)


def stack_long(wide: DataFrame, names: list[str]) -> DataFrame:
    """Wide per-topic values -> (run_id, qid, measure, value)."""
    arr = F.array(*[F.struct(F.lit(n).alias("measure"), col(f"`{n}`").alias("value")) for n in names])
    return wide.select("run_id", "qid", F.inline(arr))


def relstring(judged: DataFrame, n: int = RELSTRING_LEN) -> DataFrame:
    """Per-topic string of the first n relevance values: digit per level,
    '>' above 9, '-' not in pool, '.' pooled but unjudged."""
    ch = (F.when(col("rel") > 9, ">").when(col("rel") >= 0, col("rel").cast("string"))
           .when(col("rel") == -1, "-").when(col("rel") == UNJUDGED, ".").otherwise("<"))
    top = judged.where(col("rank") <= n)
    return (top.groupBy("run_id", "qid")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", ch.alias("c")))),
                                             lambda s: s["c"]), "").alias("relstring")))


# ------------------------------------------------------- judge-group averages

# Measures averaged over judge groups and their base measure.
AVGJG = {"map_avgjg": "map", "P_avgjg": "P", "Rprec_mult_avgjg": "Rprec_mult"}


def _jg_name(base_name: str, avg: str, base: str) -> str:
    # P_5 -> P_avgjg_5, map -> map_avgjg
    return avg + base_name[len(base):]


def evaluate_jg(run: DataFrame, qrels_jg: DataFrame, measures=("map_avgjg", "P_avgjg", "Rprec_mult_avgjg"),
                opts: EvalOptions = EvalOptions(), per_topic: bool = True, summary: bool = True) -> DataFrame:
    """Measures computed per judge group, then averaged over the topic's
    judge groups (two-level aggregation)."""
    from .judge import judge_jg
    from .summary import summarize

    names = [m if isinstance(m, str) else m[0] for m in measures]
    base = [(AVGJG[n], None) if isinstance(m, str) else (AVGJG[n], m[1]) for n, m in zip(names, measures)]
    ms = resolve([b if p is None else (b, p) for b, p in base])
    if opts.skew_safe is None:
        from dataclasses import replace
        from .ranking import decide
        flag, run = decide(run, ["run_id", "qid"], None)
        opts = replace(opts, skew_safe=flag)
    j = judge_jg(run, qrels_jg, opts)
    wide = topic_values(j, ms, opts, keys=("qid", "jg"))
    kinds = {}
    cols = []
    for avg, m in zip(names, ms):
        for n, _ in m.parts()[1]:
            out = _jg_name(n, avg, m.name)
            kinds[out] = "avg"
            cols.append(F.avg(col(f"`{n}`")).alias(out))
    per = wide.groupBy("run_id", "qid").agg(*cols)
    long = stack_long(per, list(kinds))
    parts = []
    if per_topic:
        parts.append(long)
    if summary:
        parts.append(summarize(long, kinds, qrels_jg, opts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ measure specs

GAIN_MEASURES = {"ndcg", "dcg", "ideal_dcg", "G", "ndcg_rel", "Rndcg", "rbp"}
LONG_CUTOFFS = {"P", "recall", "relative_P", "success", "map_cut", "ndcg_cut", "unj", "P_avgjg"}
DOUBLE_CUTOFFS = {"iprec_at_recall", "Rprec_mult", "Rprec_mult_avgjg"}


def parse_spec(spec: str):
    """'name' or 'name.params' -> (name, params, gains, display).

    Cut-off lists are sorted (duplicates rejected, and of whole-number ones what is not positive);
    'level=gain' pairs become a gain table; other lists keep their order.
    """
    if "." not in spec or spec.split(".", 1)[0] not in REGISTRY:
        return spec, None, {}, None
    name, raw = spec.split(".", 1)
    items = [x for x in raw.split(",") if x != ""]
    if name in LONG_CUTOFFS:
        vals = sorted({int(float(x)) for x in items})
        if any(v <= 0 for v in vals) or len(vals) != len(items):
            raise ValueError(f"bad cut-offs in {spec}")
        return name, tuple(vals), {}, None
    if name in DOUBLE_CUTOFFS:
        vals = sorted({float(x) for x in items})
        if len(vals) != len(items):
            raise ValueError(f"bad cut-offs in {spec}")
        return name, tuple(vals), {}, None
    if name in GAIN_MEASURES and any("=" in x for x in items):
        gains, p = {}, None
        for x in items:
            k, v = x.split("=", 1)
            if k == "p":
                p = float(v)
            else:
                gains[int(k)] = float(v)
        params = (p,) if (name == "rbp" and p is not None) else None
        return name, params, gains, f"{name}_{raw}"
    return name, tuple(float(x) for x in items), {}, f"{name}_{raw}"


def evaluate_specs(run: DataFrame, qrels: DataFrame, specs: list[str], opts: EvalOptions = EvalOptions(),
                   per_topic: bool = True, summary: bool = True) -> DataFrame:
    """Evaluate measure specs such as 'P.5,7,3' or 'ndcg.1=3,2=9': measures
    with their own gain tables are evaluated with those gains and renamed."""
    from dataclasses import replace
    plain, out = [], []
    for s in specs:
        name, params, gains, display = parse_spec(s)
        if gains:
            ev = evaluate(run, qrels, [name], replace(opts, gains=gains), per_topic, summary)
            out.append(ev.withColumn("measure", F.lit(display)))
        else:
            plain.append(name if params is None else (name, params))
    if plain:
        out.insert(0, evaluate(run, qrels, plain, opts, per_topic, summary))
    res = out[0]
    for x in out[1:]:
        res = res.unionByName(x)
    return res
