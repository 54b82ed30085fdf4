"""DuckDB oracle SQL for the registered queries.

Every statement starts from the driver tables (pre-registered views) and
re-derives the same fixtures, then computes the query with plain SQL
windows and aggregates: an independent formulation of each operator.
Values are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# --------------------------------------------------------------- fixtures
FIXTURE_CTES = {
    "run": """select cast(user_id as string) as qid, concat('D', lpad(cast(event_id as string), 9, '0')) as docno,
       round(value / 5) * 5 as sim, 'runA' as run_id
from events where event_type <> 'error' or event_id % 2 = 0""",
    "runs": """select qid, docno, sim, run_id from run
union all select qid, docno, 500 - sim as sim, 'runB' as run_id from run
union all select qid, docno, cast((cast(substr(docno, 2) as bigint) * 7919) % 101 as double) as sim, 'runC' as run_id from run""",
    "qrels": """select cast(user_id as string) as qid, concat('D', lpad(cast(event_id as string), 9, '0')) as docno,
       cast(case when event_id % 7 = 3 then -1 when event_type = 'purchase' then 3
                 when event_type = 'signup' then 2 when event_type = 'click' then 1 else 0 end as bigint) as rel
from events where event_id % 5 <> 0""",
    "qrels_jg": """select q.qid, cast(j.jg as string) as jg, q.docno,
       case when q.rel < 0 then q.rel else (q.rel + j.jg) % 4 end as rel
from qrels q cross join (select 0 as jg union all select 1 as jg union all select 2 as jg) j
where (cast(substr(q.docno, 2) as bigint) + j.jg) % 4 <> 0""",
    "prefs": """select q.qid, concat('u', cast(j.jg as string)) as jg, cast(s.jsg as string) as jsg, q.docno,
       cast(case when j.jg = 1 and q.rel in (1, 2) then 3 - q.rel else q.rel end as double) as rel_level
from (select qid, docno, rel, cast(substr(docno, 2) as bigint) as n from qrels where rel >= 0) q
cross join (select 0 as jg union all select 1 as jg) j
cross join (select 0 as jsg union all select 1 as jsg) s
where q.n % 4 <> 1 and (q.n + 2 * j.jg) % 5 <> 0 and (q.n + s.jsg) % 3 <> 0""",
    "qrels_prefs": """select qid, jg, '0' as jsg, docno, cast(rel as double) as rel_level from qrels_jg""",
    "corpus": """select concat('T', lpad(cast(doc_id as string), 9, '0')) as docno, source as collection,
       split_part(text, chr(10), 1) as headline, text, cast(1900 + doc_id % 100 as string) as date
from documents""",
    "topics": """select cast(401 + item_id as string) as qid, split_part(text, '.', 1) as title, split_part(text, '.', 2) as desc_text,
       concat(regexp_replace(text, '^[^.]*[.]?[^.]*[.]?', ''), ' Reports on other matters are not relevant. Kept sentence.') as narr,
       case item_id % 3 when 0 then 'during the 1990s' when 1 then 'In the 2010s and 2015, room 1234, 1980S' else '' end as date_text
from benchmark""",
}
FIXTURE_DEPS = {"runs": ["run"], "qrels_jg": ["qrels"], "prefs": ["qrels"],
                "qrels_prefs": ["qrels_jg", "qrels"]}


def ctes(*names: str, extra: list[tuple[str, str]] = ()) -> str:
    """WITH clause holding the named fixtures (and their dependencies)."""
    order: list[str] = []

    def add(n):
        for d in FIXTURE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [f"{n} as ({FIXTURE_CTES[n]})" for n in order] + [f"{n} as ({q})" for n, q in extra]
    return "with " + ",\n".join(parts) + "\n"


def r6(expr: str) -> str:
    return f"round(cast({expr} as double), 6)"


# ---------------------------------------------------------- judged ranking

def judged_ctes(level: int = 1, run: str = "run", max_docs: int | None = None,
                judged_only: bool = False, gains: dict | None = None) -> list[tuple[str, str]]:
    L = level
    gain = "cast(rel as double)"
    if gains:
        gain = "case rel " + " ".join(f"when {k} then {float(v)}" for k, v in gains.items()) + f" else {gain} end"
    trunc = f"where rank0 <= {max_docs}" if max_docs is not None else ""
    j0 = f"""select r.run_id, r.qid, r.docno, r.sim,
       case when q.rel is null then -1 when q.rel < 0 then -2 else q.rel end as rel
from {run} r left join qrels q on r.qid = q.qid and r.docno = q.docno
where r.qid in (select qid from qrels)"""
    j1 = f"""select *, row_number() over (partition by run_id, qid order by sim desc, docno desc) as rank0 from j0"""
    j2 = f"select * from j1 {trunc}"
    if judged_only:
        j2 = f"select * from ({j2}) t where rel >= 0"
    j = f"""select run_id, qid, docno, sim, rel,
       row_number() over w as rank,
       rel >= {L} as isrel,
       case when rel >= 0 then {gain} else 0.0 end as gain,
       sum(case when rel >= {L} then 1 else 0 end) over w as k,
       sum(case when rel >= 0 and rel < {L} then 1 else 0 end) over w as nj,
       sum(case when rel = -2 then 1 else 0 end) over w as u
from j2
window w as (partition by run_id, qid order by sim desc, docno desc rows between unbounded preceding and current row)"""
    st = f"""select qid, count(*) filter (where rel >= {L}) as num_rel,
       count(*) filter (where rel >= 0 and rel < {L}) as num_nonrel,
       count(*) filter (where rel > 0) as num_rel_pos,
       max(rel) filter (where rel >= 0) as max_level
from qrels group by qid"""
    ideal = f"""select qid, {gain} as g,
       row_number() over (partition by qid order by {gain} desc, docno) as pos
from qrels where rel >= 0 and {gain} > 0"""
    ist = """select qid, count(*) as ideal_n, sum(g) as ideal_gain_sum, sum(g / log2(pos + 1)) as ideal_dcg
from ideal group by qid"""
    jt = """select j.*, s.num_rel, s.num_nonrel, s.max_level, coalesce(i.ideal_n, 0) as ideal_n,
       coalesce(i.ideal_gain_sum, 0) as ideal_gain_sum, coalesce(i.ideal_dcg, 0) as ideal_dcg
from j join st s on j.qid = s.qid left join ist i on j.qid = i.qid"""
    return [("j0", j0), ("j1", j1), ("j2", j2), ("j", j), ("st", st), ("ideal", ideal), ("ist", ist), ("jt", jt)]


def topic_agg_cte() -> tuple[str, str]:
    return ("agg", """select run_id, qid, count(*) as ret,
       sum(case when isrel then 1 else 0 end) as rr,
       sum(case when rel = -1 then 1 else 0 end) as nonpool,
       sum(case when rel = -2 then 1 else 0 end) as unj,
       any_value(num_rel) as num_rel, any_value(num_nonrel) as num_nonrel, any_value(max_level) as max_level,
       any_value(ideal_n) as ideal_n, any_value(ideal_gain_sum) as ideal_gain_sum, any_value(ideal_dcg) as ideal_dcg,
       coalesce(sum(case when isrel then k / rank end), 0) as ap_sum,
       min(case when isrel then rank end) as first_rel
from jt group by run_id, qid""")


# ------------------------------------------------------------- measures
CUTS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
POINTS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
MULTS = (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)


def _ip(x):
    c = f"round({x} * num_rel)"
    key = f"ip_{int(round(x * 100))}"
    return (key, f"max(case when isrel and k >= {c} then k / rank end)",
            f"case when round({x} * num_rel) > rr then 0 else coalesce({key}, 0) end")


def measure_sql_parts(name: str):
    """(extra aggregates over jt, [(measure, value expr over the agg row)], summary kind)."""
    div = lambda a, b: f"case when ({b}) <> 0 then ({a}) / ({b}) else 0 end"
    if name == "num_q":
        return {}, [("num_q", "1.0")], "num_q"
    if name == "num_ret":
        return {}, [("num_ret", "ret")], "sum"
    if name == "num_rel":
        return {}, [("num_rel", "num_rel")], "num_rel"
    if name == "num_rel_ret":
        return {}, [("num_rel_ret", "rr")], "sum"
    if name == "num_nonrel_judged_ret":
        return {}, [(name, "ret - nonpool - unj - rr")], "sum"
    if name == "map":
        return {}, [("map", div("ap_sum", "num_rel"))], "avg"
    if name == "gm_map":
        return {}, [("gm_map", f"ln(greatest({div('ap_sum', 'num_rel')}, 0.00001))")], "gm"
    if name == "Rprec":
        return {"rin": "count(*) filter (where isrel and rank <= num_rel)"}, [("Rprec", div("rin", "num_rel"))], "avg"
    bp = ("coalesce(sum(case when isrel then case when nj > 0 then 1.0 - least(nj, num_rel) / "
          "least(num_nonrel, num_rel) else 1.0 end end), 0)")
    if name == "bpref":
        return {"bps": bp}, [("bpref", div("bps", "num_rel"))], "avg"
    if name == "gm_bpref":
        return {"bps": bp}, [("gm_bpref", f"ln(greatest({div('bps', 'num_rel')}, 0.00001))")], "gm"
    if name == "recip_rank":
        return {}, [("recip_rank", "coalesce(1.0 / first_rel, 0)")], "avg"
    if name == "iprec_at_recall":
        parts = [_ip(x) for x in POINTS]
        return {a: e for a, e, _ in parts}, [(f"iprec_at_recall_{x:3.2f}", v) for x, (_, _, v) in zip(POINTS, parts)], "avg"
    if name == "11pt_avg":
        parts = [_ip(x) for x in POINTS]
        return {a: e for a, e, _ in parts}, [("11pt_avg", "(" + " + ".join(v for _, _, v in parts) + ") / 11.0")], "avg"
    if name in ("P", "recall", "relative_P", "success"):
        cuts = (1, 5, 10) if name == "success" else CUTS
        aggs = {f"ra{n}": f"count(*) filter (where isrel and rank <= {n})" for n in cuts}
        f = {"P": lambda n: f"ra{n} / {n}.0", "recall": lambda n: div(f"ra{n}", "num_rel"),
             "relative_P": lambda n: div(f"ra{n}", f"least({n}, num_rel)"),
             "success": lambda n: f"case when ra{n} > 0 then 1.0 else 0.0 end"}[name]
        return aggs, [(f"{name}_{n}", f(n)) for n in cuts], "avg"
    if name == "map_cut":
        aggs = {f"apc{n}": f"coalesce(sum(case when isrel and rank <= {n} then k / rank end), 0)" for n in CUTS}
        return aggs, [(f"map_cut_{n}", div(f"apc{n}", "num_rel")) for n in CUTS], "avg"
    if name == "Rprec_mult":
        aggs = {f"rm{i}": f"count(*) filter (where isrel and rank <= floor({x} * num_rel + 0.9))" for i, x in enumerate(MULTS)}
        return aggs, [(f"Rprec_mult_{x:3.2f}", div(f"rm{i}", f"floor({x} * num_rel + 0.9)")) for i, x in enumerate(MULTS)], "avg"
    if name == "unj":
        aggs = {f"uj{n}": f"count(*) filter (where rel < 0 and rank <= {n})" for n in (5, 10, 20)}
        return aggs, [(f"unj_{n}", f"uj{n} / {n}.0") for n in (5, 10, 20)], "avg"
    if name == "infAP":
        term = ("case when rank = 1 then 1.0 else 1.0 / rank + ((rank - 1.0) / rank) * ((k - 1 + nj + u) / (rank - 1.0))"
                " * ((k - 1 + 0.00001) / (k - 1 + nj + 2 * 0.00001)) end")
        return {"ia": f"coalesce(sum(case when isrel then {term} end), 0)"}, [("infAP", div("ia", "num_rel"))], "avg"
    if name == "binG":
        return ({"bg": "coalesce(sum(case when isrel then 1.0 / log2(2 + rank - k) end), 0)"},
                [("binG", div("bg", "num_rel"))], "avg")
    if name == "yaap":
        return {}, [("yaap", "ln((1.0 + ap_sum) / (1.0 + num_rel - ap_sum))")], "avg"
    if name == "set_P":
        return {}, [("set_P", div("rr", "ret"))], "avg"
    if name == "set_relative_P":
        return {}, [("set_relative_P", div("rr", "least(ret, num_rel)"))], "avg"
    if name == "set_recall":
        return {}, [("set_recall", div("rr", "num_rel"))], "avg"
    if name == "set_map":
        return {}, [("set_map", div("rr * rr", "ret * num_rel"))], "avg"
    if name == "set_F":
        return {}, [("set_F", "case when rr > 0 then 2.0 * (rr / ret) * (rr / num_rel) / ((rr / ret) + (rr / num_rel)) else 0 end")], "avg"
    if name == "utility":
        return {}, [("utility", "1.0 * rr - 1.0 * (ret - rr)")], "avg"
    if name == "dcg":
        return {"dg": "coalesce(sum(case when gain <> 0 then gain / log2(rank + 1) end), 0)"}, [("dcg", "dg")], "avg"
    if name == "ideal_dcg":
        return {}, [("ideal_dcg", "ideal_dcg")], "avg"
    if name == "ndcg":
        return ({"dg": "coalesce(sum(case when gain <> 0 then gain / log2(rank + 1) end), 0)"},
                [("ndcg", div("dg", "ideal_dcg"))], "avg")
    if name == "ndcg_cut":
        aggs = {f"dc{n}": f"coalesce(sum(case when rel > 0 and rank <= {n} then rel / log2(rank + 1) end), 0)" for n in CUTS}
        aggs.update({f"ic{n}": f"any_value(ic{n})" for n in CUTS})
        return aggs, [(f"ndcg_cut_{n}", div(f"dc{n}", f"ic{n}")) for n in CUTS], "avg"
    if name == "rbp":
        return ({"rg": "coalesce(sum(case when gain <> 0 then gain * pow(0.9, rank - 1) end), 0)"},
                [("rbp", "0.1 * case when max_level > 1 then rg / max_level else rg end")], "avg")
    if name == "rbp_resid":
        return ({"rw": "coalesce(sum(case when rel < 0 then pow(0.9, rank - 1) end), 0)",
                 "ua": "count(*) filter (where rel < 0)"},
                [("rbp_resid", "case when ua > 0 then pow(0.9, ret) + 0.1 * rw else 0 end")], "avg")
    if name in ("G", "ndcg_rel", "Rndcg"):
        return WINDOWED[name]()
    raise KeyError(name)


def _g():
    return ({"gs": "coalesce(sum(case when gain <> 0 then gain / log2(2 + cost - sg) end), 0)"},
            [("G", "case when ideal_gain_sum > 0 then gs / ideal_gain_sum else 0 end")], "avg")


def _ndcg_rel():
    aggs = {"nrs": "coalesce(sum(case when gain > 0 then dcum / icum end), 0)",
            "nrh": "count(*) filter (where gain > 0)",
            "dg": "coalesce(sum(case when gain <> 0 then gain / log2(rank + 1) end), 0)"}
    tot = "(nrs + (ideal_n - nrh) * (case when ideal_dcg > 0 then dg / ideal_dcg else 0 end))"
    return aggs, [("ndcg_rel", f"case when ideal_n > 0 and {tot} > 0 then {tot} / ideal_n else 0 end")], "avg"


def _rndcg():
    # Change points of the ideal gain: last position of each gain level.
    aggs = {"rs_in": "coalesce(sum(case when is_end then dcum / icum end), 0)",
            "rc_in": "count(*) filter (where is_end)",
            "dg": "coalesce(sum(case when gain <> 0 then gain / log2(rank + 1) end), 0)"}
    tail_s = "(select coalesce(sum(a.dg / e.icum_end), 0) from ends e where e.qid = a.qid and e.pos > a.ret)"
    tail_c = "(select count(*) from ends e where e.qid = a.qid and e.pos > a.ret)"
    extra = "(a.ret > a.ideal_n + 1 and a.ideal_dcg > 0)"
    tot = f"(rs_in + {tail_s} + case when {extra} then dg / ideal_dcg else 0 end)"
    cnt = f"(rc_in + {tail_c} + case when {extra} then 1 else 0 end)"
    return aggs, [("Rndcg", f"case when num_rel > 0 and {cnt} > 0 then {tot} / {cnt} else 0 end")], "avg"


WINDOWED = {"G": _g, "ndcg_rel": _ndcg_rel, "Rndcg": _rndcg}

IDEAL_POS_CTES = [
    ("icum_t", """select qid, pos, g, sum(g / log2(pos + 1)) over (partition by qid order by pos) as icum,
       lead(g) over (partition by qid order by pos) as next_g from ideal"""),
    ("ends", """select qid, pos, icum as icum_end from icum_t where next_g is null or next_g <> g"""),
    ("jw", """select jt.*, coalesce(i.g, 0) as ig,
       sum(gain / log2(rank + 1)) over w as dcum,
       sum(coalesce(i.g, 0) / log2(rank + 1)) over w as icum,
       sum(gain) over w as sg,
       sum(greatest(coalesce(i.g, 0), 1.0)) over w as cost,
       (e.pos is not null) as is_end
from jt left join ideal i on jt.qid = i.qid and jt.rank = i.pos
     left join ends e on jt.qid = e.qid and jt.rank = e.pos
window w as (partition by jt.run_id, jt.qid order by jt.rank rows between unbounded preceding and current row)"""),
]

NDCG_CUT_CTE = ("icut", "select qid, " + ", ".join(
    f"coalesce(sum(g / log2(pos + 1)) filter (where pos <= {n}), 0) as ic{n}" for n in CUTS) + " from ideal group by qid")


def measure_query(name: str, runs: str = "runs", level: int = 1, summary: bool = True,
                  complete: bool = False, max_docs: int | None = None, judged_only: bool = False,
                  digits: int = 6, gains: dict | None = None) -> str:
    extra_aggs, vals, kind = measure_sql_parts(name)
    ex = judged_ctes(level, run=runs, max_docs=max_docs, judged_only=judged_only, gains=gains)
    src = "jt"
    if name in WINDOWED:
        ex += IDEAL_POS_CTES
        src = "jw"
    if name == "ndcg_cut":
        ex.append(NDCG_CUT_CTE)
        ex.append(("jtc", "select jt.*, " + ", ".join(f"coalesce(c.ic{n}, 0) as ic{n}" for n in CUTS)
                   + " from jt left join icut c on jt.qid = c.qid"))
        src = "jtc"
    base_aggs = dict(topic_agg_cte_cols())
    base_aggs.update(extra_aggs)
    agg = ("agg", f"select run_id, qid, " + ", ".join(f"{e} as {a}" for a, e in base_aggs.items())
           + f" from {src} group by run_id, qid")
    pt = ("pt", " union all ".join(f"select run_id, qid, '{m}' as measure, cast({v} as double) as value from agg a"
                                   for m, v in vals))
    ex += [agg, pt]
    fx = ["qrels", runs] if runs in FIXTURE_CTES else ["qrels"]
    head = ctes(*fx, extra=ex)
    per = "" if kind == "gm" else f"select run_id, qid, measure, round(value, {digits}) as value from pt"
    if not summary:
        return head + per
    if complete:
        nq = "(select count(distinct qid) from qrels)"
    else:
        nq = "count(*)"
    miss = f"({nq} - count(*))"
    summ = {"avg": f"sum(value) / {nq}", "sum": "sum(value)", "num_q": f"{nq}",
            "num_rel": "(select count(*) from qrels where rel > 0)" if complete else "sum(value)",
            "gm": f"exp((sum(value) + {miss} * ln(0.00001)) / {nq})"}[kind]
    s = f"select run_id, 'all' as qid, measure, round(cast({summ} as double), {digits}) as value from pt group by run_id, measure"
    return head + (f"{per} union all {s}" if per else s)


def topic_agg_cte_cols():
    return [("ret", "count(*)"), ("rr", "sum(case when isrel then 1 else 0 end)"),
            ("nonpool", "sum(case when rel = -1 then 1 else 0 end)"), ("unj", "sum(case when rel = -2 then 1 else 0 end)"),
            ("num_rel", "any_value(num_rel)"), ("num_nonrel", "any_value(num_nonrel)"), ("max_level", "any_value(max_level)"),
            ("ideal_n", "any_value(ideal_n)"), ("ideal_gain_sum", "any_value(ideal_gain_sum)"),
            ("ideal_dcg", "any_value(ideal_dcg)"),
            ("ap_sum", "coalesce(sum(case when isrel then k / rank end), 0)"),
            ("first_rel", "min(case when isrel then rank end)")]


PASSAGE_QRELS = """select cast(401 + b.item_id as string) as qid, concat('T', lpad(cast(d.doc_id as string), 9, '0')) as docno,
       cast(1 + coalesce(l.quality, 0) as bigint) as rel
from benchmark b join documents d on contains(d.text, b.text) left join labels l on l.doc_id = d.doc_id"""


OFFICIAL = ["num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map", "Rprec", "bpref", "recip_rank",
            "iprec_at_recall", "P"]


def eval_union(names, per_topic: bool = False, **kw) -> str:
    """Union of measure queries; summary rows only unless per_topic."""
    parts = []
    for n in names:
        q = measure_query(n, **kw)
        if per_topic:
            parts.append(f"select * from ({q})")
        else:
            parts.append(f"select * from ({q}) where qid = 'all'")
    return " union all ".join(parts)


def judged_run_sql(**kw) -> str:
    ex = judged_ctes(run="runs", **kw)
    return ctes("qrels", "runs", extra=ex) + \
        "select run_id, qid, docno, cast(rank as bigint) as rank, cast(rel as bigint) as rel from jt"


def topic_stats_sql() -> str:
    ex = judged_ctes()
    return ctes("qrels", extra=ex) + """select s.qid, cast(s.num_rel as bigint) as num_rel, cast(s.num_nonrel as bigint) as num_nonrel,
  cast(coalesce(i.ideal_n, 0) as bigint) as ideal_n, round(coalesce(i.ideal_dcg, 0), 6) as ideal_dcg
from st s left join ist i on s.qid = i.qid"""


def rel_levels_sql() -> str:
    return ctes("qrels") + "select qid, rel, count(*) as n from qrels where rel >= 0 group by qid, rel"


def relstring_sql() -> str:
    ex = judged_ctes(run="runs")
    ch = ("case when rel > 9 then '>' when rel >= 0 then cast(rel as varchar) when rel = -1 then '-' "
          "when rel = -2 then '.' else '<' end")
    return ctes("qrels", "runs", extra=ex) + \
        f"select run_id, qid, string_agg({ch}, '' order by rank) as relstring from jt where rank <= 10 group by run_id, qid"


def decorate_sql() -> str:
    ex = judged_ctes(run="run")
    return ctes("qrels", "run", extra=ex) + """select run_id, qid, cast(rank as bigint) as rank, docno, sim, cast(rel as bigint) as rel,
  round(case when isrel then k / rank end, 6) as precision,
  round(case when isrel and num_rel > 0 then k / num_rel end, 6) as recall from jt"""


def zref_sql(names=("map", "P", "ndcg", "bpref")) -> str:
    per = eval_union(names, per_topic=True, digits=15)
    return f"""select qid, measure, round(avg(value), 6) as mean, round(coalesce(stddev_samp(value), 0), 6) as stddev
from ({per}) where qid <> 'all' group by qid, measure"""


def avgjg_sql() -> str:
    """map / P / Rprec_mult per judge group, averaged over the topic's groups."""
    jgc = [
        ("rj", "select r.run_id, r.qid, g.jg, r.docno, r.sim from runs r join (select distinct qid, jg from qrels_jg) g on r.qid = g.qid"),
        ("j0", """select r.run_id, r.qid, r.jg, r.docno, r.sim,
  case when q.rel is null then -1 when q.rel < 0 then -2 else q.rel end as rel
  from rj r left join qrels_jg q on r.qid = q.qid and r.jg = q.jg and r.docno = q.docno"""),
        ("j", """select *, row_number() over w as rank, rel >= 1 as isrel,
  sum(case when rel >= 1 then 1 else 0 end) over w as k from j0
  window w as (partition by run_id, qid, jg order by sim desc, docno desc rows between unbounded preceding and current row)"""),
        ("st", "select qid, jg, count(*) filter (where rel >= 1) as num_rel from qrels_jg group by qid, jg"),
        ("a", "select j.run_id, j.qid, j.jg, any_value(s.num_rel) as num_rel, "
              "coalesce(sum(case when isrel then k / rank end), 0) as ap, "
              + ", ".join(f"count(*) filter (where isrel and rank <= {n}) as ra{n}" for n in CUTS) + ", "
              + ", ".join(f"count(*) filter (where isrel and rank <= floor({x} * s.num_rel + 0.9)) as rm{i}"
                          for i, x in enumerate(MULTS))
              + " from j join st s on j.qid = s.qid and j.jg = s.jg group by j.run_id, j.qid, j.jg"),
    ]
    div = lambda a, b: f"case when ({b}) <> 0 then ({a}) / ({b}) else 0 end"
    vals = [("map_avgjg", div("ap", "num_rel"))] + [(f"P_avgjg_{n}", f"ra{n} / {n}.0") for n in CUTS] + \
        [(f"Rprec_mult_avgjg_{x:3.2f}", div(f"rm{i}", f"floor({x} * num_rel + 0.9)")) for i, x in enumerate(MULTS)]
    pt = " union all ".join(f"select run_id, qid, '{m}' as measure, avg(cast({v} as double)) as value from a group by run_id, qid"
                            for m, v in vals)
    head = ctes("qrels", "runs", "qrels_jg", extra=jgc + [("pt", pt)])
    return head + ("select run_id, qid, measure, round(value, 6) as value from pt union all "
                   "select run_id, 'all' as qid, measure, round(sum(value) / count(*), 6) as value from pt group by run_id, measure")


def zscores_sql(names=("map", "P", "ndcg", "bpref")) -> str:
    per = eval_union(names, per_topic=True, digits=15)
    return f"""with per as (select * from ({per}) where qid <> 'all'),
zr as (select qid, measure, avg(value) as mean, coalesce(stddev_samp(value), 0) as sd from per group by qid, measure),
z as (select p.run_id, p.qid, 'Z' || p.measure as measure,
  case when zr.mean is null then -1000000 when zr.sd <> 0 then (p.value - zr.mean) / zr.sd
       when abs(p.value - zr.mean) <= 1e-9 then 0 else -1000000 end as value
  from per p left join zr on p.qid = zr.qid and p.measure = zr.measure)
select run_id, qid, measure, round(value, 6) as value from z
union all select run_id, 'all' as qid, measure, round(sum(value) / count(*), 6) as value from z group by run_id, measure"""


PREFS_NONPAIR = ["prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret", "prefs_simp",
                 "prefs_avgjg", "prefs_avgjg_Rnonrel", "prefs_simp_ret", "prefs_avgjg_ret", "prefs_avgjg_Rnonrel_ret",
                 "prefs_simp_imp", "prefs_avgjg_imp"]
PREFS_PAIR = ["prefs_pair", "prefs_pair_ret", "prefs_pair_imp"]


def _prefs_ctes(single_judge: bool) -> list[tuple[str, str]]:
    """``single_judge``: each (topic, judge group) is a topic of its own."""
    own = "qid || '|' || jg" if single_judge else "qid"
    judged = "select distinct qid as q0, qid || '|' || jg as q1 from qrels_prefs"
    return [
        ("qp", f"select {own} as qid, jg, jsg, docno, rel_level from qrels_prefs"),
        ("rx", f"select r.run_id, g.q1 as qid, r.docno, r.sim from runs r join ({judged}) g on r.qid = g.q0"
               if single_judge else "select run_id, qid, docno, sim from runs"),
        ("jd", "select distinct qid, docno from qp"),
        ("rr", """select r.run_id, r.qid, r.docno, row_number() over (partition by r.run_id, r.qid order by r.sim desc, r.docno asc) as rank
  from rx r where exists (select 1 from jd where jd.qid = r.qid and jd.docno = r.docno)"""),
        ("tp", "select distinct run_id, qid from rx where qid in (select qid from qp)"),
        ("docs", """select t.run_id, p.qid, p.jg, p.docno, p.rel_level, rr.rank from tp t join qp p on t.qid = p.qid
  left join rr on rr.run_id = t.run_id and rr.qid = p.qid and rr.docno = p.docno"""),
        ("pairs", """select a.run_id, a.qid, a.jg, a.rank as ra, b.rank as rb from docs a join docs b
  on a.run_id = b.run_id and a.qid = b.qid and a.jg = b.jg and a.rel_level > b.rel_level"""),
        ("cnt0", """select run_id, qid, jg,
  count(*) filter (where ra is not null and rb is not null and ra < rb) as ful_ret,
  count(*) filter (where ra is not null and rb is not null) as poss_ret,
  count(*) filter (where ra is not null and rb is null) as ful_imp,
  count(*) filter (where (ra is null) <> (rb is null)) as poss_imp,
  count(*) filter (where ra is null and rb is null) as notoccur from pairs group by run_id, qid, jg"""),
        ("cnt1", """select g.run_id, g.qid, g.jg, coalesce(ful_ret, 0) as ful_ret, coalesce(poss_ret, 0) as poss_ret,
  coalesce(ful_imp, 0) as ful_imp, coalesce(poss_imp, 0) as poss_imp, coalesce(notoccur, 0) as notoccur
  from (select distinct run_id, qid, jg from docs) g left join cnt0 c on g.run_id = c.run_id and g.qid = c.qid and g.jg = c.jg"""),
        # Non-relevant cap: class counts, lowest class, first R of it in compact order.
        ("gi", """select run_id, qid, jg, min(rel_level) as min_level,
  count(*) filter (where rel_level > 0) as num_rel, count(*) filter (where rel_level > 0 and rank is not null) as num_rel_ret,
  count(*) filter (where rel_level <= 0) as num_nonrel, count(*) filter (where rel_level <= 0 and rank is not null) as num_nonrel_ret
  from docs group by run_id, qid, jg"""),
        ("dl", """select d.*, g.min_level, g.num_rel, g.num_rel_ret, d.rel_level = g.min_level as is_last,
  row_number() over (partition by d.run_id, d.qid, d.jg, d.rel_level = g.min_level
                     order by d.rank is null, d.rank, d.docno) as pos_in_class
  from docs d join gi g on d.run_id = g.run_id and d.qid = g.qid and d.jg = g.jg"""),
        ("rn", """select x.run_id, x.qid, x.jg,
  count(*) filter (where x.rel_level > y.rel_level and not y.is_last and x.rank is not null and (y.rank is null or x.rank < y.rank)) as f1,
  count(*) filter (where x.rel_level > y.rel_level and not y.is_last) as p1,
  count(*) filter (where y.is_last and y.pos_in_class <= y.num_rel and x.rank is not null and (y.rank is null or x.rank < y.rank)) as f2,
  count(*) filter (where y.is_last and y.pos_in_class <= y.num_rel) as p2,
  count(*) filter (where x.rank is not null and y.rank is not null and x.rel_level > y.rel_level and not y.is_last and x.rank < y.rank) as f1r,
  count(*) filter (where x.rank is not null and y.rank is not null and x.rel_level > y.rel_level and not y.is_last) as p1r,
  count(*) filter (where x.rank is not null and y.rank is not null and y.is_last and y.pos_in_class <= y.num_rel_ret and x.rank < y.rank) as f2r,
  count(*) filter (where x.rank is not null and y.rank is not null and y.is_last and y.pos_in_class <= y.num_rel_ret) as p2r
  from dl x join dl y on x.run_id = y.run_id and x.qid = y.qid and x.jg = y.jg group by x.run_id, x.qid, x.jg"""),
        ("cnt", """select c.*, g.num_rel, g.num_rel_ret, g.num_nonrel, g.num_nonrel_ret,
  case when g.num_rel >= g.num_nonrel then c.ful_ret + c.ful_imp + g.num_rel_ret * (g.num_rel - g.num_nonrel) else r.f1 + r.f2 end as rn_ful,
  case when g.num_rel >= g.num_nonrel then c.poss_ret + c.poss_imp + c.notoccur + g.num_rel * (g.num_rel - g.num_nonrel) else r.p1 + r.p2 end as rn_poss,
  case when g.num_rel_ret >= g.num_nonrel_ret then c.ful_ret + g.num_rel_ret * (g.num_rel_ret - g.num_nonrel_ret) else r.f1r + r.f2r end as rr_ful,
  case when g.num_rel_ret >= g.num_nonrel_ret then c.poss_ret + g.num_rel * (g.num_rel_ret - g.num_nonrel_ret) else r.p1r + r.p2r end as rr_poss
  from cnt1 c join gi g on c.run_id = g.run_id and c.qid = g.qid and c.jg = g.jg
  join rn r on c.run_id = r.run_id and c.qid = r.qid and c.jg = r.jg"""),
    ]


def _closed_ctes() -> list[tuple[str, str]]:
    """The counts of :func:`_prefs_ctes` for judge groups with several sub-groups: the
    closure of all document pairs, by recursion."""
    base = dict(_prefs_ctes(False))
    return [
        ("qp", "select qid, jg, jsg, docno, rel_level from prefs"),
        *((n, base[n]) for n in ("rx", "jd", "rr", "tp")),
        ("direct", """select distinct a.qid, a.jg, a.docno as a, b.docno as b from qp a join qp b
  on a.qid = b.qid and a.jg = b.jg and a.jsg = b.jsg and a.rel_level > b.rel_level"""),
        ("closed", """select qid, jg, a, b from direct union
  select c.qid, c.jg, c.a, d.b from closed c join direct d on c.qid = d.qid and c.jg = d.jg and c.b = d.a"""),
        ("docs", """select t.run_id, p.qid, p.jg, p.docno, p.rel_level, rr.rank
  from tp t join (select distinct qid, jg, docno, rel_level from qp) p on t.qid = p.qid
  left join rr on rr.run_id = t.run_id and rr.qid = p.qid and rr.docno = p.docno"""),
        ("pairs", """select t.run_id, c.qid, c.jg, c.a, c.b, x.rank as ra, y.rank as rb from tp t join closed c on t.qid = c.qid
  left join rr x on x.run_id = t.run_id and x.qid = c.qid and x.docno = c.a
  left join rr y on y.run_id = t.run_id and y.qid = c.qid and y.docno = c.b"""),
        ("cnt0", base["cnt0"]), ("cnt1", base["cnt1"]),
        ("gi", """select run_id, qid, jg,
  count(*) filter (where rel_level > 0) as num_rel, count(*) filter (where rel_level > 0 and rank is not null) as num_rel_ret,
  count(*) filter (where rel_level = 0) as num_nonrel, count(*) filter (where rel_level = 0 and rank is not null) as num_nonrel_ret
  from docs group by run_id, qid, jg"""),
        ("kept", """select d.run_id, d.qid, d.jg, d.docno from (
    select *, count(*) filter (where rel_level = 0) over (partition by run_id, qid, jg order by rank is null, rank, docno) as zeros from docs) d
  join gi g on d.run_id = g.run_id and d.qid = g.qid and d.jg = g.jg where d.rel_level <> 0 or d.zeros <= g.num_rel"""),
        ("rn", """select p.run_id, p.qid, p.jg,
  count(*) filter (where ra is not null and (rb is null or ra < rb)) as f, count(*) as p,
  count(*) filter (where ra < rb) as fr, count(*) filter (where ra is not null and rb is not null) as pr
  from pairs p join kept x on x.run_id = p.run_id and x.qid = p.qid and x.jg = p.jg and x.docno = p.a
  join kept y on y.run_id = p.run_id and y.qid = p.qid and y.jg = p.jg and y.docno = p.b group by p.run_id, p.qid, p.jg"""),
        ("cnt", """select c.*, g.num_rel, g.num_rel_ret, g.num_nonrel, g.num_nonrel_ret,
  case when g.num_rel >= g.num_nonrel then c.ful_ret + c.ful_imp + g.num_rel_ret * (g.num_rel - g.num_nonrel) else coalesce(r.f, 0) end as rn_ful,
  case when g.num_rel >= g.num_nonrel then c.poss_ret + c.poss_imp + c.notoccur + g.num_rel * (g.num_rel - g.num_nonrel) else coalesce(r.p, 0) end as rn_poss,
  case when g.num_rel_ret >= g.num_nonrel_ret then c.ful_ret + g.num_rel_ret * (g.num_rel_ret - g.num_nonrel_ret) else coalesce(r.fr, 0) end as rr_ful,
  case when g.num_rel_ret >= g.num_nonrel_ret then c.poss_ret + g.num_rel * (g.num_rel_ret - g.num_nonrel_ret) else coalesce(r.pr, 0) end as rr_poss
  from cnt1 c join gi g on c.run_id = g.run_id and c.qid = g.qid and c.jg = g.jg
  left join rn r on c.run_id = r.run_id and c.qid = r.qid and c.jg = r.jg"""),
    ]


def prefs_closure_sql() -> str:
    head = ctes("prefs", "runs", extra=_closed_ctes()).replace("with ", "with recursive ", 1)
    cols = ["ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur", "num_rel", "num_rel_ret", "num_nonrel", "num_nonrel_ret"]
    return head + "select run_id, qid, jg, " + ", ".join(f"cast({c} as bigint) as {c}" for c in cols) + " from cnt"


def prefs_counts_sql() -> str:
    return ctes("qrels_prefs", "runs", extra=_prefs_ctes(False)) + (
        "select run_id, qid, jg, cast(ful_ret as bigint) as ful_ret, cast(poss_ret as bigint) as poss_ret, "
        "cast(ful_imp as bigint) as ful_imp, cast(poss_imp as bigint) as poss_imp, "
        "cast(notoccur as bigint) as notoccur from cnt")


def prefs_measures_sql(pair: bool = False, closed: bool = False) -> str:
    div = lambda a, b: f"case when ({b}) > 0 then ({a}) / ({b}) else 0 end"
    pa = "(poss_ret + poss_imp + notoccur)"    # poss_imp: pairs with exactly one doc retrieved
    fa = "(ful_ret + ful_imp)"
    pi = "(poss_ret + poss_imp)"
    per = f"""select run_id, qid, count(*) as n_jg, sum({pa}) as poss, sum({fa}) as ful, sum(ful_ret) as fr, sum(poss_ret) as pr,
  sum({pi}) as pi, sum({div(fa, pa)}) as avg_all, sum({div('ful_ret', 'poss_ret')}) as avg_ret, sum({div(fa, pi)}) as avg_imp,
  sum(case when rn_poss > 0 then rn_ful / rn_poss end) as avg_rn, count(*) filter (where rn_poss <= 0) as rn_bad,
  sum(case when rr_poss > 0 then rr_ful / rr_poss end) as avg_rr, count(*) filter (where rr_poss <= 0) as rr_bad
  from cnt group by run_id, qid"""
    avg = lambda s: f"case when {s} > 0 then {s} / n_jg else 0 end"
    exprs = {"prefs_num_prefs_poss": "poss", "prefs_num_prefs_ful": "ful", "prefs_num_prefs_ful_ret": "fr",
             "prefs_simp": div("ful", "poss"), "prefs_avgjg": avg("avg_all"), "prefs_simp_ret": div("fr", "pr"),
             "prefs_avgjg_ret": avg("avg_ret"), "prefs_simp_imp": div("ful", "pi"), "prefs_avgjg_imp": avg("avg_imp"),
             "prefs_pair": div("ful", "poss"), "prefs_pair_ret": div("fr", "pr"), "prefs_pair_imp": div("ful", "pi"),
             "prefs_avgjg_Rnonrel": f"case when rn_bad > 0 then 0 else {avg('avg_rn')} end",
             "prefs_avgjg_Rnonrel_ret": f"case when rr_bad > 0 then 0 else {avg('avg_rr')} end"}
    names = PREFS_PAIR if pair else PREFS_NONPAIR
    pt = " union all ".join(f"select run_id, qid, '{m}' as measure, cast({exprs[m]} as double) as value from per" for m in names)
    summed = ("prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret")
    head = ctes("qrels_prefs", "runs", extra=_prefs_ctes(pair) + [("per", per), ("pt", pt)])
    if closed:
        head = ctes("prefs", "runs", extra=_closed_ctes() + [("per", per), ("pt", pt)]).replace("with ", "with recursive ", 1)
    return head + ("select run_id, qid, measure, round(value, 6) as value from pt union all "
                   "select run_id, 'all' as qid, measure, round(case when measure in ("
                   + ", ".join(f"'{m}'" for m in summed) + ") then sum(value) else sum(value) / count(*) end, 6) as value "
                   "from pt group by run_id, measure")


def prefs_pair_multi_sql(closed: bool = False) -> str:
    """Pair vote shares across all judge groups, by enumerating doc pairs."""
    ex = (_closed_ctes() if closed else _prefs_ctes(False)) + [
        ("da", "select distinct t.run_id, p.qid, p.docno from tp t join qp p on t.qid = p.qid"),
        ("dr", "select da.*, rr.rank from da left join rr on rr.run_id = da.run_id and rr.qid = da.qid and rr.docno = da.docno"),
        ("pp", """select a.run_id, a.qid, a.docno as a, b.docno as b, a.rank as ra, b.rank as rb from dr a join dr b
  on a.run_id = b.run_id and a.qid = b.qid
  where (a.rank is not null and (b.rank is null or a.rank < b.rank)) or (a.rank is null and b.rank is null and a.docno < b.docno)"""),
        ("pv", """select pp.run_id, pp.qid, pp.a, pp.b, any_value(pp.ra) as ra, any_value(pp.rb) as rb,
  count(*) filter (where c.a = pp.a) as f, count(*) filter (where c.a = pp.b) as g
  from pp left join closed c on c.qid = pp.qid and ((c.a = pp.a and c.b = pp.b) or (c.a = pp.b and c.b = pp.a))
  group by pp.run_id, pp.qid, pp.a, pp.b""" if closed else """select pp.run_id, pp.qid, pp.a, pp.b, any_value(ra) as ra, any_value(rb) as rb,
  count(*) filter (where pa.rel_level > pb.rel_level) as f, count(*) filter (where pb.rel_level > pa.rel_level) as g
  from pp join qp pa on pa.qid = pp.qid and pa.docno = pp.a join qp pb on pb.qid = pp.qid and pb.jg = pa.jg and pb.docno = pp.b
  group by pp.run_id, pp.qid, pp.a, pp.b"""),
        ("agg", """select run_id, qid,
  sum(case when f + g > 0 and ra is not null then f * 1.0 / (f + g) else 0 end) as s_all,
  sum(case when f + g > 0 and ra is not null and rb is not null then f * 1.0 / (f + g) else 0 end) as s_ret,
  count(*) filter (where f + g > 0) as n_all, count(*) filter (where f + g > 0 and ra is not null and rb is not null) as n_ret,
  count(*) filter (where f + g > 0 and (ra is not null or rb is not null)) as n_imp from pv group by run_id, qid"""),
        ("pt", """select t.run_id, t.qid, 'prefs_pair' as measure, case when coalesce(n_all, 0) > 0 then s_all / n_all else 0 end as value from tp t left join agg a on a.run_id = t.run_id and a.qid = t.qid
  union all select t.run_id, t.qid, 'prefs_pair_ret', case when coalesce(n_ret, 0) > 0 then s_ret / n_ret else 0 end from tp t left join agg a on a.run_id = t.run_id and a.qid = t.qid
  union all select t.run_id, t.qid, 'prefs_pair_imp', case when coalesce(n_imp, 0) > 0 then s_all / n_imp else 0 end from tp t left join agg a on a.run_id = t.run_id and a.qid = t.qid"""),
    ]
    head = ctes("prefs" if closed else "qrels_prefs", "runs", extra=ex).replace("with ", "with recursive " if closed else "with ", 1)
    return head + ("select run_id, qid, measure, round(value, 6) as value from pt union all "
                   "select run_id, 'all' as qid, measure, round(sum(value) / count(*), 6) as value from pt group by run_id, measure")
