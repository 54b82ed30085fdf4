"""DuckDB oracle SQL of the file readers: the rows that the files were written from."""

from __future__ import annotations

from . import oracle as O


def run_sql() -> str:
    return O.ctes("runs") + "select run_id, qid, docno, sim from runs"


def qrels_sql() -> str:
    return O.ctes("qrels") + "select qid, docno, rel from qrels"


def qrels_jg_sql() -> str:
    return O.ctes("qrels_jg") + "select qid, jg, docno, cast(rel as bigint) as rel from qrels_jg"


def prefs_sql() -> str:
    return O.ctes("prefs") + "select qid, jg, jsg, docno, rel_level from prefs"


def qrels_prefs_sql() -> str:
    return O.ctes("qrels_prefs") + "select qid, jg, jsg, docno, rel_level from qrels_prefs"


def zscores_sql() -> str:
    return f"select qid, measure, round(mean, 6) as mean, round(stddev, 6) as stddev from ({O.zref_sql()})"


def runid_sql() -> str:
    """The tag of each run's last line, in the order of topic and document."""
    return O.ctes("runs") + """select run_id, run_id || '_' || (cast(substr(docno, 2) as bigint) % 5) as runid
from runs qualify row_number() over (partition by run_id order by qid desc, docno desc) = 1"""


def gains_sql(gains: dict) -> str:
    """Measures of the levels, with each level's gain in the place of the level."""
    names = ["dcg", "ndcg", "ideal_dcg", "ndcg_rel", "Rndcg", "G"]
    return O.eval_union(names, per_topic=True, gains=gains)


def one_topic_sql(qid: str) -> str:
    sql = O.eval_union(O.OFFICIAL, per_topic=True)
    return sql.replace("from events where event_id % 5 <> 0", f"from events where event_id % 5 <> 0 and user_id = {qid}")


def group_set_sql() -> str:
    return O.eval_union(["num_q", "num_ret", "num_rel", "num_rel_ret", "set_P", "set_recall", "set_relative_P", "set_map", "set_F",
                         "utility"], per_topic=True)


def leaderboard_sql() -> str:
    best = O.measure_query("map")
    return f"""with m as (select run_id, round(value, 4) as map from ({best}) where qid = 'all'),
a as (select * from m union all select 'runD', map from m where run_id = 'runB')
select dense_rank() over (order by map desc) as place, run_id, map from a"""


def params_sql() -> str:
    """The default measures' SQL with other numbers in it."""
    n = 50_000
    f = O.measure_query("set_F").replace(
        "2.0 * (rr / ret) * (rr / num_rel) / ((rr / ret) + (rr / num_rel))", "4.0 * (rr / ret) * (rr / num_rel) / (3.0 * (rr / ret) + (rr / num_rel))")
    u = O.measure_query("utility").replace(
        "1.0 * rr - 1.0 * (ret - rr)", f"2.0 * rr - 1.0 * (ret - rr) + 0.5 * (num_rel - rr) - 0.25 * ({n} + rr - ret - num_rel)")
    half = lambda sql: sql.replace("pow(0.9,", "pow(0.5,").replace("0.1 *", "0.5 *")
    parts = {"utility": (u, "utility_2,-1,0.5,-0.25"), "set_F": (f, "set_F_3"), "rbp": (half(O.measure_query("rbp")), "rbp_p=0.5"),
             "rbp_resid": (half(O.measure_query("rbp_resid")), "rbp_resid_p=0.5")}
    return " union all ".join(f"select * from ({sql.replace(repr(k), repr(name))})" for k, (sql, name) in parts.items())
