"""DuckDB oracle SQL for tokenizing, indexing and searching.

Uses the same token pattern and stop set as the Spark analyzer (standard
tokenizer + lowercase + stop; no stemming, which DuckDB cannot do offline).
"""

from __future__ import annotations

from . import oracle_sources as SRC
from .oracle import FIXTURE_CTES
from .oracle_sources import QUERY_SPECIAL
from .porter_sql import folded, stem_ctes

# Restated here, not imported from the code under test.
STANDARD_RE = r"[\p{L}\p{N}]+(?:['’.][\p{L}\p{N}]+)*"
STOP_WORDS = ("a an and are as at be but by for if in into is it no not of on or such that the their "
              "then there these they this to was will with").split()
DOC_FIELDS = ("headline", "date", "text")
TUNED_WEIGHTS = {"title": {"headline": 0.1, "date": 0.2, "text": 0.9}, "desc": {"headline": 0.2, "date": 0.0, "text": 0.7},
                 "narr": {"headline": 0.2, "date": 0.8, "text": 0.7}, "date": {"headline": 0.2, "date": 1.0, "text": 0.2}}
TUNED_BOOSTS = {"title": 1.0, "desc": 0.4, "narr": 0.2, "noDate": 0.0, "date": 2.0}
UNIFORM_WEIGHTS = {s: {f: 1.0 for f in DOC_FIELDS} for s in TUNED_WEIGHTS}
UNIFORM_BOOSTS = {s: 1.0 for s in TUNED_BOOSTS}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(_lit(w) for w in STOP_WORDS) + "]"


CLASSIC_RE = (r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}.-]+\.[\p{L}]+|(?:\p{L}\.){2,}"
              r"|[\p{L}\p{N}]+(?:[-.&'’][\p{L}\p{N}]+)*")
WIKI_RE = r"\[\[|\]\]|\{\{|\}\}|''+"


def tokens_sql(text: str, tokenizer: str | None = None) -> str:
    """Token list of a text: standard tokenizer, lowercase, stop; or a named tokenizer alone."""
    t = f"coalesce({text}, '')"
    if tokenizer == "whitespace":
        return f"list_filter(regexp_split_to_array({t}, '\\s+'), lambda t: t <> '')"
    if tokenizer == "wikipedia":
        t = f"regexp_replace({t}, {_lit(WIKI_RE)}, ' ', 'g')"
    if tokenizer:
        return f"regexp_extract_all({t}, {_lit(CLASSIC_RE if tokenizer == 'classic' else STANDARD_RE)}, 0)"
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({text}, ''), {_lit(STANDARD_RE)}, 0), "
            f"lambda t: lower(t)), lambda t: not list_contains({STOP_LIST}, t))")


def sanitize_sql(text: str) -> str:
    s = f"regexp_replace(coalesce({text}, ''), '[\\n\\t]', ' ', 'g')"
    s = f"regexp_replace({s}, {_lit(QUERY_SPECIAL)}, '', 'g')"
    return f"replace({s}, ':', ' ')"


def index_ctes(tokenizer: str | None = None) -> list[tuple[str, str]]:
    fields = " union all ".join(f"select docno, '{f}' as field, {f} as txt from corpus" for f in DOC_FIELDS)
    return [
        ("corpus", FIXTURE_CTES["corpus"]),
        ("ftxt", fields),
        ("tk", f"select docno, field, {tokens_sql('txt', tokenizer)} as toks from ftxt"),
        ("tok1", "select docno, field, len(toks) as dl, unnest(toks) as term from tk where len(toks) > 0"),
        ("post", "select field, term, docno, count(*) as tf, any_value(dl) as dl from tok1 group by field, term, docno"),
        ("dict", "select field, term, count(*) as df, sum(tf) as cf from post group by field, term"),
        ("fs", "select field, count(*) as N, sum(dl) as sum_dl, sum(dl) / count(*) as avgdl "
               "from (select distinct field, docno, dl from post) group by field"),
    ]


def stemmed(index: list[tuple[str, str]], queries: list[tuple[str, str]], tokens: str = "stok", out: str = "folded",
            keys: str = "qid, section, has_date") -> list[tuple[str, str]]:
    """Index and query CTEs whose terms are stemmed and folded; query tokens come from the CTE
    ``tokens`` and take their ``out`` form."""
    at = [n for n, _ in index].index("tok1")
    mine = [(("raw_" + n) if n == tokens else n, q) for n, q in queries]
    cut = [n for n, _ in mine].index("raw_" + tokens) + 1
    return (index[:at] + [("raw_tok1", index[at][1])] + mine[:cut]
            + [("all_terms", f"select term from raw_tok1 union select term from raw_{tokens}")] + stem_ctes("all_terms")
            + [("tok1", "select docno, field, dl, folded as term from raw_tok1 join ps using (term)"),
               (tokens, f"select {keys}, {out} as term from raw_{tokens} join ps using (term)")]
            + index[at + 1:] + mine[cut:])


def _with(ctes: list[tuple[str, str]]) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes) + "\n"


def postings_sql(tokenizer: str | None = None) -> str:
    return _with(index_ctes(tokenizer)) + "select field, term, docno, cast(tf as bigint) as tf, cast(dl as bigint) as dl from post"


def dictionary_sql() -> str:
    return _with(index_ctes()) + "select field, term, cast(df as bigint) as df, cast(cf as bigint) as cf from dict"


def field_stats_sql() -> str:
    return _with(index_ctes()) + ("select field, cast(N as bigint) as N, cast(sum_dl as bigint) as sum_dl, "
                                  "round(avgdl, 6) as avgdl from fs")


SIMS = {
    "bm25": "ln(1 + (N - df + 0.5) / (df + 0.5)) * tf / (tf + {k1} * (1 - {b} + {b} * dl / avgdl))",
    "tfidf": "sqrt(tf) * (1 + ln((N + 1.0) / (df + 1.0))) / sqrt(dl)",
    "lmd": "greatest(ln(1 + tf / ({mu} * ((cf + 1.0) / (sum_dl + 1.0)))) + ln({mu} / (dl + {mu})), 0)",
    "lmj": "ln(1 + ((1 - {lam}) * tf / dl) / ({lam} * ((cf + 1.0) / (sum_dl + 1.0))))",
}


def flat_queries_cte() -> tuple[str, str]:
    """Benchmark items as single-text queries searched in all fields."""
    fields = "[" + ", ".join(_lit(f) for f in DOC_FIELDS) + "]"
    return ("qt", f"""select qid, field, term, count(*) * 1.0 as weight from (
  select cast(401 + item_id as string) as qid, unnest({tokens_sql(sanitize_sql('text'))}) as term from benchmark)
  cross join (select unnest({fields}) as field) group by qid, field, term""")


def sectioned_queries_cte(weights=TUNED_WEIGHTS, boosts=TUNED_BOOSTS, tokenizer: str | None = None) -> list[tuple[str, str]]:
    wrows = " union all ".join(f"select '{s}' as section, '{f}' as field, {w} as w"
                               for s, fw in weights.items() for f, w in fw.items())
    # Topic date section: years found in the date text, a decade expanding to ten years.
    found = "regexp_extract_all(coalesce(date_text, ''), '(?i)\\b(?:1[789]|20)\\d\\d(?:s?)\\b', 0)"
    years = (f"flatten(list_transform({found}, lambda m: case when lower(m) like '%s' then "
             "list_transform(range(cast(left(m, 4) as int), cast(left(m, 4) as int) + 10), lambda y: cast(y as varchar)) "
             "else [m] end))")
    dates = f"case when len({years}) = 0 then 'null' else array_to_string({years}, ', ') end"
    secs = " union all ".join([
        "select qid, 'title' as section, title as txt, has_date from tp",
        "select qid, 'desc' as section, desc_text as txt, has_date from tp",
        "select qid, 'narr' as section, narr as txt, has_date from tp",
        "select qid, 'date' as section, date as txt, has_date from tp"])
    boost = (f"case when s.section = 'date' and not s.has_date then {boosts['noDate']} "
             + " ".join(f"when s.section = '{k}' then {v}" for k, v in boosts.items() if k != "noDate") + " end")
    return [
        ("topics", FIXTURE_CTES["topics"]),
        ("tp", f"select *, {dates} as date, ({dates}) <> 'null' as has_date from topics"),
        ("secs", secs),
        ("stok", f"select qid, section, has_date, unnest({tokens_sql(sanitize_sql('txt'), tokenizer)}) as term from secs"),
        ("wts", wrows),
        ("qt", f"""select qid, field, term, sum(w.w * ({boost})) as weight from stok s join wts w on s.section = w.section
  where w.w * ({boost}) <> 0 group by qid, field, term"""),
    ]


def search_sql(sim: str, params: dict, sectioned: bool = False, k: int = 1000, run_id: str = "run",
               ctes: list[tuple[str, str]] | None = None) -> str:
    ctes = ctes or index_ctes() + (sectioned_queries_cte() if sectioned else [flat_queries_cte()])
    expr = SIMS[sim].format(**params)
    ctes += [
        ("sc", f"""select qid, docno, sum(weight * ({expr})) as score
  from post join qt using (field, term) join dict using (field, term) join fs using (field)
  group by qid, docno"""),
        ("rk", """select qid, docno, round(score, 6) as score from sc where score > 0"""),
        ("tk2", "select qid, docno, score, row_number() over (partition by qid order by score desc, docno asc) as rank from rk"),
    ]
    return _with(ctes) + (f"select '{run_id}' as run_id, qid, docno, cast(rank as bigint) as rank, score as sim "
                          f"from tk2 where rank <= {k}")


def _map_sql(run: str, qrels: str) -> list[tuple[str, str]]:
    """AP per (run_id, qid) and MAP per run for a run CTE and a qrels CTE."""
    return [
        ("jr", f"""select r.run_id, r.qid, r.docno, coalesce(q.rel, -1) as rel,
  row_number() over (partition by r.run_id, r.qid order by r.sim desc, r.docno desc) as rank
  from {run} r left join {qrels} q on r.qid = q.qid and r.docno = q.docno where r.qid in (select qid from {qrels})"""),
        ("jk", "select *, sum(case when rel >= 1 then 1 else 0 end) over (partition by run_id, qid order by rank rows between unbounded preceding and current row) as k from jr"),
        ("nr", f"select qid, count(*) filter (where rel >= 1) as num_rel from {qrels} group by qid"),
        ("ap", """select jk.run_id, jk.qid, case when any_value(nr.num_rel) > 0 then coalesce(sum(case when rel >= 1 then k / rank end), 0) / any_value(nr.num_rel) else 0 end as ap
  from jk join nr on jk.qid = nr.qid group by jk.run_id, jk.qid"""),
        ("mp", f"select run_id, sum(ap) / (select count(distinct qid) from {qrels}) as map from ap group by run_id"),
    ]


def passage_qrels_cte() -> tuple[str, str]:
    from .oracle import PASSAGE_QRELS
    return ("pq", PASSAGE_QRELS)


SIM_CASE = ("case cfg_kind when 'bm25' then ln(1 + (N - df + 0.5) / (df + 0.5)) * tf / (tf + p1 * (1 - p2 + p2 * dl / avgdl)) "
            "when 'tfidf' then sqrt(tf) * (1 + ln((N + 1.0) / (df + 1.0))) / sqrt(dl) "
            "when 'lmd' then greatest(ln(1 + tf / (p1 * ((cf + 1.0) / (sum_dl + 1.0)))) + ln(p1 / (dl + p1)), 0) "
            "when 'lmj' then ln(1 + ((1 - p1) * tf / dl) / (p1 * ((cf + 1.0) / (sum_dl + 1.0)))) end")


def _topk(src: str, keys: str = "run_id, qid", k: int = 1000) -> list[tuple[str, str]]:
    return [("rk", f"select {keys}, docno, round(score, 6) as sim from {src} where score > 0"),
            ("runs_t", f"select * from (select *, row_number() over (partition by {keys} order by sim desc, docno desc) as rn from rk) where rn <= {k}")]


def sweep_similarity_sql() -> str:
    label = {"bm25": "bm25_k1={:g}_b={:g}", "tfidf": "tfidf", "lmd": "lmd_mu={:g}", "lmj": "lmj_lambda={:g}"}
    vals = ", ".join(f"('{label[kind].format(a, b)}', '{kind}', {a}, {b})" for kind, a, b in similarity_grid())
    ctes = index_ctes() + sectioned_queries_cte() + [
        ("cfg", f"select * from (values {vals}) t(run_id, cfg_kind, p1, p2)"),
        ("m", "select * from post join qt using (field, term) join dict using (field, term) join fs using (field)"),
        ("sc", f"select c.run_id, m.qid, m.docno, sum(m.weight * ({SIM_CASE})) as score from m cross join cfg c group by c.run_id, m.qid, m.docno"),
    ] + _topk("sc") + [passage_qrels_cte()] + _map_sql("runs_t", "pq")
    return _with(ctes) + "select c.run_id, round(coalesce(map, 0), 6) as map from cfg c left join mp using (run_id)"


def _partials(weights_uniform: bool = True) -> list[tuple[str, str]]:
    sq = sectioned_queries_cte(UNIFORM_WEIGHTS, UNIFORM_BOOSTS)
    # keep the section in the query table
    sq[-1] = ("qt", """select qid, s.section, field, term, sum(w.w) as weight from stok s join wts w on s.section = w.section
  group by qid, s.section, field, term""")
    bm = "ln(1 + (N - df + 0.5) / (df + 0.5)) * tf / (tf + 0.6 * (1 - 0.7 + 0.7 * dl / avgdl))"
    return index_ctes() + sq + [
        ("parts", f"""select qid, docno, section, field, sum(weight * ({bm})) as s
  from post join qt using (field, term) join dict using (field, term) join fs using (field) group by qid, docno, section, field"""),
    ]


def sweep_weights_sql() -> str:
    configs = weight_grid()
    vals = ", ".join(f"('{c['h']}-{c['d']}-{c['t']}', {c['h']}, {c['d']}, {c['t']})" for c in configs)
    ctes = _partials() + [
        ("wide", """select section, qid, docno, sum(case when field = 'headline' then s else 0 end) as s_headline,
  sum(case when field = 'date' then s else 0 end) as s_date, sum(case when field = 'text' then s else 0 end) as s_text
  from parts group by section, qid, docno"""),
        ("cfg", f"select * from (values {vals}) t(name, h, d, t)"),
        ("sc", "select section || '/' || c.name as run_id, qid, docno, c.h * s_headline + c.d * s_date + c.t * s_text as score from wide cross join cfg c"),
    ] + _topk("sc") + [passage_qrels_cte()] + _map_sql("runs_t", "pq")
    return _with(ctes) + """select section, section || '/' || c.name as run_id, round(coalesce(map, 0), 6) as map
  from cfg c cross join (select unnest(['title', 'desc', 'narr', 'date']) as section)
  left join mp on mp.run_id = section || '/' || c.name"""


def sweep_boosts_sql() -> str:
    configs = boost_grid()
    vals = ", ".join(f"('{c['ti']}-{c['de']}-{c['na']}-{c['da']}', {c['ti']}, {c['de']}, {c['na']}, {c['da']})" for c in configs)
    wcase = "case " + " ".join(f"when section = '{s}' and field = '{f}' then {w}" for s, fw in TUNED_WEIGHTS.items()
                               for f, w in fw.items()) + " else 0 end"
    ctes = _partials() + [
        ("sec", "select qid, docno, " + ", ".join(
            f"sum(case when section = '{s}' then ({wcase}) * s else 0 end) as s_{s}" for s in ("title", "desc", "narr", "date"))
         + " from parts group by qid, docno"),
        ("cfg", f"select * from (values {vals}) t(name, ti, de, na, da)"),
        ("sc", f"""select c.name as run_id, sec.qid, docno, c.ti * s_title + c.de * s_desc + c.na * s_narr
  + (case when tp.has_date then c.da else {TUNED_BOOSTS['noDate']} end) * s_date as score
  from sec join tp on sec.qid = tp.qid cross join cfg c"""),
    ] + _topk("sc") + [passage_qrels_cte()] + _map_sql("runs_t", "pq")
    return _with(ctes) + "select c.name as run_id, round(coalesce(map, 0), 6) as map from cfg c left join mp on mp.run_id = c.name"


def _grid(first: float, last: float, step: float) -> list[float]:
    n = round((last - first) / step) + 1
    return [round(first + i * step, 1) for i in range(n)]


def weight_grid() -> list[dict]:
    g = _grid(0, 1, 0.1)
    return [{"h": h, "d": d, "t": t} for h in g for d in g for t in g]


def boost_grid() -> list[dict]:
    g = _grid(0, 1, 0.2)
    return [{"ti": a, "de": b, "na": c, "da": d} for a in g for b in g for c in g for d in g]


def similarity_grid() -> list[tuple]:
    """(kind, p1, p2) of the 120 settings."""
    return ([("tfidf", 0.0, 0.0)] + [("bm25", k, b) for k in _grid(0.2, 2.0, 0.2) for b in _grid(0.1, 1.0, 0.1)]
            + [("lmd", m, 0.0) for m in _grid(100, 1000, 100)] + [("lmj", x, 0.0) for x in _grid(0.1, 0.9, 0.1)])


def run_lines_sql() -> str:
    return (f"select qid, rank, concat_ws(' ', qid, 'Q0', trim(docno), cast(rank as varchar), printf('%.6f', sim), run_id) as value "
            f"from ({search_sql('bm25', {'k1': 0.6, 'b': 0.7}, sectioned=True, run_id='mf')})")


def sweep_tokenizers_sql() -> str:
    """MAP of the tuned search per tokenizer (no filters), over all judged topics."""
    bm = SIMS["bm25"].format(k1=0.6, b=0.7)
    parts = []
    for t in ("standard", "whitespace", "classic", "wikipedia"):
        ctes = index_ctes(t) + sectioned_queries_cte(tokenizer=t) + [
            ("sc", f"""select qid, docno, round(sum(weight * ({bm})), 6) as sim, sum(weight * ({bm})) as raw
  from post join qt using (field, term) join dict using (field, term) join fs using (field) group by qid, docno"""),
            ("runs_t", f"""select '{t}' as run_id, qid, docno, sim from (select *, row_number() over
  (partition by qid order by sim desc, docno asc) as rn from sc where raw > 0) where rn <= 1000"""),
            passage_qrels_cte()] + _map_sql("runs_t", "pq")
        parts.append(f"select '{t}' as run_id, round(coalesce((select map from ({_with(ctes)} select map from mp)), 0), 6) as map")
    return "\nunion all ".join(parts)


def match_all_sql() -> str:
    """Default search of the readable lines; the first 1,000 documents for each of the others."""
    found = search_sql("bm25", {"k1": 1.2, "b": 0.75}, run_id="all")
    broken = "(item_id % 7 = 3 or item_id % 11 = 5)"
    clean = f"(select item_id, regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') as text from benchmark where not {broken})"
    found = found.replace("from benchmark)\n  cross join", f"from {clean})\n  cross join")
    return f"""select * from ({found}) union all
select 'all', cast(401 + item_id as varchar), docno, rank, 1.0 from benchmark, (
  select docno, row_number() over (order by docno) as rank from ({FIXTURE_CTES['corpus']}) qualify rank <= 1000) where {broken}"""


# ------------------------------------------------- stemmed and folded searches

TUNED = {"k1": 0.6, "b": 0.7}


def search_stemmed_sql(run_id: str = "stem") -> str:
    return search_sql("bm25", TUNED, run_id=run_id, ctes=stemmed(index_ctes(), sectioned_queries_cte()))


def search_expanded_sql() -> str:
    """Numbered lines over every field, stemmed but not folded, against the folded index."""
    fields = "[" + ", ".join(_lit(f) for f in DOC_FIELDS) + "]"
    queries = [("lines", SRC.numbered_queries_sql()),
               ("stok", f"select qid, unnest({tokens_sql(sanitize_sql('text'))}) as term from lines"),
               ("qt", f"select qid, field, term, count(*) * 1.0 as weight from stok cross join (select unnest({fields}) as field) group by qid, field, term")]
    return search_sql("bm25", {"k1": 1.2, "b": 0.75}, run_id="expanded",
                      ctes=stemmed(index_ctes(), queries, out="stem", keys="qid"))


def search_synonyms_sql() -> str:
    """Topics parsed from blocks whose words are followed by their synonyms."""
    parsed = SRC.topics_of_blocks(f"(select regexp_extract(raw, '<top>\\s([\\s\\S]*?)</top>', 1) as raw from ({SRC.synonym_expand_sql()}))")
    q = sectioned_queries_cte()
    names = [n for n, _ in q]
    queries = [("tp", f'select qid, title, "desc" as desc_text, narr, date, date <> \'null\' as has_date from ({parsed})')] + q[names.index("secs"):]
    return search_sql("bm25", TUNED, run_id="synonyms", ctes=stemmed(index_ctes(), queries))


def flagship_sql() -> str:
    """MAP, nDCG and P@10 of the stemmed search, per topic and on average."""
    ctes = [("run", f"select run_id, qid, docno, sim from ({search_stemmed_sql('bm25_tuned')})"), passage_qrels_cte()] + _map_sql("run", "pq") + [
        ("gains", """select run_id, qid, coalesce(sum(case when rel > 0 then rel / log2(rank + 1) end), 0) as dcg,
  count(*) filter (where rel >= 1 and rank <= 10) / 10.0 as p10 from jr group by run_id, qid"""),
        ("best", """select qid, sum(rel / log2(pos + 1)) as ideal from (
  select qid, rel, row_number() over (partition by qid order by rel desc, docno) as pos from pq where rel > 0) group by qid"""),
        ("per", """select run_id, qid, ap as map, case when ideal > 0 then dcg / ideal else 0 end as ndcg, p10 as P_10
  from ap join gains using (run_id, qid) left join best using (qid)""")]
    return _with(ctes) + """select run_id, qid, round(map, 6) as map, round(ndcg, 6) as ndcg, round(P_10, 6) as P_10 from per
union all select run_id, 'all', round(avg(map), 6), round(avg(ndcg), 6), round(avg(P_10), 6) from per group by run_id"""


#: Filters of the sweep in chain order; bit j of a subset's number stands for filter j.
SWEEP_FILTERS = ("lowercase", "stop", "porterstem", "apostrophe", "elision", "asciifolding")
PREFIXES = ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu")


def sweep_filters_sql() -> str:
    """MAP of the tuned search for all 64 filter subsets on the standard tokenizer."""
    names = [(i, "-".join(f for j, f in enumerate(SWEEP_FILTERS) if i >> j & 1) or "none") for i in range(64)]
    cfg = ", ".join(f"({i}, '{n}')" for i, n in names)
    on = lambda j: f"(sid >> {j}) & 1 = 1"
    term = f"case when {on(2)} then case when {on(0)} then stem_low else stem_raw end when {on(0)} then low else raw end"
    term = f"case when {on(3)} then regexp_replace({term}, '[''’].*$', '') else {term} end"
    inner = f"select sid, raw, low, {term} as t from forms, cfg where not ({on(1)} and list_contains({STOP_LIST}, case when {on(0)} then low else raw end))"
    elided = f"case when {on(4)} then regexp_replace(t, '^(?i)({'|'.join(PREFIXES)})[''’]', '') else t end"
    q = sectioned_queries_cte(tokenizer="standard")
    cut = [n for n, _ in q].index("wts")
    bm = SIMS["bm25"].format(**TUNED)
    wanted_q = q[-1][1].replace("from stok s", "from (select qid, section, has_date, sid, m.t as term from stok join maps m on m.raw = stok.term) s")
    wanted_q = wanted_q.replace("select qid, field, term,", "select sid, qid, field, term,").replace("group by qid, field, term", "group by sid, qid, field, term")
    kept = f"case when not ({on(1)}) then true when {on(0)} then not list_contains({STOP_LIST}, lower(raw)) else not list_contains({STOP_LIST}, raw) end"
    ctes = index_ctes("standard")[:4] + q[:cut] + [
        ("cfg", f"select * from (values {cfg}) t(sid, run_id)"),
        ("rawp", "select field, docno, term as raw, count(*) as tf from tok1 group by field, docno, term"),
        ("voc", "select distinct raw from (select raw from rawp union select term from stok)"),
        ("vw", "select raw as term from voc union select lower(raw) from voc"), *stem_ctes("vw"),
        ("forms", """select raw, lower(raw) as low, a.stem as stem_raw, b.stem as stem_low from voc
  join ps a on a.term = raw join ps b on b.term = lower(raw)"""),
        ("maps", f"select sid, raw, case when {on(5)} then {folded('x')} else x end as t from (select sid, raw, {elided} as x from ({inner}))"),
        q[cut], ("qt", wanted_q),
        ("need", "select distinct sid, term from qt"),
        ("post", """select m.sid, field, docno, m.t as term, sum(tf) as tf from maps m join need n on n.sid = m.sid and n.term = m.t
  join rawp using (raw) group by m.sid, field, docno, m.t"""),
        ("lens", f"select sid, field, docno, sum(case when {kept} then tf else 0 end) as dl from rawp, cfg group by sid, field, docno having dl > 0"),
        ("fs", "select sid, field, count(*) as N, sum(dl) as sum_dl, sum(dl) / count(*) as avgdl from lens group by sid, field"),
        ("dict", "select sid, field, term, count(*) as df, sum(tf) as cf from post group by sid, field, term"),
        ("sc", f"""select sid, qid, docno, sum(weight * ({bm})) as score from post join qt using (sid, field, term)
  join dict using (sid, field, term) join fs using (sid, field) join lens using (sid, field, docno) group by sid, qid, docno"""),
        ("rk", "select cast(sid as varchar) as run_id, qid, docno, round(score, 6) as sim from sc where score > 0"),
        ("runs_t", "select * from (select *, row_number() over (partition by run_id, qid order by sim desc, docno desc) as rn from rk) where rn <= 1000"),
        passage_qrels_cte()] + _map_sql("runs_t", "pq")
    return _with(ctes) + "select c.run_id, round(coalesce(map, 0), 6) as map from cfg c left join mp on mp.run_id = cast(c.sid as varchar)"


def missing_sections_sql() -> str:
    """The sectioned search over topics that lack some of their sections."""
    queries = sectioned_queries_cte()
    gone = lambda c, m, r: f"case when cast(qid as int) % {m} <> {r} then {c} end as {c}"
    queries[0] = ("topics", f"select qid, {gone('title', 3, 1)}, {gone('desc_text', 6, 1)}, {gone('narr', 2, 1)}, date_text from ({queries[0][1]})")
    return search_sql("bm25", TUNED, run_id="missing", ctes=index_ctes() + queries)
