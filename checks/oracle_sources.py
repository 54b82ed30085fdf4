"""DuckDB oracle SQL for SGML ingest, topic files, query lists and synonyms."""

from __future__ import annotations

from qrank.sources.render import sgml_docs_sql, topic_blocks_sql


# Restated from the format, not imported from the code under test.
QUERY_SPECIAL = r'[+\-!(){}\[\]^"~*?\\/]|&&|\|\|'
YEARS = r"(?i)\b(?:1[789]|20)\d\d(?:s?)\b"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tag(doc: str, tag: str) -> str:
    body = f"regexp_extract({doc}, '<{tag}>([\\s\\S]*?)</{tag}>', 1)"
    clean = (f"replace(regexp_replace(regexp_replace(regexp_replace({body}, '<!--.*?-->', ' ', 'g'), "
             f"'</?P>', '', 'g'), '<.*?F.*?>', ' ', 'g'), chr(10), ' ')")
    return f"(case when regexp_matches({doc}, '<{tag}>[\\s\\S]*?</{tag}>') then {clean} end)"


def _year(date: str) -> str:
    y = f"regexp_extract(coalesce({date}, ''), '\\b1\\d{{3}}\\b', 0)"
    return f"(case when {date} is null then 'null' when {y} = '' then 'null' else {y} end)"


SPLIT = """with rd as ({render}),
files as (select path, string_agg(doc, chr(10) order by doc_id) as value from rd group by path),
lists as (select path, regexp_extract_all(value, '<DOC>\\s([\\s\\S]*?)</DOC>', 1) as docs from files),
raw as (select path, split_part(path, '/', 2) as subfolder, split_part(path, '/', 1) as collection,
               unnest(docs) as raw, unnest(range(len(docs))) as pos from lists),
pj as (select *, case when collection = 'fr94' then regexp_replace(raw, '<!-- PJG[\\s\\S]*?-->', '', 'g') else raw end as d from raw),
parsed as (select trim({docno}) as docno, collection, subfolder, path, pos,
  case collection when 'fr94' then {doctitle} when 'fbis' then {ti} else {headline} end as headline,
  case collection when 'fr94' then concat(coalesce({summary}, ''), coalesce({supplem}, ''), coalesce({text}, '')) else {text} end as text,
  case collection when 'ft' then (case when {date} is null then 'null' else concat('19', substr({date}, 1, 2)) end)
                  when 'fbis' then {year1} else {year} end as date
  from pj)
"""


def _parsed() -> str:
    return SPLIT.format(render=sgml_docs_sql("documents"), docno=_tag("d", "DOCNO"), doctitle=_tag("d", "DOCTITLE"),
                        ti=_tag("d", "TI"), headline=_tag("d", "HEADLINE"), summary=_tag("d", "SUMMARY"),
                        supplem=_tag("d", "SUPPLEM"), text=_tag("d", "TEXT"), date=_tag("d", "DATE"),
                        year1=_year(_tag("d", "DATE1")), year=_year(_tag("d", "DATE")))


def sgml_ingest_sql() -> str:
    return _parsed() + "select docno, collection, subfolder, headline, text, date from parsed"


def sample_sql(kind: str, n: int) -> str:
    ordn = ", row_number() over (partition by collection, subfolder order by path, pos) as ordinal"
    if kind == "every":
        return _parsed() + (f"select docno, collection, subfolder from (select *{ordn} from parsed) "
                            f"where (ordinal - 1) % {n} = 0")
    return _parsed() + (f"select docno, collection, subfolder, cast(ordinal as bigint) as ordinal from "
                        f"(select *{ordn} from parsed) where ordinal <= {n}")


def collection_counts_sql() -> str:
    return _parsed() + "select collection, count(*) as n_docs from parsed group by collection"


def _topic_parts() -> tuple[str, str]:
    """Select lists: a block without syntax characters, and its sections."""
    def sec(tag, nxt):
        pat = f"<{tag}>([\\s\\S]*?)<{nxt}>" if nxt else f"<{tag}>([\\s\\S]*?)$"
        has = f"regexp_matches(b, '{pat}')"
        body = f"regexp_replace(regexp_extract(b, '{pat}', 1), '^\\s*(Number:|Description:|Narrative:)\\s*', '')"
        return f"(case when {has} then {body} end)"
    found = f"regexp_extract_all(b, {_lit(YEARS)}, 0)"
    years = (f"flatten(list_transform({found}, lambda m: case when lower(m) like '%s' then "
             "list_transform(range(cast(left(m, 4) as int), cast(left(m, 4) as int) + 10), lambda y: cast(y as varchar)) "
             "else [m] end))")
    block = f"regexp_replace(regexp_replace(raw, '[\\n\\t]', ' ', 'g'), {_lit(QUERY_SPECIAL)}, '', 'g') as b"
    return block, f"""trim({sec('num', 'title')}) as qid, {sec('title', 'desc')} as title, {sec('desc', 'narr')} as "desc",
  {sec('narr', None)} as narr, case when len({years}) = 0 then 'null' else array_to_string({years}, ', ') end as date"""


def topics_of_blocks(blocks: str) -> str:
    """Topic sections of a table of blocks (column raw)."""
    block, parts = _topic_parts()
    return f"select {parts} from (select {block} from {blocks})"


def _topics() -> str:
    return f"""with tb as ({topic_blocks_sql("benchmark")}),
files as (select file_id, string_agg(block, chr(10) || chr(10) order by item_id) as value from tb group by file_id),
blocks as (select unnest(regexp_extract_all(value, '<top>\\s([\\s\\S]*?)</top>', 1)) as raw from files),
tp as ({topics_of_blocks("blocks")})
"""


def topics_parse_sql() -> str:
    return _topics() + 'select qid, title, "desc", narr, date from tp'


def topic_dates_sql() -> str:
    return _topics() + "select qid, date from tp"


def negation_sql() -> str:
    split = "string_split(regexp_replace(coalesce(narr, ''), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"
    return _topics() + (f"select qid, array_to_string(list_filter({split}, lambda s: not contains(lower(s), 'not relevant')), ' ') "
                        "as narr from tp")


def numbered_queries_sql() -> str:
    return """with lines as (
  select item_id * 2 as line_no, concat(cast(item_id + 1 as varchar), '. ', regexp_replace(text, '\\n', ' ', 'g')) as value from benchmark
  union all select item_id * 2 + 1 as line_no, '   ' as value from benchmark where item_id % 5 = 4),
t as (select line_no, regexp_replace(trim(value), '^\\d+\\.\\s*', '') as text from lines)
select cast(400 + row_number() over (order by line_no) as varchar) as qid, text from t where text <> ''"""


def synonym_expand_sql() -> str:
    sid = " + ".join(f"cast(ascii(substr(w, {i + 1}, 1)) as bigint) * {1000 ** (3 - i)}" for i in range(4))
    return f"""with words as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}', 0)) as w from benchmark),
syn as (select {sid} as sid, ({sid}) * 1000 + length(w) as seq, w as word from words),
mem as (select sid, list(word order by seq, word) as m from syn group by sid),
smap as (select lower(s.word) as wl, list_filter(m.m, lambda x: lower(x) <> lower(s.word)) as syns from syn s join mem m on s.sid = m.sid),
tb as ({topic_blocks_sql("benchmark")}),
toks as (select item_id as block_id, unnest(regexp_split_to_array(block, '\\s+')) as word,
               unnest(range(len(regexp_split_to_array(block, '\\s+')))) as pos from tb),
ex as (select block_id, pos, list_concat([word], coalesce(syns, [])) as ws from toks left join smap on lower(toks.word) = smap.wl)
select block_id, array_to_string(flatten(list(ws order by pos)), ' ') as raw from ex group by block_id"""
