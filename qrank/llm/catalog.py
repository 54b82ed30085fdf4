"""Registered queries of the package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, licences, lines, packing, records, resample, rules, simhash, spelling, trie, vafile
from .common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Distinct sites from which a line counts as boilerplate.
MIN_SITES = 4


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The tools that calls derived from ``conversations`` use: (name, field, type, required, low, high).
TOOLS = [("search", "query", "string", True, 1.0, None), ("search", "limit", "integer", True, 1.0, 40.0),
         ("lookup", "key", "string", True, 1.0, 24.0), ("lookup", "exact", "boolean", False, None, None),
         ("summarise", "text", "string", True, 1.0, None), ("summarise", "ratio", "number", True, 0.0, 1.0)]


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from whole conversations.

    A user turn is a call whose arguments hold its text, an assistant turn is
    the result for the turn before it; a call refers to the call two turns
    earlier.  Key order, missing fields, wrong types, cut JSON and unknown
    tools follow from the text, so every check has work on any table.
    """
    ident = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    text = F.coalesce("text", F.lit(""))
    n = F.length(F.col("text"))
    users = (conversations.where("role = 'user'").withColumn("text", text)
             .withColumn("_s", chat.quoted(F.col("text"))))
    pick = F.pmod(n, F.lit(4))
    name = F.when(pick == 0, "search").when(pick == 1, "lookup").when(pick == 2, "summarise").otherwise(
        F.when(F.pmod(n, F.lit(3)) == 0, "teleport").otherwise("search"))
    body = F.when(name == "lookup", F.concat(F.lit('{ "key": "k'), n.cast("string"), F.lit('", "exact": '),
                                             F.when(F.pmod(n, F.lit(5)) == 0, '"yes"').otherwise("true"), F.lit("}"))) \
        .when(name == "summarise", F.concat(F.lit('{"text": '), F.col("_s"), F.when(F.pmod(n, F.lit(3)) == 0, "").otherwise(
            F.concat(F.lit(', "ratio" : '), F.when(F.pmod(n, F.lit(7)) == 0, "2").otherwise("0.5"))), F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"query":'), F.col("_s"), F.lit(', "limit": '), F.pmod(n, F.lit(50)).cast("string"), F.lit("}")))
    calls = users.select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), ident(F.col("turn") - 2).alias("parent_id"),
                         name.alias("name"), body.alias("_b"), n.alias("_n"))
    calls = calls.withColumn("arguments", F.when(F.pmod("_n", F.lit(13)) == 0, F.expr("substring(_b, 1, length(_b) - 1)"))
                             .otherwise(F.col("_b"))).drop("_b", "_n")
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """The turns that :func:`conversation_calls` leaves: every role but user and assistant, null too."""
    return conversations.where("role is null or role not in ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.col("text").alias("content"))


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    calls, results = conversation_calls(conversations)
    tools = spark.createDataFrame(TOOLS, "name string, field string, type string, required boolean, low double, high double")
    out = chat.format_chat(calls, results, tools, conversation_messages(conversations), whole=True)
    return out.select("conv_id", "position", "kind", "call_id", F.col("turn").cast("long").alias("turn"), "depth", "status",
                      "errors", F.md5(F.col("record").cast("binary")).alias("record_md5"))


ORACLES["op1_chat_formatting"] = """
WITH RECURSIVE u AS (
  SELECT DISTINCT conv_id, turn, coalesce(text, '') AS text, length(coalesce(text, '')) AS n
  FROM conversations WHERE role = 'user'),
named AS (
  SELECT *, CASE n % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' WHEN 2 THEN 'summarise'
            ELSE CASE WHEN n % 3 = 0 THEN 'teleport' ELSE 'search' END END AS name FROM u),
calls AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, name, n,
    n % 13 = 0 AS broken,
    CASE WHEN name = 'lookup' THEN '{"exact":' || CASE WHEN n % 5 = 0 THEN '"yes"' ELSE 'true' END || ',"key":"k' || n || '"}'
         WHEN name = 'summarise' THEN '{' || CASE WHEN n % 3 = 0 THEN '' WHEN n % 7 = 0 THEN '"ratio":2,' ELSE '"ratio":0.5,' END
              || '"text":' || CAST(to_json(text) AS VARCHAR) || '}'
         ELSE '{"limit":' || (n % 50) || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}' END AS args,
    CASE WHEN n % 13 = 0 THEN 'json' WHEN name = 'teleport' THEN 'tool'
         WHEN name = 'lookup' THEN concat_ws(',', CASE WHEN n >= 10000000000000000000000000 THEN 'range:key' END,
              CASE WHEN n % 5 = 0 THEN 'type:exact' END)
         WHEN name = 'summarise' THEN concat_ws(',', CASE WHEN n % 3 = 0 THEN 'missing:ratio' END,
              CASE WHEN n % 3 <> 0 AND n % 7 = 0 THEN 'range:ratio' END, CASE WHEN n = 0 THEN 'range:text' END)
         ELSE concat_ws(',', CASE WHEN n % 50 NOT BETWEEN 1 AND 40 THEN 'range:limit' END, CASE WHEN n = 0 THEN 'range:query' END)
    END AS errors
  FROM named),
depth AS (
  SELECT conv_id, turn, 0 AS depth FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, d.depth + 1 FROM depth d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
results AS (
  SELECT DISTINCT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
rows AS (
  SELECT c.conv_id, 'call' AS kind, c.call_id, c.turn, d.depth, CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    c.errors, '{"arguments":' || CASE WHEN broken THEN 'null' ELSE args END || ',"id":' || CAST(to_json(c.call_id) AS VARCHAR)
      || ',"name":"' || name || '","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || ',"type":"call","valid":'
      || CASE WHEN c.errors = '' THEN 'true' ELSE 'false' END || '}' AS record
  FROM calls c JOIN depth d USING (conv_id, turn) LEFT JOIN results r ON r.conv_id = c.conv_id AND r.call_id = c.call_id
  UNION ALL
  SELECT r.conv_id, 'result', r.call_id, r.turn, coalesce(d.depth, 0), CASE WHEN c.call_id IS NULL THEN 'no_call' ELSE 'linked' END, '',
    '{"content":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || ',"id":' || CAST(to_json(r.call_id) AS VARCHAR) || ',"type":"result"}'
  FROM results r LEFT JOIN calls c ON r.conv_id = c.conv_id AND r.call_id = c.call_id
  LEFT JOIN depth d ON d.conv_id = c.conv_id AND d.turn = c.turn
  UNION ALL
  SELECT DISTINCT conv_id, 'message', CAST(NULL AS VARCHAR), turn, 0, CASE WHEN conv_id IS NULL THEN 'no_id' ELSE 'message' END, '',
    '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null')
      || ',"type":"message"}'
  FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY depth, turn, kind, call_id, record) - 1 AS position,
       kind, call_id, CAST(turn AS BIGINT) AS turn, CAST(depth AS BIGINT) AS depth, status, errors, md5(record) AS record_md5
FROM rows
"""


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, budget=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"), MIN_SITES, counts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"),
                      F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLES["op3_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(str_split(text, chr(10))) AS line,
         generate_subscripts(str_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
spread AS (
  SELECT line, min(doc_id) AS first_id FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.line, l.pos, s.line IS NOT NULL
         AND NOT (l.doc_id = s.first_id AND row_number() OVER (PARTITION BY l.doc_id, l.line ORDER BY l.pos) = 1) AS gone
  FROM lines l LEFT JOIN spread s USING (line)),
cut AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN length(kept) END AS kept_chars,
       CASE WHEN d.text IS NOT NULL THEN md5(kept) END AS kept_md5
FROM documents d LEFT JOIN cut USING (doc_id)
"""


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), f"{path}/data", tokenizer_file(), end_id=0)
    index = records.build_index(spark, f"{path}/data", f"{path}/index")
    return records.with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "log_weight", "gumbel_key", "kept")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_k1", "_k2")


ORACLES["op7_decontamination"] = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
        FROM iw WHERE len(w) > 0)),
starts AS (
  SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
found AS (SELECT doc_id, s, m, item_id FROM starts JOIN win USING (m, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=1)


@query
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.to_json("spans"))


@query
def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


ORACLES["op11_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""

#: Entry n of the byte table of crc32, for SQL that computes it.
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = f"""
WITH tab AS ({CRC_TABLE}),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(list_transform(str_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
         lambda r, b: xor(r >> 8, t[xor(r & 255, b) + 1]), 4294967295), 4294967295) % 9 AS h
  FROM ids, tab),
placed AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT heads.c, 0 AS part, i, r, x FROM heads JOIN placed p ON p.c = heads.base AND i <= h
  UNION ALL
  SELECT heads.c, 1, i, r, x FROM heads JOIN placed p ON p.c = heads.c AND i > h),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, md5(CAST(to_json([r, x]) AS VARCHAR)) AS turn, strlen(x) AS bytes
  FROM rebuilt),
member AS (
  SELECT c, d, md5(string_agg(turn, ',') OVER (PARTITION BY c ORDER BY d)) AS k, bytes FROM turns
  UNION ALL
  SELECT c, 0, '', 0 FROM ids),
node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM member GROUP BY d, k),
up AS (SELECT DISTINCT m.d, m.k, p.k AS pk FROM member m JOIN member p ON p.c = m.c AND p.d = m.d - 1),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM up GROUP BY ALL),
below AS (SELECT DISTINCT a.d, a.k, b.d AS bd, b.k AS bk FROM member a JOIN member b ON a.c = b.c AND b.d >= a.d),
totals AS (
  SELECT below.d, below.k, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM below JOIN node ON node.d = bd AND node.k = bk LEFT JOIN kids ON kids.d = bd AND kids.k = bk GROUP BY ALL),
ends AS (
  SELECT d, k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, max(d) AS d, arg_max(k, d) AS k FROM member GROUP BY c) GROUP BY d, k)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node n JOIN totals USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN ends USING (d, k)
LEFT JOIN up USING (d, k) LEFT JOIN node p ON p.d = n.d - 1 AND p.k = up.pk
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE tab AS ({CRC_TABLE}),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(CAST(length(hx) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)),
         lambda r, b: xor(r >> 8, t[xor(r & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM counted, tab),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, v.word, v.n FROM cut a JOIN vocabulary v ON a.rest = v.word
  UNION
  SELECT v.word, a.word, a.n FROM cut a JOIN vocabulary v ON a.rest = v.word),
ranked AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND place = 1),
chain AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL
  SELECT f.word, c.root FROM chain c JOIN formed f ON f.form = c.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
