import hashlib
import json

from qrank.llm import chat

TOOLS = [("f", "a", "integer", True, 0.0, 9.0), ("f", "s", "string", False, 1.0, 3.0), ("g", "x", "number", True, None, None),
         ("g", "b", "boolean", False, None, None)]


def tools(spark):
    return spark.createDataFrame(TOOLS, "name string, field string, type string, required boolean, low double, high double")


def calls(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, call_id string, parent_id string, name string, arguments string")


def results(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, call_id string, content string")


def test_arguments_are_checked(spark):
    cases = {'{"a":1}': "", '{"s":"x","a":2}': "", '{"a":"1"}': "type:a", '{"a":1.5}': "type:a", '{"a":10}': "range:a", "{}": "missing:a",
             '{"a":1,"s":"long text"}': "range:s", '{"a":1,"s":""}': "range:s", '{"a":1,"z":[1]}': "unknown:z", '{"a":': "json",
             "[1]": "json", "": "json", '{"a":null}': "type:a", '{"a":-1,"s":5}': "range:a,type:s"}
    rows = [(1, i, f"c{i}", None, "f", a) for i, a in enumerate(cases)] + [(1, 90, "n", None, "f", None), (1, 91, "u", None, "h", '{"a":1}'),
            (1, 92, "g", None, "g", '{"x":1e3,"b":true}'), (1, 93, "v", None, None, '{"a":1}')]
    got = {r.call_id: ",".join(r.errors) for r in chat.validate(calls(spark, rows), tools(spark)).collect()}
    want = {f"c{i}": e for i, e in enumerate(cases.values())} | {"n": "json", "u": "tool", "g": "", "v": "tool"}
    assert got == want


def test_order_links_and_json(spark):
    c = [(1, 5, "d", "b", "f", '{"a": 1}'), (1, 3, "b", "a", "f", '{"s":"é\\"","a":2}'), (1, 1, "a", None, "f", '{"a":3}'),
         (1, 1, "a", None, "f", '{"a":3}'), (1, 7, "a", None, "f", '{"a":4}'), (1, 9, "x", "y", "f", "{}"), (1, 10, "y", "x", "f", "{}"),
         (1, 11, "s", "s", "f", "{}"), (1, 12, "q", "nowhere", "f", "{}"), (2, 1, "a", None, "g", "{}"), (None, 1, "a", None, "f", "{}"),
         (3, 1, None, "a", "f", "{}")]
    r = [(1, 2, "a", "ra"), (1, 4, "b", None), (1, 6, "a", "again"), (1, 8, "lost", "x"), (2, 0, "a", "early"), (None, 1, "a", "n")]
    got = chat.format_chat(calls(spark, c), results(spark, r), tools(spark)).collect()
    assert len(got) == len(set(c)) + len(r)
    one = sorted((x for x in got if x.conv_id == 1), key=lambda x: x.position)
    assert [x.position for x in one] == list(range(len(one)))
    at = {(x.kind, x.call_id, x.status): x for x in one}
    assert at["call", "a", "linked"].depth == 0 and at["call", "b", "linked"].depth == 1 and at["call", "d", "no_result"].depth == 2
    assert at["call", "a", "linked"].position < at["result", "a", "linked"].position < at["call", "b", "linked"].position
    assert at["call", "a", "duplicate"].turn == 7 and at["result", "a", "duplicate"].turn == 6 and ("result", "lost", "no_call") in at
    assert at["call", "x", "no_result"].depth == at["call", "y", "no_result"].depth == chat.CIRCLE
    assert at["call", "s", "no_result"].depth == at["call", "q", "no_result"].depth == 0
    assert {x.status for x in got if x.conv_id is None or x.call_id is None} == {"no_id"}
    for x in got:
        record = json.loads(x.record)
        assert x.record == json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(at["call", "b", "linked"].record) == {"arguments": {"a": 2, "s": 'é"'}, "id": "b", "name": "f", "result": None,
                                                           "type": "call", "valid": True}


def test_long_chain_and_empty_tables(spark):
    n = 300
    c = calls(spark, [(1, 2 * i, f"c{i}", f"c{i - 1}", "f", '{"a":1}') for i in range(n)])
    got = {r.call_id: r.depth for r in chat.depths(c.select("conv_id", "call_id", "parent_id")).collect()}
    assert got == {f"c{i}": i for i in range(n)}
    none = chat.format_chat(calls(spark, []), results(spark, []), tools(spark))
    assert none.count() == 0
    only = chat.format_chat(calls(spark, []), results(spark, [(1, 1, "a", "x")]), tools(spark)).collect()
    assert [(r.status, r.position) for r in only] == [("no_call", 0)]


def test_every_turn_of_a_conversation_has_a_row(spark, tmpdir_path):
    from qrank.llm import catalog
    turns = [(1, 0, "system", 'be "brief"'), (1, 1, "user", "one"), (1, 2, "assistant", "two"), (1, 3, "tool", None),
             (2, 0, None, "x"), (2, 1, "user", "y"), (3, 0, "system", "alone"), (3, 0, "system", "alone"), (None, 0, "system", "z")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = catalog.op1_chat_formatting(spark, tmpdir_path).collect()
    assert sorted((r.conv_id or 0, r.turn) for r in got) == sorted((c or 0, t) for c, t, *_ in set(turns))
    at = {(r.conv_id, r.turn): r for r in got}
    for c, t, role, text in turns:
        if role not in ("user", "assistant"):
            r = at[c, t]
            record = json.dumps({"content": text, "role": role, "type": "message"}, separators=(",", ":"))
            assert (r.kind, r.call_id, r.depth, r.status, r.errors) == ("message", None, 0, "message" if c else "no_id", "")
            assert r.record_md5 == hashlib.md5(record.encode()).hexdigest()
    assert [at[1, t].position for t in range(4)] == [0, 1, 2, 3] and at[2, 0].position == 0 and at[2, 1].position == 1


def test_names_of_any_kind(spark):
    """Quotes and dots in names, null and repeated rules, unknown types."""
    rules = [("f", "it's", "integer", True, 0.0, 9.0), ("f", "a.b", "string", True, None, None), ("f", 'say "x"', "boolean", False, None, None),
             ("f", "it's", "integer", True, 0.0, 9.0), ("f", "it's", "string", False, None, None), ("f", None, "string", True, None, None),
             (None, "x", "string", True, None, None), ("f", "any", "list", True, None, None), ("f", "none", None, False, None, None)]
    t = spark.createDataFrame(rules, "name string, field string, type string, required boolean, low double, high double")
    cases = {'{"it\'s":3,"a.b":"x","any":[1]}': "", '{"it\'s":30,"a.b":"x","any":1,"say \\"x\\"":1}': "range:it's,type:say \"x\"",
             '{"a.b":1}': "missing:any,missing:it's,type:a.b", '{"it\'s":3,"a.b":"x","any":null,"a":{"b":1},"none":2}': "unknown:a"}
    rows = [(1, i, f"c{i}", None, "f", a) for i, a in enumerate(cases)] + [(1, 90, "n", None, None, "{}")]
    got = {r.call_id: ",".join(r.errors) for r in chat.validate(calls(spark, rows), t).collect()}
    assert got == {f"c{i}": e for i, e in enumerate(cases.values())} | {"n": "tool"}


def test_long_texts_stay_whole(spark, monkeypatch):
    """Arguments beyond the parse limit keep their text and say so; contents have no limit."""
    monkeypatch.setattr(chat, "PARSED", 1000)
    long = '{"s":"' + "é" * 600 + '","a":1}'
    body = 'x"\n' * 5_000_000
    rows = [(1, 0, "a", None, "f", long), (1, 2, "b", None, "f", '{"s": "xx", "a":1}')]
    got = chat.format_chat(calls(spark, rows), results(spark, [(1, 1, "a", body)]), tools(spark)).collect()
    at = {(r.kind, r.call_id): r for r in got}
    assert at["call", "a"].errors == "size" and at["call", "b"].errors == ""
    assert json.loads(at["call", "a"].record)["arguments"] == long and json.loads(at["call", "a"].record)["result"] == body
    assert json.loads(at["result", "a"].record) == {"content": body, "id": "a", "type": "result"}


def test_the_parse_limit_fits_a_variant(spark):
    """The texts that grow most when parsed still fit at the limit."""
    n = chat.PARSED - 20
    for unit in ("1,", "[],", "{},", '"",'):
        text = '{"s":[' + unit * (n // len(unit) - 1) + "0]}"
        row = chat.validate(calls(spark, [(1, 0, "a", None, "f", text)]), tools(spark)).first()
        assert row.errors == ["missing:a", "type:s"] and row.canonical == text


def test_long_arguments_are_checked(spark, tmpdir_path):
    """Arguments over the parse limit, also over what JSON functions take by default, are checked like others."""
    from qrank.llm import catalog
    assert chat.PARSED < 5_000_000
    turns = [(i, 0, "user", "x" * n) for i, n in enumerate((5_000_000, 22_000_000, 5_200_000, 5_000_004))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = {r.conv_id: r for r in catalog.op1_chat_formatting(spark, tmpdir_path).collect()}
    assert [got[i].errors for i in range(4)] == ["range:limit", "range:limit", "json", ""]
    for i, args in ((0, {"limit": 0, "query": turns[0][3]}), (1, {"limit": 0, "query": turns[1][3]}), (2, None), (3, {"limit": 4, "query": turns[3][3]})):
        record = {"arguments": args, "id": f"c{i}-0", "name": "search", "result": None, "type": "call", "valid": i == 3}
        assert got[i].record_md5 == hashlib.md5(json.dumps(record, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_long_arguments_are_read_like_short_ones(spark, monkeypatch):
    cases = ['{"s":"é\\"","a":2}', '{"a":1.50}', '{"a":1,"a":2}', '{"a":NaN}', "{'a':1}", '{"a":1,}', "[1]", "", '{"a":', '{"a":null}', None,
             '{"a":1,"z":{"y":[1.0,{"c":1e3,"b":-0}]}}', '{"a":12345678901234567890123}', '{"a":"\\u0001\\/"}', ' {"a":01}', "null"]
    df = calls(spark, [(1, i, f"c{i}", None, "f", a) for i, a in enumerate(cases)])
    def read():
        return {r.call_id: (r.canonical, r.errors) for r in chat.validate(df, tools(spark), whole=True).collect()}
    want = read()
    monkeypatch.setattr(chat, "PARSED", 0)
    assert read() == want
