"""Counts of wanted terms inside tasks, against counts token by token."""

from collections import Counter

import pyarrow as pa
import pytest

from qrank.functions.analysis import Analyzer, final_form
from qrank.operators import counting
from qrank.operators import index as I


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("filters", [(), ("porterstem", "asciifolding")])
def test_a_task_counts_whole_texts(monkeypatch, small, filters):
    if small:
        for name, n in (("KNOWN", 1), ("TOKENS", 3), ("ROWS", 2)):
            monkeypatch.setattr(counting, name, n)
    texts = [["runs", "run", "été"], [], ["x"], ["running", "run", "run", "z", "ete"], ["y"] * 7 + ["runs"], []]
    rows = [("text" if i % 2 else "headline", None if i == 2 else f"d{i}", t) for i, t in enumerate(texts)]
    first, other = pa.table({"field": ["f"], "docno": ["cut"], "tokens": [["run"] * 5]}), \
        pa.table({"field": [r[0] for r in rows], "docno": [r[1] for r in rows], "tokens": pa.array([r[2] for r in rows], pa.list_(pa.string()))})
    batch = pa.concat_tables([first, other]).combine_chunks().to_batches()[0].slice(1)
    final = final_form(filters)
    got = [r for b in counting.counts_of_task(Sent(["run", "été", "ete", "x"]), final)([batch]) for r in zip(*(c.to_pylist() for c in b.columns))]
    want = []
    for field, docno, tokens in rows:
        n = Counter(t for t in ((final(t) if final else t) for t in tokens) if t in ("run", "été", "ete", "x"))
        want += [(field, t, docno, c, len(tokens)) for t, c in n.items()] + [(field, None, docno, 1, len(tokens))] * bool(tokens)
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("filters", [("lowercase", "stop"), ("lowercase", "stop", "porterstem", "asciifolding")])
def test_a_search_counts_in_one_pass_without_a_vocabulary(spark, monkeypatch, filters):
    """Repeated and null identifiers add up as in a grouping of all tokens."""
    a = Analyzer("standard", filters)
    docs = [("d1", "Running dogs", "1990", "the dog runs été"), ("d1", "Running dogs", "1990", "the dog runs fast"), ("d1", "x", "1990", None),
            (None, "dog", None, "dogs"), (None, "dog", "1991", ""), ("d2", None, "1992", "ete the DOG's dog. dog")]
    docs = spark.createDataFrame(docs, "docno string, headline string, date string, text string")
    wanted = spark.createDataFrame([("run",), ("runs",), ("dog",), ("été",), ("ete",), ("1990",), (None,)], "term string")
    rows = lambda df: Counter(map(tuple, df.select("field", "term", "docno", "tf", "dl").where("term is not null").collect()))
    want = rows(I.joined(docs, a, wanted, I.FIELDS, "docno"))
    monkeypatch.setattr(I, "term_map", None)
    monkeypatch.setattr(I, "joined", None)
    index = I.query_index(docs, a, wanted)
    assert rows(index.postings) == want and want
    whole = {r.field: (r.N, r.sum_dl) for r in index.field_stats.collect()}
    monkeypatch.undo()
    assert whole == {r.field: (r.N, r.sum_dl) for r in I.build_index(docs, a).field_stats.collect()}


def test_whole_index_counts_inside_tasks(spark):
    """No token is a row of a shuffle; repeated identifiers, nulls and empty texts count as they did."""
    rows = [("a", "x y x", "x z"), ("b", "", None), ("c", "y", "y y y"), (None, "x", "w")]
    for twice in (False, True):
        docs = spark.createDataFrame(rows * (1 + twice), "docno string, headline string, text string")
        df = I.build_postings(docs, Analyzer("whitespace", ()), fields=("headline", "text"))
        assert ("Exchange" in df._jdf.queryExecution().executedPlan().toString()) == twice
        got = {(r.field, r.docno, r.term): (r.tf, r.dl) for r in df.collect()}
        want = {("headline", "a", "x"): (2, 3), ("headline", "a", "y"): (1, 3), ("text", "a", "x"): (1, 2), ("text", "a", "z"): (1, 2),
                ("headline", "c", "y"): (1, 1), ("text", "c", "y"): (3, 3), ("headline", None, "x"): (1, 1), ("text", None, "w"): (1, 1)}
        assert got == {k: (tf * (1 + twice), dl) for k, (tf, dl) in want.items()}
