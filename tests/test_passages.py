"""Passage judgments against plain substring search."""
from collections import Counter

from qrank.sources import fixtures as fx

DOCS = [(1, "one two three four five six seven eight nine ten"), (2, "xone two three four five six sevenx"), (3, "short note"), (4, "a two thr"),
        (5, ""), (6, None), (7, "One Two Three four five"), (8, "ο λόγος ΟΔΟΣ ήταν ΟΔΟΣα εδώ και τώρα πάντα"), (1, "one two three four five six seven eight nine ten"),
        (1, "another text: one two three"), (9, "five six"), (10, "!! one-two, three? four five six seven"), (11, "ab ab ab ab ab ab ab ab cd")]
ITEMS = [(0, "one two three four five six seven"), (1, "two three"), (2, "two"), (3, "ne two three four five six seve"), (4, "one two three"),
         (5, "two three four five"), (6, ""), (7, None), (8, "ΟΔΟΣ ήταν ΟΔΟΣ"), (9, "λόγος ΟΔΟΣ ήταν ΟΔΟΣα εδώ και τώρα"), (10, "!!"),
         (2, "two"), (2, "five six"), (11, "b ab ab ab ab ab ab a"), (12, "One Two Three"), (13, "no such words here at all"), (14, "one-two, three? four")]


def pairs(spark, items, docs):
    got = fx.passage_pairs(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"))
    want = Counter((i, d) for i, t in items for d, u in docs if t is not None and u is not None and t in u)
    return Counter((r.item_id, r.doc_id) for r in got.collect()), want


def test_every_document_with_the_text(spark):
    got, want = pairs(spark, ITEMS, DOCS)
    assert got == want and want[2, 1] == 8


def test_only_long_only_short_and_no_items(spark):
    for items in ([x for x in ITEMS if x[0] in (0, 3, 9)], [x for x in ITEMS if x[0] in (1, 6)], ITEMS[7:8]):
        got, want = pairs(spark, items, DOCS)
        assert got == want


def test_judgments_of_short_and_cut_passages(spark, tmpdir_path):
    for name, rows, schema in (("benchmark", ITEMS[1:4], "item_id long, text string"), ("documents", DOCS[:4], "doc_id long, text string"),
                               ("labels", [(2, 1), (4, 0)], "doc_id long, quality int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")
    got = {(r.qid, r.docno[-1], r.rel) for r in fx.passage_qrels(spark, tmpdir_path).collect()}
    assert got == {("402", "1", 1), ("402", "2", 2), ("403", "1", 1), ("403", "2", 2), ("403", "4", 1), ("404", "1", 1), ("404", "2", 2)}
