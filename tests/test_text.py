from pyspark.sql import functions as F

from qrank.functions.analysis import Analyzer, fold_ascii_py
from qrank.functions.porter import stem


def test_porter_published_examples():
    cases = {"caresses": "caress", "ponies": "poni", "relational": "relat", "hopefulness": "hope",
             "generalizations": "gener", "oscillators": "oscil", "controll": "control", "sky": "sky"}
    for w, e in cases.items():
        assert stem(w) == e


def test_analyzer_chain(spark):
    df = spark.createDataFrame([("The Quick brown-fox's Café isn't at the U.S.A. in 1990s",)], "t string")
    toks = df.select(Analyzer("standard", ("lowercase", "stop")).tokens(F.col("t")).alias("x")).first().x
    assert "the" not in toks and "quick" in toks and "at" not in toks
    assert fold_ascii_py("Café Æsir") == "Cafe AEsir"


def test_index_and_search(spark):
    from qrank.functions import similarity as S
    from qrank.operators import index as I, query as Q, search as SE
    docs = spark.createDataFrame([("d1", "cats", "cats purr and cats sleep", "1990"),
                                  ("d2", "dogs", "dogs bark", "1991"),
                                  ("d3", None, "cats and dogs", "null")],
                                 "docno string, headline string, text string, date string")
    a = Analyzer()
    idx = I.build_index(docs, a)
    post = {(r.field, r.term, r.docno): (r.tf, r.dl) for r in idx.postings.collect()}
    assert post[("text", "cat", "d1")] == (2, 4)
    fs = {r.field: r.N for r in idx.field_stats.collect()}
    assert fs["headline"] == 2 and fs["text"] == 3
    q = spark.createDataFrame([("1", "cat")], "qid string, text string")
    run = SE.search(Q.flat_query_terms(q, a), idx, S.bm25(1.2, 0.75), k=10).collect()
    assert [r.docno for r in sorted(run, key=lambda r: r.rank)][:1] == ["d1"]


def _corpus(spark, n=200):
    return spark.createDataFrame([(f"d{i:03d}", f"h{i}", f"word{i % 7} common text {i}" if i % 9 else None, "1990") for i in range(n)],
                                 "docno string, headline string, text string, date string")


def _rows(run):
    return sorted((r.qid, r.rank, r.docno, round(r.sim, 9)) for r in run.collect())


def test_every_way_to_search_gives_the_same_run(spark, tmpdir_path, monkeypatch):
    """Over the whole index, raw text, a saved index, and a shuffled join with hot terms in parts."""
    from qrank.functions import similarity as S
    from qrank.operators import index as I, query as Q, search as SE
    from qrank.plans import sizing
    docs = _corpus(spark)
    queries = spark.createDataFrame([("1", "word3 common"), ("2", "TEXT h17 nothing"), ("3", "Words commonly")], "qid string, text string")
    for a in (Analyzer("standard", ("lowercase", "stop")), Analyzer(), Analyzer("whitespace", ("porterstem", "stop", "lowercase"))):
        qt = Q.flat_query_terms(queries, a)
        whole = I.build_index(docs, a)
        want = _rows(SE.search(qt, whole, S.bm25(1.2, 0.75), k=50))
        assert want
        part = I.query_index(docs, a, qt)
        assert sorted(part.field_stats.collect()) == sorted(whole.field_stats.collect())
        assert part.postings.select("term").distinct().count() <= qt.select("term").distinct().count() < whole.postings.select("term").distinct().count()
        assert _rows(SE.search_text(qt, docs, a, S.bm25(1.2, 0.75), k=50)) == want
        path = f"{tmpdir_path}/{a.name.replace('+', '-')}"
        I.save_index(whole, path, buckets=4)
        loaded = I.load_index(spark, path)
        assert loaded.analyzer == a and loaded.buckets == 4
        assert _rows(SE.search(qt, loaded, S.bm25(1.2, 0.75), k=50)) == want
        with monkeypatch.context() as m:
            m.setattr(SE, "MAX_BROADCAST_QUERY_TERMS", 0)
            m.setattr(SE, "TERM_PART", 30)  # "common" and "text" fall into several parts
            m.setattr(sizing, "MAX_BROADCAST_BYTES", 0)
            parts = SE.matches(qt, whole)
            assert "_part" in parts._jdf.queryExecution().executedPlan().toString()
            for index in (whole, loaded):
                assert _rows(SE.search(qt, index, S.bm25(1.2, 0.75), k=50)) == want


def test_saved_index_reads_the_terms_buckets_only(spark, tmpdir_path):
    from qrank.functions import similarity as S
    from qrank.operators import index as I, query as Q, search as SE
    a = Analyzer("standard", ("lowercase", "stop"))
    I.save_index(I.build_index(_corpus(spark), a), f"{tmpdir_path}/idx", buckets=16)
    idx = I.load_index(spark, f"{tmpdir_path}/idx")
    qt = Q.flat_query_terms(spark.createDataFrame([("1", "word3")], "qid string, text string"), a)
    run = SE.search(qt, idx, S.bm25(1.2, 0.75), k=5)
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    rows = run.collect()
    assert len(rows) == 5 and all(int(r.docno[1:]) % 7 == 3 for r in rows)


def test_match_all(spark):
    from qrank.functions import similarity as S
    from qrank.operators import search as SE
    a = Analyzer("standard", ("lowercase", "stop"))
    queries = spark.createDataFrame([("1", "word3"), ("2", '"word3'), ("3", "the"), ("4", "x AND")], "qid string, text string")
    got = _rows(SE.search_expanded(queries, _corpus(spark), a, a, S.bm25(1.2, 0.75), k=7))
    assert [r for r in got if r[0] in "24"] == [(q, i + 1, f"d{i:03d}", 1.0) for q in "24" for i in range(7)]
    assert {r[0] for r in got} == {"1", "2", "4"} and sum(r[0] == "1" for r in got) == 7


def test_own_similarity_and_quantized_lengths(spark):
    import pytest

    from qrank.functions import similarity as S
    S.register_similarity("flat", lambda p1, p2: F.col("tf") * p1 + p2)
    try:
        rows = spark.createDataFrame([(float(d), 3.0) for d in (1, 40, 41, 47, 100, 1000)], "dl double, tf double")
        got = rows.select("dl", S.Similarity("flat", 2.0, 1.0).expr().alias("s"), S.doc_len(True).alias("q")).collect()
        assert {r.s for r in got} == {7.0} and S.Similarity("flat", 2.0, 1.0).name == "flat_2_1"
        assert [r.q for r in got] == [1, 40, 40, 44, 96, 960]
        with pytest.raises(ValueError):
            S.register_similarity("flat", S.bm25)
    finally:
        S.REGISTRY.pop("flat")
