import os

from qrank.sources import sgml as SG
from qrank.sources import topics as TP
from qrank.sources.runfiles import read_qrels, read_run

SGML = """<DOC>
<DOCNO> LA010189-0001 </DOCNO>
<DATE>
<P>
January 1, 1989, Sunday
</P>
</DATE>
<HEADLINE>
<P>
Big <F P=100>news</F> today
</P>
</HEADLINE>
<TEXT>
<P>
Some text <!-- a comment --> here.
</P>
</TEXT>
</DOC>
<DOC>
<DOCNO>LA010189-0002</DOCNO>
<TEXT>
No headline, no date.
</TEXT>
</DOC>
"""
FR = """<DOC>
<DOCNO> FR940104-0-00001 </DOCNO>
<!-- PJG FTAG 4700 -->
<!-- PJG STAG 4700
spans lines -->
<DOCTITLE> A rule </DOCTITLE>
<TEXT> Body of the rule. </TEXT>
<DATE> January 4, 1994 </DATE>
</DOC>
"""


def test_sgml_ingest(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/la/la01")
    os.makedirs(f"{tmpdir_path}/fr/fr01")
    open(f"{tmpdir_path}/la/la01/file1", "w").write(SGML)
    open(f"{tmpdir_path}/la/ignored_root_file", "w").write(SGML)
    open(f"{tmpdir_path}/fr/fr01/file1", "w").write(FR)
    la = {r.docno: r for r in SG.read_collection(spark, f"{tmpdir_path}/la", "latimes").collect()}
    assert set(la) == {"LA010189-0001", "LA010189-0002"}
    os.makedirs(f"{tmpdir_path}/la/la02/deep/er")
    open(f"{tmpdir_path}/la/la02/deep/er/f", "w").write(SGML.replace("LA01", "LA02"))
    nested = SG.read_collection(spark, f"{tmpdir_path}/la", "latimes")
    assert {r.subfolder for r in nested.collect()} == {"la01", "la02"}
    assert sorted(r.docno for r in SG.sample_every(nested, 2).collect()) == ["LA010189-0001", "LA020189-0001"]
    d1 = la["LA010189-0001"]
    assert d1.date == "1989" and "<F" not in d1.headline and "Big" in d1.headline and "news" in d1.headline
    assert "comment" not in d1.text
    assert la["LA010189-0002"].headline is None and la["LA010189-0002"].date == "null"
    fr = SG.read_collection(spark, f"{tmpdir_path}/fr", "fr94", null_text="null").first()
    assert fr.headline.strip() == "A rule" and fr.text.startswith("nullnull") and fr.date == "1994"


def test_large_files_are_read_in_splits(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/la/la01/x")
    text = "".join(f"<DOC>\n<DOCNO> D{i:05d} </DOCNO>\n<TEXT>\n{'word ' * (i % 90)}\n</TEXT>\n</DOC>\n" for i in range(3000))
    open(f"{tmpdir_path}/la/la01/x/big", "w").write(text)
    open(f"{tmpdir_path}/la/la01/y", "w").write(SGML)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        docs = SG.read_collection(spark, f"{tmpdir_path}/la", "latimes")
        rows = sorted((r.path, r.pos, r.docno) for r in docs.collect())
        big = [(p, d) for f, p, d in rows if f.endswith("big")]
        assert big == [(i, f"D{i:05d}") for i in range(3000)]
        assert SG.read_docs(spark, f"{tmpdir_path}/la").select("path").rdd.getNumPartitions() > 1 and len(rows) == 3002
        assert SG.sample_every(docs, 7).count() == -(-3002 // 7)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


TOPICS = """<top>

<num> Number: 401
<title> foreign minorities, Germany

<desc> Description:
What sub-saharan differences in the 1990s impede it?

<narr> Narrative:
A relevant document will focus on causes. Mere mention is not relevant.  Others are kept.
</top>
"""


def test_topics_and_synonyms(spark, tmpdir_path):
    p = f"{tmpdir_path}/topics"
    open(p, "w").write(TOPICS)
    t = TP.read_topics(spark, p).first()
    assert t.qid == "401" and "subsaharan" in t.desc and t.date.startswith("1990, 1991") and t.date.endswith("1999")
    from pyspark.sql import functions as F
    from qrank.functions.text import drop_negated
    narr = spark.createDataFrame([(t.narr,)], "n string").select(drop_negated(F.col("n")).alias("n")).first().n
    assert "not relevant" not in narr and "Others are kept." in narr
    facts = f"{tmpdir_path}/wn.pl"
    open(facts, "w").write("s(100,1,'germany',n,1,0).\ns(100,2,'deutschland',n,1,0).\n"
                           "s(200,1,'germany',n,2,0).\ns(200,2,'frg',n,2,0).\ns(300,1,'impede',v,1,0).\n"
                           "s(300,2,'hinder',v,1,0).\n")
    syn = TP.read_synsets(spark, facts)
    assert syn.count() == 4
    blocks = spark.createDataFrame([(1, "minorities, Germany impede")], "block_id int, raw string")
    out = TP.expand_synonyms(blocks, syn).first().raw
    assert out == "minorities, Germany deutschland impede"


def test_numbered_queries(spark, tmpdir_path):
    p = f"{tmpdir_path}/q.txt"
    open(p, "w").write("1. first query\n\n2. second query\n3.third\n")
    rows = [(r.qid, r.text) for r in TP.read_numbered_queries(spark, p).orderBy("qid").collect()]
    assert rows == [("401", "first query"), ("402", "second query"), ("403", "third")]


def test_line_numbers_do_not_depend_on_splits(spark, tmpdir_path):
    from qrank.sources.lines import placed_lines
    os.makedirs(f"{tmpdir_path}/q")
    want = []
    for f in "ab":
        lines = [f"{i}. query {f}{i} {'x' * (i % 50)}" if i % 7 else "" for i in range(1, 900)]
        open(f"{tmpdir_path}/q/{f}", "w").write("\n".join(lines) + "\n")
        want += [x.split(". ", 1)[1].strip() for x in lines if x]
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    try:
        for size in ("128m", "1k"):
            spark.conf.set(conf, size)
            assert spark.read.text(f"{tmpdir_path}/q").rdd.getNumPartitions() > (1 if size == "128m" else 30) or size == "128m"
            rows = TP.read_numbered_queries(spark, f"{tmpdir_path}/q").collect()
            assert sorted((int(r.qid), r.text) for r in rows) == [(401 + i, t) for i, t in enumerate(want)]
            lines = placed_lines(spark, f"{tmpdir_path}/q").orderBy("line_no").collect()
            assert [r.line_no for r in lines] == list(range(len(lines)))
    finally:
        spark.conf.set(conf, before)


def test_synset_of_100_000_words(spark):
    """One row per member, and only texts that use the synset grow."""
    n = 100_000
    syn = spark.range(n).selectExpr("'1' as synset_id", "id as seq", "concat('W', id) as word").unionByName(
        spark.createDataFrame([("2", n + 1, "w5"), ("2", n + 2, "late"), ("3", n + 3, "ox"), ("3", n + 4, "Ox"), ("3", n + 5, "cow")],
                              "synset_id string, seq long, word string"))
    blocks = spark.createDataFrame([(1, "a w5 OX"), (2, "late b")], "block_id int, raw string")
    got = {r.block_id: r.raw for r in TP.expand_synonyms(blocks, syn).collect()}
    assert got[2] == "late w5 b"
    words = got[1].split(" ")
    assert words[:3] == ["a", "w5", "W0"] and words[-2:] == ["OX", "cow"] and len(words) == 4 + n - 1
    assert words[2:-2] == [f"W{i}" for i in range(n) if i != 5]


def test_unusable_queries(spark):
    from pyspark.sql import functions as F

    from qrank.operators.query import usable
    good = ["plain words", "(a b) [c]", '"a (b" c', "a - b", "wh?t*", "AND1 x", "it's", r"a \" b", r"\(x", "", None, "no and"]
    bad = ['"open', "(a", "b)", "a) (b", "x AND", "OR x", "*x", "x -", "y !", "[a", "{a", '"a" "b', "not NOT"]
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string").select(usable(F.col("t")).alias("ok")).collect()
    assert [r.ok for r in rows] == [True] * len(good) + [False] * len(bad)


def test_run_and_qrels_files(spark, tmpdir_path):
    open(f"{tmpdir_path}/run", "w").write("# comment\n1 Q0 d1 1 2.5 tagA extra junk\n\n1 Q0 d2 2 1.5 tagA\n")
    open(f"{tmpdir_path}/qrels", "w").write("# c\n1 0 d1 1\n1 0 d2 -1\n")
    run = read_run(spark, f"{tmpdir_path}/run", validate=True).collect()
    assert len(run) == 2 and run[0].run_id == "tagA"
    q = read_qrels(spark, f"{tmpdir_path}/qrels", validate=True).collect()
    assert sorted(r.rel for r in q) == [-1, 1]
    open(f"{tmpdir_path}/bad", "w").write("1 0 d1\n")
    open(f"{tmpdir_path}/bad2", "w").write("1 0 d1 x\n")
    open(f"{tmpdir_path}/bad3", "w").write("1 Q0 d1 1 high tagA\n")
    import pytest
    for read, name in ((read_qrels, "bad"), (read_qrels, "bad2"), (read_run, "bad3")):
        with pytest.raises(Exception, match="malformed"):
            read(spark, f"{tmpdir_path}/{name}").collect()
        assert read(spark, f"{tmpdir_path}/{name}", validate=False).count() == 0


def test_run_stream(spark, tmpdir_path):
    import glob
    from qrank.streaming.runs import evaluate_run_stream
    runs = f"{tmpdir_path}/runs"
    os.makedirs(runs)
    open(f"{runs}/a.txt", "w").write("1 Q0 d1 1 2.0 a\n1 Q0 d2 2 1.0 a\n")
    open(f"{runs}/b.txt", "w").write("1 Q0 d2 1 2.0 b\n1 Q0 d1 2 1.0 b\n")
    qrels = spark.createDataFrame([("1", "d1", 1), ("1", "d2", 0)], "qid string, docno string, rel bigint")
    q = evaluate_run_stream(spark, runs, qrels, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", ["map"])
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmpdir_path}/out").where("qid = 'all'").collect()
    maps = sorted(r.value for r in out)
    assert maps == [0.5, 1.0] and glob.glob(f"{tmpdir_path}/out/batch=*")
