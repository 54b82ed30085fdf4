"""Measure groups, specs, sinks read back, analyzer chains and readers."""
import os

import pytest
from pyspark.sql import functions as F

from qrank import sinks
from qrank.functions import analysis as A
from qrank.functions.text import topic_dates
from qrank.operators import groups as G
from qrank.operators import index as I
from qrank.operators import measures as M
from qrank.operators.judge import judge
from qrank.plans import sweep as SW
from qrank.sources import runfiles as R


def run(spark):
    rows = [("r", "1", f"d{i}", float(9 - i)) for i in range(6)] + [("r", "2", f"d{i}", float(i)) for i in range(4)]
    return spark.createDataFrame(rows, "run_id string, qid string, docno string, sim double")


def qrels(spark):
    rows = [("1", "d1", 1), ("1", "d3", 2), ("1", "d5", 0), ("2", "d0", 1), ("2", "d9", 3)]
    return spark.createDataFrame(rows, "qid string, docno string, rel bigint")


@pytest.mark.parametrize("group", sorted(G.GROUPS))
def test_groups_name_their_measures(spark, group):
    j = qrels(spark)
    if group == "qrels_jg":
        j = j.withColumn("jg", F.lit("a")).unionByName(j.withColumn("jg", F.lit("b")))
    elif "prefs" in group:
        j = j.select("qid", F.lit("a").alias("jg"), F.lit("0").alias("jsg"), "docno", F.col("rel").cast("double").alias("rel_level"))
    got = {r.measure: r.value for r in G.evaluate_group(run(spark), j, group).where("qid = 'all'").collect()}
    for m in G.GROUPS[group]:
        if m not in G.TEXT:
            assert any(k == m or k.startswith(m + "_") for k in got), m
    assert got["num_q"] == 2


def test_unknown_group(spark):
    with pytest.raises(ValueError):
        G.evaluate_group(run(spark), qrels(spark), "nothing")


def test_text_measures_and_last_tag(spark, tmpdir_path):
    open(f"{tmpdir_path}/a", "w").write("".join(f"1 Q0 d{i} 1 {9 - i} tag{i}\n" for i in range(6)))
    tags = R.last_run_tag(spark, f"{tmpdir_path}/a")
    assert tags.first().tag == "tag5"
    r = R.read_run(spark, f"{tmpdir_path}/a", run_id_from_file=True)
    got = {(x.measure, x.qid): x.text for x in G.text_measures(judge(r, qrels(spark)), tags, 4).collect()}
    assert got == {("relstring", "1"): "-1-2", ("runid", "all"): "tag5"}


def test_specs(spark):
    got = {r.measure: r.value for r in M.evaluate_specs(run(spark), qrels(spark), ["P.2,1", "ndcg.1=3,2=9", "map"], summary=False)
           .where("qid = '1'").collect()}
    assert got["P_1"] == 0.0 and got["P_2"] == 0.5 and got["map"] == 0.5 and "ndcg_1=3,2=9" in got
    with pytest.raises(ValueError):
        M.evaluate_specs(run(spark), qrels(spark), ["P.0,5"])


def test_sinks_read_back(spark, tmpdir_path):
    ranked = run(spark).withColumn("rank", F.row_number().over(
        __import__("pyspark.sql").sql.Window.partitionBy("qid").orderBy(F.desc("sim"))))
    sinks.write_run(ranked, f"{tmpdir_path}/run")
    back = R.read_run(spark, f"{tmpdir_path}/run")
    assert sorted(map(tuple, back.collect())) == sorted((r.run_id, r.qid, r.docno, r.sim) for r in ranked.collect())
    ev = M.evaluate(run(spark), qrels(spark), ["map", "num_ret"])
    sinks.write_eval(ev, f"{tmpdir_path}/ev")
    got = {(r.qid, r.measure): r.text for r in spark.read.parquet(f"{tmpdir_path}/ev").collect()}
    assert got["1", "map"] == "0.5000" and got["all", "num_ret"] == "10"
    lb = spark.createDataFrame([("b", 0.50002), ("a", 0.5), ("c", 0.9)], "run_id string, map double")
    assert sorted(map(tuple, sinks.ranked(lb).collect())) == [(1, "c", 0.9), (2, "a", 0.5), (2, "b", 0.5)]
    sinks.write_leaderboard(lb, f"{tmpdir_path}/lb")
    rows = [open(f"{tmpdir_path}/lb/{f}").read().split() for f in os.listdir(f"{tmpdir_path}/lb") if f.startswith("part")]
    assert rows == [["run_id,map", "c,0.9", "a,0.5", "b,0.5"]]


def test_dates(spark):
    text = "In the 2010s and 2015, room 1234, 1980S; 1699, 17000"
    got = spark.createDataFrame([(text,), ("none",)], "t string").select(topic_dates(F.col("t")).alias("d")).collect()
    assert got[0].d.split(", ") == [str(y) for y in range(2010, 2020)] + ["2015"] + [str(y) for y in range(1980, 1990)]
    assert got[1].d == "null"


def plain_chain(token, filters):
    import re

    from qrank.functions import porter
    for f in filters:
        if f == "lowercase":
            token = token.lower()
        elif f == "stop":
            if token in A.STOP_WORDS:
                return None
        elif f == "porterstem":
            token = porter.stem(token)
        elif f == "asciifolding":
            token = A.fold_ascii_py(token)
        elif f == "apostrophe":
            token = re.sub(r"['’].*$", "", token)
        else:
            token = re.sub("(?i)^(" + "|".join(A.ELISION_PREFIXES) + ")['’]", "", token)
    return token


CHAINS = [("porterstem", "lowercase", "stop", "asciifolding"), ("asciifolding", "stop"), ("stop", "lowercase", "porterstem"),
          ("elision", "apostrophe", "lowercase", "stop"), ("porterstem", "elision", "stop", "apostrophe"), ()]
TEXT = "The running of L'école and dogs' houses IS the Éclair with with John's"


@pytest.mark.parametrize("filters", CHAINS)
def test_any_chain_order(spark, filters):
    docs = spark.createDataFrame([("a", TEXT), ("b", "the and"), ("c", None)], "docno string, text string")
    p = I.build_postings(docs, A.Analyzer("standard", filters), fields=("text",)).collect()
    for d, t in (("a", TEXT), ("b", "the and")):
        raw = [x for x in t.split()]
        raw = [x[:-1] if x.endswith("'") else x for x in raw]
        want = [y for y in (plain_chain(x, filters) for x in raw) if y is not None]
        got = {r.term: r.tf for r in p if r.docno == d}
        assert got == {x: want.count(x) for x in want}
        assert {r.dl for r in p if r.docno == d} <= {len(want)}


def test_every_filter_subset_by_plain_chain(spark):
    raw = sorted(set(TEXT.replace("dogs'", "dogs").split()))
    vocab = spark.createDataFrame([(x,) for x in raw], "raw string").select("raw", F.lower("raw").alias("low")).select(
        "raw", "low", A._porter_udf("raw").alias("stem"), A._porter_udf("low").alias("stem_low"))
    subsets = SW.filter_subsets()
    got = {}
    for r in SW.subset_term_maps(vocab, subsets).collect():
        got[r.sid, r.raw] = r.term
    want = {(i, x): t for i, s in enumerate(subsets) for x in raw if (t := plain_chain(x, s)) is not None}
    assert len(subsets) == 64 and got == want


def test_sample_every(spark):
    docs = spark.createDataFrame([(f"c{i % 2}", f"d{i:03d}") for i in range(41)], "collection string, docno string")
    got = sorted(map(tuple, SW.sample_every(docs, 3).collect()))
    want = sorted(x for c in ("c0", "c1") for x in [(c, f"d{i:03d}") for i in range(41) if f"c{i % 2}" == c][::3])
    assert got == want


def test_preference_counts_for_any_number_of_levels(spark, monkeypatch):
    import random

    from qrank.operators import prefs as P
    rng = random.Random(6)
    prefs = spark.createDataFrame([(f"q{q}", "a", "0", f"d{d:03d}", rng.randint(-1, 9) / 2) for q in range(2) for d in range(60)],
                                  "qid string, jg string, jsg string, docno string, rel_level double")
    runs = spark.createDataFrame([("r", f"q{q}", f"d{d:03d}", float(rng.randint(0, 20))) for q in range(2) for d in rng.sample(range(80), 40)],
                                 "run_id string, qid string, docno string, sim double")
    want = sorted(map(tuple, P.prefs_counts(runs, prefs).collect()))
    monkeypatch.setattr(P, "MAX_LEVELS", 1)
    assert sorted(map(tuple, P.prefs_counts(runs, prefs).collect())) == want
    assert sorted(map(tuple, P.prefs_counts(runs, prefs, skew_safe=True).collect())) == want
