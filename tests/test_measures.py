import random

import pytest
from pyspark.sql import functions as F

from brute import measures as brute_measures
from qrank.operators import measures as M
from qrank.operators.judge import EvalOptions

NAMES = ["num_ret", "num_rel", "num_rel_ret", "map", "recip_rank", "P_5", "P_10", "recall_5", "recall_10",
         "Rprec", "bpref", "ndcg", "success_1"]
REQ = ["num_ret", "num_rel", "num_rel_ret", "map", "recip_rank", ("P", (5, 10)), ("recall", (5, 10)), "Rprec",
       "bpref", "ndcg", ("success", (1,))]


def _frames(spark, topics):
    run_rows, qrel_rows = [], []
    for qid, (ranking, qrels) in topics.items():
        run_rows += [("r", qid, d, float(s)) for d, s in ranking]
        qrel_rows += [(qid, d, int(r)) for d, r in qrels.items()]
    run = spark.createDataFrame(run_rows, "run_id string, qid string, docno string, sim double")
    qrels = spark.createDataFrame(qrel_rows, "qid string, docno string, rel bigint")
    return run, qrels


def _spark_values(spark, topics, level=1):
    run, qrels = _frames(spark, topics)
    ev = M.evaluate(run, qrels, REQ, EvalOptions(level=level), summary=False).collect()
    return {(r.qid, r.measure): r.value for r in ev}


def test_random_rankings_match_brute_force(spark):
    rng = random.Random(7)
    topics = {}
    for t in range(40):
        docs = [f"d{i:03d}" for i in range(rng.randint(1, 25))]
        ranking = [(d, rng.choice([1.0, 2.0, 3.0, 4.5])) for d in docs]
        pool = docs + [f"x{i}" for i in range(rng.randint(0, 6))]
        qrels = {d: rng.choice([-1, 0, 0, 1, 2, 3]) for d in pool if rng.random() < 0.7}
        if not qrels:
            qrels = {"zz": 0}
        topics[f"t{t}"] = (ranking, qrels)
    for level in (1, 2):
        got = _spark_values(spark, topics, level)
        for qid, (ranking, qrels) in topics.items():
            exp = brute_measures(ranking, qrels, level)
            for n in NAMES:
                assert got[(qid, n)] == pytest.approx(exp[n], abs=1e-9), (qid, n, level)


def test_hand_cases(spark):
    topics = {
        # no relevant documents judged
        "norel": ([("a", 3.0), ("b", 2.0)], {"a": 0, "b": 0}),
        # everything relevant
        "allrel": ([("a", 3.0), ("b", 2.0)], {"a": 1, "b": 1}),
        # ties broken by docno descending: b ranks before a
        "ties": ([("a", 1.0), ("b", 1.0)], {"a": 1}),
        # only unjudged documents retrieved
        "unj": ([("u", 1.0), ("v", 0.5)], {"w": 1}),
    }
    got = _spark_values(spark, topics)
    assert got[("norel", "map")] == 0.0
    assert got[("allrel", "map")] == 1.0 and got[("allrel", "P_5")] == pytest.approx(0.4)
    assert got[("ties", "map")] == pytest.approx(0.5) and got[("ties", "recip_rank")] == pytest.approx(0.5)
    assert got[("unj", "map")] == 0.0 and got[("unj", "num_rel")] == 1.0


def test_missing_topic_and_complete(spark):
    topics = {"1": ([("a", 1.0)], {"a": 1}), "2": ([("b", 1.0)], {"b": 0})}
    run, qrels = _frames(spark, topics)
    qrels = qrels.unionByName(spark.createDataFrame([("3", "c", 1)], "qid string, docno string, rel bigint"))
    plain = {r.measure: r.value for r in M.evaluate(run, qrels, ["map", "num_q", "num_rel"], per_topic=False).collect()}
    comp = {r.measure: r.value for r in M.evaluate(run, qrels, ["map", "num_q", "num_rel"], EvalOptions(complete=True),
                                                   per_topic=False).collect()}
    assert plain["map"] == pytest.approx(0.5) and plain["num_q"] == 2
    assert comp["map"] == pytest.approx(1 / 3) and comp["num_q"] == 3 and comp["num_rel"] == 2


def test_invariants(spark):
    rng = random.Random(3)
    topics = {}
    for t in range(15):
        docs = [f"d{i:02d}" for i in range(20)]
        qrels = {d: rng.choice([0, 1, 2]) for d in docs}
        ideal = sorted(docs, key=lambda d: -qrels[d])
        topics[f"i{t}"] = ([(d, float(100 - i)) for i, d in enumerate(ideal)], qrels)
    run, qrels = _frames(spark, topics)
    ev = M.evaluate(run, qrels, ["map", "ndcg", ("success", (1, 5, 10)), "set_P", "ndcg_cut"], summary=False).collect()
    vals = {(r.qid, r.measure): r.value for r in ev}
    for q in topics:
        assert vals[(q, "ndcg")] == pytest.approx(1.0)
        assert vals[(q, "ndcg_cut_10")] == pytest.approx(1.0)
        assert 0.0 <= vals[(q, "map")] <= 1.0
        assert vals[(q, "success_1")] <= vals[(q, "success_5")] <= vals[(q, "success_10")]


def test_single_judge_group_equals_plain(spark):
    topics = {"1": ([("a", 3.0), ("b", 2.0), ("c", 1.0)], {"a": 0, "b": 1, "c": 1})}
    run, qrels = _frames(spark, topics)
    qjg = qrels.withColumn("jg", F.lit("0"))
    plain = {r.measure: r.value for r in M.evaluate(run, qrels, ["map"], summary=False).collect()}
    avg = {r.measure: r.value for r in M.evaluate_jg(run, qjg, ["map_avgjg"], summary=False).collect()}
    assert avg["map_avgjg"] == pytest.approx(plain["map"])


def test_sliced_ranking_matches_window(spark):
    """The hot-group ranking plan gives the same ranks and running sums."""
    from qrank.operators.ranking import running
    rows = [("r", "q1" if i % 10 else "q2", f"d{i:04d}", float(i % 17), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "run_id string, qid string, docno string, sim double, rel int")
    order = [F.desc("sim"), F.desc("docno")]
    sums = {"k": (F.col("rel") > 0).cast("long"), "g": F.col("rel").cast("double") / 3.0}
    a = {(r.qid, r.docno): (r.rank, r.k, round(r.g, 9)) for r in running(df, ["run_id", "qid"], order, sums, skew_safe=False).collect()}
    b = {(r.qid, r.docno): (r.rank, r.k, round(r.g, 9)) for r in running(df, ["run_id", "qid"], order, sums, skew_safe=True).collect()}
    assert a == b


def test_sliced_evaluation_matches(spark):
    rng = random.Random(11)
    topics = {f"t{t}": ([(f"d{i:03d}", float(rng.randint(0, 5))) for i in range(60)],
                        {f"d{i:03d}": rng.choice([-1, 0, 1, 2]) for i in range(0, 80, 2)}) for t in range(5)}
    run, qrels = _frames(spark, topics)
    ms = ["map", "ndcg", "G", "ndcg_rel", "Rndcg", "bpref", "infAP", ("P", (5, 10))]
    a = {(r.qid, r.measure): r.value for r in M.evaluate(run, qrels, ms, EvalOptions(skew_safe=False)).collect()}
    b = {(r.qid, r.measure): r.value for r in M.evaluate(run, qrels, ms, EvalOptions(skew_safe=True)).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-9), k


def test_duplicates_and_single_topic(spark):
    topics = {"1": ([("a", 1.0), ("b", 0.5)], {"a": 1}), "2": ([("c", 1.0)], {"c": 1})}
    run, qrels = _frames(spark, topics)
    one = M.evaluate(run, qrels, ["map", "num_q"], EvalOptions(topic="2"), per_topic=False).collect()
    assert {r.measure: r.value for r in one} == {"map": 1.0, "num_q": 1.0}
    again = run.where("docno = 'a'").withColumn("sim", run.sim - 5)
    for skew_safe in (False, True):
        with pytest.raises(Exception, match="duplicate document for a topic in the run: .*1 a"):
            M.evaluate(run.unionByName(again), qrels, ["num_ret"], EvalOptions(skew_safe=skew_safe)).collect()
        kept = M.evaluate(run.unionByName(again), qrels, ["num_ret"], EvalOptions(skew_safe=skew_safe, max_docs=2), per_topic=False)
        assert kept.first().value == 3  # the second place of the document is below the cut
    with pytest.raises(Exception, match="duplicate document for a topic in the judgments: 2 c"):
        M.evaluate(run, qrels.unionByName(qrels.where("docno = 'c'")), ["num_ret"]).collect()
    twice = M.evaluate(run.unionByName(again), qrels, ["num_ret"], EvalOptions(validate=False), per_topic=False)
    assert twice.first().value == 4
