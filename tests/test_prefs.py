"""Preferences of judge groups with several sub-groups, and pair votes of many judgment vectors, by brute force."""
import random

import numpy as np
import pytest

from qrank.operators import prefs as P

PREFS = "qid string, jg string, jsg string, docno string, rel_level double"
RUN = "run_id string, qid string, docno string, sim double"


def consistent(rng, docs, groups):
    """Rows whose levels follow one hidden value per document, so that no chain contradicts another."""
    rows = []
    for q in "12":
        for jg, subs in groups.items():
            hidden = {d: rng.randrange(12) for d in range(docs)}
            for jsg in range(subs):
                cuts = sorted(rng.sample(range(1, 12), 3))
                for d in rng.sample(range(docs), docs * 2 // 3):
                    level = sum(hidden[d] >= c for c in cuts)
                    # 0 in one sub-group and above 0 in another is refused
                    rows.append((q, jg, str(jsg), f"d{d:03d}", float(level + 1) if hidden[d] >= 3 else 0.0))
    return rows


def ranking(rng, docs):
    return [("r", q, f"d{d:03d}", float(s)) for q in "12" for s, d in enumerate(rng.sample(range(docs + 9), docs // 2))]


def closed(rows):
    """{(qid, jg): set of (a, b)} with every chain of sub-groups followed."""
    out, levels = {}, {}
    for q, jg, jsg, d, lv in rows:
        levels.setdefault((q, jg), {}).setdefault(jsg, {})[d] = lv
    for g, subs in levels.items():
        docs = sorted({d for s in subs.values() for d in s})
        at = {d: i for i, d in enumerate(docs)}
        m = np.zeros((len(docs), len(docs)), bool)
        for s in subs.values():
            for a in s:
                for b in s:
                    m[at[a], at[b]] |= s[a] > s[b]
        while True:
            n = m | ((m.astype(int) @ m.astype(int)) > 0)
            if (n == m).all():
                break
            m = n
        out[g] = {(docs[i], docs[j]) for i, j in zip(*np.nonzero(m))}
    return out


def places(run, rows, q):
    judged = {r[3] for r in rows if r[0] == q}
    kept = sorted(((-s, d) for _, rq, d, s in run if rq == q and d in judged))
    return {d: i for i, (_, d) in enumerate(kept)}


def wanted(run, rows):
    out = []
    for (q, jg), pairs in closed(rows).items():
        at = places(run, rows, q)
        level = {d: lv for rq, g, _, d, lv in rows if (rq, g) == (q, jg)}
        first = lambda a, b: a in at and (b not in at or at[a] < at[b])
        rel, zero = [d for d in level if level[d] > 0], [d for d in level if level[d] == 0]
        zero.sort(key=lambda d: (d not in at, at.get(d, 0), d))
        gone = set(zero[len(rel):])
        kept = [p for p in pairs if not gone & set(p)]
        both = lambda ps: [p for p in ps if p[0] in at and p[1] in at]
        one = [p for p in pairs if (p[0] in at) != (p[1] in at)]
        out.append(("r", q, jg, sum(first(*p) for p in both(pairs)), len(both(pairs)), sum(first(*p) for p in one), len(one),
                    len(pairs) - len(both(pairs)) - len(one), len(rel), sum(d in at for d in rel), len(zero), sum(d in at for d in zero),
                    sum(first(*p) for p in kept), len(kept), sum(first(*p) for p in both(kept)), len(both(kept))))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, run = consistent(rng, 40, {"a": 3, "b": 2}), ranking(rng, 40)
    rows += rows[:5]  # repeated judgments count once
    got = P.prefs_counts(spark.createDataFrame(run, RUN), spark.createDataFrame(rows, PREFS))
    assert sorted(map(tuple, got.select("run_id", "qid", "jg", *P.COUNTS).collect())) == wanted(run, rows)


def test_groups_of_both_kinds(spark):
    rng = random.Random(3)
    rows, run = consistent(rng, 30, {"a": 3, "b": 1}), ranking(rng, 30)
    got = P.prefs_counts(spark.createDataFrame(run, RUN), spark.createDataFrame(rows, PREFS))
    want = [r[:8] for r in wanted(run, rows)]
    assert sorted(tuple(r)[:8] for r in got.select("run_id", "qid", "jg", *P.COUNTS).collect()) == want


def test_chain_of_sub_groups(spark):
    """Each sub-group links two documents; the chain of 40 is closed in a few doubling rounds."""
    rows = [("1", "a", f"s{i:02d}", f"d{i + k:02d}", 2.0 - k) for i in range(40) for k in (0, 1)]
    run = [("r", "1", "d40", 1.0), ("r", "1", "d00", 0.5)]
    rows = [(q, g, s, d, lv + 1) for q, g, s, d, lv in rows]
    got = P.prefs_counts(spark.createDataFrame(run, RUN), spark.createDataFrame(rows, PREFS)).first()
    assert (got.poss_ret, got.ful_ret, got.poss_ret + got.poss_imp + got.notoccur) == (1, 0, 41 * 40 // 2)


@pytest.mark.parametrize("rows, said", [
    ([("s", "x", 2.0), ("s", "y", 1.0), ("t", "x", 1.0), ("t", "y", 2.0)], "contradictory"),
    ([("s", "x", 2.0), ("s", "y", 1.0), ("t", "y", 2.0), ("t", "z", 1.0), ("u", "z", 2.0), ("u", "x", 1.0)], "contradictory"),
    ([("s", "x", 0.0), ("t", "x", 1.0), ("t", "y", 2.0)], "level 0"),
    ([("s", "x", 1.0), ("s", "x", 2.0), ("t", "y", 2.0)], "two levels"),
    ([("s", "x", 1.0), ("s", "x", 2.0), ("s", "y", 2.0)], "two levels")])
def test_inconsistent_judgments_stop_the_job(spark, rows, said):
    prefs = spark.createDataFrame([("1", "a", *r) for r in rows], PREFS)
    run = spark.createDataFrame([("r", "1", "x", 1.0)], RUN)
    with pytest.raises(Exception, match=said):
        P.prefs_counts(run, prefs).collect()
    with pytest.raises(Exception, match=said):
        P.pair_measures(run, prefs).collect()


def test_large_classes(spark):
    """1,000 documents per class: the counts follow from the sizes."""
    rows = [("1", "a", s, f"{c}{i:04d}", lv) for i in range(1000) for s, c, lv in
            (("s", "x", 3.0), ("s", "y", 2.0), ("t", "y", 2.0), ("t", "z", 1.0))]
    run = [("r", "1", f"{c}{i:04d}", -float(3 * i + k)) for i in range(1000) for k, c in enumerate("zyx")]
    got = P.prefs_counts(spark.createDataFrame(run, RUN), spark.createDataFrame(rows, PREFS)).first()
    later = 1000 * 999 // 2  # of two classes, the pairs whose first document has the smaller number
    assert (got.poss_ret, got.ful_ret, got.notoccur) == (3_000_000, 3 * later, 0)


def test_pair_votes_of_5000_vectors(spark):
    rng = np.random.default_rng(5)
    n, judges = 5000, 2
    level = rng.integers(0, 400, (judges, n)) / 2
    assert len(set(map(tuple, level.T))) > 4800
    rows = [("1", f"j{j}", "0", f"d{i:04d}", float(level[j, i])) for j in range(judges) for i in range(n)]
    order = rng.permutation(n)[:n // 5]
    run = [("r", "1", f"d{i:04d}", -float(k)) for k, i in enumerate(order)]
    got = P.pair_measures(spark.createDataFrame(run, RUN), spark.createDataFrame(rows, PREFS)).first()
    place = np.full(n, n)
    place[order] = np.arange(len(order))
    f = sum((lv[:, None] > lv[None, :]).astype(np.int8) for lv in level)
    share = np.where(f + f.T > 0, f / np.maximum(f + f.T, 1), 0)
    ret = place < n
    score = share * (place[:, None] < place[None, :])
    voted = np.triu(f + f.T > 0, 1)
    both = ret[:, None] & ret[None, :]
    some = ret[:, None] | ret[None, :]
    want = (score.sum() / voted.sum(), (score * both).sum() / (voted & both).sum(), score.sum() / (voted & some).sum())
    assert np.allclose((got.prefs_pair, got.prefs_pair_ret, got.prefs_pair_imp), want, rtol=1e-9)


def test_closed_counts_broadcast_no_written_table(spark):
    """Written tables compress so well that Spark would broadcast any number of their rows."""
    from qrank.operators import prefclosure as C
    rng = random.Random(5)
    prefs = spark.createDataFrame(consistent(rng, 20, {"a": 2, "b": 2}), PREFS)
    run = spark.createDataFrame(ranking(rng, 20), RUN)
    levels = C.class_levels(C.document_classes(prefs))
    for df in (C.lifts(levels), P.prefs_counts(run, prefs, False)):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
