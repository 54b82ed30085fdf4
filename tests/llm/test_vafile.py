"""Exact top-k against plain sorting; what the cells let a block leave unread."""
import math
import random

import numpy as np
import pytest

from qrank.llm import vafile

SCHEMA = "vec_id long, embedding array<float>, v string, vid long, score string, qb int"


def plain(rows, k, every):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(-max(min(sum(x * y for x, y in zip(q, c)), 2 ** 63 - 1), -2 ** 63), j is None, j or 0, j)
                  for b, (j, c) in enumerate(good) if b != a]
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def run(spark, rows, k=4, every=5, bits=5):
    df = spark.createDataFrame([(i, v, "x", 1, "y", 2) for i, v in rows], SCHEMA)
    return sorted(map(tuple, vafile.top_k(df, k=k, every=every, bits=bits).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_against_plain_sorting(spark, bits, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 1)  # blocks of 256 entries
    monkeypatch.setattr(vafile, "QUERIES", 1)
    monkeypatch.setattr(vafile, "SLAB", 7)
    rng = np.random.default_rng(bits)
    rows = [(i, v) for i, v in enumerate(rng.normal(0, 0.3, (600, 6)).round(1).tolist())]  # many ties
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one vector many times
    rows += [(1200, [50.0] * 6), (1201, [-1e6, 0.0, 0.0, 0.0, 0.0, 1e6])]  # outliers
    random.Random(1).shuffle(rows)
    assert run(spark, rows, bits=bits) == plain(rows, 4, 5)


def test_awkward_rows(spark):
    rows = [(0, None), (5, []), (10, [1.0, float("nan")]), (15, [1.0, None]), (20, [float("inf"), 0.0]), (25, [0.5, -0.5]),
            (30, [0.5]), (35, [0.5, -0.5, 2.0]), (None, [3.0, 3.0]), (None, [3.0, 3.0]), (40, [0.0, 0.0]), (45, [0.5, -0.5]),
            (45, [0.5, -0.5]), (45, [1.0, 0.0]), (7, [0.5, -0.5]), (50, [1e30, -1e30])]
    want = plain([(i, v and [x if x is None or not math.isfinite(x) else max(min(x, 2 ** 57), -2 ** 57) for x in v]) for i, v in rows], 20, 5)
    got = run(spark, rows, k=20)
    assert [r for r in got if r[0] != 50] == [r for r in want if r[0] != 50]
    assert [r[:3] for r in got if r[0] == 50] == [r[:3] for r in want if r[0] == 50]  # products beyond a long stay at its end
    assert run(spark, rows[:1]) == [] and run(spark, [(5, [1.0])]) == [] and run(spark, [(6, [1.0]), (7, [2.0])]) == []
    assert vafile.top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        vafile.top_k(spark.createDataFrame([], SCHEMA), bits=9)


def test_double_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v) for i, v in enumerate(rng.normal(0, 0.1, (60, 3)).tolist())]
    got = vafile.top_k(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), k=3, every=4).collect()
    ints = [[math.floor(64 * x) for x in v] for _, v in rows]
    want = [(q, r + 1, j, -s) for q in range(0, 60, 4) for r, (s, j) in enumerate(sorted(
        (-sum(a * b for a, b in zip(ints[q], ints[j])), j) for j in range(60) if j != q)[:3])]
    assert sorted(map(tuple, got)) == want


def test_bounds_hold_and_most_vectors_stay_unread():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(0, 0.125, (4000, 64)))
    marks = np.array([np.maximum.accumulate(np.r_[c.min(), np.ceil(np.linspace(*np.quantile(c, [0.001, 0.999]), 33))[1:-1], c.max() + 1]) for c in x.T])
    code = vafile.cell_codes(x, marks)
    at, code = np.arange(64), code.astype(int)
    assert (marks[at, code] <= x).all() and (x < marks[at, code + 1]).all()
    q = x[:100]
    qi, ci, score, read = vafile.search_block(q, x, code, marks, 11)
    assert read < 0.1 * len(q) * len(x)
    exact = (q @ x.T).astype(int)
    for i in range(len(q)):
        assert sorted(score[qi == i])[::-1][:11] == sorted(exact[i])[::-1][:11]
        assert (score[qi == i] == exact[i, ci[qi == i]]).all()
