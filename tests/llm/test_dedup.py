import numpy as np
import pytest
import xxhash

from qrank.llm import components, lines, simhash
from qrank.llm.common import LOWER

from . import data


def brute_fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(codes, budget):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def test_fingerprint_blocks():
    for r in data.rows():
        assert simhash.fingerprint(r[1].encode() if r[1] is not None else None) == brute_fingerprint(r[1])
    long = " ".join(f"w{i % 977} X{i % 31}" for i in range(300_000))
    assert len(long) > 2 * simhash.TEXT_BLOCK
    assert simhash.fingerprint(long.encode()) == brute_fingerprint(long)


def test_near_duplicates_whole(spark):
    rows = data.rows()
    codes = [brute_fingerprint(r[1]) for r in rows]
    g = groups(codes, 2)
    low = {k: min((rows[i][0] for i in range(len(rows)) if g[i] == k and rows[i][0] is not None), default=None) for k in set(g)}
    want = sorted(((r[0], simhash.signed(c), low[k]) for r, c, k in zip(rows, codes, g)), key=repr)
    found = simhash.near_duplicates(data.documents(spark))
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found.collect()), key=repr) == want
    kept = simhash.keep_one(data.documents(spark))
    assert kept.columns == data.documents(spark).columns
    assert kept.count() == len(set(g))
    assert simhash.near_duplicates(data.empty(spark)).count() == 0 and simhash.keep_one(data.empty(spark)).count() == 0


@pytest.mark.parametrize("cap", [2, 16, 512])
def test_trie_links_lose_nothing_in_dense_groups(spark, cap):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for c in centre:  # many codes around a centre, most in one subtrie
        for _ in range(120):
            flips = rng.integers(40, 64, rng.integers(1, 5)).astype(np.uint64)
            codes.add(int(c ^ np.bitwise_xor.reduce(np.uint64(1) << flips)))
    codes = sorted(codes)
    df = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    star = {r.a: r.b for r in components.stars(simhash.near_links(df, 2, cap)).collect()}
    got = {}
    for c in codes:
        got.setdefault(star.get(simhash.signed(c), simhash.signed(c)), set()).add(c)
    want = {}
    for c, k in zip(codes, groups(codes, 2)):
        want.setdefault(k, set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_trie_pairs_by_brute_force():
    rng = np.random.default_rng(2)
    code = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64))
    group = np.zeros(len(code), np.int64)
    i, j = simhash.trie_links(group, code, 2)
    want = {(a, b) for a in range(len(code)) for b in range(a + 1, len(code)) if (int(code[a]) ^ int(code[b])).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_stars_on_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.a: r.b for r in components.stars(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def brute_lines(rows, min_sites, keep_first=True):
    sites, first = {}, {}
    for r in rows:
        for line in (r[1] or "").split("\n") if r[1] is not None else ():
            if line.strip(" \t\n\r\x0b\x0c"):
                sites.setdefault(line, set()).add(r[3])
                if r[0] is not None:
                    first[line] = min(first.get(line, r[0]), r[0])
    bad = {x for x, s in sites.items() if len(s - {None}) >= min_sites}
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None))
            continue
        kept, seen = [], set()
        for line in r[1].split("\n"):
            own = keep_first and r[0] is not None and first.get(line) == r[0] and line not in seen
            seen.add(line)
            if line not in bad or own:
                kept.append(line)
        out.append((r[0], "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites,keep_first", [(2, True), (4, True), (5, False), (100, True)])
def test_line_dedup(spark, min_sites, keep_first):
    got = lines.dedup_lines(data.documents(spark), min_sites, keep_first=keep_first)
    assert got.columns == data.documents(spark).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute_lines(data.rows(), min_sites, keep_first)
    assert lines.dedup_lines(data.empty(spark), min_sites).count() == 0


def test_many_sites_need_the_sketch_and_the_exact_count(spark):
    rows = [(i * 1000 + s, f"line {i}", "en", f"site{s}", 1) for i, n in enumerate((55, 59, 60, 61, 80)) for s in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = lines.dedup_lines(docs, 60).where("text != ''").groupBy("text").count().collect()
    assert {r.text: r["count"] for r in out} == {"line 0": 55, "line 1": 59, "line 2": 1, "line 3": 1, "line 4": 1}
    low, high = lines.near_band(60)
    assert low < 60 < high
