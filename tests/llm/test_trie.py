"""The prefix trie against a plain dictionary of prefixes, band heights down to two."""
import hashlib
import random
import zlib

import pytest

from qrank.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, d long, rep string, bytes int, s0 int"


def plain(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = abs(c) // 5 * 5 * (1 if c >= 0 else -1)  # c - c % 5 with the sign of c
        built[c] = convs.get(base, [])[:h] + own[h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, totals = [], {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(totals[k][0] for k in kids.get(p, [])) or 1
        saved = sum(totals[k][1] for k in kids.get(p, [])) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        totals[p] = (leaves, saved)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(built[c]) == len(p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA)
    return sorted(map(tuple, trie.prefix_trie(df, **kw).collect()), key=repr)


def invented(rng, convs, longest, roles=("user", "assistant"), words=2):
    return [(c, t, roles[t % 2], f"w{rng.randrange(words)}é" * rng.randrange(3)) for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("height", [2, 3, 32])
def test_against_plain_prefixes(spark, height):
    rng = random.Random(height)
    rows = invented(rng, rng.sample(range(-12, 60), 50), 14)
    rng.shuffle(rows)
    assert run(spark, rows, height=height) == plain(rows)


def test_awkward_rows(spark):
    rows = [(3, None, None, None), (3, None, "a", None), (3, 1, None, "x"), (3, 1, None, "x"), (3, 1, "a", "b"), (3, 0, "", "y"),
            (None, 1, "user", "lost"), (5, 2, "user", ""), (8, 0, "ab", "c"), (9, 0, "a", "bc"), (8, 1, "u", "t" * 300_000),
            (9, 1, "u", "t" * 300_000), (4, 7, "x", "\x00,\n"), (2 ** 40, 0, "a", "bc"), (2 ** 40, 0, "a", "bc")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[6:7]) == [] and run(spark, []) == []


def test_long_and_common_conversations(spark, monkeypatch):
    """Turns, sums and ids that are cut into pieces and carried on; one conversation holds most rows."""
    monkeypatch.setattr(trie, "PIECE", 7)
    monkeypatch.setattr(trie, "RUN", 5)
    rows = [(0, t, "user", f"t{t % 11}") for t in range(700)] + [(1, t, "user", f"t{t % 11}") for t in range(650)]
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]
    assert run(spark, rows, height=4) == plain(rows)
