"""Spelling variants against all single edits; the index against plain string search."""
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from qrank.llm import spelling
from tests.llm import data


def plain(rows, shortest=7, least=2, ratio=10, every=31):
    n = Counter()
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in low).split():
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    cuts = {}
    for w in n:
        for i in range(len(w)):
            cuts.setdefault(w[:i] + w[i + 1:], []).append((i, w))
    near = {w: set() for w in n}
    for short, found in cuts.items():
        for i, w in found:
            near[w] |= {u for j, u in found if i == j and u != w}
            if short in near:
                near[w].add(short), near[short].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda u: (-n[u], u), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def run(df, **kw):
    return sorted(map(tuple, spelling.variant_groups(df, **kw).collect()))


def variants(rng, words, alphabet):
    out = list(words)
    for w in words:
        for _ in range(3):
            k = rng.randrange(len(w))
            out.append(rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:]]))
    return out


def test_search_by_all_edits():
    rng = random.Random(1)
    for alphabet in ("ab", "abé×", "abcdefgÿ"):
        for _ in range(12):
            words = sorted({"".join(rng.choices(alphabet, k=rng.randint(7, 10))) for _ in range(rng.randint(1, 250))})
            want = set()
            for w in words:
                for i in range(len(w) + 1):
                    want |= {(w, w[:i] + c + w[i:]) for c in alphabet} | ({(w, w[:i] + w[i + 1:])} if i < len(w) else set())
                    want |= {(w, w[:i] + c + w[i + 1:]) for c in alphabet} if i < len(w) else set()
            want = {(w, u) for w, u in want if u != w and u in set(words)}
            got = [(words[q], words[u]) for side in (0, 1) for q, u in spelling.near_in_bucket(side, words, words)]
            assert len(got) == len(set(got)) and set(got) == want


def test_index_counts_and_steps():
    words = ["banana", "bananas", "ananas", "band"]
    alphabet = np.unique(np.frombuffer((spelling.DELIMITER + "".join(words)).encode("utf-32-le"), np.uint32))
    index = spelling.Bidirectional(words, alphabet)
    text = spelling.DELIMITER + spelling.DELIMITER.join(words) + spelling.DELIMITER
    count = lambda s: sum(text.startswith(s, i) for i in range(len(text)))
    for pattern in ("ana", "nan", "b", "band", "xyz"[:0] + "s\x01a", "nab"):
        lo, other, size = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([index.size])
        for s in spelling.symbols(pattern, alphabet)[::-1]:
            lo, other, size = index.backward(np.array([s]), lo, other, size)
        assert size[0] == count(pattern)
        for c in "ans" if size[0] else "":
            assert index.forward(spelling.symbols(c, alphabet), other, size)[1][0] == count(pattern + c)
    seq = np.array([3, 1, 2, 2, 0, 3, 1, 1])
    ranks = spelling.Ranks(seq, 4)
    for c in range(4):
        for i in range(len(seq) + 1):
            n, less = ranks.count(np.array([c]), np.array([i]), True)
            assert (n[0], less[0]) == ((seq[:i] == c).sum(), (seq[:i] < c).sum())


def test_suffix_array():
    rng = np.random.default_rng(2)
    for text in ([0], [1, 0], [1] * 50 + [0], [*rng.integers(1, 4, 300), 0], [*([1, 2] * 200), 0]):
        text = np.array(text, np.int64)
        assert list(spelling.suffix_array(text)) == sorted(range(len(text)), key=lambda i: list(text[i:]))


@pytest.mark.parametrize("chars", [60, 2000, 1 << 18])
def test_against_all_edits(spark, chars):
    """Buckets, and halves that are dealt over a grid of pieces, give the same rows."""
    rng = random.Random(chars)
    words = variants(rng, ["".join(rng.choices("abcdeé", k=rng.randint(7, 11))) for _ in range(60)] +
                     ["prefix" + "".join(rng.choices("abcde", k=3)) for _ in range(40)], "abcdeé")
    rows = [(i if i % 9 else None, " ".join(rng.choices(words, weights=[40 if j < 100 else 1 for j in range(len(words))], k=300))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = run(df, chars=chars)
    assert got == plain(rows) and sum(r[1] is not None for r in got) > 5


def test_awkward_texts(spark):
    assert run(data.documents(spark)) == plain([(r[0], r[1]) for r in data.rows()])
    assert run(data.empty(spark)) == []
    rows = [(1, "Aaaaaaaa" * 500 + " Äpfelbäume äpfelbäume ÄPFELBÄUME×÷ÿ"), (1, "Aaaaaaaa" * 500), (2, "x" + "aaaaaaaa" * 500), (2, "x" + "aaaaaaaa" * 500)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), every=10 ** 9) == plain(rows, every=10 ** 9)


def test_blocks_cut_no_run():
    text = "ab cdé " * 50 + "x" * 40 + "--" + "y" * 9
    parts = list(spelling.text_blocks(text, 16))
    assert "".join(parts) == text and all(not (a[-1].isalpha() and b[0].isalpha()) for a, b in zip(parts, parts[1:]))


def test_chains_of_forms(spark):
    rows = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(19)] + [("other", "w05")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {f"w{i:02d}": "w19" for i in range(19)} | {"other": "w19"}
