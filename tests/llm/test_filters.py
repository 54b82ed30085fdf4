import hashlib
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from qrank.llm import decontam, langid, licences, resample, rules
from qrank.llm.common import LOWER

from . import data


# ------------------------------------------------------------ decontamination
def bench_rows():
    base = [r[1] for r in data.rows() if r[1] and len(r[1].split()) > 20]
    return [(10, " ".join(base[0].split()[5:20])), (2, base[1].upper()), (3, " ".join(base[2].split()[:9])), (4, "shared line"),
            (5, None), (6, ""), (7, base[1]), (7, base[1]), (8, "zzz yyy"), (9, "word"), (None, base[3])]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER).decode())


def brute_contamination(rows, bench):
    windows = {}
    for i, t in bench:
        w = words(t)
        m = min(10, len(w))
        for s in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + m]), set()).add(i)
    out = []
    for r in rows:
        w, hit, items = words(r[1]), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if (x := tuple(w[s:s + m])) in windows:
                    hit.update(range(s, s + m))
                    items |= windows[x]
        items = sorted(str(i) for i in items if i is not None)
        out.append((r[0], len(w), len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [500_000, 0])
def test_decontamination(spark, small, monkeypatch):
    monkeypatch.setattr(decontam.find_windows, "__defaults__", (small,))
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = decontam.contamination(data.documents(spark), bench).drop("_k1", "_k2")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_contamination(data.rows(), bench_rows())


def test_decontamination_edges(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = data.documents(spark)
    got = decontam.contamination(docs, none).collect()
    assert len(got) == len(data.rows()) and not any(r.contaminated for r in got)
    assert decontam.contamination(data.empty(spark), spark.createDataFrame(bench_rows(), "item_id long, text string")).count() == 0
    clean = decontam.clean(docs, spark.createDataFrame(bench_rows()[:3], "item_id long, text string"))
    bad = sum(r[-1] for r in brute_contamination(data.rows(), bench_rows()[:3]))
    assert clean.columns == docs.columns and clean.count() == len(data.rows()) - bad and bad


# ------------------------------------------------------------ quality rules
def brute_base(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {k for i, x in enumerate(win) if win.count(x) > 1 for k in (i, i + 1, i + 2)} if len(w) < 400 else None
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), hit


def test_statistics_by_brute_force():
    extra = ["a b c a b c d", "x x x x", "a b c", "#|<> & a\n#|<> & a\n\n", "ä ö ü ä ö ü"]
    for t in [r[1] for r in data.rows()] + extra:
        got, want = rules.statistics(t.encode() if t is not None else None), brute_base(t)
        assert got[:4] == want[:4]
        if want[4] is not None:
            assert got[4] == len(want[4])


def junk(i):
    rng = np.random.default_rng(i)
    return " ".join(f"w{rng.integers(500)}{c}" for c in rng.choice(list("#$%*"), 80))


def labelled(spark):
    import random
    rng = random.Random(5)
    rows = [(i, junk(i) if i % 3 == 0 else data.invented(rng, 120), "en", "s", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, int(i % 3 != 0), 0) for i in range(0, 240)] + [(3, 1, 0), (4, None, 0), (None, 0, 0), (9999, 0, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_rules_learn_and_are_monotone(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in rules.quality_rules(docs, labels).collect()}
    assert len(got) == 300 and all(got[i].kept == (i % 3 != 0) for i in range(240, 300))
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] + 0.3 * rng.random(600) < 0.6) & (x[:, 1] > 0.2)).astype(int)
    model = rules.fit_trees(x, y, (-1, 0, 1), trees=25)
    grid = np.linspace(0, 1, 50)
    for _ in range(40):
        p = np.repeat(rng.random((1, 3)), 50, axis=0)
        for f, s in ((0, -1), (2, 1)):
            q = p.copy()
            q[:, f] = grid
            assert (s * np.diff(model.score(q)) >= -1e-12).all()
    walked = []
    for row in x[:50]:  # node arrays against a plain walk
        t = model.base
        for f, c, v in zip(model.feature, model.cut, model.value):
            n = 0
            while n < len(f):
                n = 2 * n + (2 if f[n] >= 0 and row[f[n]] > c[n] else 1)
            t += v[n - len(f)]
        walked.append(1 / (1 + np.exp(-t)))
    assert np.allclose(model.score(x[:50]), walked)


def test_quality_rules_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rules.quality_rules(data.documents(spark), none).collect()
    assert len(got) == len(data.rows()) and all(r.kept != r.base_failed and r.score is None for r in got)
    _, labels = labelled(spark)
    assert rules.quality_rules(data.documents(spark), labels).count() == len(data.rows())
    assert rules.quality_rules(data.empty(spark), labels).count() == 0


# ------------------------------------------------------------ importance resampling
def test_resampling_keeps_target_like_rows(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in resample.importance_resample(docs, labels).collect()}
    right = sum(got[i].kept == (i % 3 != 0) for i in range(300))
    assert len(got) == 300 and right >= 290
    k = sum(r.kept for r in got.values())
    assert {r.doc_id for r in sorted(got.values(), key=lambda r: -r.gumbel_key)[:k]} == {r.doc_id for r in got.values() if r.kept}
    kept = resample.keep_resampled(docs, labels)
    assert kept.columns == docs.columns and kept.count() == k


def test_resampling_edges(spark):
    _, labels = labelled(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in resample.importance_resample(data.documents(spark), none).collect())
    assert resample.importance_resample(data.documents(spark), labels).count() == len(data.rows())
    assert resample.importance_resample(data.empty(spark), labels).count() == 0


def test_weights_by_brute_force(spark):
    texts = [("a b a c " * 60, True), ("a b !! c " * 50, False), ("", True), (None, False), ("z z z", True), ("bad " * 90, False)]
    parts = [resample.buckets((t or "").encode(), {}) for t, _ in texts]
    n = resample.UNI + resample.BI
    raw = np.bincount(np.concatenate(parts), minlength=n)
    target = np.bincount(np.concatenate([p for p, (_, g) in zip(parts, texts) if g]), minlength=n)
    counts = resample.bucket_counts(spark.createDataFrame(texts, "t string, good boolean").selectExpr("cast(t as binary) t", "good"))
    got = {r.bucket: (r.raw, r.target) for r in counts.collect()}
    assert got == {b: (raw[b], target[b]) for b in np.flatnonzero(raw)}
    want = np.zeros(n)
    for s in (slice(0, resample.UNI), slice(resample.UNI, n)):
        e = raw[s] * target[s].sum() / raw[s].sum()
        w = np.log((target[s] + resample.SMOOTH) / (e + resample.SMOOTH))
        want[s] = np.where(np.abs(target[s] - e) > resample.Z * np.sqrt(e + 1), w, 0)
    assert np.allclose(resample.bucket_weights(counts), want, atol=1e-5) and (want < 0).any() and (want > 0).any()
    assert (resample.buckets(b"A B", {}) == resample.buckets(b"a b", {})).all()


def test_cut_and_noise(spark):
    """The cut weighs low quality and toxic rows apart and keeps the clean share; the noise decides between the classes."""
    rng = np.random.default_rng(2)
    w = np.r_[rng.normal(0.4, 0.15, 4000), rng.normal(-3, 1, 900), rng.normal(-0.5, 0.3, 100)]
    good, toxic = np.arange(5000) < 4000, np.arange(5000) >= 4900
    chance = lambda t, x: 1 - np.exp(-np.exp(np.minimum((x - t) / 0.05, 50)))
    cut = resample.choose_cut(w, good, toxic, 0.05, 0.99)
    assert chance(cut, w[good]).mean() >= 0.99 and chance(cut, w[toxic]).mean() < 0.2 and chance(cut + 0.05, w[good]).mean() < 0.99
    assert resample.choose_cut(w[good], good[good], toxic[good], 0.05, 0.99) == 0.0
    assert chance(resample.choose_cut(w, good, toxic, 0.05, 1 - 1e-9), w[good]).mean() > 0.999
    rows = spark.createDataFrame([(i, i, i, float(x)) for i, x in enumerate(w)], "doc_id long, _k1 long, _k2 long, log_weight double")
    u = (F.pmod(F.xxhash64("_k1"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    got = resample._top(rows.withColumn("gumbel_key", F.col("log_weight") / 0.05 - F.log(-F.log(u))),
                        1 - F.exp(-F.exp((F.col("log_weight") - cut) / 0.05))).toPandas()
    k = round(chance(cut, w).sum())
    plain = set(np.argsort(-w)[:k])
    assert got.kept.sum() == k and 5 < len(plain - set(got[got.kept].doc_id)) < 0.05 * k


@pytest.mark.parametrize("k", [1, 2, 7, 50, 99, 100])
def test_kth_largest(spark, k):
    values = [round(float(x), 3) for x in np.random.default_rng(3).normal(size=90)] + [0.5] * 10
    df = spark.createDataFrame([(v,) for v in values], "key double")
    edge, above = resample.kth_largest(df, k)
    assert edge == sorted(values)[-k] and above == sum(v > edge for v in values)


# ------------------------------------------------------------ language id
def test_language_id(spark):
    import random
    rng = random.Random(1)
    parts = {"en": ["the", "ing", "er"], "de": ["sch", "ung", "ä"], "fr": ["eau", "que", "é"]}
    rows = []
    for i in range(360):
        lang = ["en", "de", "fr"][i % 3]
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(60))
        rows.append((i, text, lang if i % 10 else None, "s", 1))
    rows += [(1000, None, "en", "s", 1), (1001, "123 !!!", "en", "s", 1), (1002, "", "en", "s", 1), (None, rows[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    import zlib
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is None:
            assert not r.held_out
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.lang_pred == ("und" if r.doc_id >= 1000 else ["en", "de", "fr"][r.doc_id % 3])


def test_language_id_edges(spark):
    assert langid.identify(data.documents(spark)).count() == len(data.rows())
    assert langid.identify(data.empty(spark)).count() == 0
    blind = data.documents(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(blind).collect()} == {"und"}


def test_ngrams_by_brute_force():
    texts = [b"Ab c", "é1x".encode(), b"", b"q"]
    b, t = langid.ngrams(texts)
    want = 0
    for x in texts:
        p = b" " + x.translate(langid.TABLE) + b" "
        for n in (2, 3, 4):
            want += sum(32 not in p[i + 1:i + n - 1] and not (n == 2 and p[i:i + 2] == b"  ") for i in range(len(p) - n + 1))
    assert len(b) == len(t) == want and b.max() < langid.BUCKETS


def test_texts_of_no_learned_language_are_rejected(spark):
    import random
    rng = random.Random(6)
    parts = {"en": ["the", "ing", "er", "on", "ly"], "de": ["sch", "ung", "ä", "ich", "en"], "fr": ["eau", "que", "é", "ou", "les"]}
    say = lambda some, n=60: " ".join("".join(rng.choices(some, k=rng.randint(1, 3))) for _ in range(n))
    names = sorted(parts)
    rows = [(i, say(parts[names[i % 3]]), names[i % 3]) for i in range(600)]
    foreign = ["日本語 文章 です", "Ελληνικά κείμενο εδώ", "русский текст здесь", "xqzj wvkx jjqz"]
    rows += [(1000 + i, say(foreign[i % 4].split()), None) for i in range(80)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=300, all_pieces=6_000).collect()
    known, unknown = [r for r in got if r.doc_id < 1000], [r for r in got if r.doc_id >= 1000]
    assert sum(r.rejected for r in unknown) >= 0.9 * len(unknown) and sum(r.rejected for r in known) <= 0.05 * len(known)


def test_every_language_is_learned(spark):
    import random
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"l{i:02d}" for i in range(80)]
    parts = {x: ["".join(rng.choices(letters, k=3)) for _ in range(4)] for x in names}
    say = lambda x, n: " ".join("".join(rng.choices(parts[x], k=2)) for _ in range(n))
    rows = [(i, say(names[i % 80], 25), names[i % 80]) for i in range(1600)]
    rows += [(i, say("l00", 15_000), "l00") for i in range(1600, 1660)]  # one language with very long texts
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)).collect()
    assert {r.lang_pred for r in got} == set(names)
    want = {i: x for i, _, x in rows}
    assert sum(r.lang_pred == want[r.doc_id] for r in got) >= 0.97 * len(rows)


def test_pieces_are_bounded_and_from_all_of_a_text(spark):
    text = "é" * 5000 + " word" * 3000
    some = langid.pieces_of(text.encode())
    assert max(map(len, some)) < 2 * langid.PIECE and b"".join(some).replace(b" ", b"") == text.replace(" ", "").encode()
    assert all(p.decode() for p in some)
    rows = [(i, " ".join(f"w{j}x{i}" for j in range(30_000)), "en") for i in range(30)]
    sample = langid.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    pieces, langs = langid.sampled_pieces(sample)
    assert set(langs) == {"en"} and 1000 < len(pieces) <= 4_000 + 30
    assert max(int(p.split()[-1][1:].split(b"x")[0]) for p in pieces) > 25_000


# ------------------------------------------------------------ licences
def brute_licences(text, templates):
    words = licences.words_of((text or "").encode())
    sh = licences.shingles_of(words)
    found = {}
    for name, some in templates.items():
        for t in some:
            want = licences.shingles_of(licences.words_of(t.encode()))
            size = licences.BLOCK
            while size < len(want):
                size *= 2
            for at in range(0, max(1, len(sh)), licences.BLOCK):
                share = len(set(want) & set(sh[at:at + 2 * size])) / len(set(want))
                if share >= 0.8:
                    found[name] = max(found.get(name, 0), share)
    return found


def test_licence_scan(spark):
    import random
    rng = random.Random(9)
    rows = []
    for i in range(150):
        parts = [data.invented(rng, rng.randint(0, 90))]
        for name in rng.sample(sorted(licences.TEMPLATES), rng.randint(0, 3)):
            t = rng.choice(licences.TEMPLATES[name]).split()
            if rng.random() < 0.4 and len(t) > 14:
                t[rng.randrange(len(t))] = "changed"
            parts += [" ".join(t), data.invented(rng, rng.randint(0, 60))]
        rows.append((i, "\n".join(parts), "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in licences.scan_licences(docs).collect()}
    for i, t, *_ in rows:
        want = brute_licences(t, licences.TEMPLATES)
        assert got[i].licences == ",".join(sorted(want)) and got[i].n_licences == len(want)
        assert got[i].containment == max(want.values(), default=0.0)


def test_licence_edges(spark):
    got = licences.scan_licences(data.documents(spark)).collect()
    assert len(got) == len(data.rows()) and not any(r.n_licences for r in got)
    assert licences.scan_licences(data.documents(spark), {}).count() == len(data.rows())
    assert licences.scan_licences(data.empty(spark)).count() == 0
