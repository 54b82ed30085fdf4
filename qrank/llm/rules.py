"""Quality rules: document statistics, a base rule, and boosted trees with monotonic constraints.

Statistics come from one Arrow pass over whole texts.  The trees are fitted in
numpy on a bounded sample of labelled rows (``MAX_TRAIN``, those with the
smallest id hash), flattened into node arrays and applied to Arrow batches of
statistics, a whole batch per tree level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_unique",
         "n_top", "n_upper", "n_bang", "n_digits", "n_stops", "n_pipes")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "unique", "top", "upper", "bangs", "digits",
            "stops", "pipes")
#: -1: the score never rises with the feature; 1: never falls; 0: free.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1, "top": -1, "upper": -1, "bangs": -1, "pipes": -1}
MAX_TRAIN = 20_000
SPACE, SYMBOLS, UPPER, DIGITS = b" \t\n\v\f\r", b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


# ------------------------------------------------------------ statistics
def repeated_words(ids: np.ndarray, distinct: int, n: int = 3) -> int:
    """Words inside an ``n``-word window that occurs at least twice."""
    if len(ids) <= n:
        return 0
    key = ids[:len(ids) - n + 1]
    span = distinct
    for k in range(1, n):
        if span * distinct >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            span = int(key.max()) + 1
        key = key * distinct + ids[k:len(ids) - n + 1 + k]
        span *= distinct
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[at] > 1
    if not twice.any():
        return 0
    hit = np.zeros(len(ids), bool)
    for k in range(n):
        hit[k:len(ids) - n + 1 + k] |= twice
    return int(hit.sum())


def statistics(text: bytes | None) -> tuple[int, ...]:
    """``STATS`` of a text (null: as empty)."""
    text = text or b""
    words = text.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    lines, seen, dup = text.split(b"\n"), set(), 0
    for line in lines:
        if line.strip():
            if line in seen:
                dup += 1
            seen.add(line)
    gone = lambda some: len(text) - len(text.translate(None, some))
    chars = len(text.decode("utf-8", "replace"))
    return (n, chars - gone(SPACE), gone(SYMBOLS), dup, repeated_words(ids, len(number)), chars, len(lines), len(number),
            int(np.bincount(ids).max()) if n else 0, gone(UPPER), text.count(b"!"), gone(DIGITS),
            text.count(b".") + text.count(b",") + text.count(b"?"), text.count(b"|"))


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, *STATS) of each row."""

    def run(batches):
        for b in batches:
            rows = [statistics(t.as_py()) for t in b.column(1)]
            cols = np.array(rows, np.int64).reshape(-1, len(STATS)).T
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in cols)], ["doc_id", *STATS])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES`` from columns of ``STATS``."""
    words, chars, lines = (np.maximum(s[k], 1).astype(float) for k in ("n_words", "n_chars", "n_lines"))
    return np.column_stack([
        np.log(words), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words, s["n_unique"] / words, s["n_top"] / words, s["n_upper"] / chars, s["n_bang"] / words,
        s["n_digits"] / chars, s["n_stops"] / words, s["n_pipes"] / words])


# ------------------------------------------------------------ boosted trees
@dataclass
class Trees:
    """Trees as node arrays (one row per tree; children of node i: 2i + 1 and 2i + 2)."""

    feature: np.ndarray  # (trees, inner nodes); -1: go left
    cut: np.ndarray
    value: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of each row, all rows a level at a time."""
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                at = f[node]
                node = 2 * node + 1 + ((x[row, at] > c[node]) & (at >= 0))
            total += v[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: tuple[int, ...], trees: int = 60, depth: int = 3, rate: float = 0.2,
              bins: int = 48, least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Logistic gradient boosting on histograms.

    A split against a feature's constraint is refused, and the middle of a
    constrained split's two values bounds all values below it, so every tree,
    and their sum, is monotonic in the constrained features.
    """
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.column_stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T)])
    inner = (1 << depth) - 1
    out = Trees(np.full((trees, inner), -1), np.zeros((trees, inner)), np.zeros((trees, inner + 1)), 0.0)
    total = np.zeros(len(y))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        bound = {0: (-np.inf, np.inf)}
        for i in range(inner):
            low, high = bound[i]
            mine = np.flatnonzero(node == i)
            best = (1e-9, -1, 0, (low, high), (low, high))
            value = lambda a, b: np.clip(a / (b + ridge), low, high)
            gain = lambda a, b, v: 2 * a * v - (b + ridge) * v * v
            whole = gain(g[mine].sum(), h[mine].sum(), value(g[mine].sum(), h[mine].sum()))
            for f, q in enumerate(cuts):
                if not len(q) or not len(mine):
                    continue
                gs = np.cumsum(np.bincount(code[mine, f], g[mine], len(q) + 1))
                hs = np.cumsum(np.bincount(code[mine, f], h[mine], len(q) + 1))
                gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
                vl, vr = value(gl, hl), value(gr, hr)
                won = gain(gl, hl, vl) + gain(gr, hr, vr) - whole
                won[(hl < least) | (hr < least) | (monotone[f] * (vr - vl) < 0)] = -1
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    mid = (vl[k] + vr[k]) / 2
                    left, right = ((low, mid), (mid, high)) if monotone[f] > 0 else ((mid, high), (low, mid)) \
                        if monotone[f] < 0 else ((low, high), (low, high))
                    best = (won[k], f, k, left, right)
            _, f, k, left, right = best
            bound[2 * i + 1], bound[2 * i + 2] = left, right
            out.feature[t, i] = f
            if f >= 0:
                out.cut[t, i] = cuts[f][k]
            node[mine] = 2 * i + 1 + ((code[mine, f] > k) if f >= 0 else 0)
        for leaf in range(inner + 1):
            mine = node == inner + leaf
            low, high = bound[inner + leaf]
            v = rate * float(np.clip(g[mine].sum() / (h[mine].sum() + ridge), low, high)) if mine.any() else 0.0
            if not mine.any() and np.isfinite([low, high]).any():
                v = rate * float(np.clip(0.0, low, high))
            out.value[t, leaf] = v
            total[mine] += v
    return out


def pick_threshold(score: np.ndarray, y: np.ndarray, keep_weight: float = 2.0) -> float:
    """The threshold with the best weighted share of good rows kept and bad rows dropped (ties: nearest 0.5)."""
    grid = np.linspace(0.02, 0.98, 97)
    won = [(keep_weight * (score[y == 1] >= t).mean() + (score[y == 0] < t).mean()) for t in grid]
    best = max(won)
    return float(min((t for t, w in zip(grid, won) if w > best - 1e-9), key=lambda t: abs(t - 0.5)))


# ------------------------------------------------------------ operator
def label_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, quality, toxic): one row per id; of repeated labels the worst counts, nulls do not."""
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, *STATS, base_failed, score, kept) of each row of ``docs``.

    base_failed: fewer than 50 words, or over half of the words repeat.
    kept: not base_failed and a tree score of at least the threshold; where no
    usable labels exist (none, or of one kind) the base rule alone decides and
    the score is null.  Null and empty texts have no words and fail.  Repeated
    rows each get a row; null ids are scored like others but never train.
    Other columns are not read.
    """
    stats = materialize(document_stats(docs, id_col, text_col), "stats")
    known = label_rows(labels).where(F.col("quality").isNotNull()).select("doc_id", "quality")
    sample = (stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), *STATS).limit(max_train)).toArrow()
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stats.withColumn("base_failed", base)
    y = (sample["quality"].to_numpy() >= 1).astype(int)
    if len(set(y)) < 2:
        return rows.withColumn("score", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    x = features({s: sample[s].to_numpy() for s in STATS})
    sign = tuple(MONOTONE.get(f, 0) for f in FEATURES)
    hold = np.arange(len(y)) % 4 == 3  # rows stand in hash order
    if min(len(set(y[hold])), len(set(y[~hold]))) == 2:
        cut = pick_threshold(fit_trees(x[~hold], y[~hold], sign).score(x[hold]), y[hold])
    else:
        cut = 0.5
    model = fit_trees(x, y, sign)

    def run(batches):
        for b in batches:
            col = {s: b.column(b.schema.get_field_index(s)).to_numpy() for s in STATS}
            score = model.score(features(col))
            bad = b.column(b.schema.get_field_index("base_failed")).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array(~bad & (score >= cut))],
                                             [*b.schema.names, "score", "kept"])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATS) + ", base_failed boolean, score double, kept boolean"
    return rows.mapInArrow(run, schema)
