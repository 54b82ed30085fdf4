"""Term-document similarity functions as Column expressions.

Every function maps the columns of a joined (query term, posting,
dictionary, field statistics) row to the term's score contribution:
``tf`` (term frequency in the field), ``dl`` (field length in tokens),
``df``/``cf`` (document / collection frequency of the term in the field),
``N`` (documents having the field), ``avgdl`` and ``sum_dl``.
Scores are summed per (query, document) - all four are linear in the
query-side weight, which is what makes the parameter sweeps cheap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

col = F.col

# Default parameters (tuned BM25 of the default run, and the
# library defaults used by the expanded-query search).
BM25_TUNED = (0.6, 0.7)
BM25_DEFAULT = (1.2, 0.75)


def doc_len(quantize: bool = False) -> Column:
    """Field length; optionally rounded to the 1-byte length encoding
    (lengths above 40 lose precision) - exact by default."""
    dl = col("dl").cast("double")
    if not quantize:
        return dl
    # Small lengths are exact; larger ones keep 4 significant bits.
    bits = F.floor(F.log2(dl))
    step = F.pow(F.lit(2.0), F.greatest(bits - 3, F.lit(0.0)))
    return F.when(dl <= 40, dl).otherwise(F.floor(dl / step) * step)


def bm25(k1: float | Column = BM25_TUNED[0], b: float | Column = BM25_TUNED[1], quantize: bool = False) -> Column:
    k1 = F.lit(k1) if not isinstance(k1, Column) else k1
    b = F.lit(b) if not isinstance(b, Column) else b
    idf = F.log(1.0 + (col("N") - col("df") + 0.5) / (col("df") + 0.5))
    tf = col("tf").cast("double")
    return idf * tf / (tf + k1 * (1.0 - b + b * doc_len(quantize) / col("avgdl")))


def tfidf(idf_power: float = 1.0, quantize: bool = False) -> Column:
    idf = 1.0 + F.log((col("N") + 1.0) / (col("df") + 1.0))
    return F.sqrt(col("tf").cast("double")) * F.pow(idf, F.lit(idf_power)) / F.sqrt(doc_len(quantize))


def lm_dirichlet(mu: float | Column = 2000.0, quantize: bool = False) -> Column:
    mu = F.lit(mu) if not isinstance(mu, Column) else mu
    p = (col("cf") + 1.0) / (col("sum_dl") + 1.0)
    s = F.log(1.0 + col("tf") / (mu * p)) + F.log(mu / (doc_len(quantize) + mu))
    return F.greatest(s, F.lit(0.0))


def lm_jelinek_mercer(lmbda: float | Column = 0.7, quantize: bool = False) -> Column:
    lmbda = F.lit(lmbda) if not isinstance(lmbda, Column) else lmbda
    p = (col("cf") + 1.0) / (col("sum_dl") + 1.0)
    return F.log(1.0 + ((1.0 - lmbda) * col("tf") / doc_len(quantize)) / (lmbda * p))


@dataclass(frozen=True)
class Similarity:
    """A named similarity with parameters (a row of a sweep grid)."""

    kind: str = "bm25"
    p1: float = BM25_TUNED[0]
    p2: float = BM25_TUNED[1]

    def expr(self) -> Column:
        """The similarity as a column over matches."""
        args = {"tfidf": (), "lmd": (self.p1,), "lmj": (self.p1,)}.get(self.kind, (self.p1, self.p2))
        return REGISTRY[self.kind](*args)

    @property
    def name(self) -> str:
        if self.kind == "bm25":
            return f"bm25_k1={self.p1:g}_b={self.p2:g}"
        if self.kind == "tfidf":
            return "tfidf"
        if self.kind == "lmd":
            return f"lmd_mu={self.p1:g}"
        if self.kind == "lmj":
            return f"lmj_lambda={self.p1:g}"
        return f"{self.kind}_{self.p1:g}_{self.p2:g}"


REGISTRY = {"bm25": bm25, "tfidf": tfidf, "lmd": lm_dirichlet, "lmj": lm_jelinek_mercer}


def register_similarity(name: str, build) -> None:
    """Make ``build(p1, p2)``, a column over matches (tf, dl, df, cf, N, avgdl, sum_dl), available as
    ``Similarity(name, p1, p2)``.  A name is given once."""
    if name in REGISTRY:
        raise ValueError(f"similarity {name!r} exists")
    REGISTRY[name] = build
