"""Small fixtures: documents with every awkward case, and columns that clash with internal names."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _k1 string, _row string, h long, "
          "pos string, start string, row long")


def invented(rng: random.Random, n: int, vocab: int = 4000) -> str:
    parts = ["ing", "the", "er", "on", "ly", "re", "st", "an", "ou", "é", "ß"]
    pick = lambda: "".join(random.Random(rng.randrange(vocab)).choices(parts, k=3))
    return " ".join(pick() for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(3)
    texts: list[str | None] = [invented(rng, n) for n in (0, 1, 2, 3, 9, 10, 40, 60, 80, 120, 300)]
    base = invented(rng, 150)
    texts += [base, base, base.upper(), base.replace(" ", "  \n"), base + " extra", "x " + base]
    shared = [f"shared line number {i} with some words" for i in range(4)]
    texts += ["\n".join([invented(rng, 12), shared[i % 4], "", "  ", shared[i % 4], invented(rng, 7)]) for i in range(24)]
    texts += [None, "", " ", "\n\n", "!!! ??? ...", "a\x00b\tc\r\nd", "word " * 5000, "ÀÉ é ß 中文 😀 words", "<|endoftext|> text"]
    texts += [invented(rng, 20_000, 10 ** 6)]
    out = [(i, t, ["en", "de", "fr", None][i % 4], f"s{i % 7}" if i % 11 else None, len(t or ""), "k", "r", i, "p", "s", i)
           for i, t in enumerate(texts)]
    out += [out[11], out[11], out[20], out[-1][:1] + ("another text of the same id",) + out[-1][2:]]  # repeated rows, an id twice
    out += [(None, base, "en", "s1", 1, "k", "r", 1, "p", "s", 1), (None, None, None, None, None, None, None, None, None, None, None)]
    return out


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
