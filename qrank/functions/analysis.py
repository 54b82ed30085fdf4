"""Text analysis as Spark jobs: tokenizers, token filters, analyzers.

An ``Analyzer`` is a tokenizer plus an ordered list of filters.  Filters
that are pure column expressions (lowercase, stop, apostrophe, elision)
run inside whole-stage codegen on token arrays; vocabulary filters
(porterstem, asciifolding) map each DISTINCT term once (``term_map``) and
the map is joined back to postings/query terms by Spark.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import cloudpickle

from ..plans.tables import written
from . import porter

# The 33-word English stop set of the search library.
STOP_WORDS = ("a an and are as at be but by for if in into is it no not of on or such that the their "
              "then there these they this to was will with").split()

# French article/pronoun prefixes removed by the elision filter.
ELISION_PREFIXES = ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu")

# Tokenizer patterns (documented approximations of the library grammars).
STANDARD_RE = r"[\p{L}\p{N}]+(?:['’.][\p{L}\p{N}]+)*"
CLASSIC_RE = (r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}.-]+\.[\p{L}]+"      # e-mail
              r"|(?:\p{L}\.){2,}"                                 # acronym A.B.C.
              r"|[\p{L}\p{N}]+(?:[-.&'’][\p{L}\p{N}]+)*")         # words, hosts, numbers
WIKI_MARKUP_RE = r"\[\[|\]\]|\{\{|\}\}|''+"

TOKENIZERS = ("standard", "whitespace", "classic", "wikipedia")
FILTERS = ("lowercase", "stop", "porterstem", "asciifolding", "apostrophe", "elision")
VOCAB_FILTERS = ("porterstem", "asciifolding")


@dataclass(frozen=True)
class Analyzer:
    tokenizer: str = "standard"
    filters: tuple = ("lowercase", "stop", "porterstem", "asciifolding")
    stop_words: tuple = field(default=tuple(STOP_WORDS))

    def __post_init__(self):
        if self.tokenizer not in TOKENIZERS:
            raise ValueError(f"unknown tokenizer {self.tokenizer}")
        for f in self.filters:
            if f not in FILTERS:
                raise ValueError(f"unknown filter {f}")

    @property
    def name(self) -> str:
        return "+".join((self.tokenizer,) + tuple(self.filters))

    # -- column stage -------------------------------------------------
    def column_filters(self) -> tuple:
        """Filters applied on token arrays, in order, up to the first
        vocabulary filter; the remainder is applied by ``term_map``."""
        out = []
        for f in self.filters:
            if f in VOCAB_FILTERS:
                break
            out.append(f)
        return tuple(out)

    def vocab_filters(self) -> tuple:
        n = len(self.column_filters())
        return tuple(self.filters[n:])

    def tokens(self, text: Column) -> Column:
        """array<string> of tokens after the column-stage filters."""
        t = tokenize(text, self.tokenizer)
        for f in self.column_filters():
            t = apply_filter(t, f, self.stop_words)
        return t


def tokenize(text: Column, tokenizer: str) -> Column:
    text = F.coalesce(text, F.lit(""))
    if tokenizer == "standard":
        return F.regexp_extract_all(text, F.lit(STANDARD_RE), 0)
    if tokenizer == "whitespace":
        return F.filter(F.split(text, r"\s+"), lambda t: t != "")
    if tokenizer == "classic":
        return F.regexp_extract_all(text, F.lit(CLASSIC_RE), 0)
    if tokenizer == "wikipedia":
        return F.regexp_extract_all(F.regexp_replace(text, WIKI_MARKUP_RE, " "), F.lit(STANDARD_RE), 0)
    raise ValueError(tokenizer)


def apply_scalar(t: Column, name: str, stop_words=STOP_WORDS) -> Column:
    """One filter on one term; null where ``stop`` removes it."""
    if name == "lowercase":
        return F.lower(t)
    if name == "stop":
        return F.when(~t.isin(list(stop_words)), t)
    marked = t.contains("'") | t.contains("’")  # most terms need no pattern
    if name == "apostrophe":
        return F.when(marked, F.regexp_replace(t, r"['’].*$", "")).otherwise(t)
    if name == "elision":
        return F.when(marked, F.regexp_replace(t, "^(?i)(" + "|".join(ELISION_PREFIXES) + ")['’]", "")).otherwise(t)
    if name == "porterstem":
        return _porter_udf(t)
    if name == "asciifolding":
        return F.when(F.length(t) == F.octet_length(t), t).otherwise(fold_ascii(t))  # ASCII stays
    raise ValueError(f"unknown filter {name}")


def apply_filter(tokens: Column, name: str, stop_words=STOP_WORDS) -> Column:
    if name == "stop":
        return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))
    if name in VOCAB_FILTERS:
        raise ValueError(f"{name} is not a column filter")
    return F.transform(tokens, lambda t: apply_scalar(t, name))


# ASCII folding table built by rule: Latin letters U+00C0..U+024F whose
# canonical decomposition starts with an ASCII letter, plus ligatures.
def _fold_tables():
    src, dst, multi = [], [], {}
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        base = unicodedata.normalize("NFKD", ch)
        base = "".join(c for c in base if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    # Letters without a decomposition.
    for ch, rep in {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Ø": "O", "ø": "o",
                    "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d",
                    "ı": "i", "Ħ": "H", "ħ": "h"}.items():
        if len(rep) == 1:
            src.append(ch)
            dst.append(rep)
        else:
            multi[ch] = rep
    return "".join(src), "".join(dst), multi


_FOLD_SRC, _FOLD_DST, _FOLD_MULTI = _fold_tables()


def fold_ascii(t: Column) -> Column:
    out = F.translate(t, _FOLD_SRC, _FOLD_DST)
    for ch, rep in _FOLD_MULTI.items():
        out = F.replace(out, F.lit(ch), F.lit(rep))
    return out


_FOLD = str.maketrans(_FOLD_SRC, _FOLD_DST)


def fold_ascii_py(s: str) -> str:
    if s.isascii():
        return s
    s = s.translate(_FOLD)
    for ch, rep in _FOLD_MULTI.items():
        s = s.replace(ch, rep)
    return s


# -- vocabulary stage --------------------------------------------------

# The stemmer module is shipped with the UDF by value, so Python workers do
# not need the library installed or on their path.
cloudpickle.register_pickle_by_value(porter)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_porter_udf = F.pandas_udf(porter.stem_series, T.StringType())


#: Vocabulary filters that :func:`final_form` knows.
PER_TOKEN = frozenset(VOCAB_FILTERS)


def final_form(filters: tuple):
    """The vocabulary ``filters`` (each in ``PER_TOKEN``) as a function of one token; None without any."""
    steps = [{"porterstem": porter.stem, "asciifolding": fold_ascii_py}[f] for f in filters]

    def final(token):
        for step in steps:
            token = step(token)
        return token
    return final if steps else None


def term_map(terms: DataFrame, analyzer: Analyzer, term_col: str = "term") -> DataFrame:
    """(term, out_term) for the distinct raw terms under the vocabulary
    filters of ``analyzer``; terms that a late ``stop`` removes have no row.  Stemming runs as an Arrow-batched pandas UDF
    once per distinct term; folding is a JVM expression."""
    # written: the filter on the UDF's result would else be pushed below the distinct, to every token
    vocab = written(terms.select(F.col(term_col).alias("term")).distinct(), "vocabulary")
    out = F.col("term")
    for f in analyzer.vocab_filters():
        out = apply_scalar(out, f, analyzer.stop_words)
    return vocab.select("term", out.alias("out_term")).where(F.col("out_term").isNotNull())


def analyze(df: DataFrame, id_col: str, fields: list[str], analyzer: Analyzer) -> DataFrame:
    """Token arrays per (id, field): columns id_col, field, tokens.
    Vocabulary filters are NOT applied here (see ``term_map``)."""
    stacked = df.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("_s"))
    return stacked.select(id_col, F.col("_s.field").alias("field"),
                          analyzer.tokens(F.col("_s.text")).alias("tokens"))
