"""Column expressions for document and topic text clean-up.

Used as stages of the ingest and topic jobs (whole collections at once):
tag extraction and cleaning, year extraction, query sanitizing, topic
sections, negated-sentence removal and date expansion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from query text (query-syntax operators).
QUERY_SPECIAL = r'[+\-!(){}\[\]^"~*?\\/]|&&|\|\|'
# Fixed value: years 1700-2099, optionally a decade ('1990s').
YEAR_RE = r"(?i)\b(17\d{2}|18\d{2}|19\d{2}|20\d{2})(s?)\b"


def extract_tag(doc: Column, tag: str, clean: bool = True) -> Column:
    """Body of the first <tag>...</tag>; NULL when the tag is absent.

    Cleaning (in this order): comments ``<!--...-->`` (single line) to a
    space, drop ``<P>``/``</P>``, any tag containing an F (``<F P=100>``)
    to a space, newlines to spaces.
    """
    pat = f"(?s)<{tag}>(.*?)</{tag}>"
    body = F.regexp_extract(doc, pat, 1)
    if clean:
        body = F.regexp_replace(body, r"<!--.*?-->", " ")
        body = F.regexp_replace(body, r"</?P>", "")
        body = F.regexp_replace(body, r"<.*?F.*?>", " ")
        body = F.regexp_replace(body, r"\n", " ")
    return F.when(doc.rlike(f"(?s)<{tag}>.*?</{tag}>"), body)


def remove_pjg(doc: Column) -> Column:
    """Drop ``<!-- PJG ... -->`` comments, also across lines."""
    return F.regexp_replace(doc, r"(?s)<!-- PJG.*?-->", "")


def extract_year(c: Column) -> Column:
    """First 4-digit year 1xxx as text; the string 'null' when none."""
    y = F.regexp_extract(F.coalesce(c, F.lit("")), r"\b1\d{3}\b", 0)
    return F.when(y == "", F.lit("null")).otherwise(y)


def ft_year(c: Column) -> Column:
    """Two-digit year prefix of a yymmdd date, as '19yy'."""
    return F.concat(F.lit("19"), F.substring(c, 1, 2))


def sanitize_query(c: Column) -> Column:
    """Remove query-syntax characters; newline/tab to space; ':' to space."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\n\t]", " ")
    c = F.regexp_replace(c, QUERY_SPECIAL, "")
    return F.regexp_replace(c, ":", " ")


def drop_negated(narr: Column) -> Column:
    """Remove sentences containing 'not relevant' (case-insensitive)."""
    sentences = F.split(F.coalesce(narr, F.lit("")), r"(?<=[.!?])\s+")
    kept = F.filter(sentences, lambda s: ~F.lower(s).contains("not relevant"))
    return F.array_join(kept, " ")


def topic_dates(text: Column) -> Column:
    """Years in the text joined by ', ' (a decade gives ten years); 'null' when
    there are none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(YEAR_RE), 0)
    years = F.flatten(F.transform(found, lambda m: F.when(
        F.lower(m).endswith("s"),
        F.transform(F.sequence(F.substring(m, 1, 4).cast("int"), F.substring(m, 1, 4).cast("int") + 9),
                    lambda y: y.cast("string")))
        .otherwise(F.array(m))))
    return F.when(F.size(years) == 0, F.lit("null")).otherwise(F.array_join(years, ", "))
