"""The published suffix-stripping stemmer as DuckDB SQL, one CTE per step."""

from __future__ import annotations

# Suffix rules of steps 2, 3 and 4 of the published algorithm, restated.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
         "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
         "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
         "ous", "ive", "ize"]
# Letters that folding spells out.
LETTERS = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l",
           "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d", "ı": "i", "Ħ": "H", "ħ": "h"}


def classes(w: str) -> str:
    """A word with @ for each vowel and # for each consonant; y is a vowel behind a consonant."""
    x = f"regexp_replace(regexp_replace({w}, '[^aeiouy]', '#', 'g'), '[aeiou]', '@', 'g')"
    x = f"regexp_replace({x}, '^y', '#')"
    for _ in range(4):  # longer runs of y do not occur
        x = f"replace(replace({x}, '#y', '#@'), '@y', '@#')"
    return x


def cut(c: str, n: int) -> str:
    return f"left({c}, length({c}) - {n})"


def measure(c: str) -> str:
    return f"len(regexp_extract_all({c}, '@+#+'))"


def twin(w: str, c: str) -> str:
    return f"(length({w}) >= 2 and right({w}, 1) = substr({w}, length({w}) - 1, 1) and right({c}, 1) = '#')"


def short(w: str, c: str) -> str:
    return f"(length({w}) >= 3 and right({c}, 3) = '#@#' and right({w}, 1) not in ('w', 'x', 'y'))"


def rules(table: dict, least: int = 0) -> str:
    return "case " + " ".join(
        f"when w like '%{s}' then case when {measure(cut('c', len(s)))} > {least} then {cut('w', len(s))} || '{r}' else w end"
        for s, r in table.items()) + " else w end"


def stem_ctes(words: str, prefix: str = "ps") -> list[tuple[str, str]]:
    """CTEs whose last, ``<prefix>``, has (term, stem, folded) for the ``term`` column of the CTE ``words``."""
    step4 = "case " + " ".join(
        f"when w like '%{s}' then case when {measure(cut('c', len(s)))} > 1"
        + (f" and right({cut('w', len(s))}, 1) in ('s', 't')" if s == "ion" else "") + f" then {cut('w', len(s))} else w end"
        for s in STEP4) + " else w end"
    vowel = lambda n: f"contains({cut('c', n)}, '@')"
    e1 = cut("c", 1)
    stages = [
        ("case when w like '%sses' then " + cut("w", 2) + " when w like '%ies' then " + cut("w", 2)
         + " when w like '%ss' then w when w like '%s' then " + cut("w", 1) + " else w end", "false"),
        (f"case when w like '%eed' then case when {measure(cut('c', 3))} > 0 then {cut('w', 1)} else w end "
         f"when w like '%ed' and {vowel(2)} then {cut('w', 2)} when w like '%ing' and {vowel(3)} then {cut('w', 3)} else w end",
         f"w not like '%eed' and ((w like '%ed' and {vowel(2)}) or (w not like '%ed' and w like '%ing' and {vowel(3)}))"),
        (f"case when not more then w when w like '%at' or w like '%bl' or w like '%iz' then w || 'e' "
         f"when {twin('w', 'c')} and right(w, 1) not in ('l', 's', 'z') then {cut('w', 1)} "
         f"when {measure('c')} = 1 and {short('w', 'c')} then w || 'e' else w end", "false"),
        (f"case when w like '%y' and {vowel(1)} then {cut('w', 1)} || 'i' else w end", "false"),
        (rules(STEP2), "false"), (rules(STEP3), "false"), (step4, "false"),
        (f"case when w like '%e' and ({measure(e1)} > 1 or ({measure(e1)} = 1 and not {short(cut('w', 1), e1)})) then {cut('w', 1)} else w end", "false"),
        (f"case when {measure('c')} > 1 and {twin('w', 'c')} and w like '%l' then {cut('w', 1)} else w end", "false"),
    ]
    out = [(f"{prefix}0", f"select distinct term, term as w, false as more from {words}")]
    for i, (w, more) in enumerate(stages):
        out.append((f"{prefix}{i + 1}", f"select term, {w} as w, {more} as more from (select *, {classes('w')} as c from {prefix}{i})"))
    last = f"{prefix}{len(stages)}"
    stem = "case when length(term) <= 2 then term else w end"
    out.append((prefix, f"select term, stem, {folded('stem')} as folded from (select term, {stem} as stem from {last})"))
    return out


def folded(text: str) -> str:
    """Latin letters without their marks."""
    for a, b in LETTERS.items():
        text = f"replace({text}, '{a}', '{b}')"
    return f"strip_accents({text})"
