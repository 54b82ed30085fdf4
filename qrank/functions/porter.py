"""Porter (1980) suffix-stripping stemmer for English.

A compact implementation of the published algorithm (steps 1a-5b), used
through ``stem_vocabulary``: a pandas UDF applied to the DISTINCT
vocabulary only (never per token), whose (term, stem) map is joined back
to postings by Spark.
"""

from __future__ import annotations

_VOWELS = frozenset("aeiou")


def _cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of VC sequences in ``stem``."""
    n, i, L = 0, 0, len(stem)
    while i < L and _cons(stem, i):
        i += 1
    while i < L:
        while i < L and not _cons(stem, i):
            i += 1
        if i >= L:
            break
        while i < L and _cons(stem, i):
            i += 1
        n += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


# Suffix rules of steps 2, 3 and 4 of the published algorithm.
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
          ("logi", "log")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

# The last letters of all suffixes of the rules, "y" and "ll" too: other words are their own stems.
_LAST = frozenset(x[-1] for x in [*(r[0] for r in _STEP2 + _STEP3), *_STEP4, "s", "eed", "ed", "ing", "y", "e", "ll"])
# The rules of a step by the last letter of their suffixes, in their order.
_STEP2, _STEP3 = ({c: [r for r in rules if r[0][-1] == c] for c in _LAST} for rules in (_STEP2, _STEP3))
_STEP4 = {c: [x for x in _STEP4 if x[-1] == c] for c in _LAST}


def _replace(w: str, rules, min_m: int) -> str:
    for suf, rep in rules.get(w[-1], ()) if w else ():
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if _m(stem) > min_m else w
    return w


def stem(word: str) -> str:
    """Stem one lower-case word."""
    w = word
    if len(w) <= 2 or w[-1] not in _LAST:
        return w
    # Step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # Step 1b
    extra = False
    if w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _m(w) == 1 and _cvc(w):
            w += "e"
    # Step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # Steps 2 and 3
    w = _replace(w, _STEP2, 0)
    w = _replace(w, _STEP3, 0)
    # Step 4
    for suf in _STEP4.get(w[-1], ()) if w else ():
        if w.endswith(suf):
            stem_ = w[: len(w) - len(suf)]
            if suf == "ion":
                if stem_ and stem_[-1] in "st" and _m(stem_) > 1:
                    w = stem_
            elif _m(stem_) > 1:
                w = stem_
            break
    # Step 5a
    if w.endswith("e"):
        s = w[:-1]
        if _m(s) > 1 or (_m(s) == 1 and not _cvc(s)):
            w = s
    # Step 5b
    if _m(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


def stem_series(s):
    """Entry point for a pandas UDF (Series of str -> Series of str); each
    distinct word of the batch is stemmed once."""
    memo = {}

    def one(x):
        if not isinstance(x, str):
            return x
        r = memo.get(x)
        if r is None:
            r = memo[x] = stem(x)
        return r
    return s.map(one)
