"""Licence scan: neighbouring versions are told apart."""
import pytest

from qrank.llm import licences

FILL = " ".join(f"word{i} filler{i}" for i in range(40))
GPL = "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as " \
      "published by the Free Software Foundation{2} "
LATER = "either version {0} of the License, or (at your option) any later version."
BSD = licences._BSD
CASES = {
    GPL.format(":", "", ",") + LATER.format(3): "GPL-3.0-or-later",
    GPL.format(";", "", ";") + LATER.format(2): "GPL-2.0-or-later",
    GPL.format(";", "", ";") + "version 2.": "GPL-2.0",
    GPL.format(":", "", ",") + "version 3.": "GPL-3.0",
    GPL.replace("program", "library").format(";", "Library ", ";") + LATER.format(2): "LGPL-2.0-or-later",
    GPL.replace("program", "library").format(";", "Lesser ", ";") + LATER.format(2.1): "LGPL-2.1-or-later",
    GPL.format(":", "Lesser ", ",") + LATER.format(3): "LGPL-3.0-or-later",
    GPL.format(":", "Affero ", ",") + LATER.format(3): "AGPL-3.0-or-later",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    BSD: "BSD-2-Clause",
    licences.NOTICES["BSD-3-Clause"][1]: "BSD-3-Clause",
    licences.NOTICES["MIT-0"][0]: "MIT-0", licences.NOTICES["MIT"][2]: "MIT",
    licences.NOTICES["ISC"][1] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE": "ISC",
    licences.NOTICES["0BSD"][0]: "0BSD",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under CC BY 3.0.": "CC-BY-3.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": "CC-BY-SA-3.0",
    licences.NOTICES["MPL-1.1"][0]: "MPL-1.1", licences.NOTICES["MPL-2.0"][0]: "MPL-2.0", licences.NOTICES["CC0-1.0"][0]: "CC0-1.0",
}


def scan(*texts):
    return [",".join(sorted(x)) for x in licences.Scanner(licences.NOTICES).scan([t.encode() for t in texts], {})]


def test_neighbouring_versions():
    texts = [f"{FILL} {t} {FILL}" for t in CASES]
    assert dict(zip(CASES, scan(*texts))) == CASES
    assert dict(zip(CASES, scan(*CASES))) == CASES


def test_several_notices_of_one_text():
    two = GPL.format(";", "", ";") + LATER.format(2)
    three = GPL.format(":", "", ",") + LATER.format(3)
    assert scan(f"{two} {three}", f"{three} {FILL} {two}") == ["GPL-2.0-or-later,GPL-3.0-or-later"] * 2
    assert scan("Released under the MIT License. Licensed under the Apache License, Version 2.0.") == ["Apache-2.0,MIT"]
    assert scan(two.replace("version 2", "version x")) == ["GPL-2.0-or-later,GPL-3.0-or-later"]  # nothing tells which


@pytest.mark.parametrize("name", sorted(licences.NOTICES))
def test_each_notice_is_found_as_itself(name):
    assert scan(*(f"{FILL} {t} {FILL}" for t in licences.NOTICES[name])) == [name] * len(licences.NOTICES[name])


# ------------------------------------------------------------ templates of any length
def long_texts():
    import random
    rng = random.Random(4)
    words = [f"w{i}" for i in range(700)]
    base = rng.choices(words, k=4000)
    other = base[:2500] + rng.choices(words, k=1500)  # a version that shares its first part
    return {"LONG-1.0": [" ".join(base)], "LONG-2.0": [" ".join(other)], "MID": [" ".join(rng.choices(words, k=300))], "TINY": ["one line of five words"]}


def test_band_count_follows_the_length():
    """Every template meets a window that holds just enough of it, with the stated probability."""
    assert licences.level_of(1) == licences.level_of(8) == 0 and licences.level_of(9) == 1 and licences.level_of(4000) == 9
    for n in (1, 5, 8, 9, 60, 300, 4000, 50_000):
        k = -(-4 * n // 5)
        low = k / (2 * (8 << licences.level_of(n)) + n - k)
        b = licences.bands_for(n)
        assert b <= licences.BANDS and (1 - low) ** b <= 1.001 * licences.MISSED
    assert licences.bands_for(1) > 100 > 45 > licences.bands_for(4000)


def test_whole_licence_texts_as_a_table(spark):
    import random
    rng = random.Random(9)
    texts = long_texts()
    t = spark.createDataFrame([(k, v, "x") for k, vs in texts.items() for v in vs] + [(None, "lost", "x"), ("NULL", None, "x")],
                              "identifier string, text string, doc_id string")
    body = texts["LONG-1.0"][0].split()
    damaged = [w if rng.random() > 0.02 else "damaged" for w in body]  # some 90 % of the shingles stay
    fill = [f"f{i}" for i in range(5000)]
    rows = [(1, " ".join(fill + body + fill)), (2, " ".join(fill[:37] + damaged)), (3, texts["LONG-2.0"][0].upper()), (4, " ".join(body[:2000])),
            (5, "see: one line of five words! " + texts["MID"][0]), (6, None), (7, ""), (8, " ".join(fill))]
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), t).collect()}
    assert [got[i].licences for i in range(1, 9)] == ["LONG-1.0", "LONG-1.0", "LONG-2.0", "", "MID,TINY", "", "", ""]
    span = got[1].spans[0]
    assert (span.licence, span.first_word, span.n_words, span.containment) == ("LONG-1.0", 5000, 4000, 1.0)
    assert 0.8 <= got[2].containment < 1 and got[2].spans[0].first_word >= 37 and 3900 < got[2].spans[0].n_words <= 4000
    assert [(s.licence, s.first_word, s.n_words) for s in got[5].spans] == [("MID", 6, 300), ("TINY", 1, 5)]
    with pytest.raises(ValueError):
        licences.template_texts(t, max_bytes=1000)


def test_notices_by_brute_force(spark):
    """Every text is compared with every notice at every place, for the notices that the query seeks."""
    from . import data
    notices = [(n, t) for n, ts in licences.NOTICES.items() for t in ts]
    texts = [r[1] for r in data.rows()][:60] + [f"{FILL} {t} {FILL}" for _, t in notices[::5]]
    found = licences.Scanner(licences.NOTICES).scan([(t or "").encode() for t in texts], {})
    for text, got in zip(texts, found):
        have = set(licences.shingles_of(licences.words_of((text or "").encode())))
        share = {}
        for n, t in notices:
            want = set(licences.shingles_of(licences.words_of(t.encode())))
            share[n] = max(share.get(n, 0), len(want & have) / len(want))
        over = {n for n, x in share.items() if x >= 0.8}
        assert set(got) <= over and bool(got) == bool(over)
        assert all(got[n][0] <= share[n] + 1e-9 for n in got)
