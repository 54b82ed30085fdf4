"""Licence scan: MinHash bands over overlapping word windows, then exact containment.

A document's word 5-shingles are cut into blocks of ``BLOCK``; a window is an
even power of two of blocks, and windows start at every block.  A template of c
shingles is sought in windows of 2L shingles, L the least multiple of BLOCK by
a power of two that holds it, so any place of the template lies in a window.
A window with k = 0.8 c of the template (rounded up) has a Jaccard similarity J of at
least k / (2L + c - k): 1/16 for a one-shingle template, 1/5 to 1/3 for long ones.
Bands hold one row, so with b of them a window meets its template with
probability 1 - (1 - J)^b; each template takes as many as its own J needs for
0.9997 (:func:`bands_for`: 126 for one shingle, some 20 to 40 for long texts), and each
place lies in two windows.  Every window so found is then compared shingle for
shingle.  Templates may be single sentences or whole licence texts.
Notices of neighbouring versions share most of their shingles, so each place
of a text counts for one notice only, the one of which it has most.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, materialize, slices

SHINGLE, BLOCK, BANDS, CONTAINED = 5, 8, 128, 0.8
#: Chance that a window with just enough of its template meets it in no band.
MISSED = 3e-4
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

#: Public licence notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "GPL-2.0-or-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation; either version 2 of "
                         "the License, or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_GNU = ("This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
        "License as published by the Free Software Foundation; ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.")
_MIT = (TEMPLATES["MIT"][1] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivs",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivs"}


def _gnu_notices() -> dict[str, list[str]]:
    """Headers and one-line notices of the GNU licences, "or later" and of one version."""
    out: dict[str, list[str]] = {"GPL-1.0-or-later": [_GNU.format(what="program", kind="")
                                                      + "either version 1, or (at your option) any later version."]}
    for short, kind, version in (("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "Library ", "2.0"), ("LGPL", "Lesser ", "2.1"),
                                 ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0")):
        v = version.removesuffix(".0")
        name, later = f"{short}-{version}", f"{short}-{version}-or-later"
        for what in ("program", "library") if short == "LGPL" else ("program",):
            head = _GNU.format(what=what, kind=kind)
            out.setdefault(later, []).append(head + f"either version {v} of the License, or (at your option) any later version.")
            out.setdefault(name, []).extend([head + f"version {v}.", head + f"version {v} of the License."])
        out[name] += [f"This work is licensed under the GNU {kind}General Public License, version {v}.",
                      f"you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License version {v} "
                      "as published by the Free Software Foundation"]
    return out


def _cc_notices() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for code, words in _CC.items():
        for version, area in (("3.0", "Unported"), ("4.0", "International")):
            w = words.replace("NoDerivs", "NoDerivatives") if version == "4.0" else words
            out[f"CC-{code}-{version}"] = [f"Licensed under CC {code} {version}.",
                                           f"This work is licensed under a Creative Commons {w} {version} {area} License."]
    return out


def _merged(*parts: dict[str, list[str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for part in parts:
        for name, texts in part.items():
            have = out.setdefault(name, [])
            have += [t for t in texts if words_of(t.encode()) not in [words_of(x.encode()) for x in have]]
    return out


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.translate(LOWER))


#: What is sought: ``TEMPLATES`` and their neighbours, the other versions and variants and the longer notices.
NOTICES = _merged(TEMPLATES, _gnu_notices(), _cc_notices(), {
    "0BSD": [TEMPLATES["ISC"][0] + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
             "THIS SOFTWARE"],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "BSD-2-Clause": [_BSD],
    "BSD-3-Clause": [_BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission."],
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide.", "Licensed under CC0 1.0 Universal."],
    "ISC": [TEMPLATES["ISC"][0] + ", provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": [_MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software."],
    "MIT-0": [_MIT + ". THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND"],
} | {f"MPL-{v}": [f"The contents of this file are subject to the Mozilla Public License Version {v} (the \"License\"); you may not use "
                  "this file except in compliance with the License. You may obtain a copy of the License at "
                  "http://www.mozilla.org/MPL/"] for v in ("1.0", "1.1")})


def shingles_of(words: list[bytes]) -> list[tuple[bytes, ...]]:
    """Word 5-shingles; a shorter text is one shingle; no word, none."""
    return list(zip(*(words[i:] for i in range(SHINGLE)))) or ([tuple(words)] if words else [])


def shingle_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """A 32-bit hash of each shingle."""
    from xxhash import xxh32_intdigest

    if len(known) > 300_000:
        known.clear()
    h = []
    for w in words:
        x = known.get(w)
        if x is None:
            x = known[w] = xxh32_intdigest(w)
        h.append(x)
    h = np.array(h, np.uint32)
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, np.uint32)
    for k in range(min(SHINGLE, len(h))):
        out = out * np.uint32(0x85EBCA6B) + h[k:k + n]
    out ^= out >> np.uint32(16)
    return out * np.uint32(0xC2B2AE35)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return rng.integers(1, 1 << 32, BANDS, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, BANDS, dtype=np.uint32)


def level_of(shingles: int) -> int:
    """The least level whose L = BLOCK << level holds a template of so many shingles."""
    return max(0, -(-shingles // BLOCK) - 1).bit_length()


def bands_for(shingles: int) -> int:
    """Bands that a template of so many shingles needs: a window of 2L with 0.8 of it stays
    unmet with probability ``MISSED`` at most."""
    least = int(np.ceil(CONTAINED * shingles))
    low = least / (2 * (BLOCK << level_of(shingles)) + shingles - least)
    return min(BANDS, int(np.ceil(np.log(MISSED) / np.log1p(-low))))


class Scanner:
    """Templates with their signatures, grouped by window size."""

    def __init__(self, templates: dict[str, list[str]]):
        self.mul, self.add = permutations()
        self.items = []  # (licence, shingle set, shingles)
        sizes: dict[int, list[int]] = {}
        mins = []
        for name in sorted(templates):
            for text in templates[name]:
                words = words_of(text.encode())
                some = set(shingles_of(words))
                if not some:
                    continue
                n = len(shingles_of(words))
                sizes.setdefault(level_of(n), []).append(len(self.items))
                self.items.append((name, some, n))
                h = shingle_hashes(words, {})
                mins.append((h[:, None] * self.mul + self.add).min(axis=0))
        self.levels = sorted(sizes.items())
        self.bands = [bands_for(n) for _, _, n in self.items]
        self.mins = np.array(mins, np.uint32).reshape(-1, BANDS)

    def candidates(self, hashes: list[np.ndarray]) -> set[tuple[int, int, int, int]]:
        """(document, first shingle, shingles of the window, template) where a band agrees."""
        most = 2 << (self.levels[-1][0] if self.levels else 0)  # blocks of the largest window
        size = np.array([max(most, -(-len(h) // BLOCK)) for h in hashes])
        flat = np.concatenate([np.r_[h, np.full(s * BLOCK - len(h), h[-1])] for h, s in zip(hashes, size)])  # repeats change no set
        doc = np.repeat(np.arange(len(hashes)), size)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
        left = np.repeat(size, size) - start  # blocks from here to the document's end
        hit: dict[tuple[int, int], np.ndarray] = {}
        for j in range(BANDS):
            x = flat * self.mul[j] + self.add[j]
            while len(x) > len(doc):
                x = np.minimum(x[0::2], x[1::2])
            width = 1
            for level, items in self.levels:
                while width < 2 << level:
                    x = np.minimum(x, np.r_[x[width:], x[-width:]])
                    width *= 2
                for i in (i for i in items if j < self.bands[i]):
                    at = np.flatnonzero(x == self.mins[i, j])
                    if len(at):
                        at = at[left[at] >= width]
                        key = (i, width)
                        hit[key] = np.union1d(hit[key], at) if key in hit else at
        return {(int(doc[a]), int(start[a]) * BLOCK, w * BLOCK, i) for (i, w), at in hit.items() for a in at}

    def scan(self, texts: list[bytes], known: dict[bytes, int]) -> list[dict[str, tuple[float, int, int]]]:
        """Licence -> (best containment, 0.8 or more; first word and number of words of that place) of each text."""
        words = [words_of(t) for t in texts]
        some = [i for i, w in enumerate(words) if w]
        found: list[dict[str, tuple[float, int, int]]] = [{} for _ in texts]
        if not some or not self.items:
            return found
        by_doc: dict[int, list[tuple[int, int, int]]] = {}
        for d, at, size, i in self.candidates([shingle_hashes(words[k], known) for k in some]):
            by_doc.setdefault(some[d], []).append((at, size, i))
        for k, places in by_doc.items():
            found[k] = self.chosen(words[k], places)
        return found

    def chosen(self, words: list[bytes], places: list[tuple[int, int, int]]) -> dict[str, tuple[float, int, int]]:
        """Licence -> best containment, and its place in words, among ``places`` (first shingle, window, template) of one text.

        The best match goes first (by shingles found in its tightest place, then by containment: a damaged "or later" header
        holds a higher share of the shorter one without) and takes the shingles of that place; another match counts if its
        window holds 0.8 of its template without taken shingles.  Equally good matches all count: nothing tells them apart.
        """
        ranked: dict[tuple[int, float], list[tuple[str, float, set, list, int, int, int]]] = {}
        for at, size, i in sorted(places):
            name, template, length = self.items[i]
            window = shingles_of(words[at:at + size + SHINGLE - 1])
            share = len(template & set(window)) / len(template)
            if share >= CONTAINED:
                first, most = tightest([x if x in template else None for x in window], length)
                ranked.setdefault((most, most / len(template)), []).append((name, share, template, window, at, at + first, length))
        taken: set[int] = set()
        best: dict[str, tuple[float, int, int]] = {}
        names = set()
        for key in sorted(ranked, reverse=True):
            taking: set[int] = set()
            for name, share, template, window, at, first, length in ranked[key]:
                if share > best.get(name, (0.0,))[0]:
                    mine = [j for j in range(first, min(first + length, at + len(window))) if window[j - at] in template]
                    best[name] = share, mine[0], min(mine[-1] + SHINGLE, len(words)) - mine[0]
                free = {x for j, x in enumerate(window, at) if j not in taken}
                if len(template & free) / len(template) >= CONTAINED:
                    names.add(name)
                    taking.update(range(first, first + length))
            taken |= taking
        return {x: best[x] for x in names}


def tightest(hits: list, length: int) -> tuple[int, int]:
    """Start of the first stretch of ``length`` entries with the most distinct ones but None, and how many."""
    held: dict = {}
    start, most = 0, -1
    for j in range(len(hits)):
        if hits[j] is not None:
            held[hits[j]] = held.get(hits[j], 0) + 1
        if j >= length and hits[j - length] is not None:
            held[hits[j - length]] -= 1
            if not held[hits[j - length]]:
                del held[hits[j - length]]
        if len(held) > most:
            start, most = max(0, j - length + 1), len(held)
    return start, most


def template_texts(templates: DataFrame, max_bytes: int = 64 << 20) -> dict[str, list[str]]:
    """A template table (identifier, text) as a dictionary; rows with a null are passed over.

    The texts travel to every task, so their size is checked before they come
    to the driver: beyond ``max_bytes`` that is an error.
    """
    some = materialize(templates.select("identifier", "text").where("identifier is not null and text is not null").distinct(), "templates")
    size = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"templates of {size} bytes; at most {max_bytes}")
    out: dict[str, list[str]] = {}
    for r in some.orderBy("identifier", "text").toArrow().to_pylist():
        out.setdefault(r["identifier"], []).append(r["text"])
    return out


def scan_licences(docs: DataFrame, templates: DataFrame | dict[str, list[str]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_licences, licences, containment, spans) of each row of ``docs``.

    licences: identifiers of the templates that a window contains to 0.8 or
    more by word 5-shingles, at each place of the text the one with most shingles there,
    sorted and comma-joined (none: empty); containment: the best of them
    (none: 0); spans: (licence, first_word, n_words, containment) of each,
    where its best place begins and how long it is, words counted from 0.
    ``templates`` is a table (identifier, text) of notices or whole licence
    texts of any length, or such a dictionary; without it the scan seeks
    ``NOTICES``.  See :func:`template_texts` for its bound.  Null, empty and
    wordless texts match nothing.  Repeated rows each get a row, null ids too;
    an empty table gives none; other columns are not read.
    """
    chosen = NOTICES if templates is None else templates if isinstance(templates, dict) else template_texts(templates)
    span = pa.struct([("licence", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])

    def run(batches):
        scanner, known = Scanner(chosen), {}
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(1)]
            found = [x for lo, hi in slices(texts, 1 << 20) for x in scanner.scan(texts[lo:hi], known)]
            spans = [[(n, x[n][1], x[n][2], x[n][0]) for n in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(sorted(x)) for x in found], pa.string()),
                 pa.array([max((v[0] for v in x.values()), default=0.0) for x in found], pa.float64()),
                 pa.array([[dict(zip(span.names, y)) for y in x] for x in spans], pa.list_(span))],
                ["doc_id", "n_licences", "licences", "containment", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
            .mapInArrow(run, "doc_id long, n_licences long, licences string, containment double, "
                             "spans array<struct<licence: string, first_word: long, n_words: long, containment: double>>"))
