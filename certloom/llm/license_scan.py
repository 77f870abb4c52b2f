"""License scans: winnowed template fingerprints, then banded alignment.

Templates (license texts and statements) and documents are cut into lower-cased words.  The smallest
k-gram hash of every window of ``window`` words is a fingerprint, so a template and a document that
share a run of ``window`` words share a fingerprint.  The templates' fingerprints form an inverted
index; each hit gives a template and a diagonal (where the template would start in the document).
Hits of one template on diagonals closer than the band are one candidate, which is aligned word by
word inside the band around its diagonal.  A match reports the template, the share of its words that
align in order (``coverage``, at least ``min_coverage``) and the word and byte span.  Coverage alone does
not tell GPL-2 from GPL-3, so a match must also hold the template's deciding words, one after the other
with nothing between: all words of a template of fewer than ``SHORT``, else its ``deciding`` phrases.
"Licence" counts as "license" there.

Templates are an argument of at most ``MAX_TEMPLATE_WORDS`` words in all, so the index that tasks get
is bounded; documents are scanned whole, one by one, and never shuffled.

Defined results: null and empty texts have no words and no match; a template of fewer than ``window`` words is
found by its whole hash; overlapping matches of one template keep the best (the earlier of equals); an opening
part (``PART_OF``) is not reported where the whole text is; rows that repeat an id, or have none, are scanned
each by itself; other columns pass through whatever their names, but one named like a result column gives way
to it; an empty table gives an empty result.
"""

from __future__ import annotations

from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T
from .decontamination import words_of

MAX_TEMPLATE_WORDS = 1_000_000
SHORT = 20

# Public license statements, notices and opening parts; the whole texts are files in
# ``licenses``.
TEMPLATES = {
    "mit-statement": "Released under the MIT License.",
    "apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-statement": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-statement": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3-statement": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3-statement": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-statement": "Licensed under the Mozilla Public License, Version 2.0.",
    "cc0-1.0-statement": "Licensed under CC0 1.0.",
    "cc-by-4.0-statement": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-statement": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-statement": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-statement": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-statement": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nd-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-nc-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nc-sa-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License."),
    "cc-by-nc-nd-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License."),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "gpl-3-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "gpl-2-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."),
    "lgpl-3-notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "agpl-3-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
} | {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted(
    files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}
#: Opening parts, not reported inside the whole text.
PART_OF = {"mit-grant": ("mit",), "isc-grant": ("isc",), "bsd-conditions": ("bsd-2-clause", "bsd-3-clause")}
#: Phrases of the longer templates that name license, version and kind.
DECIDING = {
    "apache-2.0": ("Apache License Version 2.0, January 2004",),
    "apache-2.0-notice": ("Licensed under the Apache License, Version 2.0", "licenses/LICENSE-2.0"),
    "artistic-1": ("The Artistic License Preamble",),
    "cc-by-sa-4.0": ("Attribution-ShareAlike 4.0 International",),
    "cc0-1.0": ("CC0 1.0 Universal",),
    "gfdl-1.2": ("GNU Free Documentation License Version 1.2",),
    "gfdl-1.3": ("GNU Free Documentation License Version 1.3",),
    "gpl-1": ("GNU GENERAL PUBLIC LICENSE Version 1",),
    "gpl-2": ("GNU GENERAL PUBLIC LICENSE Version 2",),
    "gpl-3": ("GNU GENERAL PUBLIC LICENSE Version 3",),
    "gpl-2-notice": ("GNU General Public License as published", "version 2 of the License"),
    "gpl-3-notice": ("GNU General Public License as published", "version 3 of the License"),
    "lgpl-2": ("GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June",),
    "lgpl-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1",),
    "lgpl-3": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3",),
    "lgpl-2.1-notice": ("GNU Lesser General Public License as published", "version 2.1 of the License"),
    "lgpl-3-notice": ("GNU Lesser General Public License as published", "version 3 of the License"),
    "agpl-3-notice": ("GNU Affero General Public License as published", "version 3 of the License"),
    "mpl-1.1": ("MOZILLA PUBLIC LICENSE Version 1.1",),
    "mpl-2.0": ("Mozilla Public License Version 2.0",),
    "mpl-2.0-notice": ("Mozilla Public License, v. 2.0",),
}
#: Lines that claim rights without naming a license; the registered query reports them too.
RESERVED = {"all-rights-reserved": "All rights reserved."}


def _words(text: str) -> np.ndarray:
    return words_of(*T.text_buffer(pa.array([text], pa.string())))[0]


LICENSE, LICENCE = _words("license licence")


def _folded(words: np.ndarray) -> np.ndarray:
    return np.where(words == LICENCE, LICENSE, words)


def winnow(values: np.ndarray, woff: np.ndarray, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (word index) and hashes of the fingerprints: the leftmost smallest k-gram hash of every
    window of ``size`` words."""
    if len(values) < size:
        return np.zeros(0, np.int64), np.zeros(0, T.U64)
    at = np.arange(len(values) - k + 1)
    grams = T.span_hash(T.span_sums(values), at, at + k)
    places = T.leftmost_min(grams, size - k + 1)[T.ranges(woff[:-1], np.maximum(np.diff(woff) - size + 1, 0))]
    if len(places):
        places = places[np.concatenate(([True], places[1:] != places[:-1]))]
    return places, grams[places]


class TemplateIndex:
    """Inverted index of template fingerprints (bounded by ``MAX_TEMPLATE_WORDS``), and the alignment."""

    def __init__(self, templates: dict[str, str], window: int, k: int, band: int, min_coverage: float,
                 deciding: dict[str, tuple[str, ...]]):
        names = sorted(templates)
        self.size, self.k, self.ids = window, k, names
        self.words, self.off = words_of(*T.text_buffer(pa.array([templates[n] for n in names], pa.string())))
        if len(self.words) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"more than {MAX_TEMPLATE_WORDS} template words")
        places, hashes = winnow(self.words, self.off, window, k)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], places[order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        length, sums = np.diff(self.off), T.span_sums(self.words)
        for n in np.unique(length[(length > 0) & (length < window)]).tolist():
            items = np.flatnonzero(length == n)
            h = T.span_hash(sums, self.off[items], self.off[items] + n)
            order = np.argsort(h, kind="stable")
            self.short[n] = h[order], items[order]
        self.band, self.min_coverage = band, min_coverage
        self.phrases = []
        for i, n in enumerate(names):
            whole = self.words[self.off[i]:self.off[i + 1]]
            told = [_words(x) for x in deciding.get(n, ())] + ([whole] if len(whole) < SHORT else [])
            self.phrases.append([_folded(x) for x in told])

    @staticmethod
    def _pairs(sorted_hashes, hashes):
        """(row of ``hashes``, entry of ``sorted_hashes``) of all equal pairs."""
        a = np.searchsorted(sorted_hashes, hashes, "left")
        n = np.searchsorted(sorted_hashes, hashes, "right") - a
        return np.repeat(np.arange(len(hashes)), n), T.ranges(a, n)

    def decided(self, words, item: int) -> bool:
        """Whether every deciding phrase of the template is in ``words``."""
        words = _folded(words)
        for phrase in self.phrases[item]:
            at = np.arange(max(len(words) - len(phrase) + 1, 0))
            for j, x in enumerate(phrase):
                at = at[words[at + j] == x]
            if not len(at):
                return False
        return True

    def candidates(self, values, woff):
        """(document, template, diagonal) sorted; the diagonal is a word index of the document."""
        places, hashes = winnow(values, woff, self.size, self.k)
        row, entry = self._pairs(self.hashes, hashes)
        p, q = places[row], self.places[entry]
        item = np.searchsorted(self.off, q, "right") - 1
        found = [(p, item, p - (q - self.off[item]))]
        sums = T.span_sums(values)
        for n, (known, items) in self.short.items():
            s = T.ranges(woff[:-1], np.maximum(np.diff(woff) - n + 1, 0))
            row, entry = self._pairs(known, T.span_hash(sums, s, s + n))
            found.append((s[row], items[entry], s[row]))
        p, item, diagonal = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = np.searchsorted(woff, p, "right") - 1
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal = doc[order], item[order], diagonal[order]
        if not len(doc):
            return doc, item, diagonal
        # a cluster runs over diagonals at most band / 2 from its first
        same = np.concatenate(([False], (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])))
        first, begin = [], None
        for i, (joined, d) in enumerate(zip(same.tolist(), diagonal.tolist(), strict=True)):
            if not joined or d - begin > self.band // 2:
                first.append(i)
                begin = d
        return doc[first], item[first], diagonal[first]

    def align(self, values, low, high, item: int, diagonal):
        """Banded alignment of one template with several places: (matched words, first, end)."""
        words = self.words[self.off[item]:self.off[item + 1]]
        width = 2 * self.band + 1
        j = diagonal[:, None] + np.arange(-self.band, self.band + 1)  # document word of each band cell
        # packed: matched words, then the latest first word, then the earliest last word
        shift1, shift2 = 40, 20
        origin = diagonal - self.band
        best = np.zeros((len(diagonal), width + 1), np.int64)
        mask = (1 << shift2) - 1
        for i, word in enumerate(words):
            at = j + i
            inside = (at >= low[:, None]) & (at < high[:, None])
            equal = np.zeros(at.shape, bool)
            equal[inside] = values[at[inside]] == word
            before = best[:, :width]
            rel = at - origin[:, None]
            grown = ((before >> shift1) + 1) << shift1
            first = np.where(before >> shift1 > 0, (before >> shift2) & mask, rel)
            taken = grown | (first << shift2) | (mask - rel)
            # best[:, b + 1] is the cell above at the same document word
            row = np.maximum(np.where(equal, taken, before), best[:, 1:])
            best[:, :width] = np.maximum.accumulate(row, axis=1)
        top = best[:, :width].max(axis=1)
        return top >> shift1, origin + ((top >> shift2) & mask), origin + mask - (top & mask) + 1

    def possible(self, values, woff, rows, doc, diagonal, item: int):
        """The rows whose reach holds as many words of the template as a match needs."""
        words = self.words[self.off[item]:self.off[item + 1]]
        need = self.min_coverage * len(words)
        lo = np.maximum(woff[doc[rows]], diagonal[rows] - self.band)
        hi = np.minimum(woff[doc[rows] + 1], diagonal[rows] + len(words) + self.band)
        rows, lo, hi = (x[hi - lo >= need] for x in (rows, lo, hi))
        if not len(rows):
            return rows
        first = lo.min()
        known = np.concatenate(([0], np.cumsum(np.isin(values[first:hi.max()], words))))
        return rows[known[hi - first] - known[lo - first] >= need]

    def matches(self, values, woff):
        """Per document: [(template, matched, coverage, first word, end word)] relative to it."""
        out = [[] for _ in range(len(woff) - 1)]
        doc, item, diagonal = self.candidates(values, woff)
        for t in np.unique(item).tolist():
            size = int(self.off[t + 1] - self.off[t])
            rows = self.possible(values, woff, np.flatnonzero(item == t), doc, diagonal, t)
            for lo in range(0, len(rows), 4096):
                r = rows[lo:lo + 4096]
                n, first, end = self.align(values, woff[doc[r]], woff[doc[r] + 1], t, diagonal[r])
                for i in np.flatnonzero(n >= self.min_coverage * size).tolist():
                    d = int(doc[r[i]])
                    # a last or first "licence" does not align
                    if not self.decided(values[max(first[i] - 1, woff[d]):min(end[i] + 1, woff[d + 1])], t):
                        continue
                    out[d].append((self.ids[t], int(n[i]), int(n[i]) / size, int(first[i] - woff[d]),
                                   int(end[i] - woff[d])))
        for d, found in enumerate(out):
            if len(found) > 1:
                kept = []
                for m in sorted(found, key=lambda m: (m[0], -m[2], m[3], m[4])):
                    if any(x[0] in PART_OF.get(m[0], ()) and m[3] < x[4] and x[3] < m[4] for x in found):
                        continue
                    if not any(m[0] == x[0] and m[3] < x[4] and x[3] < m[4] for x in kept):
                        kept.append(m)
                out[d] = sorted(kept, key=lambda m: (m[3], m[4], m[0]))
        return out


MATCH = "struct<template:string,matched:bigint,coverage:double,first_word:bigint,end_word:bigint,first_byte:bigint,end_byte:bigint>"


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, text_col: str = "text", window: int = 4,
                  k: int = 3, band: int = 8, min_coverage: float = 0.8, out_col: str = "license",
                  deciding: dict[str, tuple[str, ...]] = DECIDING) -> DataFrame:
    """``docs`` plus ``license``: a struct of ``n_words`` and ``matches`` (template, matched words,
    coverage, word span and byte span)."""
    T.prepare(docs.sparkSession)
    index = TemplateIndex(TEMPLATES if templates is None else templates, window, k, band, min_coverage,
                          deciding)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    source = docs.select(F.col(f"`{text_col}`").alias("_t"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    schema = S.StructType([source.schema["_row"], S.StructField("n_words", S.LongType()),
                           S.StructField("matches", S._parse_datatype_string(f"array<{MATCH}>"))])
    match_type = pa.list_(pa.struct([
        ("template", pa.string()), ("matched", pa.int64()), ("coverage", pa.float64()), ("first_word", pa.int64()),
        ("end_word", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]))
    names = [f.name for f in match_type.value_type]

    def scan(batches):
        for b in batches:
            n_words, matches = [], []
            for _, buf, off in T.text_slices(b.column(0)):
                low = T.LOWER[buf]
                ws, we, woff = T.word_spans(low, off, T.NOT_ALNUM)
                n_words += np.diff(woff).tolist()
                for d, found in enumerate(shared.value.matches(T.word_hashes(low, ws, we), woff)):
                    matches.append([dict(zip(names, (
                        *m, int(ws[woff[d] + m[3]] - off[d]), int(we[woff[d] + m[4] - 1] - off[d])), strict=True))
                        for m in found])
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(n_words, pa.int64()),
                                              pa.array(matches, match_type)], names=schema.names)

    out = source.mapInArrow(scan, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in T.beside(docs.columns, out_col)],
                      F.struct("n_words", "matches").alias(out_col))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: words, matches, the license names found and the words they cover."""
    d = scan_licenses(docs.select("doc_id", "text"), TEMPLATES | RESERVED)
    m = F.col("license.matches")
    return d.select(
        "doc_id", "license.n_words", F.size(m).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(m["template"])), ",").alias("licenses"),
        F.coalesce(F.array_max(m["coverage"]), F.lit(0.0)).alias("max_coverage"),
        F.aggregate(m, F.lit(0).cast("long"), lambda acc, x: acc + x["matched"]).alias("n_matched"),
        F.array_join(F.transform(m, lambda x: F.concat_ws("-", x["first_byte"], x["end_byte"])), ",").alias("spans"))
