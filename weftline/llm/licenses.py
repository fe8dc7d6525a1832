"""License scans by a generalised suffix automaton of license texts.

Documents are streamed once, word by word, through the automaton of all templates' words, which gives at each word the
longest match ending there (matching statistics) and where in the templates it lies. Matches of at least MIN_MATCH words,
or of a whole shorter template, become anchors; those of one template in rising order are chained, and a chain's share of
the template's words is its coverage. Chains that cover a template enough (COVERAGE; short notices wholly) are its spans;
of overlapping chains of one template those are taken that together cover most words. Each span gives the label.

Base labels come from phrases of whole words, each found at all its places by the same pass over the words.

Defined cases: null and empty text have no words; letters are lowered for A-Z alone and words are runs of ASCII digits,
ASCII letters and all non-ASCII characters; overlapping phrases all count; repeated rows are scanned alike; equal chains
go to the one that ends first; null and repeated ids are rows of their own; an empty table gives no rows; other columns of
docs are left out, and where id_col is the name of a result column, that column's name gets a trailing underscore. Memory
per document is linear in its words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from weftline.llm.common import free, table

#: Words of an anchor, share of a template that a chain must cover, words of templates that must be covered wholly, and
#: words between anchors at most.
MIN_MATCH, COVERAGE, SHORT, GAP = 6, 0.5, 24, 12

#: (phrase, label) of the base scan; fixed values.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: (label, text) of the templates: well-known notices.
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)

#: Kinds of Creative Commons licenses, and how their names are written out.
COMMONS = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
#: SPDX identifiers of the labels.
SPDX = {"MIT": "mit", "Apache-2.0": "apache", "GPL-2.0": "gpl", "GPL-3.0": "gpl", "LGPL-2.1": "lgpl", "LGPL-3.0": "lgpl", "AGPL-3.0": "agpl", "BSD-2-Clause": "bsd", "BSD-3-Clause": "bsd", "MPL-2.0": "mpl", "ISC": "isc", "EPL-2.0": "epl", "CC0-1.0": "cc0", "Unlicense": "unlicense", "BSL-1.0": "boost"}


def short_notices() -> list[tuple[str, str]]:
    """(label, text) of the usual lines, made by rule."""
    made = [(label, f"SPDX-License-Identifier: {name}") for name, label in SPDX.items()]
    for version in ("4.0", "3.0"):
        for kind, name in COMMONS.items():
            label = f"cc-{kind}"
            made += [(label, f"Licensed under CC {kind.upper()} {version}"), (label, f"SPDX-License-Identifier: CC-{kind.upper()}-{version}"), (label, f"licensed under a Creative Commons {name} {version} {'International' if version == '4.0' else 'Unported'} License")]
    return [*made, ("cc0", "Licensed under CC0 1.0"), ("lgpl", "GNU Lesser General Public License"), ("agpl", "GNU Affero General Public License"), ("mpl", "Mozilla Public License"), ("epl", "Eclipse Public License")]


TEMPLATES = (*NOTICES, *short_notices())

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Automaton:
    """The generalised suffix automaton of several word sequences."""

    next: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])
    whole: list[tuple[int, ...]] = field(default_factory=list)

    def _state(self, length: int, link: int, out: dict[bytes, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, word: bytes, q: int) -> int:
        c = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        made = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = made
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return made

    @classmethod
    def of(cls, sequences: list[list[bytes]]) -> Automaton:
        """Of the sequences; each state knows all (sequence, position) where its matches end, and the sequences that are
        suffixes of its longest match."""
        a = cls()
        for s in sequences:
            last = 0
            for w in s:
                last = a._extend(last, w)
        for k, s in enumerate(sequences):
            at = 0
            for i, w in enumerate(s):
                at = a.next[at][w]
                up = at
                while up > 0 and (k, i) not in a.ends[up]:
                    a.ends[up].add((k, i))
                    up = a.link[up]
        last = [len(s) - 1 for s in sequences]
        a.whole = [tuple(sorted(k for k, i in ends if i == last[k] and last[k] < a.length[at])) for at, ends in enumerate(a.ends)]
        for at in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            a.whole[at] = tuple(sorted({*a.whole[at], *a.whole[max(a.link[at], 0)]}))
        return a

    def matches(self, seen: list[bytes], least: int, whole: list[tuple[int, int, int]] | None = None) -> Iterator[tuple[int, int, int]]:
        """(last word, words, state) of the matches of at least so many words that can't be longer to the right; (last word,
        words, state) wherever a whole sequence may end goes to the list whole."""
        step, link, length = self.next, self.link, self.length
        root, state, have = step[0], 0, 0
        for i, w in enumerate(seen):
            if not state and w not in root:
                continue
            to = step[state].get(w)
            if to is None:
                if have >= least:
                    yield i - 1, have, state
                while state and w not in step[state]:
                    state = link[state]
                have = length[state]
                to = step[state].get(w)
                if to is None:
                    have = 0
                    continue
            state = to
            have += 1
            if whole is not None and self.whole[state]:
                whole.append((i, have, state))
        if have >= least:
            yield len(seen) - 1, have, state


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES, least: int = MIN_MATCH, coverage: float = COVERAGE, gap: int = GAP, short: int = SHORT):
        self.templates = [(label, words(text)) for label, text in templates]
        self.automaton = Automaton.of([w for _, w in self.templates])
        self.phrases = [(words(p), label) for p, label in phrases]
        self.heads: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for p, label in self.phrases:
            self.heads.setdefault(p[-1], []).append((p, label))
        self.gap = gap
        self.sizes = [len(w) for _, w in self.templates]
        #: Words that a chain of each template must have.
        self.needed = [n if n < short else coverage * n for n in self.sizes]
        self.least, self.short = least, short

    def base(self, seen: list[bytes]) -> list[tuple[int, str]]:
        """(start, label) of all places of the phrases."""
        found = []
        for last, ends in self.heads.items():
            at = -1
            for _ in range(seen.count(last)):
                at = seen.index(last, at + 1)
                for p, label in ends:
                    begin = at - len(p) + 1
                    if begin >= 0 and seen[begin : at + 1] == p:
                        found.append((begin, label))
        return found

    def chains(self, anchors: list[tuple[int, int, int, int]], size: int) -> list[tuple[int, int, int]]:
        """(words covered, first word, last word) of the best chain that ends at each anchor (first and last word in the
        text, then in the template), anchors in the order of their ends."""
        best: list[tuple[int, int, int]] = []
        recent = 0
        for i, (a, b, c, d) in enumerate(anchors):
            have, first = d - c + 1, a
            while anchors[recent][1] < a - self.gap - size:
                recent += 1
            for j in range(recent, i):
                _, b0, _, d0 = anchors[j]
                if b0 < a <= b0 + self.gap and d0 < c and best[j][0] + d - c + 1 > have:
                    have, first = best[j][0] + d - c + 1, best[j][1]
            best.append((have, first, b))
        return best

    def spans(self, seen: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, coverage) of the chains that cover a template enough: of each template those that
        don't overlap and together cover most words."""
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        whole: list[tuple[int, int, int]] = []
        for last, n, state in self.automaton.matches(seen, self.least, whole):
            for k, end in sorted(self.automaton.ends[state]):
                if self.sizes[k] >= self.short:
                    by.setdefault(k, []).append((last - n + 1, last, end - n + 1, end))
        # A short notice may stand inside a longer match, and so is taken where its last word stands.
        for last, n, state in whole:
            for k in self.automaton.whole[state]:
                if self.sizes[k] < self.short and self.sizes[k] <= n:
                    by.setdefault(k, []).append((last - self.sizes[k] + 1, last, 0, self.sizes[k] - 1))
        found = []
        for k, anchors in sorted(by.items()):
            label, template = self.templates[k]
            fine = [c for c in self.chains(anchors, len(template)) if c[0] >= self.needed[k]]
            lasts = [c[2] for c in fine]
            # most[i]: (words covered by the best of the first i chains, the last taken, what is taken before it)
            most: list[tuple[int, int, int]] = [(0, -1, 0)]
            for i, (have, first, _) in enumerate(fine):
                before = bisect_left(lasts, first, 0, i)
                taken = (most[before][0] + have, i, before)
                most.append(taken if taken[0] > most[-1][0] else most[-1])
            at, mine = len(fine), []
            while at and most[at][1] >= 0:
                _, i, at = most[at]
                mine.append((label, fine[i][1], fine[i][2], min(1.0, fine[i][0] / len(template))))
            found += mine[::-1]
        return found

    def scan(self, text: str | None) -> tuple:
        """(words, base places, first, last, base labels, labels, score, spans)."""
        seen = words(text)
        base = self.base(seen)
        spans = self.spans(seen)
        starts = [s for s, _ in base]
        labels = {label for _, label in base}
        score = 1.0 if base else min(1.0, max((s[3] for s in spans), default=0.0))
        return len(seen), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {s[0] for s in spans})), score, [dict(zip(("label", "first", "last", "coverage"), s, strict=True)) for s in spans]


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPAN)
_SPARK = (LongType(), LongType(), LongType(), LongType(), StringType(), StringType(), DoubleType(), ArrayType(StructType([StructField("label", StringType()), StructField("first", LongType()), StructField("last", LongType()), StructField("coverage", DoubleType())])))
_NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col and the columns of Scanner.scan()."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = [free(n, [id_col]) for n in _NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for b in batches:
            made = [scanner.scan(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([m[i] for m in made], k) for i, k in enumerate(_KINDS))], [id_col, *names])

    schema = StructType([StructField(id_col, rows.schema["id"].dataType), *(StructField(n, t) for n, t in zip(names, _SPARK, strict=True))])
    return rows.mapInArrow(run, schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumn("spans", F.to_json("spans"))


QUERIES = {"op5_suffix_automaton_licenses": op5}
