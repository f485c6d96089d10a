"""License scans by conditional compression.

A document is read as lower-case words. A template of n words that appears with at most d differing words has
one of d + 1 pieces of it unchanged, so every place where a piece appears proposes a block: as long as the
template with room for d words on both sides, whatever stands around it (places of one template at most d words
apart are one block). Each block is compressed alone and with the proposed template as a raw zstandard
dictionary, both with the same parameters. Blocks are taken in the order of the bytes that the dictionary saves,
and in this order confirmed by exact wording differences: at most MAX_DIFFERENT of the template's words may
differ, and no version number or other word that tells licenses apart (a template without that much tolerance has
to appear word for word). A confirmed stretch keeps its words: a block with a smaller reduction whose stretch
meets it finds nothing there. So of templates that share their wording the one that explains most bytes of the
text wins, and one that doesn't hold word by word gives way to the next. A winner is compared with the confirmed
stretches that meet it and come within CLOSE bytes, which is what the coding of sizes alone may account for: of these
the one with fewest differences stays, then the one with most words, then the first in rank. Equal reductions rank
by more words, then by license and place. The rank never rejects a block, it only orders them; a block is never longer than the
template and its room, so neither rank nor gain depends on the length of the document. The gain of a confirmed
stretch is the bytes saved on it, as a share of what the template saves on itself.

In a template of more than LONG words (a full text) only the first TITLE words are held to the rule for telling
words. So a full text without its title is told from its kin by the number of differences alone.

Nothing is shuffled; templates are fixed, small and sent with the task.

Identifiers of SPDX-License-Identifier lines are read as they stand (operands of an expression each; an
exception after "with" is left out).

Edge cases: a NULL or empty text has no license; white space, case and punctuation don't count; every
occurrence is reported, also repeated ones and those of repeated rows; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect, bisect_left
from collections import Counter
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.license_wordings import WORDINGS
from saleslake.llm.superkmers import Rows, columns

MAX_DIFFERENT = 0.1
LEVEL = 12
#: Bytes of reduction that don't tell two templates apart.
CLOSE = 8
#: Words by which pieces are looked up; no template is shorter.
HEAD = 3

#: Wordings by SPDX identifier (fixed values); a license may have several.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-only",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *WORDINGS,
)
#: A template with more words is a full text; only its title tells it apart, so that a changed address or
#: section number doesn't.
LONG = 400
TITLE = 8
#: Words that tell licenses apart and may not differ.
TELLING = frozenset(
    "mit isc bsd apache gnu gpl lgpl agpl affero lesser library eclipse epl mozilla mpl creative commons cc by sa nc nd "
    "noncommercial sharealike noderivatives attribution domain later only".split()
)

#: A version with a plus sign (GPLv2+) is a word of its own.
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*(?:(?<=[0-9])\+(?![a-z0-9]))?")
_SPDX = re.compile(
    r"(?i:\bSPDX-License-Identifier)[ \t]*:[ \t]*"
    r"(\(*[A-Za-z0-9][\w.+:-]*\)*(?:[ \t]+(?:AND|OR|WITH|and|or|with)[ \t]+\(*[A-Za-z0-9][\w.+:-]*\)*)*)"
)
_EXCEPTION = re.compile(r"(?i)\s+with\s+[\w.+:-]+")
#: Identifiers that SPDX has replaced.
_REPLACED = re.compile(r"((?:A|L)?GPL-\d\.\d|GFDL-\d\.\d)(\+?)")


def normal_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def spdx_tags(text: str) -> list[tuple[str, float, int, int, int]]:
    """Every identifier, of whatever license, in SPDX-License-Identifier lines; rows as those of a scan."""
    out = []
    at = before = 0
    for m in _SPDX.finditer(text):
        at, before = at + len(normal_words(text[before : m.start()])), m.start()
        n_words = len(normal_words(m[0]))
        for name in re.split(r"[()\s]+(?:and|or)[()\s]+", _EXCEPTION.sub("", m[1]), flags=re.I):
            name = name.strip("()").rstrip(".:-")
            old = _REPLACED.fullmatch(name)
            name = old[1] + ("-or-later" if old[2] else "-only") if old else name
            out.append((name, 1.0, 0, at, at + n_words))
    return out


def _telling(word: str) -> bool:
    return word in TELLING or not word.isalpha()


class Template:
    def __init__(self, license_id: str, text: str) -> None:
        self.license, self.words = license_id, normal_words(text)
        self.most = int(MAX_DIFFERENT * len(self.words))

    def pieces(self) -> list[tuple[int, tuple[str, ...]]]:
        """Where each of ``most + 1`` pieces of the words begins, and its words."""
        n = self.most + 1
        cuts = [k * len(self.words) // n for k in range(n + 1)]
        return [(a, tuple(self.words[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]

    @cached_property
    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        """Without and with the template as dictionary; the parameters are the same, so sizes compare."""
        normal = " ".join(self.words).encode()
        content = zstandard.ZstdCompressionDict(normal, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        same = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=2 * len(normal), dict_size=len(normal), write_content_size=False
        )
        alone = zstandard.ZstdCompressor(compression_params=same)
        return alone, zstandard.ZstdCompressor(compression_params=same, dict_data=content)

    def saved(self, words: list[str]) -> int:
        """Bytes by which the template as dictionary makes the compressed words smaller."""
        normal = " ".join(words).encode()
        alone, given = self.compressors
        return len(alone.compress(normal)) - len(given.compress(normal))

    @cached_property
    def own_gain(self) -> int:
        return max(1, self.saved(self.words))

    def gain(self, words: list[str]) -> float:
        return self.saved(words) / self.own_gain


_FAR = 1 << 40
#: A differing telling word costs more than all other words of a stretch, so a stretch without one is nearer.
_TOLD = 1 << 20


def align(
    template: list[str], words: list[str], band: tuple[int, int] | None = None, most: int = _FAR
) -> tuple[int, int, int, bool]:
    """Differences of the template and the stretch of ``words`` nearest to it.

    (insertions, deletions and replacements; begin and end of the stretch; whether a telling word
    differs.) A semi-global edit distance; the stretch may begin and end anywhere, and one in which no telling
    word differs is nearer than any in which one does. band: the least and the
    greatest place of a word less that of the template's word it meets. The search ends early, and counts
    as telling, if no stretch has at most ``most`` differences.
    """
    numbers: dict[str, int] = {}
    wanted = [numbers.setdefault(t, len(numbers)) for t in template]
    given = np.array([numbers.get(w, -1) for w in words], np.int64)
    title = TITLE if len(template) > LONG else len(template)
    deleted = np.array([_TOLD if k < title and _telling(t) else 1 for k, t in enumerate(template)], np.int64)
    inserted = np.array([_TOLD if _telling(w) else 1 for w in words], np.int64)
    least, greatest = band or (-len(template), len(words))
    first, last = max(0, least), min(len(words), greatest)
    upto = np.append(0, np.cumsum(inserted))
    rows = [(first, np.zeros(last - first + 1, np.int64))]
    for i, t in enumerate(wanted):
        if i == title:
            inserted = np.ones(len(words), np.int64)
            upto = np.append(0, np.cumsum(inserted))
        at, before = rows[-1]
        first, last = max(0, i + 1 + least), min(len(words), i + 1 + greatest)
        row = np.full(last - first + 1, _FAR)
        end = min(last, at + len(before) - 1)
        row[: end - first + 1] = before[first - at : end - at + 1] + deleted[i]
        low, high = max(first, at + 1), min(last, at + len(before))
        replaced = np.maximum(inserted[low - 1 : high], deleted[i])
        replaced[given[low - 1 : high] == t] = 0
        part = row[low - first : high - first + 1]
        np.minimum(part, before[low - 1 - at : high - at] + replaced, out=part)
        own = upto[first : last + 1]
        row = np.minimum.accumulate(row - own) + own
        if row.min() > most:
            return int(row.min()), 0, 0, True
        rows.append((first, row))

    def cost(i, j):
        at, row = rows[i]
        return row[j - at] if at <= j < at + len(row) else _FAR

    first, row = rows[-1]
    differs = row.min() >= _TOLD
    j = end = first + int(row.argmin())
    i, different = len(template), 0
    while i:
        here = cost(i, j)
        if j and template[i - 1] == words[j - 1] and here == cost(i - 1, j - 1):
            i, j = i - 1, j - 1
            continue
        different += 1
        strict = _TOLD if i <= title and j and _telling(words[j - 1]) else 1
        if j and here == cost(i - 1, j - 1) + max(deleted[i - 1], strict):
            i, j = i - 1, j - 1
        elif here == cost(i - 1, j) + deleted[i - 1]:
            i -= 1
        else:
            j -= 1
    return different, j, end, bool(differs)


class Block(NamedTuple):
    """A block of a text, proposed by the pieces of a template found in it."""

    saved: int
    template: int
    #: Least and greatest place of the template's first word.
    first: int
    last: int
    low: int
    high: int


class Scanner:
    def __init__(self, templates=TEMPLATES) -> None:
        self.templates = [Template(*t) for t in templates]
        #: Pieces by their words, and their lengths by their first words.
        self.pieces: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        self.lengths: dict[tuple[str, ...], set[int]] = {}
        for k, t in enumerate(self.templates):
            for at, piece in t.pieces():
                self.pieces.setdefault(piece, []).append((k, at))
                self.lengths.setdefault(piece[:HEAD], set()).add(len(piece))

    def proposed(self, words: list[str]):
        """(template, place of its first word if nothing before the piece differs) of every piece found."""
        heads = zip(*(words[k:] for k in range(HEAD)), strict=False)
        for i, head in enumerate(heads):
            for size in self.lengths.get(head, ()):
                for k, at in self.pieces.get(tuple(words[i : i + size]), ()):
                    yield k, i - at

    def blocks(self, words: list[str]) -> list[Block]:
        """Bounded blocks that may hold a template, the one whose bytes its template saves most of first."""
        places: dict[int, set[int]] = {}
        for k, at in self.proposed(words):
            places.setdefault(k, set()).add(at)
        out = []
        for k, found in places.items():
            t = self.templates[k]
            groups: list[list[int]] = []
            for at in sorted(found):
                if groups and at - groups[-1][0] <= t.most:
                    groups[-1].append(at)
                else:
                    groups.append([at])
            for group in groups:
                low = max(0, group[0] - t.most)
                high = min(len(words), group[-1] + len(t.words) + t.most)
                part = words[low:high]
                if sum((Counter(t.words) - Counter(part)).values()) <= t.most:
                    out.append(Block(t.saved(part), k, group[0], group[-1], low, high))
        out.sort(key=lambda x: (-x.saved, -len(self.templates[x.template].words), self.templates[x.template].license, x))
        return out

    def size(self, block: Block) -> int:
        return len(self.templates[block.template].words)

    def core(self, block: Block) -> int:
        return self.size(block) - self.templates[block.template].most

    def confirmed(self, words: list[str], block: Block) -> tuple[int, int, int] | None:
        """Differences, begin and end of the block's nearest stretch, if it is near enough."""
        t = self.templates[block.template]
        if not t.most:
            return 0, block.low, block.high
        band = (block.first - block.low - t.most, block.last - block.low + t.most)
        different, a, b, told = align(t.words, words[block.low : block.high], band, t.most)
        return None if told or different > t.most or a >= b else (different, block.low + a, block.low + b)

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(license, gain, differences, begin, end) of what a text has, by position in its words."""
        words = normal_words(text)
        kept: list[tuple[str, float, int, int, int]] = []
        begins: list[int] = []

        def free(begin: int, end: int) -> bool:
            k = bisect_left(begins, end)
            return not k or kept[k - 1][4] <= begin

        def found_in(block: Block) -> tuple[int, int, int] | None:
            # whatever is confirmed in the block has these words
            sure = block.last + self.templates[block.template].most, block.first + self.core(block)
            found = self.confirmed(words, block) if free(*sure) else None
            return found if found and free(*found[1:]) else None

        ranked = self.blocks(words)
        places = sorted((block.first, k) for k, block in enumerate(ranked))
        for block in ranked:
            found = found_in(block)
            if not found:
                continue
            best = (found[0], -self.size(block), 0, block, found)
            near = places[bisect_left(places, (block.low - self.size(block),)) : bisect_left(places, (block.high,))]
            for _, k in near:
                other = ranked[k]
                if other is not block and 0 <= block.saved - other.saved <= CLOSE:
                    meets = found_in(other)
                    if meets and meets[1] < found[2] and found[1] < meets[2]:
                        best = min(best, (meets[0], -self.size(other), k + 1, other, meets))
            _, _, _, block, (different, a, b) = best
            t = self.templates[block.template]
            k = bisect(begins, a)
            kept.insert(k, (t.license, t.gain(words[a:b]), different, a, b))
            begins.insert(k, a)
        return sorted(kept + spdx_tags(text), key=lambda x: x[3])


_RESULT = "doc_id long, occurrence int, license string, gain double, n_different int, n_words int"
_RESULT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("occurrence", pa.int32()), ("license", pa.string()),
     ("gain", pa.float64()), ("n_different", pa.int32()), ("n_words", pa.int32())]
)

_scanners: dict[tuple, Scanner] = {}


def _scanner(templates) -> Scanner:
    """The worker's scanner; it stays for the worker's next tasks."""
    if templates not in _scanners:
        _scanners.clear()
        _scanners[templates] = Scanner(templates)
    return _scanners[templates]


def _scan(templates):
    def run(batches):
        scanner = _scanner(templates)
        out = Rows(_RESULT_SCHEMA)
        for batch in batches:
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                for k, (name, gain, different, low, high) in enumerate(scanner.scan(text), 1):
                    if out.add((doc_id, k, name, round(gain, 6), different, high - low), 64):
                        yield out.batch()
        yield out.batch()

    return run


def scan(df: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per license found: doc_id, occurrence (from 1, in text order), license, gain, n_different
    (words that differ from the template) and n_words (of the stretch)."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.where(F.col("text").isNotNull()).mapInArrow(_scan(tuple(templates)), _RESULT)
