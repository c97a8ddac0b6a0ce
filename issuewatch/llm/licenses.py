"""License scans by conditional compression.

License words preselect small overlapping parts of a text; the stretches in them that have
enough words of a template are the candidate blocks. A block's words are compressed alone
and with each such template as a raw zstandard dictionary, by the same parameters. Of
templates whose blocks overlap the one with the largest size reduction wins, and it is
confirmed by its exact wording differences: a word alignment that gives the words the
block lacks and those it adds. So of texts that differ in a few words (a version, a name)
compression decides which one is quoted.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import Match, SequenceMatcher
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker

# The wording of public licenses and of the notices that name them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
        ' "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,'
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to"
        " the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may'
        " obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express'
        " or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are"
        " met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
        " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution.",
    ),
    ("BSD", "Released under the BSD License."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this"
        " file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the"
        " above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
#: Words of which each template holds one; a text without any has no block.
MARKERS = r"(?i)licen[sc]e|copyright|permission|redistribut|public domain"
#: Share of a template's words that a block has in order, to confirm it.
CONFIRM = 0.9
LEVEL = 12
#: Text length that the compression parameters are chosen for, whatever a block's own.
BLOCK_BYTES = 2048
WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


@dataclass
class Scanner:
    """The templates, ready to compress with; one per Python worker."""

    templates: tuple[tuple[str, str], ...]
    plain: zstandard.ZstdCompressor = field(init=False)
    primed: list[zstandard.ZstdCompressor] = field(init=False)
    words: list[list[str]] = field(init=False)
    counts: list[Counter[str]] = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        fixed = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK_BYTES)
        self.plain = zstandard.ZstdCompressor(compression_params=fixed)
        self.words = [[w.lower() for w in WORDS.findall(t)] for _, t in self.templates]
        dictionaries = [zstandard.ZstdCompressionDict(joined(w), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for w in self.words]
        self.primed = [zstandard.ZstdCompressor(compression_params=fixed, dict_data=d) for d in dictionaries]
        self.counts = [Counter(w) for w in self.words]
        self.longest = max((reach(len(w)) for w in self.words), default=0)

    def scan(self, text: str) -> list[tuple[str, int, int, int, int, float, list[str], list[str]]]:
        """(license, template, start, end, reduction, similarity, missing, added) of a whole text."""
        spots = [(m.group().lower(), m.start(), m.end()) for m in WORDS.finditer(text)]
        found = [f for a, b in blocks(text, spots, self.longest) for f in self.scan_block(text, spots[a:b])]
        # of overlapping finds the one whose template saves most
        found.sort(key=lambda f: (-f[4], f[1], f[2], f[3]))
        starts: list[int] = []
        taken: list = []
        for f in found:
            k = bisect_left(starts, f[2])
            if (k == 0 or taken[k - 1][3] <= f[2]) and (k == len(taken) or taken[k][2] >= f[3]):
                starts.insert(k, f[2])
                taken.insert(k, f)
        return taken

    def scan_block(self, text: str, spots: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int, int, float, list[str], list[str]]]:
        """All finds, also overlapping ones, in a block of words (word, start, end)."""
        words = [s[0] for s in spots]
        there = Counter(words)
        # a block with fewer of a template's words than `CONFIRM` cannot quote it
        likely = [i for i, c in enumerate(self.counts) if sum(min(n, there[w]) for w, n in c.items()) >= CONFIRM * len(self.words[i])]
        if not likely:
            return []
        found = []
        for i in likely:
            for at, to, share, missing, added in quotes(self.words[i], words):
                reduction = self.reduction(i, words[at:to])
                found.append((self.templates[i][0], i, spots[at][1], spots[to - 1][2], reduction, share, missing, added))
        return found

    def reduction(self, template: int, block: list[str]) -> int:
        """Bytes that the template, as a dictionary, saves on a block's words."""
        raw = joined(block)
        return len(self.plain.compress(raw)) - len(self.primed[template].compress(raw))


def joined(words: list[str]) -> bytes:
    return " ".join(words).encode("utf-8", "surrogatepass")


def reach(n: int) -> int:
    """Words that a quote of a template of `n` words may have."""
    return n + max(2, n // 10)


def blocks(text: str, spots: list[tuple[str, int, int]], longest: int) -> list[tuple[int, int]]:
    """Spans of `2 * longest` words, each `longest` behind the one before, that hold every run of
    `longest` words around a license word."""
    starts = [s[1] for s in spots]
    wanted: list[int] = []
    for m in re.finditer(MARKERS, text):
        first, last = max(0, bisect_right(starts, m.start()) - longest), bisect_left(starts, m.end()) - 1
        for k in range(max(first // longest, wanted[-1] + 1 if wanted else 0), max(0, last) // longest + 1):
            wanted.append(k)
    return [(k * longest, (k + 2) * longest) for k in wanted if k * longest < len(spots)]


def quotes(template: list[str], words: list[str]) -> list[tuple[int, int, float, list[str], list[str]]]:
    """Where `words` quote `template`: (from, to, share of its words in order, missing, added).

    Anchors are the places of the template's words; each anchor's stretch, as long as the
    template and a tenth, is aligned word by word.
    """
    n = len(template)
    places = {w: i for i, w in reversed(list(enumerate(template)))}
    known = [0, *accumulate(w in places for w in words)]
    starts = sorted({max(0, j - places[w]) for j, w in enumerate(words) if w in places})
    out, free = [], 0
    for at in starts:
        # the second: too few words of the template, in any order
        if at < free or known[min(len(words), at + reach(n))] - known[at] < CONFIRM * n:
            continue
        part, same, share = aligned(template, words, at)
        if share < CONFIRM:
            continue
        if same[0].b:  # a stretch from the first matching word on may hold more of the end
            again = aligned(template, words, at + same[0].b)
            if again[2] > share:
                at, (part, same, share) = at + same[0].b, again
        first, last = same[0].b, same[-1].b + same[-1].size
        matched_a = {m.a + k for m in same for k in range(m.size)}
        matched_b = {m.b + k for m in same for k in range(m.size)}
        missing = [w for k, w in enumerate(template) if k not in matched_a]
        added = [w for k, w in enumerate(part[first:last], first) if k not in matched_b]
        out.append((at + first, at + last, share, missing, added))
        free = at + last
    return out


def aligned(template: list[str], words: list[str], at: int) -> tuple[list[str], list[Match], float]:
    """(the stretch from `at`, its runs of the template's words, their share of the template)."""
    part = words[at : at + reach(len(template))]
    same = [m for m in SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if m.size]
    return part, same, sum(m.size for m in same) / len(template)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """One row per license found in a document.

    Columns: `id_col`, license, template (its number), start and end (characters of the
    text), reduction (bytes that the template saves on the words found), similarity (share of
    the template's words that are there in order), missing and added (the exact wording
    differences). Finds of one document do not overlap: the larger reduction wins, of equal
    ones the earlier template.

    Null, empty and unlicensed texts have no row. Repeated rows each give their rows; null
    ids are kept; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(MARKERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = per_worker(f"licenses {hash(templates)}", lambda: Scanner(templates))
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column("text")):
                some = scanner.scan(text.as_py())
                at += [k] * len(some)
                found += some
            columns = list(zip(*found, strict=True)) if found else [[]] * 8
            arrays = [pa.array(list(c), t) for c, t in zip(columns, _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *arrays], ["id", *_NAMES])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, license string, template int, start int, end int, reduction int, similarity double, missing array<string>, added array<string>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


_NAMES = ["license", "template", "start", "end", "reduction", "similarity", "missing", "added"]
_KINDS = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string())]
