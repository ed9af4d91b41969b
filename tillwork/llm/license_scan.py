"""License scans by conditional compression.

A sentence that names licensing in any way is a candidate, with what lies within a notice's reach of it.
Its words, in blocks that hold any notice whole, are compressed alone and with each template as zstandard
raw dictionary, and what that saves ranks the templates. All are then confirmed by wording in that order:
a template stands where its exact wording does; the words added, removed or replaced are listed, and they
must be few and no version number among them. The template that saved most of those confirmed wins its
words, unless others stand over some of them: then just these words are compressed with each again, so
that nothing around them has a part in it. What is left of the block on either side is ranked anew, until
nothing stands there. None is left out for its rank.

Line ends are blanks; the words of a notice may lie in several lines or sentences, which are then one
block. A block that holds several notices is cut where each but the first starts, so that every one is
found. A notice right after a word that denies it ("not licensed under") names no license. The BSD
conditions are told apart by the clause that only one of them has.

Candidates are looked for in every sentence of every text; a built-in pattern keeps texts without any
from Python. Nothing is shuffled.

Defined cases: a null or empty text has no candidates and no license. Templates that save the same go by
the fewer wording differences, then by the order of TEMPLATES. The end of a sentence inside a notice, or
a run of other letters than a to z, counts as one word added. Repeated rows get equal answers. Other
columns pass through ``scan_licenses``; its one result column, ``licenses``, replaces one of that name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import pairwise

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import bounded_batches, read_table
from tillwork.llm.registry import query

#: Usual wordings of license notices by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, "
                     "are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms "
                         "of the GNU General Public License as published by the Free Software Foundation, either "
                         "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms "
                         "of the GNU General Public License as published by the Free Software Foundation; either "
                         "version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms "
                          "of the GNU Lesser General Public License as published by the Free Software Foundation; "
                          "either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms "
                          "of the GNU Affero General Public License as published by the Free Software Foundation, "
                          "either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
                "Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-3.0", "Licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-SA-3.0", "Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
)

#: The conditions of both BSD licenses start with one sentence. Of the texts below, the first stands in the
#: conditions of both and the second in those of three clauses only.
BSD = "BSD-3-Clause"
SECOND_CLAUSE = "redistributions in binary form must reproduce"
THIRD_CLAUSE = "neither the name of"
#: Words within which the conditions follow that sentence.
CONDITIONS = 160

#: Words that deny what follows them at once, as the pattern of words cuts them.
DENIALS = ("not", "never", "no longer", "isn t", "aren t", "wasn t", "not yet", "not be", "never been")

#: Line ends and comment signs may stand between the words of a cue.
CUE = (
    r"(?i)licen[sc]|copyright|\bcc[^a-zA-Z0-9.!?]*(by|0)\b|public[^a-zA-Z0-9.!?]+domain"
    r"|rights[^a-zA-Z0-9.!?]+reserved|redistribution|permission[^a-zA-Z0-9.!?]+is"
)
#: Share of the template's words that must be there; words around it do not count.
LEAST_ALIKE = 0.8
#: Stands for the end of a sentence, or for other letters, among the words.
STOP = "."
#: The price of a version number among the differences.
NEVER = 1000

_cue = re.compile(CUE)
_sentence = re.compile(r"(?<=[.!?])[ \t]+|\n")
_word = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*[A-Za-z0-9+]|[A-Za-z0-9]")
_full_stop = re.compile(r"[.!?][\"')\]]*\s")
_other_letter = re.compile(r"[^\W\d_]")


def words(text: str) -> list[str]:
    return [w.lower() for w in _word.findall(text)]


def _tokens(text: str) -> tuple[list[str], list[int], list[int]]:
    """The words of a text with STOP between sentences, where each starts, and where it ends."""
    tokens, starts, ends, end = [], [], [], 0
    for match in _word.finditer(text):
        start, gap = match.start(), text[end : match.start()]
        if gap != " " and tokens:
            upper = text[start].isupper()
            if upper and _full_stop.search(gap) or _other_letter.search(gap):
                tokens.append(STOP)
                starts.append(end)
                ends.append(start)
        end = match.end()
        tokens.append(match[0].lower())
        starts.append(start)
        ends.append(end)
    return tokens, starts, ends


@cache
def _compressors() -> tuple[zstandard.ZstdCompressor, list[zstandard.ZstdCompressor]]:
    """One without a dictionary, and one per template."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        19,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    made = []
    for _, wording in TEMPLATES:
        content = zstandard.ZstdCompressionDict(
            " ".join(words(wording)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        made.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings))
    return zstandard.ZstdCompressor(compression_params=settings), made


@lru_cache(4096)
def reductions(block: str) -> tuple[float, ...]:
    """The share of a block's compressed size that each template saves."""
    plain, conditional = _compressors()
    data = block.encode()
    alone = len(plain.compress(data))
    return tuple(1 - len(compressor.compress(data)) / alone for compressor in conditional)


def ranked(block: str) -> list[int]:
    """All templates, those that save most of the block first."""
    saved = reductions(block)
    return sorted(range(len(TEMPLATES)), key=lambda i: -saved[i])


@cache
def _wordings() -> list[tuple[list[str], int]]:
    """The words of each template, and how many may differ."""
    split = [words(wording) for _, wording in TEMPLATES]
    return [(w, int((1 - LEAST_ALIKE) * len(w))) for w in split]


@cache
def _reach() -> int:
    """The words that a notice may have."""
    return max(len(wording) + most for wording, most in _wordings())


def _price(word: str) -> int:
    return NEVER if word[0].isdigit() else 1


def _regions(at: list[int], length: int, most: int) -> list[list[int]]:
    """Where enough words of a template lie close together; it can stand nowhere else."""
    out = []
    for first, last in zip(at, at[length - most - 1 :], strict=False):
        if last < (end := first + length + most):
            if out and first <= out[-1][1]:
                out[-1][1] = end
            else:
                out.append([first, end])
    return out


def _stretches(wording: list[str], most: int, tokens: list[str], lo: int, hi: int):
    """The stretches that differ from a template in at most so many words: price, start, end.

    For every end the cheapest alignment with the template, of those the shortest.
    """
    prices = [_price(w) for w in wording]
    column = [(0, -lo)]
    for price in prices:
        column.append((column[-1][0] + price, -lo))
    for j in range(lo, min(hi, len(tokens))):
        token, added = tokens[j], _price(tokens[j])
        former, column = column, [(0, -j - 1)]
        for i, word in enumerate(wording):
            best = min(
                (former[i + 1][0] + added, former[i + 1][1]), (column[i][0] + prices[i], column[i][1])
            )
            column.append(min(best, former[i]) if word == token else best)
        if column[-1][0] <= most:
            yield column[-1][0], -column[-1][1], j + 1


def _confirmed(i: int, tokens: list[str], lo: int, hi: int) -> Iterator[tuple[int, int, int, int]]:
    """Where a template stands in a block: price, template, start, end."""
    wording, most = _wordings()[i]
    known = set(wording)
    places = [j for j in range(lo, hi) if tokens[j] in known]
    for first, last in _regions(places, len(wording), most):
        for price, start, end in _stretches(wording, most, tokens, first, min(last, hi)):
            yield price, i, start, end


def _winner(tokens: list[str], lo: int, hi: int, standing: list) -> tuple[int, float, int, int, int]:
    """Of the templates that stand in a block, the one that saves most, at its best place."""

    def text(start: int, end: int) -> str:
        return " ".join(tokens[start:end])

    def best(rivals: list, start: int, end: int) -> tuple[int, float, int, int, int]:
        saved = reductions(text(start, end))
        _, price, i = min((-saved[i], price, i) for price, i, _, _ in rivals)
        return min((p, -reductions(text(s, e))[i], i, s, e) for p, j, s, e in rivals if (p, j) == (price, i))

    def meets(place: tuple, start: int, end: int) -> bool:
        return place[2] < end and start < place[3]

    leader = best(standing, lo, hi)
    near = [place for place in standing if meets(place, *leader[3:])]
    # A template reaches into its neighbour's words only where it has no cheaper place.
    near = [p for p in near if not any(q[1] == p[1] and q[0] < p[0] and meets(q, *p[2:]) for q in standing)]
    if all(place[1] == leader[2] for place in near):
        return leader
    return best(near, min(place[2] for place in near), max(place[3] for place in near))


def _winners(tokens: list[str], lo: int, hi: int) -> list[tuple[int, float, int, int, int]]:
    """The notices of a block. Each winner cuts it in two, which are ranked anew."""
    order = ranked(" ".join(tokens[lo:hi]))
    out, parts = [], [(lo, hi, [place for i in order for place in _confirmed(i, tokens, lo, hi)])]
    while parts:
        lo, hi, standing = parts.pop()
        if standing := [place for place in standing if lo <= place[2] and place[3] <= hi]:
            out.append(_winner(tokens, lo, hi, standing))
            start, end = out[-1][3:]
            parts += [(lo, start, standing), (end, hi, standing)]
    return sorted(out, key=lambda notice: notice[3])


def notices(tokens: list[str], passages: list | None = None) -> list[tuple[int, float, int, int, int]]:
    """Where templates win in some passages, by default all words: price, less what is saved, template,
    start and end. None overlap; none where it is denied.

    A passage is taken in blocks of twice the words that a notice may have, and of a block that is not
    the last the notices that start in its first half.
    """
    out, reach = [], _reach()
    for lo, hi in [(0, len(tokens))] if passages is None else passages:
        while lo < hi:
            until = hi if hi - lo <= 2 * reach else lo + reach
            found = [n for n in _winners(tokens, lo, min(hi, lo + 2 * reach)) if n[3] < until]
            lo = max([until, *(end for *_, end in found)])
            out += [notice for notice in found if not denied(tokens, notice[3])]
    return out


def denied(tokens: list[str], start: int) -> bool:
    """Whether the words right before a notice, in its sentence, deny it."""
    return any(tokens[max(0, start - len(w)) : start] == w for w in map(str.split, DENIALS))


def license_of(i: int, tokens: list[str], end: int) -> str:
    """The license of a template that stands up to ``end``. The opening of the BSD conditions names the one
    whose clauses follow; alone it cannot be told and counts as three clauses."""
    name, wording = TEMPLATES[i]
    if name == BSD and not wording.startswith("SPDX"):
        after = f" {' '.join(t for t in tokens[end : end + CONDITIONS] if t != STOP)} "
        if f" {SECOND_CLAUSE} " in after and f" {THIRD_CLAUSE} " not in after:
            return "BSD-2-Clause"
    return name


def differences(stretch: list[str], wording: list[str]) -> list[str]:
    """The words that differ, as +word and -word, in the cheapest alignment."""
    n, m = len(wording), len(stretch)
    cost = [[0] * (m + 1) for _ in range(n + 1)]  # of what follows
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            ways = []
            if i < n:
                ways.append(cost[i + 1][j] + _price(wording[i]))
            if j < m:
                ways.append(cost[i][j + 1] + _price(stretch[j]))
            if i < n and j < m and wording[i] == stretch[j]:
                ways.append(cost[i + 1][j + 1])
            cost[i][j] = min(ways, default=0)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and wording[i] == stretch[j] and cost[i][j] == cost[i + 1][j + 1]:
            i, j = i + 1, j + 1
        elif i < n and cost[i][j] == cost[i + 1][j] + _price(wording[i]):
            out.append(f"-{wording[i]}")
            i += 1
        else:
            out.append(f"+{stretch[j]}")
            j += 1
    return out


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one."""
    out = []
    for lo, hi in sorted(spans):
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _passages(cues: list, pieces, starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """The words that may belong to a notice in or near a sentence with a cue. Sentences within reach are
    taken whole: a notice may lie in two of them and touch a next one."""
    out = []
    for lo, hi in _joined(cues):
        first, last = bisect_left(starts, lo), bisect_left(starts, hi)
        for _ in range(2):
            first, last = max(0, first - _reach()), min(len(starts), last + _reach())
            if first < last:
                lo, hi = pieces(starts[first], ends[last - 1])
                first, last = min(first, bisect_left(starts, lo)), max(last, bisect_left(starts, hi))
        out.append((first, last))
    return _joined(out)


def _scanned(text: str, cut: bool) -> list[dict]:
    tokens, starts, ends = _tokens(text)
    # Where the pieces between cuts start, the end of the text last.
    marks = sorted({0, len(text), *(m.end() for m in _sentence.finditer(text) if cut)})

    def pieces(start: int, end: int) -> tuple[int, int]:
        return marks[bisect_right(marks, start) - 1], marks[bisect_left(marks, end)]

    cues = [pieces(*m.span()) for m in _cue.finditer(text)]
    found = notices(tokens, _passages(cues, pieces, starts, ends) if cut else None)
    blocks = _joined(cues + [pieces(starts[s], ends[e - 1]) for *_, s, e in found])

    def block_at(place: int) -> tuple[int, int]:
        return blocks[bisect_right(blocks, (place, len(text))) - 1]

    cued = {block_at(lo) for lo, _ in cues}
    within = defaultdict(list)
    for notice in sorted(found, key=lambda notice: notice[3]):
        within[block_at(starts[notice[3]])].append(notice)
    out = []
    for block in blocks:
        if block not in cued and cut:
            continue
        if not within[block]:
            shown = text[slice(*block)].strip()
            out.append({"block": shown, "license": None, "reduction": None, "differences": []})
            continue
        # From its second notice on each is a block of its own: no word is listed twice.
        bounds = [block[0], *(starts[notice[3]] for notice in within[block][1:]), block[1]]
        for notice, (begin, until) in zip(within[block], pairwise(bounds), strict=True):
            _, saving, i, start, end = notice
            lo, hi = bisect_left(starts, begin), bisect_left(starts, until)
            around = [f"+{w}" for w in tokens[lo:start] + tokens[end:hi] if w != STOP]
            out.append(
                {
                    "block": text[begin:until].strip(),
                    "license": license_of(i, tokens, end),
                    "reduction": -saving,
                    "differences": differences(tokens[start:end], _wordings()[i][0]) + around,
                }
            )
    return out


def identified(block: str) -> list[tuple[str, float, list[str]]]:
    """Each license a block names, what its template saves, and how the wordings differ; in order."""
    found = [f for f in _scanned(block, cut=False) if f["license"]]
    return [(f["license"], f["reduction"], f["differences"]) for f in found]


def identify(block: str) -> tuple[str, float, list[str]] | None:
    """The first of the licenses a block names."""
    return next(iter(identified(block)), None)


def scan(text: str | None) -> list[dict]:
    """The candidate blocks of a text, in order, with the license of each or None."""
    return _scanned(text, cut=True) if text and _cue.search(text) else []


_FOUND = "array<struct<block:string,license:string,reduction:double,differences:array<string>>>"
_ARROW = pa.list_(
    pa.struct(
        [
            ("block", pa.string()), ("license", pa.string()), ("reduction", pa.float64()),
            ("differences", pa.list_(pa.string())),
        ]
    )
)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``licenses``: its candidate blocks and what each was found to be."""

    @F.arrow_udf(_FOUND)
    def licenses(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([scan(t.as_py()) for t in batch], _ARROW)

    bounded_batches(docs.sparkSession)
    candidate = F.when(F.col(text).rlike(CUE), F.col(text))
    return docs.withColumn("licenses", licenses(candidate))


@query()
def op3_license_scan(spark, sf_dir):
    """For every document its candidate blocks, its licenses, and how their wording differs."""
    scanned = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    known = F.filter("licenses", lambda x: x["license"].isNotNull())
    return scanned.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_candidates"),
        F.array_distinct(F.transform(known, lambda x: x["license"])).alias("licenses"),
        F.flatten(F.transform(known, lambda x: x["differences"])).alias("wording_differences"),
        F.array_max(F.transform(known, lambda x: x["reduction"])).alias("best_reduction"),
    )
