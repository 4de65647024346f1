"""License notices by conditional compression.

A candidate block is the paragraph around a cue, joined over line ends: from a paragraph (lines up to the next one without a word) all words
that are no farther from a cue than the longest wording with its edits has words, so that a wording that holds the cue lies wholly in the
block, however it is wrapped.  Cues are some fixed phrases and, for a wording without any of them, words of its own: a word that must
agree, or one word more than the wording may have edits.  Tokens without a letter or digit, such as comment marks, are no words.  A block is
compressed alone and with each license's wordings as raw dictionary; licenses are ranked by the share of bytes saved.  Every license is
then compared word by word, whatever it saves.

Words that tell licenses apart must agree: words with a digit, and words of short wordings (under ``LONG_WORDS`` words) that only one or two
licenses have, their names.  They may be neither changed, left out nor, where they belong to another license, put in.  Else a long
wording may have edits of at most ``most_edits`` of its words, a short one as many words that are only spelt otherwise.  Of wordings that fit
onto the same words the one with the most words less edits decides.  One row per block, license and place, with the line where it begins;
blocks with a fixed cue but without any are reported with a null license and the line of that cue.

Null and empty texts have no blocks.  Equal savings go to the license named first.  Repeated rows are reported each.  An empty
table gives no rows.  Everything is done inside the row: no shuffle.  Other columns are not read.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches

LEVEL = 9
MOST_EDITS = 0.2
LONG_WORDS = 20
NAMED_BY = 2
"""A word of short wordings of at most so many licenses is a name."""
SPELLING = 2
"""Letters by which two spellings of a word may differ."""
NEVER = 1 << 20
CUES = ("licen", "copyright", "all rights reserved", "permission is hereby", "without warranty", "implied warranty", "spdx-", "public domain", "redistribution and use")
BLOCKS = "doc_id long, block int, line int, license string, saved double, edits int, wording_words int, differences string, text string"

# Well-known public license notices.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.0": ("This work is licensed under the GNU Library General Public License, version 2.", "SPDX-License-Identifier: LGPL-2.0-only"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met:",
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "ISC": (
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "Licensed under the Zlib License.",
        "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ),
    "Unlicense": ("SPDX-License-Identifier: Unlicense", "This is free and unencumbered software released into the public domain."),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("SPDX-License-Identifier: CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    "All-Rights-Reserved": ("All rights reserved.",),
}
_WORD = re.compile(r"[^\s.,;:()\"']+(?:\.[^\s.,;:()\"']+)*")


def word_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and lower-case form of each word."""
    return [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text) if any(map(str.isalnum, m[0]))]


def wording_words(text: str) -> list[str]:
    return [w for *_, w in word_spans(text)]


def paragraphs(text: str) -> Iterator[tuple[int, str]]:
    """Line number and text of each run of lines that have a word."""
    first, held = 0, []
    for k, line in enumerate(text.split("\n")):
        if any(map(str.isalnum, line)):
            first = first if held else k
            held.append(line)
        elif held:
            yield first, "\n".join(held)
            held = []
    if held:
        yield first, "\n".join(held)


class Cues:
    """Where a notice may be: the pattern, and words of which a text without a cue has none."""

    def __init__(self, phrases: tuple[str, ...] = CUES):
        self.pattern = re.compile("|".join(r"\W+".join(map(re.escape, c.split())) for c in phrases), re.IGNORECASE)
        self.words = tuple({max(c.split(), key=len).lower() for c in phrases})

    def possible(self, text: str) -> bool:
        low = text.lower()
        return any(c in low for c in self.words)


FIXED = Cues()


def candidate_blocks(text: str, reach: int, cues: Cues | None = None) -> list[tuple[int, str]]:
    """Line number and text of each block: the words of a paragraph up to ``reach`` words from a cue."""
    cues = cues or FIXED
    if not cues.possible(text):
        return []
    blocks = []
    for line, body in paragraphs(text):
        found = [m.span() for m in cues.pattern.finditer(body)]
        if not found:
            continue
        spans = word_spans(body)
        starts, windows = [a for a, *_ in spans], []
        for a, b in found:
            first, last = max(0, bisect_right(starts, a) - 1 - reach), min(len(spans), bisect_right(starts, b - 1) + reach)
            if windows and first <= windows[-1][1]:
                windows[-1][1] = last
            else:
                windows.append([first, last])
        for first, last in windows:
            a, b = spans[first][0] if first else 0, spans[last - 1][1] if last < len(spans) else len(body)
            blocks.append((line + body.count("\n", 0, a), body[a:b]))
    return blocks


def letters_apart(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


@functools.lru_cache(maxsize=10_000)
def spelt_otherwise(a: str, b: str) -> bool:
    return min(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= SPELLING and letters_apart(a, b) <= SPELLING


class Prices:
    """What an edit of a wording costs: 1, or ``NEVER`` where words must agree."""

    def __init__(self, names: frozenset[str] = frozenset(), short: bool = False):
        self.names, self.short = names, short

    def fixed(self, word: str) -> bool:
        return word in self.names or any(map(str.isdigit, word))

    def change(self, word: str, there: str) -> int:
        if word == there:
            return 0
        if self.fixed(word) or there in self.names or self.short and not spelt_otherwise(word, there):
            return NEVER
        return 1

    def leave_out(self, word: str) -> int:
        return NEVER if self.short or self.fixed(word) else 1

    def put_in(self, there: str) -> int:
        return NEVER if self.short or there in self.names else 1


class FreePrices(Prices):
    def fixed(self, word: str) -> bool:
        return False


def edit_costs(wording: list[str], block: list[str], prices: Prices) -> list[list[int]]:
    """For the first i words of the wording: the least price of edits into a part of the block that ends before its word j."""
    m = len(block)
    cost, put_in = [[0] * (m + 1)], [prices.put_in(b) for b in block]
    for w in wording:
        above, out = cost[-1], prices.leave_out(w)
        row = [above[0] + out] + [0] * m
        for j in range(1, m + 1):
            b = block[j - 1]
            row[j] = min(above[j - 1] + (0 if w == b else prices.change(w, b)), above[j] + out, row[j - 1] + put_in[j - 1])
        cost.append(row)
    return cost


def edits_back(cost: list[list[int]], wording: list[str], block: list[str], j: int, prices: Prices) -> tuple[list[str], list[int]]:
    """The edits of the part that ends before word j of the block, and the places of the words that agree."""
    i, found, same = len(wording), [], []
    while i:
        if j and cost[i][j] == cost[i - 1][j - 1] + prices.change(wording[i - 1], block[j - 1]):
            if wording[i - 1] != block[j - 1]:
                found.append(f"{wording[i - 1]}>{block[j - 1]}")
            else:
                same.append(j - 1)
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + prices.leave_out(wording[i - 1]):
            found.append(f"-{wording[i - 1]}")
            i -= 1
        else:
            found.append(f"+{block[j - 1]}")
            j -= 1
    return found[::-1], same[::-1]


def fewest_edits(wording: list[str], block: list[str], prices: Prices | None = None) -> tuple[int, list[str]]:
    """Word edits that turn the wording into the part of the block it fits best, and what they are."""
    prices = prices or FreePrices()
    cost = edit_costs(wording, block, prices)
    j = min(range(len(block) + 1), key=lambda x: cost[-1][x])
    return cost[-1][j], edits_back(cost, wording, block, j, prices)[0]


def license_names(wordings: dict[str, list[list[str]]]) -> frozenset[str]:
    """Words of short wordings that few licenses have in any wording."""
    held = Counter(w for texts in wordings.values() for w in {w for t in texts for w in t})
    return frozenset(w for texts in wordings.values() for t in texts if len(t) < LONG_WORDS for w in t if held[w] <= NAMED_BY)


def cues_of(templates: dict[str, tuple[str, ...]], names: frozenset[str], most_edits: float) -> Cues:
    """The fixed cues and those of wordings that hold none of them."""
    phrases = list(CUES)
    known = Counter(w for texts in templates.values() for t in texts for w in set(wording_words(t)))
    for texts in templates.values():
        for t in texts:
            if FIXED.pattern.search(t) or not (words := wording_words(t)):
                continue
            rare = sorted(words, key=lambda w: (known[w], -len(w), w))
            sure = [w for w in rare if w in names or any(map(str.isdigit, w))]
            phrases += sure[:1] or rare[:int(most_edits * len(words) + 1e-9) + 1]
    return Cues(tuple(phrases))


class Matcher:
    def __init__(self, templates: dict[str, tuple[str, ...]], level: int = LEVEL, most_edits: float = MOST_EDITS):
        bare = dict(write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        plain = zstandard.ZstdCompressionParameters.from_level(level, **bare)
        self.alone = zstandard.ZstdCompressor(compression_params=plain)
        self.given = {}
        for name, texts in templates.items():
            words = zstandard.ZstdCompressionDict("\n".join(texts).lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(compression_params=plain, dict_data=words)
        self.wordings = {name: [wording_words(t) for t in texts] for name, texts in templates.items()}
        self.names = license_names(self.wordings)
        self.cues = cues_of(templates, self.names, most_edits)
        self.most_edits = most_edits
        self.reach = max((int((1 + most_edits) * len(w)) + 1 for x in self.wordings.values() for w in x), default=0)
        self.match = functools.lru_cache(maxsize=1_000)(self._match)

    def savings(self, block: str) -> list[tuple[float, str]]:
        data = " ".join(block.lower().split()).encode()
        size = len(self.alone.compress(data))
        ranked = [(1 - len(c.compress(data)) / size, name) for name, c in self.given.items()]
        return sorted(ranked, key=lambda x: -x[0])

    def fits(self, wording: list[str], words: list[str], there: Counter) -> Iterator[tuple[int, list[str], list[int]]]:
        """Edits, what they are and the words that agree, for each end in the block where few enough edits do."""
        most, prices = int(self.most_edits * len(wording) + 1e-9), Prices(self.names, len(wording) < LONG_WORDS)
        lacked = Counter(wording) - there
        if sum(lacked.values()) > most or any(map(prices.fixed, lacked)):
            return
        cost = edit_costs(wording, words, prices)
        for j, edits in enumerate(cost[-1]):
            if edits <= most:
                yield edits, *edits_back(cost, wording, words, j, prices)

    def _match(self, block: str) -> list[tuple]:
        """Line within the block, license, savings, edits, words of the wording and differences."""
        spans = word_spans(block)
        words = [w for *_, w in spans]
        there, ranked, found = Counter(words), self.savings(block), []
        for rank, (saved, name) in enumerate(ranked):
            for wording in self.wordings[name]:
                found += [(edits - len(wording), rank, same, (name, saved, edits, len(wording), " ".join(what)))
                          for edits, what, same in self.fits(wording, words, there)]
        if not found:
            cue = FIXED.pattern.search(block)
            return [(block.count("\n", 0, cue.start()), None, ranked[0][0], None, None, None)] if cue else []
        taken, places = set(), []
        for *_, same, hit in sorted(found, key=lambda x: x[:2]):
            if taken.isdisjoint(same):
                taken.update(same)
                places.append((same[0], hit))
        return [(block.count("\n", 0, spans[at][0]), *hit) for at, hit in sorted(places)]


@functools.lru_cache(maxsize=2)
def _matcher(templates: tuple, level: int, most_edits: float) -> Matcher:
    return Matcher(dict(templates), level, most_edits)


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, level: int = LEVEL,
                  most_edits: float = MOST_EDITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    known = tuple((templates or TEMPLATES).items())
    fields = pa.schema([("doc_id", pa.int64()), ("block", pa.int32()), ("line", pa.int32()), ("license", pa.string()), ("saved", pa.float64()),
                        ("edits", pa.int32()), ("wording_words", pa.int32()), ("differences", pa.string()), ("text", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(known, level, most_edits)
        for batch in batches:
            rows = [(k, b, line + at, *hit, block) for k, body in zip(*(c.to_pylist() for c in batch.columns)) if body
                    for b, (line, block) in enumerate(candidate_blocks(body, matcher.reach, matcher.cues)) for at, *hit in matcher.match(block)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), scan, BLOCKS)
