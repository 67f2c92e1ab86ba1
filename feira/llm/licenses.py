"""License notices in texts, found by patience alignment with templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# The notices looked for.
TEMPLATES = {
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details."
    ),
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer."
    ),
}
# Phrases that tell a license from its relatives. Each must stand in the text, word after
# word, where the template's is aligned.
DECIDING = {
    "All-rights-reserved": ("all rights", "reserved"),
    "Apache-2.0": ("apache", "2 0"),
    "Apache-2.0-header": ("apache", "2 0"),
    "CC-BY-NC-4.0": ("cc by nc", "4 0"),
    "GPL-3.0": ("gnu general public license", "version 3"),
    "GPL-3.0-header": ("gnu general public license", "version 3"),
    "MIT": ("mit",),
    "MIT-permission": ("without restriction", "sell"),
}
# Words that make another license of it when they stand inside the stretch.
FOREIGN = {
    "Apache-2.0-header": ("educational",),
    "CC-BY-NC-4.0": ("nd", "sa"),
    "GPL-3.0": ("affero", "lesser", "library"),
    "GPL-3.0-header": ("affero", "lesser"),
    "MIT": ("0", "no"),
}
# Words that turn a notice around when they stand before it.
NEGATIONS = ("not", "never", "neither", "nor")
# Part of a template's words that must be aligned.
COVERAGE = 0.8
# Stretches of one text whose alignment is remembered.
REMEMBERED = 4096
# The aligned stretch of the text may be this much longer than the template.
STRETCH = 1.5

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

_NEGATIONS = frozenset(word.encode() for word in NEGATIONS)

SCHEMA = StructType(
    [
        StructField("license", StringType()),
        StructField("coverage", DoubleType()),
        StructField("first_word", LongType()),
        StructField("last_word", LongType()),
        StructField("n_notices", LongType()),
    ]
)


def plain_words(text: str) -> list[bytes]:
    """Words in lower case (A-Z), cut at every ASCII character but letters and digits."""
    return text.encode().translate(_LETTERS).split()


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first part, whose second part rises too."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        length = bisect_left(tails, b)
        before[i] = ends[length - 1] if length else -1
        if length == len(tails):
            tails.append(b)
            ends.append(i)
        else:
            tails[length], ends[length] = b, i
    chosen, i = [], ends[-1] if ends else -1
    while i >= 0:
        chosen.append(pairs[i])
        i = before[i]
    return chosen[::-1]


def _single(words: list[bytes], begin: int, end: int) -> dict[bytes, int]:
    """Words that occur once in the stretch, and where."""
    counts = Counter(words[begin:end])
    return {words[i]: i for i in range(begin, end) if counts[words[i]] == 1}


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Patience alignment: pairs of places with equal words, rising in both.

    Words that occur once in both stretches anchor it, as far as their order agrees; the gaps
    between anchors are aligned in the same way, after equal words at their ends are paired off.
    """
    pairs = []
    open_gaps = [(0, len(a), 0, len(b))]
    while open_gaps:
        i, j, k, m = open_gaps.pop()
        while i < j and k < m and a[i] == b[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            pairs.append((j, m))
        if i == j or k == m:
            continue
        ours, theirs = _single(a, i, j), _single(b, k, m)
        anchors = _rising(sorted((place, theirs[w]) for w, place in ours.items() if w in theirs))
        if not anchors:
            continue
        pairs += anchors
        for place, other in (*anchors, (j, m)):
            open_gaps.append((i, place, k, other))
            i, k = place + 1, other + 1
    return sorted(pairs)


@dataclass(frozen=True)
class Template:
    name: str
    words: list[bytes]
    deciding: list[list[bytes]]
    foreign: frozenset[bytes]

    @property
    def counts(self) -> Counter:
        return Counter(self.words)

    @property
    def phrases(self) -> list[tuple[int, list[bytes]]]:
        """The deciding phrases and where they first stand in the template."""
        found = []
        for phrase in self.deciding:
            places = range(len(self.words) - len(phrase) + 1)
            place = next((i for i in places if self.words[i : i + len(phrase)] == phrase), None)
            if place is None:
                raise ValueError(f"template {self.name} does not hold {b' '.join(phrase).decode()!r}")
            found.append((place, phrase))
        return found


def decided(
    words: list[bytes],
    pairs: list[tuple[int, int]],
    phrases: list[tuple[int, list[bytes]]],
    foreign: frozenset[bytes],
    size: int,
) -> bool:
    """Whether each phrase stands in the text where one of its words is aligned, with no foreign word between.

    A foreign word in the place of the template's last words counts as well, and so does a negation in front. `size`
    is the number of words of the template.
    """
    at = {other: place for place, other in pairs}
    for begin, phrase in phrases:
        starts = [at[begin + i] - i for i in range(len(phrase)) if begin + i in at]
        if not any(start >= 0 and words[start : start + len(phrase)] == phrase for start in starts):
            return False
    (first, begin), (last, end) = pairs[0], pairs[-1]
    # Words of the template that are not aligned may stand changed at the ends.
    in_front = words[max(0, first - begin - 1) : first]
    return foreign.isdisjoint(words[first : last + size - end]) and _NEGATIONS.isdisjoint(in_front)


class Scanner:
    """Looks for all templates in one text after the other."""

    def __init__(
        self,
        templates: dict[str, str],
        coverage: float,
        stretch: float,
        deciding: dict[str, tuple[str, ...]] | None = None,
        foreign: dict[str, tuple[str, ...]] | None = None,
    ):
        self.templates = [
            Template(
                name,
                plain_words(text),
                [plain_words(phrase) for phrase in (deciding or {}).get(name, ())],
                frozenset(word for words in (foreign or {}).get(name, ()) for word in plain_words(words)),
            )
            for name, text in sorted(templates.items())
        ]
        self.counts = [template.counts for template in self.templates]
        self.phrases = [template.phrases for template in self.templates]
        self.coverage, self.stretch = coverage, stretch

    def notices(self, text: str) -> Iterator[tuple[str, float, int, int]]:
        """(template, coverage, first word, last word) of every notice, template by template."""
        words = plain_words(text)
        known = set(words)
        for template, counts, phrases in zip(self.templates, self.counts, self.phrases):
            size = len(template.words)
            need = max(1, -int(-self.coverage * size // 1))
            # No alignment can pair more words than the text has of the template's.
            if sum([counts[w] for w in known & counts.keys()]) < need:
                continue
            if all(known.issuperset(phrase) for _, phrase in phrases):
                yield from self._stretches(words, template, counts, phrases, need)

    def _stretches(self, words, template, counts, phrases, need) -> Iterator[tuple[str, float, int, int]]:
        size = len(template.words)
        longest = int(self.stretch * size) + 1
        hits = [i for i, w in enumerate(words) if w in counts]
        after = 0
        # Alignments by the words of a stretch: text that is repeated is aligned once.
        aligned: dict[bytes, list[tuple[int, int]]] = {}
        for last in range(need - 1, len(hits)):
            begin, end = hits[last - need + 1], hits[last] + 1
            if begin < after or end - begin > longest:
                continue
            # The words that are still missing may stand on either side, or be those of another notice.
            left, right = max(after, begin - longest + need), min(len(words), begin + longest)
            for i, j in dict.fromkeys(((left, right), (begin, right), (left, end), (begin, end))):
                stretch = b" ".join(words[i:j])
                found = aligned.get(stretch)
                if found is None:
                    if len(aligned) > REMEMBERED:
                        aligned.clear()
                    found = aligned[stretch] = align(words[i:j], template.words)
                if len(found) < need or found[-1][0] - found[0][0] >= longest:
                    continue
                pairs = [(i + place, other) for place, other in found]
                if decided(words, pairs, phrases, template.foreign, size):
                    yield template.name, len(pairs) / size, pairs[0][0], pairs[-1][0]
                    after = pairs[-1][0] + 1
                    break

    def best(self, text: str) -> tuple[str, float, int, int, int] | None:
        """The notice with the most aligned words of the whole text, and the number of notices.

        Of equal ones the higher coverage, then the first name, then the first place.
        """
        found = list(self.notices(text))
        sizes = {t.name: len(t.words) for t in self.templates}
        if not found:
            return None
        first = min(found, key=lambda n: (-round(n[1] * sizes[n[0]]), -n[1], n[0], n[2]))
        return (*first, len(found))


def licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    stretch: float = STRETCH,
    key: str = "doc_id",
    text: str = "text",
    deciding: dict[str, tuple[str, ...]] | None = None,
    foreign: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word, n_notices), one row per document.

    `license` is the template that the text covers with the most words, NULL without any; places count
    the words of `plain_words`. A NULL or empty text has no notice. Repeated rows and rows with a NULL
    key get each their own result; other columns are left out; a table without rows gives no rows.
    Each text is looked at by itself, so nothing is shuffled.

    `deciding` and `foreign` give, by template, the phrases that must stand in the text and the words that
    must not stand between; without them DECIDING and FOREIGN hold for the default templates and none for others.
    """
    chosen = TEMPLATES if templates is None else templates
    if templates is None:
        deciding = DECIDING if deciding is None else deciding
        foreign = FOREIGN if foreign is None else foreign

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, coverage, stretch, deciding, foreign)
        for batch in batches:
            found = [scanner.best(value.as_py() or "") for value in batch.column(1)]
            columns = zip(*[row or (None, 0.0, None, None, 0) for row in found])
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
            if len(found):
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema.fieldNames())

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = StructType([StructField("doc_id", picked.schema["k"].dataType), *SCHEMA])
    return picked.mapInArrow(run, schema)
