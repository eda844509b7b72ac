"""Licence scans by sentence rules.

A text is cut into sentence parts, parts are normalised to lower-case words, and runs of whole parts that spell a
known licence sentence become that sentence's identifier.  The identifier sequence of a text is then matched
against ordered rules: a rule holds where its sentences follow each other in order with at most ``GAP`` other parts
between two of them.  A sentence may be wrapped over lines or stand behind comment signs; copyright lines and
holders may stand between the sentences.

One pass over the texts, no shuffle; the rules are a few kilobytes in the code.

Defined cases: null and empty texts have no part and no licence; of rules that start at the same place the longest
counts; repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import re
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

GAP = 4

# The sentences of well-known licences and notices, by identifier.
SENTENCES = {
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "by-nc": "Licensed under CC BY-NC 4.0.",
    "mit-short": "Released under the MIT License.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "mit-title": "The MIT License",
    "mit-title-short": "MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "by": "Licensed under CC BY 4.0.",
    "by-sa": "Licensed under CC BY-SA 4.0.",
    "cc0": "Released under CC0 1.0.",
}
# Licences as ordered sentences.
RULES = (
    ("GPL-3.0-only", ("gpl3-work",)),
    ("CC-BY-NC-4.0", ("by-nc",)),
    ("CC-BY-4.0", ("by",)),
    ("CC-BY-SA-4.0", ("by-sa",)),
    ("CC0-1.0", ("cc0",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-title-short", "mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-header", "apache-comply")),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-obtain", "apache-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("MPL-2.0", ("mpl2",)),
    ("Unlicense", ("unlicense",)),
)

_PARTS = re.compile(r"(?<=[.!?;:])\s+|[\r\n]+")
_WORDS = re.compile(r"[a-z0-9]+")


def normalised(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class Scanner:
    """Known sentences by first word, longest first, and rules by first identifier, longest first."""

    def __init__(self, sentences=None, rules=RULES, gap: int = GAP):
        self.gap = gap
        self.by_word: dict[str, list[tuple[list[str], str]]] = {}
        for name, sentence in (sentences or SENTENCES).items():
            words = normalised(sentence)
            self.by_word.setdefault(words[0], []).append((words, name))
        for known in self.by_word.values():
            known.sort(key=lambda x: (-len(x[0]), x[1]))
        self.by_first: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
        for licence, names in rules:
            self.by_first.setdefault(names[0], []).append((licence, names))
        for of in self.by_first.values():
            of.sort(key=lambda x: (-len(x[1]), x[0]))

    def identifiers(self, text: str | None) -> tuple[int, list[tuple[int, int, str]]]:
        """Number of parts with words, and (first part, part after the last, identifier) of known sentences in order."""
        parts = [words for words in map(normalised, _PARTS.split(text or "")) if words]
        found, at = [], 0
        while at < len(parts):
            step = at + 1
            for words, name in self.by_word.get(parts[at][0], ()):
                end = self._spelled(parts, at, words)
                if end:
                    found.append((at, end, name))
                    step = end
                    break
            at = step
        return len(parts), found

    @staticmethod
    def _spelled(parts: list[list[str]], at: int, words: list[str]) -> int:
        """The part after those that together are exactly ``words``; 0 if there are none."""
        done = 0
        while done < len(words):
            if at == len(parts) or parts[at] != words[done : done + len(parts[at])]:
                return 0
            done += len(parts[at])
            at += 1
        return at if done == len(words) else 0

    def licences(self, found: list[tuple[int, int, str]]) -> list[tuple[str, int, int]]:
        """(licence, first part, part after the last) of every rule that holds."""
        out, at = [], 0
        while at < len(found):
            step = at + 1
            for licence, names in self.by_first.get(found[at][2], ()):
                last = self._follows(found, at, names)
                if last is not None:
                    out.append((licence, found[at][0], found[last][1]))
                    step = last + 1
                    break
            at = step
        return out

    def _follows(self, found, at: int, names: tuple[str, ...]) -> int | None:
        for name in names[1:]:
            end, at = found[at][1], at + 1
            while at < len(found) and found[at][2] != name and found[at][0] - end <= self.gap:
                at += 1
            if at == len(found) or found[at][2] != name or found[at][0] - end > self.gap:
                return None
        return at


def scan(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    doc_id, n_parts, identifiers (array, in order), licences (sorted distinct array), matches (licence, first, end in parts).
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(gap=gap)
        for batch in batches:
            out = []
            for text in batch["text"]:
                n_parts, found = scanner.identifiers(text)
                matches = scanner.licences(found)
                out.append((n_parts, [x[2] for x in found], sorted({m[0] for m in matches}), [dict(zip(("licence", "first", "end"), m)) for m in matches]))
            yield pd.DataFrame(out, columns=["n_parts", "identifiers", "licences", "matches"]).assign(doc_id=batch["doc_id"])

    # Ids go as text: beside nulls pandas would make them floats.
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        rows, "n_parts long, identifiers array<string>, licences array<string>, matches array<struct<licence:string,first:long,end:long>>, doc_id string"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
