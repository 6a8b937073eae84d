"""License notices by conditional compression: what a template shortens most is compared with it word by word."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import steps

# Wording of well-known license notices, by SPDX identifier. Both whole notices and short lines.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        'the "Software", to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "LGPL-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."),
}

#: A block is looked at if it holds one of these; each template does.
CUES = r"(?i)licen[sc]e|redistribution and use|permission is hereby|free software|public domain|creative commons|\bcc0\b|\bcc[ -]by\b"

# Words that tell variants of a license apart. They, and all words with a digit, must be the same in text and template.
VARIANTS = frozenset("affero lesser library noncommercial sharealike noderivatives noderivs nc sa nd".split())

_WORD = re.compile(r"[a-z0-9]+")
_BLOCK = re.compile(r"[^\n]+(?:\n(?!\s*\n)[^\n]+)*")
_LINE = re.compile(r"[^\n]+")


@dataclass(frozen=True)
class Settings:
    """``reduction``: bytes that a template must save of those of the block's best window, as a share.

    ``same``: share of template words that the window must hold in order. Every template that saves
    enough is compared by wording, in the order of its saving.
    """

    reduction: float = 0.35
    same: float = 0.85
    templates: dict[str, tuple[str, ...]] = field(default_factory=lambda: TEMPLATES)


@dataclass(frozen=True)
class Match:
    license: str
    start: int
    end: int
    reduction: float
    same: float
    missing: str
    added: str


class Scanner:
    """Compressors by template; the plain one is the yardstick."""

    def __init__(self, s: Settings):
        self.s = s
        self.forms = [(name, text, _WORD.findall(text.lower())) for name, texts in sorted(s.templates.items()) for text in texts]
        self.plain = zstandard.ZstdCompressor(level=6)
        self.given = [zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, _, w in self.forms]

    def windows(self, text: str) -> Iterator[tuple[int, int]]:
        """Spans of lines that hold a cue, and of the whole paragraph if it has several lines."""
        for block in _BLOCK.finditer(text):
            if not _CUE.search(block[0]):
                continue
            lines = [m for m in _LINE.finditer(block[0])]
            for m in lines:
                if _CUE.search(m[0]):
                    yield block.start() + m.start(), block.start() + m.end()
            if len(lines) > 1:
                yield block.start(), block.end()

    def best(self, words: list[tuple[str, int, int]]) -> tuple[Match, int, int] | None:
        """The winner among the words (each with its place), and which of them it covers."""
        plain = [w for w, _, _ in words]
        raw = " ".join(plain).encode()
        size = len(self.plain.compress(raw))
        ranked = sorted(((size - len(c.compress(raw))), -len(form[2]), i) for i, (c, form) in enumerate(zip(self.given, self.forms, strict=True)))[::-1]
        found = None
        for saved, _, i in ranked:
            name, _, form = self.forms[i]
            share = saved / max(min(size, len(" ".join(form))), 1)
            # A notice within much other text saves little of the text, but much of its own length.
            if share < self.s.reduction and saved < self.s.reduction * len(" ".join(form)):
                continue
            runs = [r for r in difflib.SequenceMatcher(None, form, plain, autojunk=False).get_matching_blocks() if r.size]
            if not runs:
                continue
            # Words at either end that differ are part of the notice, too.
            first = max(0, runs[0].b - runs[0].a)
            last = min(len(plain), runs[-1].b + runs[-1].size + len(form) - runs[-1].a - runs[-1].size)
            same = sum(r.size for r in runs) / len(form)
            kept = {r.a + k for r in runs for k in range(r.size)}
            used = {r.b + k for r in runs for k in range(r.size)}
            missing = [w for k, w in enumerate(form) if k not in kept]
            added = [w for k, w in enumerate(plain[first:last], first) if k not in used]
            if same < self.s.same or len(added) > (1 - self.s.same) * len(form):
                continue
            if any(w in VARIANTS or any(c.isdigit() for c in w) for w in (*missing, *added)):
                continue
            match = Match(name, words[first][1], words[last - 1][2], share, same, " ".join(missing), " ".join(added))
            if found is None or (match.same, -len(added), len(form)) > found[0]:
                found = (match.same, -len(added), len(form)), (match, first, last)
        return found[1] if found else None

    def all_of(self, text: str, start: int, end: int) -> list[Match]:
        """Every notice in a span: after one is found, the words on both its sides are looked at in the same way."""
        words = [(m[0], start + m.start(), start + m.end()) for m in _WORD.finditer(text[start:end].lower())]
        out, open_ = [], [(0, len(words))]
        while open_:
            a, b = open_.pop()
            if b > a and (found := self.best(words[a:b])):
                match, first, last = found
                out.append(match)
                open_ += [(a, a + first), (a + last, b)]
        return out

    def scan(self, text: str) -> list[Match]:
        """Matches of a text in order; of those that overlap the one that covers most stays."""
        found = [m for span in self.windows(text) for m in self.all_of(text, *span)]
        kept: list[Match] = []
        for m in sorted(set(found), key=lambda m: (m.start - m.end, m.start, -m.same, m.license)):
            if all(m.end <= k.start or k.end <= m.start for k in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: m.start)


_CUE = re.compile(CUES)
_SCANNERS: dict[int, Scanner] = {}


def scan(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, license, start, end (code points), reduction, same, missing and added words: a row a notice found.

    Texts are whole. Those without a cue never leave the scan of the table; null and empty texts have no rows.
    Repeated rows give repeated results, and other columns are not read. Differences are words of the template that the text lacks, and words in between that it adds.
    """
    key = hash(tuple(sorted(s.templates.items())) + (s.reduction, s.same))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCANNERS:
            _SCANNERS[key] = Scanner(s)
        scanner = _SCANNERS[key]
        for batch in batches:
            for part in steps(batch, "text"):
                rows = [(d, m.license, m.start, m.end, m.reduction, m.same, m.missing, m.added) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True) for m in scanner.scan(t)]
                columns = list(zip(*rows, strict=True)) or [[]] * 8
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "license", "start", "end", "reduction", "same", "missing", "added"])

    cued = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike(CUES))
    return cued.mapInArrow(find, "doc_id long, license string, start long, end long, reduction double, same double, missing string, added string")
