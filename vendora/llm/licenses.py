"""License scans by conditional compression.

Candidate blocks are runs of sentences and lines of a paragraph that hold a cue word, wherever its lines break, and, so that a
notice inside a sentence is cut out of it, the windows of each template's word count that hold the words that name its license
and share most words with it. A block whose words allow a template is compressed alone and with it as a zstandard raw dictionary; templates that
make it smaller are confirmed by their exact wording: words of the template that the block lacks and words it adds
are listed, and a template is accepted if few differ, none of those that name the license, and no word was added that would name
another (``QUALIFIERS``). One row is returned
per block that is accepted; of blocks that overlap the most similar counts, and the longest of equals.

The scan is one pass without a shuffle; what a task learns about a block it keeps for later copies of it.

Defined cases: null and empty texts have no block; repeated rows are reported as often as they stand; a null id is
kept; paragraphs may have any length, blocks have at most the words that the longest template can be accepted with; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUES = r"(?i)licen[cs]|copyright|rights\s+reserved|permission\s+is\s+hereby|public\s+domain|redistribut|warrant|\b[la]?gpl|\bspdx|creative\s+commons|\bcc[ -]by\b"
#: Words that make another license of one: a block that adds one of them to a template's wording is not that template's.
QUALIFIERS = {"sa", "nc", "nd", "lesser", "library", "affero", "not", "no"}
#: Notice wordings by paragraph, and the words of each that name the license.
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("MIT", "This project is licensed under the terms of the MIT license.", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "sublicense"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general public 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0.", "gnu general public v3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general public 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser public 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero public 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3 clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", "bsd 2 clause"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "redistribution binary"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("ISC", "Licensed under the ISC License.", "isc"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative commons attribution 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "cc by nc sa 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal Public Domain Dedication.", "cc0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu general public 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gnu general public 2"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu lesser public 3"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "gnu lesser public 2.1"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu affero public 3"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", "unless applicable governing limitations license"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "redistributions source retain disclaimer"),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions binary reproduce disclaimer"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "neither contributors endorse promote"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "permission fee granted appear"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla mpl 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "eclipse 2.0"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "permission alter redistribute restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:", "organization execute transmit derivative"),
    ("Proprietary", "All rights reserved.", "all rights reserved"),
    ("Proprietary", "Copyright. All rights reserved.", "copyright rights reserved"),
    ("MIT", "available under the MIT license", "mit"),
    ("Apache-2.0", "available under the Apache License 2.0", "apache 2.0"),
    ("GPL-2.0", "under the GNU GPL v2", "gpl v2"),
    ("GPL-2.0", "under the GPL version 2", "gpl 2"),
    ("GPL-3.0", "under the GNU GPL v3", "gpl v3"),
    ("GPL-3.0", "under the GPL version 3", "gpl 3"),
    ("LGPL-2.1", "under the GNU LGPL v2.1", "lgpl v2.1"),
    ("LGPL-3.0", "under the GNU LGPL v3", "lgpl v3"),
    ("AGPL-3.0", "under the GNU AGPL v3", "agpl v3"),
    ("CC-BY-4.0", "under CC BY 4.0", "cc by 4.0"),
    ("CC-BY-SA-4.0", "under CC BY-SA 4.0", "cc by sa 4.0"),
    ("CC-BY-NC-4.0", "under CC BY-NC 4.0", "cc by nc 4.0"),
    ("CC-BY-NC-SA-4.0", "under CC BY-NC-SA 4.0", "cc by nc sa 4.0"),
)
#: Identifiers that a one-line tag may name.
TAGS = (
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "Unlicense", "EPL-2.0", "Zlib", "BSL-1.0",
)
TEMPLATES += tuple((tag.removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {tag}", "spdx " + " ".join(tag.lower().split("-"))) for tag in TAGS)
KEPT_BLOCKS = 20_000
_word = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_any_word = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")


def words(text: str) -> list[str]:
    return _word.findall(text.lower())


def _plain(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


class Scanner:
    """Ranks and confirms templates; one per Python worker."""

    def __init__(self, templates=TEMPLATES, min_words: float = 0.8, min_reduction: float = 0.3):
        import zstandard

        options = {"level": 19, "write_checksum": False, "write_content_size": False}
        self.alone = zstandard.ZstdCompressor(**options)
        self.frame = len(self.alone.compress(b""))  # bytes that no dictionary saves
        self.with_template = []
        for _, wording, _ in templates:
            raw = zstandard.ZstdCompressionDict(_plain(wording), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template.append(zstandard.ZstdCompressor(dict_data=raw, write_dict_id=False, **options))
        self.templates = [(name, words(wording), set(words(must))) for name, wording, must in templates]
        self.counts = [Counter(want) for _, want, _ in self.templates]
        self.min_words, self.min_reduction = min_words, min_reduction
        # no block of more words can have the share
        self.most = int(max(len(want) for _, want, _ in self.templates) * (2 / min_words - 1) + 1e-9)
        self.known: dict[str, tuple | None] = {}

    def judge(self, block: str) -> tuple | None:
        """(license, reduction, similarity, missing, added) of the block's accepted template."""
        if block not in self.known:
            if len(self.known) >= KEPT_BLOCKS:
                self.known.clear()
            self.known[block] = self._judge(block)
        return self.known[block]

    def _judge(self, block: str) -> tuple | None:
        have, best = words(block), None
        held, count = set(have), Counter(have)
        fit = [i for i, (_, want, must) in enumerate(self.templates) if must <= held and 2 * (count & self.counts[i]).total() >= self.min_words * (len(want) + len(have)) - 1e-9]
        if not fit:
            return None
        raw = _plain(block)
        base = len(self.alone.compress(raw)) - self.frame
        reduction = {i: 1 - (len(self.with_template[i].compress(raw)) - self.frame) / base for i in fit}
        for i in sorted(fit, key=lambda i: (-reduction[i], i)):
            name, want, _ = self.templates[i]
            if reduction[i] < self.min_reduction:
                continue
            diff = difflib.SequenceMatcher(None, want, have, autojunk=False)
            missing, added = [], []
            for op, a, b, c, d in diff.get_opcodes():
                if op != "equal":
                    missing += want[a:b]
                    added += have[c:d]
            share = 2 * (len(want) - len(missing)) / max(len(want) + len(have), 1)
            if share >= self.min_words - 1e-9 and not QUALIFIERS & set(added) and (best is None or share > best[2]):
                best = (name, reduction[i], share, " ".join(missing), " ".join(added))
        return best

    def windows(self, text: str) -> Iterator[tuple[int, int]]:
        """Of every run of neighbouring windows of a template's word count that hold its naming words and could have the share: those with most words in common."""
        for p in cued(text):
            found = [(m[0], p.start() + m.start(), p.start() + m.end()) for m in _word.finditer(p[0].lower())] if p[0].isascii() else [(m[0].lower(), m.start(), m.end()) for m in _any_word.finditer(text, p.start(), p.end())]
            places: dict[str, list[int]] = {}
            for i, (w, _, _) in enumerate(found):
                places.setdefault(w, []).append(i)
            for (_, want, must), count in zip(self.templates, self.counts, strict=True):
                if all(w in places for w in must) and len(found) >= len(want):
                    yield from self._alike(found, places, len(want), must, count)

    def _alike(self, found: list[tuple], places: dict[str, list[int]], n: int, must: set[str], count: Counter) -> Iterator[tuple[int, int]]:
        rarest = min(must, key=lambda w: len(places[w]))
        starts = sorted({s for i in places[rarest] for s in range(max(0, i - n + 1), min(i, len(found) - n) + 1)})
        held: Counter = Counter()
        common, last, best, run = 0, None, 0, []
        for s in [*starts, None]:
            if s is None or last is None or s != last + 1:
                yield from run
                best, run = 0, []
                if s is None:
                    return
                held = Counter(w for w, _, _ in found[s : s + n])
                common = (held & count).total()
            else:
                out, new = found[last][0], found[s + n - 1][0]
                common -= held[out] <= count[out]
                held[out] -= 1
                common += held[new] < count[new]
                held[new] += 1
            last = s
            if common < self.min_words * n - 1e-9 or any(not held[w] for w in must):
                yield from run
                best, run = 0, []
            elif common >= best:
                run = [*(run if common == best else ()), (found[s][1], found[s + n - 1][2])]
                best = common

    def scan(self, text: str) -> list[tuple]:
        """(start, end, license, reduction, similarity, missing, added) by place."""
        found = [(s, e, *x) for s, e in dict.fromkeys((*blocks(text, self.most), *self.windows(text))) if (x := self.judge(text[s:e]))]
        out: list[tuple] = []
        for x in sorted(found, key=lambda x: (-x[4], x[0] - x[1], x[0])):
            if all(x[1] <= s or e <= x[0] for s, e, *_ in out):
                out.append(x)
        return sorted(out)


_cue = re.compile(CUES)
_paragraph = re.compile(r"[^\n]+(?:\n[^\n]+)*")
#: Where a sentence or a line ends; ``v.`` is an abbreviation.
_end = re.compile(r"(?<!\bv)(?<!\bV)[.!?](?=\s)|(?=\n)|\Z")


def cued(text: str) -> Iterator[re.Match]:
    """The paragraphs with a cue."""
    if _cue.search(text):
        for p in _paragraph.finditer(text):
            if _cue.search(text, p.start(), p.end()):
                yield p


def blocks(text: str, most: int) -> Iterator[tuple[int, int]]:
    """Candidate blocks: runs of sentences and lines within a paragraph, of up to ``most`` words and with a cue."""
    for p in cued(text):
        cues = [(m.start(), m.end()) for m in _cue.finditer(text, p.start(), p.end())]
        parts, at = [], p.start()
        for m in _end.finditer(p[0]):
            end = p.start() + m.end()
            piece = text[at:end]
            if piece.strip():
                parts.append((at + len(piece) - len(piece.lstrip()), at + len(piece.rstrip()), len(words(piece))))
            at = end
        c = 0
        for i, (start, _, _) in enumerate(parts):
            while c < len(cues) and cues[c][0] < start:
                c += 1
            if c == len(cues):
                break
            n = 0
            for _, end, size in parts[i:]:
                n += size
                if n > most:
                    break
                if cues[c][1] <= end:
                    yield start, end


_scanner: list[Scanner] = []


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    if not _scanner:
        _scanner.append(Scanner())
    names = ["k", "no", "start", "end", "license", "reduction", "similarity", "missing", "added"]
    for batch in batches:
        rows = [(k, no, *x) for k, no, t in zip(batch["k"].tolist(), batch["no"].tolist(), batch["t"], strict=True) for x in _scanner[0].scan(t)]
        yield pd.DataFrame(rows, columns=names)


def license_scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, start, end, license, reduction, similarity, missing, added): each accepted block of each text, k its id."""
    ident = F.col(key).cast("long")
    some = df.select(F.coalesce(ident, F.lit(0)).alias("k"), ident.isNull().alias("no"), F.col(text).alias("t")).filter(F.col("t").rlike(CUES))
    found = some.mapInPandas(_rows, "k long, no boolean, start long, end long, license string, reduction double, similarity double, missing string, added string")
    return found.withColumn("k", F.when(~F.col("no"), F.col("k"))).drop("no")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: license notices in ``documents``."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("k", "doc_id")
