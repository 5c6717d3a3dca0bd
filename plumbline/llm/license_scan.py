"""Licence texts in documents: MinHash over overlapping windows, then exact containment."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.common import slices, texts_of
from plumbline.llm.shingles import shingle_hashes, universal_hashes

# Notices by which texts name their licence, and passages of licences that tell them
# apart. A passage that licences share goes by the name of their family.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "the terms and conditions of this Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "the terms and conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-ND-4.0", "the terms and conditions of this Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
    ("CC-BY-NC-4.0", "the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    (
        "CC-BY-NC-SA-4.0",
        "the terms and conditions of this Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "Public License",
    ),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
    ),
    (
        "CC-BY-NC-ND-4.0",
        "the terms and conditions of this Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "Public License",
    ),
    (
        "CC0-1.0",
        "Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and "
        "surrenders all of Affirmer's Copyright and Related Rights",
    ),
    ("BSD-2-Clause", "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
    ("MIT-0", 'persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS"'),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("0BSD", 'with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS"'),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    (
        "AGPL-3.0",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software.",
    ),
    (
        "LGPL-3.0",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of "
        "the GNU General Public License, supplemented by the additional permissions listed below.",
    ),
    (
        "GPL-2.0",
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free "
        "software--to make sure the software is free for all its users.",
    ),
    (
        "LGPL-2.1",
        "This license, the Lesser General Public License, applies to some specially designated software "
        "packages--typically libraries--of the Free Software Foundation and other authors who decide to use it.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, "
        "irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
        "sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    ("MPL-2.0", "means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    (
        "EPL",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, "
        "REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
    ("EPL-1.0", "Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"),
    ("EPL-1.0", "are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0 which is available at"),
]

# Licences whose wordings are so near that a changed copy may be of any of them.
FAMILIES = {
    "BSD": ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"),
    "CC": ("CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
    "EPL": ("EPL-1.0", "EPL-2.0"),
    "GPL": ("GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0"),
}
FAMILY = {name: family for family, names in FAMILIES.items() for name in names}

WIDTH = 5
CONTAINED = 0.8
# 48 bands of one minimum. A window is at most four times its template's shingles, so
# similarity to a template of which it holds four fifths is 0.2 or more: one in 45,000 is missed.
BANDS = 48
SEED = 977

TERM = re.compile(r"[^\W_]+")
MATCH = "doc_id bigint, license string, start int, end int, containment double"


def lowered(text: str) -> str:
    """Lower case, with every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def terms(text: str) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in TERM.findall(lowered(text))]


class Templates:
    """Shingle sets, sizes and minima of the templates, by the window level that fits them.

    Level ``l`` has blocks of ``2^l`` shingles, and a window is two neighbouring
    blocks. A template is looked for on the first level whose block holds it, so
    wherever it stands, some window holds all of it.
    """

    def __init__(self, templates, width: int, bands: int):
        self.width = width
        self.a, self.b = universal_hashes(bands, SEED)
        self.names, self.sets, self.low, self.level = [], [], [], []
        for name, text in templates:
            words = terms(text)
            if len(words) < width:
                raise ValueError(f"a template needs {width} words: {text}")
            shingles = np.unique(shingle_hashes(words, width))
            self.names.append(name)
            self.sets.append(shingles)
            with np.errstate(over="ignore"):
                self.low.append((shingles[:, None] * self.a + self.b).min(axis=0))
            self.level.append(max(0, int(np.ceil(np.log2(len(words) - width + 1)))))
        # By template: its shingles that a template of the same family lacks, for each that shares some.
        self.telling = [
            [own for own in map(np.setdiff1d, [a] * len(others), others) if len(own) < len(a)]
            for name, a in zip(self.names, self.sets)
            for others in [[b for n, b in zip(self.names, self.sets) if n != name and FAMILY.get(n) == FAMILY.get(name, "")]]
        ]
        self.levels = max(self.level) + 1
        # By level and band: a table of low bits that sifts minima, and template numbers by minimum.
        self.sieve = [[np.zeros(1 << 16, bool) for _ in range(bands)] for _ in range(self.levels)]
        for t, level in enumerate(self.level):
            for j in range(bands):
                self.sieve[level][j][int(self.low[t][j] & np.uint64(0xFFFF))] = True
        self.used = [any(at == level for at in self.level) for level in range(self.levels)]

    def candidates(self, values: np.ndarray) -> set[tuple[int, int]]:
        """``(template, window)`` that share a minimum in some band."""
        found = set()
        buffer = np.empty(len(values), "u8")
        for j in range(len(self.a)):
            with np.errstate(over="ignore"):
                np.multiply(values, self.a[j], out=buffer)
                np.add(buffer, self.b[j], out=buffer)
            block = buffer
            for level in range(self.levels):
                if self.used[level]:
                    window = np.minimum(block[:-1], block[1:]) if len(block) > 1 else block
                    for i in np.flatnonzero(self.sieve[level][j][window.astype("u2")]):
                        for t, at in enumerate(self.level):
                            if at == level and self.low[t][j] == window[i]:
                                found.add((t, int(i)))
                even = len(block) // 2 * 2
                halved = np.minimum(block[0:even:2], block[1:even:2])
                block = np.append(halved, block[-1]) if len(block) % 2 else halved
        return found

    def matches(self, texts: list[str], contained: float) -> dict[int, list[tuple[str, int, int, float]]]:
        """By text number, its ``license, first word, last word + 1, containment``.

        The texts' shingles stand in one row. A window may reach into the next
        text; what it holds is judged text by text.
        """
        made = [shingle_hashes(w, self.width) if len(w) >= self.width else np.empty(0, "u8") for w in map(terms, texts)]
        values = np.concatenate(made) if made else np.empty(0, "u8")
        if not len(values):
            return {}
        begins = np.concatenate([[0], np.cumsum([len(v) for v in made])])
        spans: dict[int, list[tuple]] = {}
        for t, i in self.candidates(values):
            size = 1 << self.level[t]
            lo, hi = i * size, min((i + 2) * size, len(values))
            inside = lo + np.flatnonzero(np.isin(values[lo:hi], self.sets[t]))
            owner = np.searchsorted(begins, inside, "right") - 1
            for d in np.unique(owner):
                own = inside[owner == d]
                held = np.unique(values[own])
                share = len(held) / len(self.sets[t])
                if share >= contained:
                    first, last = int(own[0] - begins[d]), int(own[-1] - begins[d])
                    told = all(2 * np.isin(x, held).sum() >= len(x) for x in self.telling[t] if len(x))
                    name = self.names[t] if told else FAMILY[self.names[t]]
                    spans.setdefault(int(d), []).append((share, first, last + self.width, t, name))
        out = {}
        for d, found in spans.items():
            # Neighbouring windows see one occurrence; the one that holds most of it stands.
            found.sort(key=lambda s: (s[4] in FAMILIES, -s[0], -len(self.sets[s[3]]), s[1], s[2], s[3]))
            kept: list[tuple] = []
            for s in found:
                if not any(k[1] < s[2] and s[1] < k[2] for k in kept):
                    kept.append(s)
            kept.sort(key=lambda s: s[1])
            out[d] = sorted((self._named(kept, i), lo, hi, share) for i, (share, lo, hi, _, _) in enumerate(kept))
        return out

    def _named(self, kept: list[tuple], i: int) -> str:
        """The licence of a match: a shared opening has that of its family's next passage, up to the next opening."""
        *_, t, name = kept[i]
        if self.names[t] in FAMILIES:
            for *_, u, following in kept[i + 1 :]:
                if self.names[u] == name:
                    break
                if FAMILY.get(following) == name:
                    return following
        return name


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    width: int = WIDTH,
    contained: float = CONTAINED,
    bands: int = BANDS,
) -> DataFrame:
    """A row per match: ``doc_id, license, start, end, containment``.

    Every whole text is cut into overlapping windows of words, lower-cased and
    without signs, on as many scales as templates need. A window that shares the
    minimum of any of the hashes with a template is its candidate; it matches if it
    holds ``contained`` of the template's distinct shingles. ``start`` and ``end``
    (exclusive) are code points. Of overlapping matches one that names a licence
    stands before one of a family, then the one with the largest containment, then
    the longer template.

    A passage that licences share is reported by their family (BSD, EPL), or by the
    licence whose own passage follows before the next such opening. A match that
    holds less than half of what tells its template from one of the same family is
    reported by the family (GPL, CC). Licences without a template are not found.

    Null, empty and short texts have no matches. Rows that share an id are scanned
    apart. Templates are a fixed list, sent with the task.
    """
    made = Templates(templates, width, bands)

    def scan(batches):
        for batch in batches:
            # Runs of about 400 kB keep the values of one pass in a core's cache.
            for part in slices(batch, 400_000):
                out = []
                keys, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                for d, found in sorted(made.matches(texts, contained).items()):
                    at = [m.span() for m in TERM.finditer(lowered(texts[d]))]
                    out += [(keys[d], name, at[lo][0], at[hi - 1][1], share) for name, lo, hi, share in found]
                if out:
                    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64()]
                    names = ["doc_id", "license", "start", "end", "containment"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return texts_of(docs, id_col, text_col).mapInArrow(scan, MATCH)
