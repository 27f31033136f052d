"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Words are lower-cased (ASCII) and freed of ASCII punctuation; shingles are runs of three words. For every template
length there are windows of that many shingles, a quarter of it apart, so that some window shares at least about
three quarters of its shingles with a template that lies in the text. Window and template are compared by
BANDS bands of ROWS MinHash values: at similarity 0.5 they meet with probability 0.999, at 0.7 with 0.9999999.
A window that holds no shingle of any template cannot meet one and is not hashed. A retrieved template is verified
by its exact containment: the share of its distinct shingles that lie in a run of as many shingles as it has, of all such
runs up to one step from the window the one that holds most. As sister
licenses differ in a word or two, the match must also hold the template's deciding words, one after the other; titles
and short forms (`titles`) are made by rule from families and versions and must stand there word for word. A match that
lies within a match of a larger template which holds all its shingles is part of that statement and not told twice.

Defined cases: null and empty texts match nothing; texts are scanned whole; templates of fewer than three words are
refused; overlapping finds of one template are one match; repeated rows are scanned one by one; an empty table gives
no rows; only the id and text columns are read. Templates are a bounded parameter, known to every task.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import SPACE, mixed, shingles, word_hashes

K = 3
BANDS, ROWS = 24, 2
CONTAINMENT = 0.8

#: Notices and grants of common public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                          "that the following conditions are met",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                   "Public License as published by the Free Software Foundation",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Warranty-disclaimer": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
                           "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
}

#: Parts of the texts of common public licenses.
TEMPLATES |= {
    "MIT-full": TEMPLATES["MIT-grant"] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                "the Software. " + TEMPLATES["Warranty-disclaimer"] + ". In no event shall the authors or copyright holders be liable for any "
                "claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection "
                "with the software or the use or other dealings in the software",
    "BSD-2-Clause-conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                               "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                               "and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                                "products derived from this software without specific prior written permission",
    "BSD-disclaimer": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, "
                      "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "BSL-1.0-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                     "accompanying documentation covered by this license",
    "GNU-copying": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
    "GPL-warranty-notice": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                           "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "Unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
                       "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "Zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
                  "and redistribute it freely, subject to the following restrictions",
    "Zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
}

#: Families of licenses, their short names and versions.
FAMILIES = {
    "GNU General Public License": ("GPL", "2 3"),
    "GNU GPL": ("GPL", "2 3"),
    "GNU Lesser General Public License": ("LGPL", "2.1 3"),
    "GNU LGPL": ("LGPL", "2.1 3"),
    "GNU Library General Public License": ("LGPL", "2"),
    "GNU Affero General Public License": ("AGPL", "3"),
    "GNU AGPL": ("AGPL", "3"),
    "GNU Free Documentation License": ("GFDL", "1.1 1.2 1.3"),
    "Apache License": ("Apache", "1.1 2.0"),
    "Mozilla Public License": ("MPL", "2.0"),
    "Eclipse Public License": ("EPL", "1.0 2.0"),
    "European Union Public Licence": ("EUPL", "1.1 1.2"),
    "Artistic License": ("Artistic", "1.0 2.0"),
    "Academic Free License": ("AFL", "3.0"),
    "Open Software License": ("OSL", "3.0"),
    "Boost Software License": ("BSL", "1.0"),
    "Common Development and Distribution License": ("CDDL", "1.0 1.1"),
}
#: Parts of Creative Commons licenses, and their versions.
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_CODES = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
#: Other short forms.
SHORT_FORMS = {
    "MIT:licensed": "licensed under the MIT License",
    "MIT:terms": "under the terms of the MIT License",
    "MIT:title": "The MIT License MIT",
    "BSD-2-Clause:title": "BSD 2-Clause License",
    "BSD-3-Clause:title": "BSD 3-Clause License",
    "BSD-2-Clause:quoted": "BSD 2-Clause \"Simplified\" License",
    "BSD-3-Clause:quoted": "BSD 3-Clause \"New\" or \"Revised\" License",
    "ISC:licensed": "licensed under the ISC License",
    "Apache-2.0:code": "Apache-2.0 License",
    "CC0-1.0:title": "CC0 1.0 Universal",
    "Unlicense:title": "released under the Unlicense",
    "WTFPL-2:title": "Do What The Fuck You Want To Public License",
}


def titles() -> dict[str, str]:
    """Titles and short forms of licenses: every family in its versions, as `version V`, `vV` and `V`."""
    out = dict(SHORT_FORMS)
    for family, (code, versions) in FAMILIES.items():
        said = "" if family.endswith(("License", "Licence")) and "Library" not in family else f":{family.split()[1]}"
        for v in versions.split():
            out |= {f"{code}-{v}{said}:{form.split('{')[0].strip() or 'plain'}": f"{family} {form.format(v)}" for form in ("version {}", "v{}", "{}")}
    for code in CC_CODES:
        name = "-".join(CC_PARTS[p] for p in code.split("-"))
        for v in CC_VERSIONS:
            out |= {f"CC-{code}-{v}:short": f"CC {code} {v}", f"CC-{code}-{v}:name": f"Creative Commons {name} {v}"}
    return out


TEMPLATES |= titles()

#: Words, one after the other, without which a text is not of this template but of a sister.
DECIDING = {
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "AGPL-notice": "GNU Affero General Public License",
    "Apache-2.0": "Apache License, Version 2.0",
    "Apache-2.0-header": "Apache License, Version 2.0",
    "CC-BY-4.0": "Creative Commons Attribution 4.0",
    "CC-BY-4.0-short": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-NC-4.0-notice": "Creative Commons Attribution-NonCommercial 4.0",
    "CC-BY-NC-ND-4.0": "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0",
    "CC-BY-NC-ND-4.0-short": "CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
    "CC-BY-NC-SA-4.0-short": "CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "Creative Commons Attribution-NoDerivatives 4.0",
    "CC-BY-ND-4.0-short": "CC BY-ND 4.0",
    "CC-BY-SA-4.0": "Creative Commons Attribution-ShareAlike 4.0",
    "CC-BY-SA-4.0-short": "CC BY-SA 4.0",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "GPL-notice": "GNU General Public License",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "LGPL-notice": "GNU Lesser General Public License",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License, v. 2.0",
}
_EXACT = titles()

_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() or c in SPACE else 32 for c in range(256))
_WORD = re.compile(rb"[^ \t\n\x0b\f\r]+")
_rng = np.random.default_rng(20240311)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def normal(text: str) -> bytes:
    """UTF-8 of `text`, ASCII letters lower-cased, other ASCII marks blank; as many bytes as the text has."""
    return text.encode().translate(_TABLE)


def bands(members: np.ndarray) -> np.ndarray:
    """Band keys of a non-empty set of shingle hashes."""
    least = (members[:, None] * _FACTORS >> np.uint64(16)).min(axis=0).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x100000001B3) + least[:, r])
    return key


def _holds(words: np.ndarray, run: np.ndarray) -> bool:
    """Whether the words of `run` stand in `words`, one after the other."""
    n = len(words) - len(run) + 1
    return n > 0 and bool(np.all([words[j : j + n] == w for j, w in enumerate(run)], axis=0).any())


class Matcher:
    """Templates by band key and by their shingles."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.sets, self.lengths, self.deciding = [], [], []
        self.by_band: dict[int, list[int]] = {}
        for t, name in enumerate(self.names):
            words = word_hashes(normal(templates[name]))
            if len(words) < K:
                raise ValueError(f"template {name} has fewer than {K} words")
            members = np.unique(shingles(words, K))
            self.sets.append(members)
            self.lengths.append(len(words) - K + 1)
            run = word_hashes(normal(DECIDING.get(name, _EXACT.get(name, ""))))
            self.deciding.append(run if _holds(words, run) else run[:0])  # own templates may bear such a name
            for key in bands(members).tolist():
                self.by_band.setdefault(key, []).append(t)
        self.every = np.unique(np.concatenate(self.sets))
        # templates whose shingles are all held by a larger one
        self.within = [{u for u, other in enumerate(self.sets) if len(other) > len(mine) and np.isin(mine, other).all()} for mine in self.sets]

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, containment, start, end) of every match, in code points of `text`."""
        words = word_hashes(normal(text))
        if len(words) < K:
            return []
        all_shingles = shingles(words, K)
        at = np.minimum(np.searchsorted(self.every, all_shingles), len(self.every) - 1)
        hits = np.flatnonzero(self.every[at] == all_shingles)
        if not len(hits):
            return []
        found: dict[int, list[tuple[int, int, float]]] = {}
        for length in sorted(set(self.lengths)):
            step = max(1, length // 4)
            # starts (multiples of the step) of the windows that hold a hit
            first = np.maximum(0, -(-(hits - length + 1) // step))
            starts = np.unique(np.concatenate([first + i for i in range(length // step + 1)])) * step
            starts = starts[(starts < len(all_shingles))]
            near = np.searchsorted(hits, starts + length) > np.searchsorted(hits, starts)
            for start in starts[near].tolist():
                window = np.unique(all_shingles[start : start + length])
                likely = {t for key in bands(window).tolist() for t in self.by_band.get(key, ()) if self.lengths[t] == length}
                for t in likely:
                    if best := self._best(words, all_shingles, t, max(0, start - step), start + step):
                        found.setdefault(t, []).append(best)
        if not found:
            return []
        raw, spans = text.encode(), [m.span() for m in _WORD.finditer(normal(text))]
        out = []
        for t, places in found.items():
            around = [(a, b) for u in self.within[t] for a, b, _ in found.get(u, ())]
            places = [p for p in places if not any(a <= p[0] and p[1] <= b for a, b in around)]
            merged: list[list] = []
            for a, b, share in sorted(places):
                if merged and a < merged[-1][1]:
                    merged[-1][1], merged[-1][2] = max(merged[-1][1], b), max(merged[-1][2], share)
                else:
                    merged.append([a, b, share])
            for a, b, share in merged:
                start = len(raw[: spans[a][0]].decode())
                out.append((self.names[t], share, start, start + len(raw[spans[a][0] : spans[b - 1][1]].decode())))
        return sorted(out, key=lambda m: (m[2], m[0]))

    def _best(self, words: np.ndarray, all_shingles: np.ndarray, t: int, lo: int, hi: int) -> tuple[int, int, float] | None:
        """(first word, end, containment) of the run that holds most of template `t` and its deciding words, of those
        that start at `lo` to `hi`."""
        length, wanted = self.lengths[t], self.sets[t]
        part = all_shingles[lo : hi + length]
        at = np.minimum(np.searchsorted(wanted, part), len(wanted) - 1)
        inside = np.flatnonzero(wanted[at] == part)
        best, most = None, (CONTAINMENT, 0)  # the share, then the places held, as a shingle may come twice
        for start in range(max(1, min(hi - lo + 1, len(part) - length + 1))):
            held = inside[np.searchsorted(inside, start) : np.searchsorted(inside, start + length)]
            share = len(np.unique(at[held])) / len(wanted)
            if (share, len(held)) > most:
                a, b = lo + int(held[0]), lo + int(held[-1]) + K
                if not len(self.deciding[t]) or _holds(words[a:b], self.deciding[t]):
                    best, most = (a, b, share), (share, len(held))
        return best


@functools.cache
def _matcher(templates: tuple[tuple[str, str], ...]) -> Matcher:
    return Matcher(dict(templates))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per match: id, license, containment, start and end (code points, end exclusive)."""
    kind = docs.schema[id_column].dataType.simpleString()
    given = tuple(sorted(templates.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = _matcher(given)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(i, *m) for i, x in enumerate(part.column(1).to_pylist()) if x for m in to.find(x)]
                source, names, share, start, end = zip(*rows) if rows else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64())), pa.array(names, pa.string()), pa.array(share, pa.float64()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["id", "license", "containment", "start", "end"])

    out = docs.select(id_column, text_column).mapInArrow(run, f"id {kind}, license string, containment double, start long, end long")
    return out.withColumnRenamed("id", id_column)


def licenses_of(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row with a match and license: number of matches, best containment, place of the first match."""
    found = scan(docs, templates, id_column=id_column, text_column=text_column)
    return found.groupBy(id_column, "license").agg(F.count("*").alias("n_matches"), F.max("containment").alias("containment"),
                                                   F.min("start").alias("start"), F.min_by("end", "start").alias("end"))
