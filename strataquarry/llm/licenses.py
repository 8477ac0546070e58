"""License scans: winnowed fingerprints of templates pick candidates, banded alignment reports coverage and spans.

Templates are short notices and the full texts of common licenses (`texts/`). Words are lower case, punctuation parts them.
Each template's word triples are winnowed (the smallest of every `spread` neighbours stays); templates under `SHORT` words
keep all of them. The inverted index of all templates is fixed in size. A text's triples look up the index in one vectorised
step and vote for diagonals; votes within a band of one another are a candidate if a twentieth of the template's fingerprints
voted (one at least). In a text that repeats itself such votes go on without end: candidates wider than twice template and band
are read in overlapping stretches of that width, so a region is bounded by its template whatever the text. Candidates whose words
cannot have enough in common in order, by bags and then by a row of bits, go; the others are aligned: the longest chain of equal words in order whose diagonals stay within the band (only
pairs inside it are listed), which is `band` words or a sixteenth of the template. Matches of at least `coverage` of a template's words are reported
with code-point spans (templates under `WHOLE` words must match in every word without a gap, since one word makes another license of them);
a match inside the span of a longer one of its own license is not.

Defined results: null or empty text matches nothing; texts of any length are read whole; repeated rows are reported each;
equal coverage orders by start, end, then license; other columns, whatever their names, are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import small_batches

# Notices and texts of public licenses.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
K, SPREAD, BAND, COVERAGE = 3, 3, 8, 0.8
SHORT, WHOLE = 20, 10
SCAN = "doc_id long, n_matches long, licenses string, best_coverage double, spans string"


@cache
def templates() -> tuple[tuple[str, str], ...]:
    """(license, text) of the notices and of every file in texts/."""
    files = sorted((Path(__file__).parent / "texts").glob("*.txt"))
    return (*NOTICES, *((f.stem, f.read_text(encoding="utf-8")) for f in files))


@dataclass
class Templates:
    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray  # sorted fingerprints
    owner: np.ndarray
    place: np.ndarray
    votes: np.ndarray  # that a candidate needs
    band: np.ndarray
    least: np.ndarray  # words that a match needs


def winnow(grams: np.ndarray, spread: int) -> np.ndarray:
    """Positions that are the smallest (rightmost on ties) of some `spread` neighbours; all of a shorter list's minimum."""
    if len(grams) <= spread:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, np.int64)
    sliding = np.lib.stride_tricks.sliding_window_view(grams, spread)[:, ::-1]
    return np.unique(np.arange(len(sliding)) + spread - 1 - np.argmin(sliding, 1))


def index(pairs: tuple[tuple[str, str], ...], k: int = K, spread: int = SPREAD, band: int = BAND, coverage: float = COVERAGE) -> Templates:
    buf, docs = W.buffers(pa.array([t for _, t in pairs]))
    w = W.split(W.FOLD[buf], docs)
    words = [w.hashes[w.first[i] : w.first[i + 1]] for i in range(len(pairs))]
    size = np.array([len(x) for x in words])
    grams = [W.Runs(x).grams(k) for x in words]
    at = [np.arange(len(g)) if n < SHORT else winnow(g, spread) for g, n in zip(grams, size.tolist(), strict=True)]
    prints = np.concatenate([g[a] for g, a in zip(grams, at, strict=True)])
    owner = np.repeat(np.arange(len(words)), [len(a) for a in at])
    order = np.argsort(prints, kind="stable")
    least = np.where(size < WHOLE, size, np.ceil(coverage * size - 1e-9)).astype(np.int64)
    votes = np.maximum(1, np.array([len(a) for a in at]) // 20)
    return Templates([n for n, _ in pairs], words, prints[order], owner[order], np.concatenate(at)[order], votes, np.maximum(band, size // 16), least)


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched words, first, end) of the longest common subsequence whose matches lie on diagonals low..high (text - template)."""
    if not len(text):
        return 0, -1, -1
    kinds, rank = np.unique(text, return_inverse=True)
    wide = len(text) + 1
    keys = np.sort(rank * wide + np.arange(len(text)))
    place = np.minimum(np.searchsorted(kinds, template), len(kinds) - 1)
    known = np.flatnonzero(kinds[place] == template)
    row = place[known] * wide
    # of each template word's places in the text, only those inside the band are ever listed
    a = np.searchsorted(keys, row + np.clip(known + low, 0, len(text)))
    n = np.maximum(0, np.searchsorted(keys, row + np.clip(known + high + 1, 0, len(text))) - a)
    i = np.repeat(known, n)
    j = keys[np.repeat(a, n) + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)] % wide
    chain = np.lexsort((-j, i))  # of one template word at most one match can follow another
    ends: list[int] = []  # least last place of a chain of each length
    firsts: list[int] = []  # and where that chain begins
    for x in j[chain].tolist():
        at = bisect.bisect_left(ends, x)
        first = firsts[at - 1] if at else x
        if at == len(ends):
            ends.append(x)
            firsts.append(first)
        else:
            ends[at], firsts[at] = x, first
    return (len(ends), firsts[-1], ends[-1] + 1) if ends else (0, -1, -1)


def common(template: np.ndarray, text: np.ndarray, least: int) -> bool:
    """Whether template and text can have `least` words in common in order: their bags first, then their longest common
    subsequence, whose length a row of bits gives."""
    kinds, counts = np.unique(template, return_counts=True)
    place = np.minimum(np.searchsorted(kinds, text), len(kinds) - 1)
    inside = kinds[place] == text
    if np.minimum(np.bincount(place[inside], minlength=len(kinds)), counts).sum() < least:
        return False
    where: dict[int, int] = {}
    for i, x in enumerate(template.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(template)) - 1
    row = full
    for x in text[inside].tolist():
        hit = row & where[x]
        row = (row + hit | row - hit) & full
    return len(template) - row.bit_count() >= least


def _stretches(low: np.ndarray, high: np.ndarray, begin: np.ndarray, end: np.ndarray, most: np.ndarray, diagonal: np.ndarray, votes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(group, lowest, highest diagonal) of groups. Where a text repeats itself neighbouring diagonals go on without end: a group
    wider than `most` is read in stretches of twice that, each half over the last, which hold every match that is narrower."""
    for g, (a, b, x, y, m, v) in enumerate(zip(low.tolist(), high.tolist(), begin.tolist(), end.tolist(), most.tolist(), votes.tolist(), strict=True)):
        if b - a <= 2 * m:
            yield g, a, b
            continue
        starts = np.arange(a, b - m + 1, m)
        first = x + np.searchsorted(diagonal[x:y], starts)
        last = x + np.searchsorted(diagonal[x:y], starts + 2 * m, "right")
        for i in np.flatnonzero(last - first >= v).tolist():
            yield g, int(diagonal[first[i]]), int(diagonal[last[i] - 1])


def _parts(at: np.ndarray, n: np.ndarray, reach: int, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of seeds that have about `most` fingerprints; each begins `reach` words before the last one's end, so that what lies across an end is whole in one."""
    sums, lo = np.concatenate([[0], np.cumsum(n)]), 0
    while lo < len(at):
        hi = max(int(np.searchsorted(sums, sums[lo] + most, "right")) - 1, int(np.searchsorted(at, at[lo] + 2 * reach)), lo + 1)
        yield lo, min(hi, len(at))
        if hi >= len(at):
            return
        lo = int(np.searchsorted(at, at[hi] - reach))


def scan_chunk(found: Templates, w: W.Words, k: int) -> list[tuple[int, int, float, int, int]]:
    """(document, template, coverage, first word, end word) of each match."""
    grams = W.Runs(w.hashes).grams(k)
    if not len(grams):
        return []
    at = np.flatnonzero(np.isin(grams, found.prints) & W.whole(w.first, k))
    lo, hi = np.searchsorted(found.prints, grams[at], "left"), np.searchsorted(found.prints, grams[at], "right")
    reach = 2 * (max(len(x) for x in found.words) + int(found.band.max()))
    size = np.array([len(x) for x in found.words])
    out = {}
    for x, y in _parts(at, hi - lo, reach):
        n = (hi - lo)[x:y]
        row = np.repeat(at[x:y], n)
        which = np.repeat(lo[x:y], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        owner, diagonal = found.owner[which], row - found.place[which]
        doc = np.searchsorted(w.first, row, "right") - 1
        order = np.lexsort((diagonal, owner, doc))
        doc, owner, diagonal = doc[order], owner[order], diagonal[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] - diagonal[:-1] > found.band[owner[1:]])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(new))
        some = end - begin >= found.votes[owner[begin]]
        begin, end = begin[some], end[some]
        own, docs = owner[begin], doc[begin]
        for g, low, high in _stretches(diagonal[begin], diagonal[end - 1], begin, end, size[own] + found.band[own], diagonal, found.votes[own]):
            d, o = int(docs[g]), int(own[g])
            template, band, least = found.words[o], int(found.band[o]), int(found.least[o])
            a, b = max(int(w.first[d]), low - band), min(int(w.first[d + 1]), high + len(template) + band)
            if not common(template, w.hashes[a:b], least):
                continue
            matched, first, stop = align(template, w.hashes[a:b], low - band - a, high + band - a)
            if matched >= least and (len(template) >= WHOLE or stop - first == matched):
                base = a - int(w.first[d])
                out[d, o, base + first, base + stop] = matched / len(template)
    return [(d, o, c, a, b) for (d, o, a, b), c in out.items()]


def outermost(hits: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """(start, end, license, coverage) in order, without those inside a longer one of their license or a better one of the same span."""
    out, reach = [], {}
    for hit in sorted(hits, key=lambda x: (x[0], -x[1], x[2], -x[3])):
        if reach.get(hit[2], -1) < hit[1]:
            out.append(hit)
            reach[hit[2]] = hit[1]
    return sorted(out)


def scan_licenses(documents: DataFrame, pairs: tuple[tuple[str, str], ...] | None = None, k: int = K, spread: int = SPREAD, band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """One row a row of documents(doc_id, text): matches, licenses, best coverage, spans license:start:end."""
    small_batches(documents.sparkSession)
    found = index(pairs or templates(), k, spread, band, coverage)
    names = [x.split()[0] for x in SCAN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                w = W.split(W.FOLD[buf], docs)
                own: list[list[tuple]] = [[] for _ in range(len(part))]
                hits = scan_chunk(found, w, k)
                points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)]) if hits else None
                for d, o, c, a, b in hits:
                    first = int(w.first[d])
                    own[d].append((int(points[w.starts[first + a]] - points[docs[d]]), int(points[w.ends[first + b - 1]] - points[docs[d]]), found.names[o], c))
                own = [outermost(x) for x in own]
                yield pa.record_batch(
                    [part.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([",".join(sorted({m[2] for m in x})) for x in own]), pa.array([max((m[3] for m in x), default=0.0) for x in own]), pa.array([",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in x) for x in own])],
                    names=names,
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCAN)
