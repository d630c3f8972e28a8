"""License scans: winnowed fingerprints pick candidates, banded alignment reports matches.

Of every ``WINDOW`` word n-grams in a row the one with the smallest hash is a fingerprint, so texts
that share ``GRAM + WINDOW - 1`` words in a row share a fingerprint.  An inverted index of the
templates' fingerprints names template and place.  Hits of one template on nearby diagonals are one
candidate, if they are as many as the template's length asks for; it is aligned word by word within a
band around them, in time in proportion to the template's length.  Candidates that cover too little of their template
alone are pieces of a text that was put into or taken out of in places: their matched words are chained in the
order of text and template, so the band bounds a shift within a piece and not what stands between pieces.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tidy
from .shingles import shingle_hashes, words_at

GRAM, WINDOW = 3, 2
#: Templates of fewer words may be left with runs of two words by the changes that ``COVERAGE`` allows:
#: their pairs of words are looked for at every place.
SHORT = 12
#: Part of a template's words that a match covers at least.
COVERAGE = 0.8
#: Hits that a candidate has at least, for each word of its template.  Four in five words in their order
#: leave about four times as many.
HITS = 0.05
#: Words around a hit that an alignment may match; four in five words in order leave a hit in about eight words.
NEAR = 8
#: Hits for each word with which a candidate goes first, and diagonals looked at for words that begin or end it.
MANY, ENDS = 0.3, 4
#: Pieces are chained for templates of so many words, and have so many words at least: a few words of a short notice
#: stand far from each other in any long text.
CHAIN, PIECE = 64, 8
#: Part of a template's words that the hits of a chain cover; its pieces are then aligned.
JOINED = 0.5
#: Words that an alignment may be off its diagonal: a fifth of the template's, within these.
BAND = (2, 64)
#: Words that all templates may have together: the index goes to every task.
TEMPLATE_WORDS = 1_000_000
#: Full license texts, one file each; the file's name is the template's.
FOLDER = Path(__file__).parent / "license_texts"

# Public license notices and short licenses.
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
NOTICES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": BSD_HEAD + " " + BSD_TAIL,
    "BSD-3-Clause": BSD_HEAD + " " + BSD_NAMES + " " + BSD_TAIL,
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All-rights-reserved": "All rights reserved.",
}


def templates() -> dict[str, str]:
    """The notices above and the full texts of ``FOLDER``."""
    return NOTICES | {f.stem: f.read_text("utf-8") for f in sorted(FOLDER.glob("*.txt"))}


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the smallest hash of each window, the last of equal ones."""
    n = len(grams)
    if n <= WINDOW:
        return np.array([n - 1 - int(grams[::-1].argmin())]) if n else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[:, ::-1]
    return np.unique(np.arange(n - WINDOW + 1) + WINDOW - 1 - view.argmin(axis=1))


@dataclass
class Postings:
    """Hashes, ascending, with the template and the place in it."""

    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, grams: list[tuple[int, np.ndarray]]) -> Postings:
        name = np.concatenate([np.full(len(g), t) for t, g in grams] or [np.zeros(0, np.int64)])
        place = np.concatenate([np.arange(len(g)) for _, g in grams] or [np.zeros(0, np.int64)])
        prints = np.concatenate([g for _, g in grams] or [np.zeros(0, np.uint64)])
        order = np.argsort(prints, kind="stable")
        return cls(prints[order], name[order], place[order])

    def hits(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(template, diagonal, place) of every posting of the grams at the places ``at``."""
        lo, hi = (np.searchsorted(self.prints, grams[at], side) for side in ("left", "right"))
        n = hi - lo
        k = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        return np.stack([self.template[k], at - self.place[k], at], 1)


@dataclass
class Index:
    """Templates' words, postings of all their grams, and of the pairs of words of short ones."""

    names: list[str]
    words: list[np.ndarray]
    grams: Postings
    pairs: Postings

    @classmethod
    def build(cls, texts: Mapping[str, str]) -> Index:
        words = [words_at(t, plain=True)[0] for t in texts.values()]
        if sum(map(len, words)) > TEMPLATE_WORDS:
            raise ValueError(f"templates may have {TEMPLATE_WORDS} words together")
        # every gram of a template is indexed: the text's winnowing needs no luck at its edges
        grams = [(i, shingle_hashes(w, GRAM)) for i, w in enumerate(words) if len(w) >= GRAM]
        pairs = [(i, shingle_hashes(w, 2)) for i, w in enumerate(words) if 2 <= len(w) < SHORT]
        return cls(list(texts), words, Postings.of(grams), Postings.of(pairs))


def band(n: int) -> int:
    """Words that an alignment may be off its diagonal."""
    return min(max(BAND[0], n // 5), BAND[1])


def align(template: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Matched (template word, text word) pairs of the best alignment: 2 for a match, -1 for a change or a gap.

    Word i of the template may stand at i .. i + ``width`` of ``text``.  A row of scores is a few numpy
    steps; what was chosen is kept as bits and followed back.
    """
    n, at = len(template), np.arange(width + 1)
    padded = np.concatenate([text, np.zeros(max(0, n + width - len(text)), text.dtype)])
    score = np.zeros(width + 1, np.int64)
    same, up, left = (np.zeros((n, width + 1), bool) for _ in range(3))
    for i in range(n):
        same[i] = (padded[i : i + width + 1] == template[i]) & (i + at < len(text))
        used = score + np.where(same[i], 2, -1)  # both words
        skipped = np.append(score[1:] - 1, -(1 << 40))  # a template word without a text word
        best = np.maximum(used, skipped)
        up[i] = skipped > used
        score = np.maximum.accumulate(best + at) - at  # text words without a template word
        left[i] = score > best
    o, i = width - int(score[::-1].argmax()), n - 1  # of equal ends the one that skips least
    pairs = []
    while i >= 0:
        if left[i, o]:
            o -= 1
        elif up[i, o]:
            i, o = i - 1, o + 1
        else:
            if same[i, o]:
                pairs.append((i, i + o))
            i -= 1
    return np.array(pairs[::-1], np.int64).reshape(-1, 2)


def chained(pairs: np.ndarray) -> np.ndarray:
    """The most (template word, text word) pairs that ascend in both."""
    if (np.diff(pairs, axis=0) > 0).all():
        return pairs
    pairs = pairs[np.lexsort((-pairs[:, 1], pairs[:, 0]))]  # of one template word one text word at most
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, x in enumerate(pairs[:, 1].tolist()):
        k = bisect_left(ends, x)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(x)
            last.append(i)
        else:
            ends[k], last[k] = x, i
    chain, i = [], last[-1] if last else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return pairs[chain[::-1]]


def aligned(template: np.ndarray, words: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Matched pairs within the band around the diagonals of the hits; text words from the beginning of ``words``.

    What begins or ends word for word on one of the diagonals with most hits needs no alignment.
    """
    n, b, low = len(template), band(len(template)), int(diagonal[0])
    found, count = np.unique(diagonal, return_counts=True)
    head, tail, parts = 0, n, [np.zeros((0, 2), np.int64)] * 2
    for d in found[np.argsort(-count, kind="stable")][:ENDS].tolist():
        a, z = max(0, -d), min(n, len(words) - d)
        differ = np.flatnonzero(template[a:z] != words[a + d : z + d]) + a if a < z else np.array([0])
        first, last = (int(differ[0]), int(differ[-1]) + 1) if len(differ) else (z, a)
        if a == 0 and first > head:
            head, parts[0] = first, np.stack([np.arange(first), np.arange(first) + d], 1)
        if z == n and last < tail:
            tail, parts[1] = last, np.stack([np.arange(last, n), np.arange(last, n) + d], 1)
    if head < tail:
        begin = head + low - b
        window = words[max(0, begin) : max(0, tail + low + 2 * b)]
        if begin < 0:  # before the text's first word there is none
            window = np.concatenate([np.zeros(-begin, words.dtype), window])
        parts.append(align(template[head:tail], window, 3 * b) + [head, begin])
    return chained(np.concatenate(parts))


def near_hits(places: np.ndarray, n: int) -> int:
    """Words of a template with a hit within NEAR words; what an alignment matches has hits around it."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.maximum(places - NEAR, 0), 1)
    np.add.at(step, np.minimum(places + GRAM + NEAR, n), -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def in_rows(hits: np.ndarray) -> np.ndarray:
    """Pairs of the words of the hits, in their order."""
    at = (hits[:, 2, None] + np.arange(GRAM)).ravel()
    return chained(np.stack([at - np.repeat(hits[:, 1], GRAM), at], 1))


def joined(pieces: list[np.ndarray], n: int) -> list[list[int]]:
    """Numbers of the pieces, which are in the order of the text, that make chains of JOINED of a template's words.

    A chain takes pieces as long as they add to it; where it is long enough, the next one begins behind it.
    """
    out, first = [], 0
    while first < len(pieces) - 1:
        chain, used = pieces[first], [first]
        for k in range(first + 1, len(pieces)):
            more = chained(np.concatenate([chain, pieces[k]]))
            if len(more) > len(chain):
                chain, used = more, [*used, k]
            elif len(chain) >= JOINED * n:
                break
        if len(chain) < JOINED * n:
            break  # all that follow are fewer
        out.append(used)
        first = next((k for k in range(first + 1, len(pieces)) if pieces[k][0, 1] > chain[-1, 1]), len(pieces))
    return out


def find(text: str, index: Index, coverage: float) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first code point, end) of each match in a text."""
    words, starts, ends = words_at(text, plain=True)
    if len(words) < 2:
        return []
    grams, pairs = shingle_hashes(words, GRAM) if len(words) >= GRAM else words[:0], shingle_hashes(words, 2)
    hits = np.concatenate([index.grams.hits(grams, winnow(grams)), index.pairs.hits(pairs, np.flatnonzero(np.isin(pairs, index.pairs.prints)))])
    if not len(hits):
        return []
    hits = hits[np.lexsort(hits.T[::-1])]
    found = []
    for mine in np.split(hits, np.flatnonzero(np.diff(hits[:, 0])) + 1):
        t, n, taken, pieces = int(mine[0, 0]), len(index.words[mine[0, 0]]), np.zeros(len(words), bool), []
        if n >= CHAIN and near_hits(np.unique(mine[:, 2] - mine[:, 1]), n) < coverage * n:
            continue
        # candidates with many hits first: what their matches span is theirs, and hits by chance there are none
        for share in (MANY, HITS):
            left = mine[~taken[mine[:, 2]]]
            diagonal, i = left[:, 1], 0
            while i < len(diagonal):
                j = int(np.searchsorted(diagonal, diagonal[i] + band(n), side="right"))
                if j - i < share * n:
                    i = int(np.searchsorted(diagonal, diagonal[i], side="right"))
                    continue
                part = left[i:j]
                i = j  # diagonals within the band are one candidate
                if n < CHAIN or near_hits(np.unique(part[:, 2] - part[:, 1]), n) >= coverage * n:
                    pairs = aligned(index.words[t], words, part[:, 1])
                    if len(pairs) >= coverage * n:
                        taken[pairs[0, 1] : pairs[-1, 1] + 1] = True
                        found.append((t, len(pairs) / n, len(pairs), int(pairs[0, 1]), int(pairs[-1, 1])))
                        continue
                if n >= CHAIN:
                    rows = in_rows(part)
                    if len(rows) >= PIECE:
                        taken[rows[:, 1]] = True
                        pieces.append((rows, part[:, 1]))
        pieces.sort(key=lambda p: int(p[0][0, 1]))
        for some in joined([rows for rows, _ in pieces], n):
            pairs = chained(np.concatenate([aligned(index.words[t], words, pieces[k][1]) for k in some]))
            if len(pairs) >= coverage * n:
                found.append((t, len(pairs) / n, len(pairs), int(pairs[0, 1]), int(pairs[-1, 1])))
    # overlapping matches of one template are one: the fullest, then the first
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (x[0], x[3], x[4])):
        if kept and kept[-1][0] == x[0] and x[3] <= kept[-1][4]:
            kept[-1] = max(kept[-1], x, key=lambda y: (y[1], -y[3]))
        else:
            kept.append(x)
    raw = text.encode("utf-8", "surrogatepass")
    char = (lambda k: k) if len(raw) == len(text) else (lambda k: len(raw[:k].decode("utf-8", "surrogatepass")))
    return sorted(((index.names[t], c, m, char(int(starts[i])), char(int(ends[j]))) for t, c, m, i, j in kept), key=lambda x: (x[3], x[0]))


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", texts: Mapping[str, str] | None = None, coverage: float = COVERAGE
) -> DataFrame:
    """(id, license, coverage, matched_words, start, end) for every match in the whole texts.

    Words are compared without case and punctuation; spans are code points.  Overlapping matches of
    one template are one.  ``texts`` names the templates (see ``templates`` for the default); all of them
    together go to every task.  Null, empty and short texts have none; repeated rows each have theirs;
    other columns aren't looked at; an empty table gives no rows; texts of any length are read whole, in time in
    proportion to their length and to their matches' templates.
    """
    small_batches(docs.sparkSession)
    index = Index.build(templates() if texts is None else texts)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    kind = rows.schema[id_col].dataType.simpleString()
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, out = [], []
            for i, text in enumerate(b.column("_text").to_pylist()):
                got = find(text, index, coverage)
                who += [i] * len(got)
                out += got
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(who, pa.int64())), *[pa.array([x[k] for x in out], kinds[k]) for k in range(5)]],
                ["_id", "license", "coverage", "matched_words", "start", "end"],
            )

    out = rows.mapInArrow(tidy(run), f"_id {kind}, license string, coverage double, matched_words long, start long, end long")
    return out.withColumnRenamed("_id", id_col)


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    """License notices in every document, with coverage and span."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
