"""License scan: MinHash bands over overlapping text windows, then exact containment.

Method. A template is a license text or notice as words (``normal_words``; version numbers
stay). Its shingles number ``own``. Windows start every ``stride`` shingles, an eighth of
``own`` or less, and are just long enough that any ``own`` shingles in a row lie whole in
one (``geometry``). A window that holds ``CONTAINMENT`` of a template's shingles therefore has
at least the similarity that ``least_similarity`` gives, never below a half, so bands of
``ROWS`` rows collide surely enough (``CERTAINTY``) with the number of bands that
``bands_needed`` gives, at most ``HASHES / ROWS``. Where a window collides with a template in
a band, the shingles there are compared with the template's exactly, and every stretch that
holds the share is a match if it also has the template's phrases (name and version) word by
word. Templates that share half of their shingles are variants: of variants that overlap, the
one held to the greater share stays, then the longer one.

Window minima come from minima of blocks that double in length, so a document costs one pass
over its shingles and little more for each template length, whatever the overlap.

Scale. One map over the texts; templates and their bands are a bounded parameter. No
shuffle, no state. A text is hashed in pieces and scanned in segments; eight bytes a word are
all that is held of the whole.

Edge cases: null or empty text has no license; a text shorter than a window is one window;
a template of fewer than five words is one shingle of all its words, and found only in
texts of just these words; a template without words is found nowhere; repeated rows give
repeated results; very long texts are whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.common import mix64, slices, text_input

WORDS_PER_SHINGLE, HASHES, ROWS, CONTAINMENT, CERTAINTY = 5, 66, 2, 0.75, 0.9999
#: Shingles scanned, and bytes of text hashed, at once.
SEGMENT, PIECE = 8192, 1 << 20
#: Shingles of the templates that are scanned together; each tier above doubles them.
TIER = 256
#: Templates that share this much of the smaller one's shingles are variants.
VARIANT = 0.5


class Template(NamedTuple):
    """A license text, and phrases that a match must hold word by word."""

    text: str
    phrases: tuple[str, ...] = ()


_GNU_2 = "it under the terms of the GNU {0}General Public License as published by the Free Software Foundation; either version {1} of the License, or (at your option) any later version."
_GNU_3 = "it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
_WARRANTY = ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_2 = ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_CC = "This work is licensed under a Creative Commons {} International License"
_LINE = "This work is licensed under the GNU {}General Public License, version {}"

#: Short public licenses whole, and the notices and lines that name the long
#: ones. Whole texts of those come from a folder, see ``read_templates``.
TEMPLATES: dict[str, str | Template] = {
    "agpl-3": Template(_LINE.format("Affero ", 3), ("affero general public license", "version 3")),
    "agpl-3-header": Template("This program is free software: you can redistribute it and/or modify " + _GNU_3.format("Affero "), ("affero general public license", "version 3")),
    "apache-2": Template("Licensed under the Apache License, Version 2.0", ("apache license", "version 2.0")),
    "apache-2-header": Template("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license", "version 2.0")),
    "bsd": Template(_BSD),
    "bsd-2": Template(_BSD + _BSD_2 + _BSD_END),
    "bsd-3": Template(_BSD + _BSD_2 + _BSD_3 + _BSD_END, ("neither the name of",)),
    "cc-by-3": Template(_CC.format("Attribution 3.0"), ("attribution 3.0",)),
    "cc-by-4": Template(_CC.format("Attribution 4.0"), ("attribution 4.0",)),
    "cc-by-nc-4": Template("Licensed under CC BY-NC 4.0", ("by-nc 4.0",)),
    "cc-by-sa-4": Template(_CC.format("Attribution-ShareAlike 4.0"), ("sharealike 4.0",)),
    "gpl-2": Template(_LINE.format("", 2), ("gnu general public license", "version 2")),
    "gpl-2-header": Template("This program is free software; you can redistribute it and/or modify " + _GNU_2.format("", "2"), ("gnu general public license", "version 2 of")),
    "gpl-3": Template(_LINE.format("", 3), ("gnu general public license", "version 3")),
    "gpl-3-header": Template("This program is free software: you can redistribute it and/or modify " + _GNU_3.format(""), ("gnu general public license", "version 3")),
    "isc": Template("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "lgpl-2.1-header": Template("This library is free software; you can redistribute it and/or modify " + _GNU_2.format("Lesser ", "2.1"), ("lesser general public license", "version 2.1")),
    "lgpl-3": Template(_LINE.format("Lesser ", 3), ("lesser general public license", "version 3")),
    "lgpl-3-header": Template("This program is free software: you can redistribute it and/or modify " + _GNU_3.format("Lesser "), ("lesser general public license", "version 3")),
    "mit": Template("Released under the MIT License"),
    "mit-text": Template("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software." + _WARRANTY),
    "mpl-2": Template("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license", "v. 2.0")),
    "zlib": Template("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
}
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_VERSION = re.compile(r"(?i)\b(?:version|v)[\W_]{0,3}\d+(?:\.\d+)*")


def normal_words(text: str | None) -> list[bytes]:
    """Words with A-Z lowered."""
    return _WORD.findall((text or "").encode().lower())


def as_template(template: str | Template) -> Template:
    """A bare text must be matched with the first version it names, if any."""
    if isinstance(template, Template):
        return template
    version = _VERSION.search(template)
    return Template(template, (version[0],) if version else ())


class WordHashes(dict):
    """64-bit hashes of words, kept once computed."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def geometry(own: int) -> tuple[int, int]:
    """Stride and length in strides of the windows for templates of ``own`` shingles: any
    ``own`` shingles in a row lie in one window."""
    stride = 1 << max(0, (own // 8).bit_length() - 1)
    return stride, -(-(own + stride - 1) // stride)


def least_similarity(own: int, containment: float = CONTAINMENT) -> float:
    """Similarity of a template and a full window that holds that share of its shingles."""
    stride, length = geometry(own)
    held = math.ceil(containment * own)
    return held / (own + stride * length - held)


def bands_needed(similarity: float, certainty: float = CERTAINTY) -> int:
    """The bands of ``ROWS`` rows that collide that surely."""
    bands = 1
    while (1 - similarity**ROWS) ** bands > 1 - certainty:
        bands += 1
    return bands


class _Known(NamedTuple):
    name: str
    own: np.ndarray  # sorted distinct shingles
    order: np.ndarray  # where the template has them
    least: np.ndarray  # MinHash values of its bands
    total: int  # shingles with the repeated ones
    repeated: frozenset[int]  # places of those
    words: int
    phrases: list[np.ndarray]


class _Tier:
    """Templates of about one size: by stride and length of their windows."""

    def __init__(self) -> None:
        self.shapes: dict[int, dict[int, list[_Known]]] = defaultdict(lambda: defaultdict(list))
        self.reach, self.need, self.widest = 0, math.inf, 1

    def add(self, stride: int, length: int, known: _Known, need: int) -> None:
        self.shapes[stride][length].append(known)
        self.reach, self.need, self.widest = max(self.reach, stride * length), min(self.need, need), max(self.widest, stride)

    def templates(self) -> Iterator[_Known]:
        for lengths in self.shapes.values():
            for templates in lengths.values():
                yield from templates


class Scanner:
    def __init__(self, templates: dict[str, str | Template]):
        r = np.random.default_rng(5)
        self.odd = r.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.factors = mix64(np.arange(1, WORDS_PER_SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
        self.cache = WordHashes()
        known: list[_Known] = []
        tiers: dict[int, _Tier] = defaultdict(_Tier)
        for name, template in sorted(templates.items()):
            text, phrases = as_template(template)
            words = self.word_hashes(text)
            if not len(words):
                continue
            every = self.shingles(words)
            own, order, times = np.unique(every, return_index=True, return_counts=True)
            stride, length = geometry(len(every))
            bands = bands_needed(least_similarity(len(every)))
            known.append(_Known(name, own, order, self.hashes(own).min(axis=1)[: bands * ROWS], len(every), frozenset(order[times > 1].tolist()), len(words), [self.word_hashes(p) for p in phrases]))
            tiers[max(0, (len(every) // TIER).bit_length())].add(stride, length, known[-1], math.ceil(CONTAINMENT * len(own)))
        self.tiers = [tiers[k] for k in sorted(tiers)]
        self.variants = {(a.name, b.name) for a in known for b in known if a is not b and np.isin(a.own, b.own).sum() >= VARIANT * min(len(a.own), len(b.own))}
        self.sizes = {k.name: len(k.own) for k in known}

    def word_hashes(self, text: str | None) -> np.ndarray:
        """Hashes of the words in order, from pieces that end between words."""
        raw, at, out = (text or "").encode(), 0, [np.empty(0, np.uint64)]
        while at < len(raw):
            gap = _GAP.search(raw, min(at + PIECE, len(raw)))
            end = gap.end() if gap else len(raw)
            words = _WORD.findall(raw[at:end].lower())
            out.append(np.fromiter(map(self.cache.__getitem__, words), np.uint64, len(words)))
            if len(self.cache) > 500_000:
                self.cache = WordHashes()
            at = end
        return np.concatenate(out)

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Hashes of the shingles in order; of fewer than five words the one of all."""
        k = min(WORDS_PER_SHINGLE, len(words))
        total = np.zeros(max(0, len(words) - k + 1) if k else 0, np.uint64)
        for i in range(k):
            total += words[i : len(words) - k + 1 + i] * self.factors[i]
        return mix64(total + np.uint64(k))

    def hashes(self, shingles: np.ndarray) -> np.ndarray:
        """One row of 32-bit hashes for each hash function."""
        out = np.empty((HASHES, len(shingles)), np.uint32)
        for i, odd in enumerate(self.odd):
            out[i] = (shingles * odd) >> np.uint64(32)
        return out

    def collisions(self, line: np.ndarray, tier: _Tier) -> dict[str, list[tuple[int, int]]]:
        """For each template the windows (first shingle, length) of the line that collide with
        it in a band. Zeros in the line are no shingles."""
        out: dict[str, list[tuple[int, int]]] = defaultdict(list)
        none = np.iinfo(np.uint32).max
        step = max(SEGMENT, tier.widest)  # both are powers of two: segments start at a window
        for start in range(0, len(line), step):
            piece = line[start : start + step + tier.reach]
            width = min(step, len(line) - start)
            blocks = np.full((HASHES, -(-(width + tier.reach) // tier.widest) * tier.widest), none, np.uint32)
            blocks[:, : len(piece)] = self.hashes(piece)
            blocks[:, : len(piece)][:, piece == 0] = none
            stride = 1
            while True:
                shapes = sorted(tier.shapes.get(stride, {}).items())
                most = max((len(t.least) for _, templates in shapes for t in templates), default=0)
                doubled, size, count = blocks[:most], 1, -(-width // stride)
                for length, templates in shapes:
                    while 2 * size <= length:  # minima of ``size`` blocks from every block on
                        doubled = np.minimum(doubled[:, :-size], doubled[:, size:])
                        size *= 2
                    rows = max(len(t.least) for t in templates)
                    windows = np.minimum(doubled[:rows, :count], doubled[:rows, length - size : length - size + count])
                    for t in templates:
                        hit = np.zeros(count, bool)
                        for band in range(0, len(t.least), ROWS):
                            same = windows[band] == t.least[band]
                            for row in range(band + 1, band + ROWS):
                                same &= windows[row] == t.least[row]
                            hit |= same
                        out[t.name] += [(start + w * stride, length * stride) for w in np.flatnonzero(hit).tolist()]
                if stride == tier.widest:
                    break
                blocks, stride = np.minimum(blocks[:, ::2], blocks[:, 1::2]), 2 * stride
        return out

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        return self.scan_all([text])[0]

    def scan_all(self, texts: list[str | None]) -> list[list[tuple[str, int, int, float]]]:
        """Every stretch of each template found in each text: (name, first word, last word,
        containment). The texts' shingles stand in one line, so far apart that no window
        reaches two texts, and every text starts at a window: what else is scanned with a text
        changes nothing."""
        words = [self.word_hashes(t) for t in texts]
        sizes = [max(len(w) - WORDS_PER_SHINGLE + 1, min(len(w), 1)) for w in words]
        out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        for tier in self.tiers:
            able = [d for d, n in enumerate(sizes) if n >= tier.need]
            room = [-(-(sizes[d] + tier.reach) // tier.widest) * tier.widest for d in able]
            starts = np.concatenate([[0], np.cumsum(room)]).astype(np.int64)
            line = np.zeros(starts[-1], np.uint64)
            for d, a in zip(able, starts.tolist(), strict=False):
                line[a : a + sizes[d]] = self.shingles(words[d])
            windows = self.collisions(line, tier)
            for t in tier.templates():
                by_text: dict[int, list[tuple[int, int]]] = defaultdict(list)
                for a, length in windows[t.name]:
                    k = int(np.searchsorted(starts, a, side="right")) - 1
                    by_text[k].append((a, min(a + length, int(starts[k]) + sizes[able[k]])))
                for k, pairs in by_text.items():
                    out[able[k]] += self.verified(t, words[able[k]], line, int(starts[k]), pairs)
        return [self.settled(found) for found in out]

    def verified(self, t: _Known, words: np.ndarray, line: np.ndarray, start: int, windows: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, float]]:
        """The stretches of a template in the windows of the text that starts there."""
        at, places = [], []
        for a, b in joined(windows):
            place = np.minimum(np.searchsorted(t.own, line[a:b]), len(t.own) - 1)
            same = np.flatnonzero(t.own[place] == line[a:b])
            at += (same + (a - start)).tolist()
            places += t.order[place[same]].tolist()
        for i, j, share in stretches(at, places, len(t.own), t.words, t.total, t.repeated):
            last = min(j + WORDS_PER_SHINGLE, len(words)) - 1
            if all(holds(words[i : last + 1], p) for p in t.phrases):
                yield t.name, i, last, share

    def settled(self, found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
        """Without the stretches that a variant of their template overlaps and beats."""
        found = sorted(found, key=lambda f: (f[1], f[0]))
        beaten, open_ = set(), []
        for k, (name, first, last, share) in enumerate(found):
            open_ = [o for o in open_ if found[o][2] >= first]
            for o in open_:
                if (name, found[o][0]) in self.variants:
                    other = found[o]
                    beaten.add(o if (share, self.sizes[name]) > (other[3], self.sizes[other[0]]) else k)
            open_.append(k)
        return sorted(f for k, f in enumerate(found) if k not in beaten)


def joined(windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Windows in order, with those that touch made one."""
    a = b = None
    for start, end in sorted(windows):
        if b is not None and start <= b:
            b = max(b, end)
            continue
        if b is not None:
            yield a, b
        a, b = start, end
    if b is not None:
        yield a, b


def holds(words: np.ndarray, phrase: np.ndarray) -> bool:
    """Whether the words have the phrase in a row."""
    n = len(words) - len(phrase) + 1
    return n > 0 and bool(np.logical_and.reduce([words[i : i + n] == p for i, p in enumerate(phrase)]).any()) if len(phrase) else True


def stretches(at: list[int], places: list[int], own: int, length: int, total: int, repeated: frozenset[int]) -> Iterator[tuple[int, int, float]]:
    """First and last shingle and containment of every stretch, none of which overlap.

    ``at`` are the shingles that match, ``places`` where the template has them. A stretch is
    the first that holds enough of the template within a window's length. It goes on as long
    as the template does, which shingles show that the template has once (those that it
    repeats go with their neighbours), and gives up what it holds twice at its start.
    """
    need, i, j, free = math.ceil(CONTAINMENT * own), 0, 0, 0
    held: Counter[int] = Counter()

    def leave() -> None:
        nonlocal i
        held[places[i]] -= 1
        if not held[places[i]]:
            del held[places[i]]
        i += 1

    while j < len(at):
        held[places[j]] += 1
        j += 1
        while at[j - 1] - at[i] >= 2 * length:
            leave()
        if len(held) < need:
            continue
        mark = next((k for k in range(j - 1, i - 1, -1) if places[k] not in repeated), j - 1)
        while True:
            k = j
            while k < len(at) and places[k] in repeated and at[k] - at[k - 1] <= length:
                k += 1
            if k == len(at) or places[k] in repeated or places[k] <= places[mark] or at[k] - at[k - 1] > length:
                break
            held.update(places[j : k + 1])
            mark, j = k, k + 1
        while j < len(at) and places[j] in repeated and places[mark] + at[j] - at[mark] < total:  # the template's end
            held[places[j]] += 1
            j += 1
        while held[places[i]] > 1:
            leave()
        while i > free and places[i - 1] < places[i] and at[i] - at[i - 1] <= length:
            i -= 1
            held[places[i]] += 1
        yield at[i], at[j - 1], len(held) / own
        held.clear()
        i = free = j


def _scan(templates: dict[str, str | Template]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kind = pa.list_(pa.struct([("name", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("containment", pa.float64())]))
        for batch in slices(batches):
            found = [[dict(zip(("name", "first", "last", "containment"), f, strict=True)) for f in text] for text in scanner.scan_all(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "found"])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str | Template] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, found`` (name, first and last word, containment of every stretch)."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = f"doc_id {kind}, found array<struct<name: string, first: bigint, last: bigint, containment: double>>"
    return source.mapInArrow(_scan(templates), schema)


def read_templates(spark: SparkSession, folder: str, most_bytes: int = 16 << 20) -> dict[str, str]:
    """License texts of a folder, one a file, by file name without its ending. They go to every
    task, so their size is checked before they are read."""
    files = spark.read.text(folder, wholetext=True)
    size = files.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of license texts, at most {most_bytes} are taken")
    return {re.sub(r"\.(txt|md)$", "", r["file_name"]): r["value"] for r in files.select("_metadata.file_name", "value").collect()}


def license_digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        F.size(F.array_distinct("found.name")).cast("long").alias("n_licenses"),
        F.array_join(F.array_distinct("found.name"), ",").alias("licenses"),
        F.coalesce(F.array_min("found.first"), F.lit(-1)).alias("first_word"),
        F.round(F.coalesce(F.array_max("found.containment"), F.lit(0.0)), 6).alias("containment"),
    )
