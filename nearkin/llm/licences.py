"""Licence notices in documents: shared word pairs vote on diagonals, spans are verified word by word."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrow import LOWER, NOT_WORD, batches_of_bytes, flat, grams, hashes, runs
from nearkin.llm.columns import text_or_empty

#: Words in a rolling window; two, so that a phrase of two words has one.
K = 2
#: Places of a template whose votes are the bits of one mask; a longer template has several.
MASK_BITS = 60
#: Neighbouring diagonals are this far apart at most: words put in or left out in one go.
SLACK = 4
#: Words in a row, at most, that differ inside a span, in the document and in the template.
GAP = 8
#: The least share of a template's words, and of a span's own words, that agree in order.
MIN_COVERAGE = 0.7
#: Templates of up to so many words must be there with all their words, as one word tells them apart.
SHORT_WORDS = 12

# The phrases that are exact matches, with their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Wording of public licence notices, with the labels they get.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    # Whole notices.
    ("mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
        OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE."""),
    ("apache-2.0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License."""),
    ("gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details. You should have received a copy of the GNU General Public License
        along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("mpl-2.0", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("zlib", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
        claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be
        removed or altered from any source distribution."""),
    ("unlicense", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means."""),
)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in lower case, and each text's first word."""
    data, bounds = flat(texts)
    data = LOWER[data]
    starts, ends, first = runs(~NOT_WORD[data], bounds)
    return hashes(data, starts, ends), first


class Catalog:
    """Phrases and templates, with the window hashes by which documents meet their places."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]):
        self.labels: list[str] = []
        self.exact: list[bool] = []
        self.words: list[int] = []
        self.rows: list[tuple[int, int, int]] = []
        for exact, group in ((True, phrases), (False, templates)):
            for label, text in group:
                words, _ = word_hashes(pa.array([text]))
                if len(words) < K:
                    raise ValueError(f"a phrase or template has {K} words or more: {text!r}")
                self.rows += [(int(h), len(self.labels), t) for t, h in enumerate(grams(words, K).astype(np.int64))]
                self.labels.append(label)
                self.exact.append(exact)
                self.words.append(len(words))


def _windows(batches):
    for batch in batches_of_bytes(batches, "text"):
        words, first = word_hashes(batch.column("text"))
        counts = np.diff(first)
        every = grams(words, K).astype(np.int64)
        sizes = np.maximum(counts - K + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(first[:-1], sizes)
        values = pa.array(every[inside], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
            ],
            names=["row", "doc_id", "n_words", "windows"],
        )


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def _aligned(points: list[tuple[int, int]], least: float) -> list[tuple[int, int, int]]:
    """``start, end, agreeing`` of the spans in which a template's words stand in order.

    ``points`` are the windows that agree, as places in the document and in the template. A window
    carries on the one before it on its diagonal, or one that ended up to GAP words earlier in both,
    on a diagonal at most SLACK away: so neighbouring diagonals merge. Words that agree count 2,
    words left out on either side -1, and every window keeps its best alignment (then the one of
    more agreeing words, then the later start). Of the alignments that hold ``least`` agreeing
    words, and MIN_COVERAGE of their own words, those of the highest count stay (then the earliest
    start, then the earliest end) that share no word with one that stays already.
    """
    points = sorted(points)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    places: dict[int, list[int]] = defaultdict(list)
    for p, t in points:
        found = (2 * K, K, p)
        if (before := best.get((p - 1, t - 1))) is not None:
            found = max(found, (before[0] + 2, before[1] + 1, before[2]))
        for gap in range(GAP + 1):
            at = p - K - gap
            for u in places.get(at, ()):
                skipped = t - u - K
                if 0 <= skipped <= GAP and abs(gap - skipped) <= SLACK:
                    count, agreeing, start = best[at, u]
                    found = max(found, (count + 2 * K - gap - skipped, agreeing + K, start))
        best[p, t] = found
        places[p].append(t)
    ended = sorted(
        (-count, start, p + K, agreeing)
        for (p, _), (count, agreeing, start) in best.items()
        if agreeing >= least and agreeing >= MIN_COVERAGE * (p + K - start)
    )
    taken: list[tuple[int, int, int]] = []
    for _, start, end, agreeing in ended:
        i = bisect_left(taken, (start, end, 0))
        if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or taken[i][0] >= end):
            taken.insert(i, (start, end, agreeing))
    return taken


def _spans(hits: list[dict], catalog: Catalog) -> tuple[list[dict], list[dict]]:
    """Exact places, and verified spans of the other templates, from a document's diagonals."""
    votes: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for hit in hits:
        votes[hit["entry"]][hit["diagonal"]] |= hit["mask"] << (MASK_BITS * hit["block"])
    places, spans = [], []
    for entry, diagonals in sorted(votes.items()):
        label, words = catalog.labels[entry], catalog.words[entry]
        if catalog.exact[entry]:
            whole = (1 << (words - K + 1)) - 1
            places += [{"label": label, "start": d, "end": d + words} for d, mask in sorted(diagonals.items()) if mask == whole]
            continue
        least = words if words <= SHORT_WORDS else MIN_COVERAGE * words
        voted = 0
        for mask in diagonals.values():
            voted |= mask
        if K * voted.bit_count() < least:
            continue
        points = [(d + t, t) for d, mask in diagonals.items() for t in _bits(mask)]
        spans += [
            {"label": label, "start": start, "end": end, "coverage": agreeing / words}
            for start, end, agreeing in _aligned(points, least)
        ]
    return places, _widest(spans)


def _widest(spans: list[dict]) -> list[dict]:
    """The spans in order, without those inside a span of the same label: a sentence inside its notice."""
    left, reach = [], {}
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"], -s["coverage"], s["label"])):
        if span["end"] > reach.get(span["label"], -1):
            left.append(span)
            reach[span["label"]] = span["end"]
    return left


def scan(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, places, spans`` of every row of ``docs``, in numbers of words from 0.

    All rolling windows of two words meet the places of the templates in a join. A window at
    place p that stands at t in a template votes for the diagonal p - t. ``places`` are the
    diagonals of a phrase with every vote: there its words stand consecutively. ``spans`` come from
    an alignment over neighbouring diagonals, which verifies that the template's words stand there in
    order: all words of a template of up to SHORT_WORDS, else MIN_COVERAGE of them, and MIN_COVERAGE
    of the span's own words; ``coverage`` is the share of the template's words. Spans of one template
    share no words (see ``_aligned`` for ties); of spans of one label inside each other the outer one
    stays. The template table has the size of the given lists and is broadcast. A null or empty text
    has no words; a very long text is one row until its windows are dealt out, and its votes meet
    again by row; rows that repeat an id stay rows of their own; other columns, whatever their
    names, are not looked at; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    catalog = Catalog(phrases, templates)
    positions = spark.createDataFrame(catalog.rows, "window long, entry int, at_template int")
    kind = docs.schema[id_col].dataType.simpleString()
    windows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
    ).mapInArrow(_windows, f"row long, doc_id {kind}, n_words long, windows array<long>")
    votes = (
        windows.select("row", "doc_id", "n_words", F.posexplode_outer("windows").alias("at", "window"))
        .join(F.broadcast(positions), "window", "left")
        .groupBy(
            "row", "doc_id", "n_words", "entry",
            F.expr(f"at_template div {MASK_BITS}").cast("int").alias("block"),
            (F.col("at") - F.col("at_template")).alias("diagonal"),
        )
        .agg(F.bit_or(F.expr(f"shiftleft(1L, at_template % {MASK_BITS})")).alias("mask"))
    )
    hit = F.when(F.col("entry").isNotNull(), F.struct("entry", "block", "diagonal", "mask"))
    by_row = votes.groupBy("row", "doc_id", "n_words").agg(F.collect_list(hit).alias("hits"))
    place_type = "array<struct<label: string, start: long, end: long>>"
    span_type = "array<struct<label: string, start: long, end: long, coverage: double>>"

    def verify(batches):
        for batch in batches:
            found = [_spans(hits, catalog) for hits in batch.column("hits").to_pylist()]
            base = [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array([f[0] for f in found], pa.list_(pa.struct(base))),
                    pa.array([f[1] for f in found], pa.list_(pa.struct([*base, ("coverage", pa.float64())]))),
                ],
                names=["doc_id", "n_words", "places", "spans"],
            )

    return by_row.mapInArrow(verify, f"doc_id {kind}, n_words long, places {place_type}, spans {span_type}")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, ends, labels and score of each row of ``scan``; labels of nothing are empty text."""
    def labels(*columns):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*columns))), ",")

    starts = F.col("places.start")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"),
        labels(F.col("places.label"), F.col("spans.label")).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0)))
        .alias("score"),
    )
