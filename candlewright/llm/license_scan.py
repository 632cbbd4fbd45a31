"""Licence notices in documents (operator 3).

A logistic regression on hashed word n-grams gives every paragraph (line) a probability per licence family, for licence
text of no known family, and for ordinary text. Lines of more words than a window are classified in overlapping windows
of two lengths (``WINDOWS``), so a notice counts wherever it stands: short ones fill the short windows. A family counts only when its probability is at least ``CERTAIN`` and one of
its templates is found around the window: most of the template's word pairs. Otherwise it is licence text of an unknown
family, if its probability is at least ``LEAST`` and over that of ordinary text. A window of mostly repeated words is judged
by its different words. Of windows that overlap, the best per confirmed family is reported, or the most probable one if none is confirmed.

The model is trained in numpy on the driver from the templates below, altered at random with a fixed seed, and from about
``MAX_ORDINARY`` different paragraphs of over ``MIN_CHARS`` characters of the corpus, chosen by a threshold on their hash
(one window of their first ``MAX_CHARS`` characters each). Paragraphs with a word of licence language are not taught as
ordinary, but a few fixed sentences are. One temperature is fitted on templates that were wholly held out, so that the
probabilities mean what they say of new wordings; then the model is trained on all.

The whole text of every document is classified, in numpy batches inside the tasks; nothing is shuffled.

Defined cases: null, empty or wordless texts give no row; repeated rows give repeated rows; a document without
id keeps a null id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.base import mixed

# Families and notices that stand for them. The last of a family is held out when the temperature is fitted.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability",
        "This project is available under the terms of the MIT license.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0, January 2004", "you may not use this file except in compliance with the License", "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "See the License for the specific language governing permissions and limitations under the License.",
        "This project is released under the Apache 2.0 license.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.", "redistribute it and/or modify it under the terms of the GNU General Public License", "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.", "Licensed under the GPLv3 or later.", "Released under the GNU GPL v2.",
        "This is free software under the GPL version 2 or any later version.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "under the terms of the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "Released under the LGPL v3.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.", "under the terms of the GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-only",
        "You should have received a copy of the GNU Affero General Public License along with this program.", "Released under the AGPL v3.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD license.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties are disclaimed",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mpl": [
        "subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License", "https://creativecommons.org/licenses/by/4.0/",
        "This article is distributed under the terms of the Creative Commons Attribution License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "https://creativecommons.org/licenses/by-sa/4.0/",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "https://creativecommons.org/licenses/by-nc/4.0/",
        "shared under the Creative Commons Attribution-NonCommercial License",
    ],
    "cc0": [
        "Released under CC0 1.0.", "has waived all copyright and related rights to this work", "dedicated to the public domain under CC0", "https://creativecommons.org/publicdomain/zero/1.0/",
        "CC0 1.0 Universal Public Domain Dedication",
    ],
    "reserved": ["All rights reserved.", "No part of this work may be reproduced without written permission", "may not be reproduced or distributed in any form without the prior written permission of the publisher"],
}
UNKNOWN_NOTICES = [
    "Licensed under the {} License.", "Released under the {} License, version {}.", "This work is licensed under the terms of the {} {} licence.", "Distributed under the {} {} license, see the license file.",
    "By using {} you accept the terms of this license.", "Use is subject to the {} license agreement.",
]
#: Ordinary sentences with words of licence language.
ORDINARY_SENTENCES = [
    "He lost his driver's license on the way home.", "They applied for a marriage license at the town hall.", "The license plate of the car was covered with mud.", "The pub had no license to sell wine.",
    "She asked for permission to leave the room.", "The software was easy to use and free of charge.", "The warranty on the washing machine ran out last year.", "The public library is open under the same terms as before.",
    "The copyright case was decided by the court in May.", "All rights and duties of the members are listed below.", "The general public was not admitted to the hearing.", "You may not use the lift in case of fire.",
    "In the morning he went to the office by bus.", "It is one of the oldest houses of the town, and the garden is open to all.", "See the next page for the list of names.", "This work was done by the end of the year.",
    "The officer asked the driver for the papers of the car.", "The file is on the table in the other room.", "They were all in the park when it began to rain.", "You can find the answer at the end of the book.",
]
LICENCE_LIKE = "licen[cs]e|copyright|warrant|redistribut|creative ?commons|public domain|hereby granted|rights reserved|written permission|\\b(a|l)?gpl|\\bspdx|\\bcc0\\b|\\bcc.by"

UNKNOWN, ORDINARY = "unknown", "ordinary"
CLASSES = (*TEMPLATES, UNKNOWN, ORDINARY)
DIMENSIONS = 1 << 14
VARIANTS = 30
MAX_ORDINARY, MIN_CHARS, MAX_CHARS = 3000, 20, 2000
WINDOWS = (8, 24)  # words; each with a stride of half of it
WINDOW = WINDOWS[-1]
CERTAIN, CONFIRMED, LEAST = 0.5, 0.6, 0.3
EPOCHS, RATE, DECAY = 8, 0.5, 1e-6
BATCH_WORDS = 1 << 16
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(paragraphs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the word 1-, 2- and 3-grams of all paragraphs, one after another, and how many each has."""
    n = np.fromiter(map(len, paragraphs), np.int64, len(paragraphs))
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for p in paragraphs for w in p), np.uint64, int(n.sum()))
    owner = np.repeat(np.arange(len(n)), n)
    grams, owners, chain = [hashed], [owner], hashed
    for k in (1, 2):
        chain = mixed(chain[:-1]) + hashed[k:] if len(hashed) > k else hashed[:0]
        inside = owner[:len(chain)] == owner[k:k + len(chain)]
        grams.append(chain[inside])
        owners.append(owner[:len(chain)][inside])
    buckets, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (mixed(buckets[order]) % np.uint64(DIMENSIONS)).astype(np.int64), np.bincount(owners, minlength=len(n))


@dataclass
class Model:
    weights: np.ndarray  # class x bucket
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, buckets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Paragraph x class; every paragraph has a word."""
        starts = np.cumsum(sizes) - sizes
        sums = np.stack([np.add.reduceat(w[buckets], starts) for w in self.weights], axis=1)
        return sums / np.sqrt(sizes)[:, None] + self.bias

    def softmax(self, z: np.ndarray) -> np.ndarray:
        z = z / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, paragraphs: list[list[str]]) -> np.ndarray:
        return self.softmax(self.logits(*features(paragraphs)))

    def of_windows(self, words: list[str], first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The same for the stretches from ``first`` to ``end`` of a list of words: every n-gram is looked up once, whatever windows hold it."""
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
        hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        sums, sizes, chain, rows = np.zeros((len(first), len(CLASSES))), np.zeros(len(first)), hashed, np.ascontiguousarray(self.weights.T)
        for k in range(3):
            if k:
                chain = mixed(chain[:-1]) + hashed[k:]
            upto = np.zeros((len(chain) + 1, len(CLASSES)))
            np.cumsum(rows[(mixed(chain) % np.uint64(DIMENSIONS)).astype(np.int64)], axis=0, dtype=np.float64, out=upto[1:])
            low = np.minimum(first, len(chain))
            high = np.maximum(np.minimum(end - k, len(chain)), low)
            sums += upto[high] - upto[low]
            sizes += high - low
        return self.softmax(sums / np.sqrt(sizes)[:, None] + self.bias)


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:])) or {(w, "") for w in words}


TEMPLATE_PAIRS = {family: [pairs(words_of(t)) for t in notices] for family, notices in TEMPLATES.items()}


def template_share(family: str, words: list[str]) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    own = pairs(words)
    return max(len(t & own) / len(t) for t in TEMPLATE_PAIRS[family])


def examples(ordinary: list[list[str]], seed: int = 5) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Altered templates, made-up licences and ordinary windows, their classes, and whether their template is to be held out."""
    rng = np.random.default_rng(seed)
    filler = [w for p in [*ordinary, *map(words_of, ORDINARY_SENTENCES)] for w in p][:20000]
    some = lambda n, of=filler: [of[i] for i in rng.integers(0, len(of), n)]
    different = list(dict.fromkeys(filler))  # so that a word that fills a small corpus isn't all of ordinary text
    out, labels, held = [], [], []

    def add(words: list[str], label: str, last: bool) -> None:
        words = [w for w in words if rng.random() > 0.05] or words
        if len(words) > 8 and rng.random() < 0.3:  # what a window cuts off
            a = rng.integers(0, len(words) // 2)
            words = words[a:a + max(8, 2 * len(words) // 3)]
        around = int(rng.integers(0, max(1, rng.choice(WINDOWS) - len(words)) + 1)) if rng.random() < 0.6 else 0
        before = int(rng.integers(0, around + 1))
        out.append(some(before) + words[:WINDOW] + some(around - before))
        labels.append(CLASSES.index(label))
        held.append(last)

    for family, notices in TEMPLATES.items():
        for notice in notices:
            for _ in range(VARIANTS):
                add(words_of(notice), family, notice is notices[-1])
    for i in range(VARIANTS * 12):
        notice = UNKNOWN_NOTICES[i % len(UNKNOWN_NOTICES)]
        add(words_of(notice.format(*some(2))), UNKNOWN, notice is UNKNOWN_NOTICES[-1])
    for i, sentence in enumerate(ORDINARY_SENTENCES):
        for _ in range(VARIANTS):
            add(words_of(sentence), ORDINARY, i % 5 == 4)
    for i, p in enumerate([*ordinary, *(some(rng.integers(1, WINDOW + 1), of) for of in (filler, different) for _ in range(300))]):
        if p:
            n = int(rng.choice(WINDOWS))
            a = int(rng.integers(0, max(1, len(p) - n + 1)))
            out.append(p[a:a + n])
            labels.append(CLASSES.index(ORDINARY))
            held.append(i % 5 == 4)
    return out, np.array(labels), np.array(held)


def trained(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    model = Model(np.zeros((len(CLASSES), DIMENSIONS), np.float32), np.zeros(len(CLASSES), np.float32))
    square = np.full((len(CLASSES), DIMENSIONS), 1e-3, np.float32)
    rng = np.random.default_rng(1)
    parts = [np.unique(r) for r in rows]
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            buckets = parts[i]
            z = model.weights[:, buckets].sum(axis=1) / np.sqrt(len(rows[i])) + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = (p / np.sqrt(len(rows[i])))[:, None] + DECAY * model.weights[:, buckets]
            square[:, buckets] += g * g
            model.weights[:, buckets] -= RATE * g / np.sqrt(square[:, buckets])
            model.bias -= 0.05 * p
    return model


def fit(ordinary: list[list[str]]) -> Model:
    paragraphs, labels, held = examples(ordinary)
    rows = [features([p])[0] for p in paragraphs]
    first = trained([r for r, h in zip(rows, held) if not h], labels[~held])
    z, y = first.logits(*features([p for p, h in zip(paragraphs, held) if h])), labels[held]

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    model = trained(rows, labels)
    model.temperature = float(min(np.geomspace(0.2, 20, 60), key=loss))
    return model


def ordinary_sample(documents: DataFrame) -> list[list[str]]:
    """About ``MAX_ORDINARY`` different paragraphs without licence language, those whose hash is under a threshold; never twice as many."""
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line")).where((F.length("line") > MIN_CHARS) & ~F.lower("line").rlike(LICENCE_LIKE))
    lines = lines.select(F.xxhash64("line").alias("h"), F.substring("line", 1, MAX_CHARS).alias("line"))
    different = lines.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, MAX_ORDINARY / max(1, different))
    few = lines.where(F.col("h") <= F.lit(int(-(2**63) + share * (2**64 - 2**12)))).distinct()
    return [words_of(r["line"]) for r in few.orderBy("h", "line").limit(2 * MAX_ORDINARY).collect()]


NOTICES = "doc_id long, paragraph int, start int, end int, family string, predicted string, probability double, template_share double"


def lowered(line: str) -> str:
    """In lower case if that keeps the places of all characters."""
    low = line.lower()
    return low if len(low) == len(line) else line


@lru_cache(maxsize=4096)
def places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end words of the windows of a line of ``n`` words; a short line is one window."""
    found = {(a, a + size) for size in WINDOWS if size < n for a in [*range(0, n - size, size // 2), n - size]} | ({(0, n)} if 0 < n <= WINDOW else set())
    both = np.array(sorted(found), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def span_of(line: str, a: int, b: int, n: int) -> tuple[int, int]:
    """Where the words from ``a`` to ``b`` of ``n`` stand, in code points; all of them are the whole line."""
    if b - a == n:
        return 0, len(line)
    spans = [m.span() for m in islice(WORD.finditer(lowered(line)), a, b)]
    return spans[0][0], spans[-1][1]


def windows_of(line: str) -> tuple[list[str], list[tuple[int, int, int, int]]]:
    """The words of a line, and (first word, end word, start, end) of its windows."""
    words = [w.lower() for w in WORD.findall(lowered(line))]
    return words, [(a, b, *span_of(line, a, b, len(words))) for a, b in zip(*(x.tolist() for x in places(len(words))))]


def _scan(batches, shared):
    model, names = shared.value, np.array(CLASSES)
    ordinary = CLASSES.index(ORDINARY)
    for batch in batches:
        rows: list[tuple] = []
        words: list[str] = []  # of the lines at hand
        lines: list[tuple] = []  # document, paragraph, place, first word and number of words, text
        hits: list[tuple] = []  # windows of one line that overlap
        at_hand: list = [None, 0]  # line and end of the hits
        docs = batch.column(0).to_pylist()

        def report():
            sure = [h for h in hits if h[-1]]
            best: dict = {}
            for h in sure or hits:
                key, rank = (h[4], (h[7], h[6])) if sure else (None, (h[6], 0.0))
                if key not in best or rank > best[key][0]:
                    best[key] = rank, h
            rows.extend(sorted((h[:-1] for _, h in best.values()), key=lambda r: r[1:5]))
            hits.clear()

        def classify():
            windows = [places(line[4]) for line in lines]
            if not words:
                lines.clear()
                return
            times = np.array([len(w[0]) for w in windows])
            owner, here = np.repeat(np.arange(len(lines)), times), np.repeat(np.array([line[3] for line in lines]), times)
            first, end = (np.concatenate([w[i] for w in windows]) + here for i in (0, 1))
            step = 1 << 14
            for c in range(0, len(first), step):
                low, high = int(first[c]), int(end[c:c + step].max())
                p = model.of_windows(words[low:high], first[c:c + step] - low, end[c:c + step] - low)
                for i in np.flatnonzero(p[:, ordinary] < 0.5).tolist():
                    decide(lines[owner[c + i]], int(first[c + i]), int(end[c + i]), p[i])
            lines.clear()
            words.clear()

        def decide(line, a, b, p):
            d, k, at, here, n, text = line
            different = list(dict.fromkeys(words[a:b]))
            if 2 * len(different) <= b - a:
                p = model.probabilities([different])[0]
            best = int(p[:ordinary].argmax())
            family, share = str(names[best]), 0.0
            if p[best] < max(LEAST, p[ordinary]):
                return
            if family != UNKNOWN:
                share = template_share(family, words[max(here, a - WINDOW):min(here + n, b + WINDOW)])
            sure = bool(p[best] >= CERTAIN and share >= CONFIRMED)
            start, end = (at + x for x in span_of(text, a - here, b - here, n))
            if hits and (at_hand[0] != (d, k) or start >= at_hand[1]):
                report()
            at_hand[:] = [(d, k), max(end, at_hand[1] if hits else end)]
            hits.append((docs[d], k, start, end, family if sure else UNKNOWN, family, float(p[best]), share, sure))

        for d, text in enumerate(batch.column(1)):
            at = 0
            for k, line in enumerate((text.as_py() or "").split("\n")):
                low = lowered(line)
                own = WORD.findall(low) if low is not line else [w.lower() for w in WORD.findall(line)]
                if own:
                    lines.append((d, k, at, len(words), len(own), line))
                    words += own
                at += len(line) + 1
                if len(words) >= BATCH_WORDS:
                    classify()
        classify()
        report()
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [f.split()[0] for f in NOTICES.split(", ")])


def notices(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """A row per stretch of a paragraph that reads like a licence notice, with its place in code points."""
    if model is None:
        model = fit(ordinary_sample(documents))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: _scan(b, shared), NOTICES)
