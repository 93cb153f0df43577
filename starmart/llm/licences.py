"""Licence scan by a trained paragraph classifier (operator 1).

A sparse logistic regression over word n-grams (1 to 3 words) tells the families
of ``TEMPLATES`` and an ``unknown`` class apart, for every line of every document.

* Training texts: the templates, whole, cut, with words dropped and inside corpus lines;
  for ``unknown`` at most ``sample`` lines of the corpus (those with the smallest
  hashes) that share little with any template, corpus lines with stray template words, and
  templates in shuffled order.  That bounded sample is all the driver sees of the corpus.
* The n-grams are those of the templates, but for those in more than ``common`` of the corpus lines; L1 shrinkage
  takes out what doesn't help.
* Calibration: on texts kept out of the fit, a temperature is fitted to the class probabilities, and
  the cutoff for calling a line known is raised until less than ``false_rate`` of the
  unknown ones pass.
* A prediction is confirmed by comparison with the family's templates: the longest common
  subsequence must cover ``min_similarity`` of the template's words, or, for lines of at least 12
  words, of the line's own words (a part of a long licence text).

* Notices that run over several lines: the words of each paragraph (a run of non-blank lines) are classified in
  windows that hold the longest template, overlapping by half. A window called known is confirmed if the common
  subsequence covers ``min_similarity`` of a template's words within a stretch of lines that isn't
  much longer than the template; the stretch is cut down to the lines that matter.

A line without any weighted n-gram has the class ``unknown``.  Every weighted n-gram is filed under
its rarest word, so a document is looked at line by line only if it holds such a word: nothing is skipped
that could be found.

Result: one row for each line that is called known, with its family (``unknown`` if no template confirms it), and one for
each confirmed stretch of two and more lines: its first line and their number.

Defined results: null and empty texts and empty lines have no rows; repeated rows
give repeated rows; a null id is kept; an empty table gives an empty result (the fit then has
no corpus lines); extra columns are ignored; ties between families go to the first in
alphabetical order; texts are processed whole, paragraphs of any length by windows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8
from .decontam import Item, lcs, words_of

UNKNOWN = "unknown"
#: fixed texts: public licence notices by family
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced or distributed without the "
        "prior written permission of the publisher.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work under the CC0 1.0 Universal Public Domain Dedication.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
GRAM = 3


def grams(words: list[bytes]):
    """All n-grams of 1 to GRAM words."""
    for n in range(1, GRAM + 1):
        yield from zip(*(words[i:] for i in range(n)))


@dataclass
class LicenceModel:
    families: list[str]               # the last is UNKNOWN
    index: dict[tuple, int]           # weighted n-grams only
    weights: np.ndarray               # n-grams x families
    bias: np.ndarray
    temperature: float
    cutoff: float
    keys: frozenset                   # the rarest word of every weighted n-gram
    min_similarity: float = 0.8

    def scores(self, words: list[bytes]) -> np.ndarray:
        at = sorted({self.index[g] for g in grams(words) if g in self.index})
        return (self.bias + self.weights[at].sum(axis=0)) / self.temperature

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        return softmax(self.scores(words)[None, :])[0]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def shares(words: list[bytes], family: str) -> tuple[float, float]:
    """How much of a template of the family the words hold, and how much of the words a template holds, at best."""
    held, part = 0.0, 0.0
    for template in _TEMPLATE_WORDS[family]:
        common = lcs(Item(0, template, []).masks(), len(template), words)
        held, part = max(held, common / len(template)), max(part, common / max(1, len(words)))
    return held, part


def similarity(words: list[bytes], family: str) -> float:
    """How well the best template of the family covers the line, or the line a part of it."""
    held, part = shares(words, family)
    return max(held, part if len(words) >= 12 else 0.0)


_TEMPLATE_WORDS = {f: [words_of(t.encode()) for t in ts] for f, ts in TEMPLATES.items()}


def training_texts(corpus: list[list[bytes]], rng) -> tuple[list[list[bytes]], list[int], list[str]]:
    """Word lists, class numbers and class names."""
    families = sorted(TEMPLATES) + [UNKNOWN]
    flat = [w for f in families[:-1] for t in _TEMPLATE_WORDS[f] for w in t]
    filler = corpus or [[b"plain", b"text"]]
    texts, classes = [], []

    def around(words):
        line = filler[rng.integers(len(filler))]
        cut = rng.integers(0, min(6, len(line)) + 1)
        return line[:cut] + words if rng.random() < 0.5 else words + line[:cut]

    for c, family in enumerate(families[:-1]):
        for template in _TEMPLATE_WORDS[family]:
            for _ in range(24):
                words = template
                if len(template) > 20 and rng.random() < 0.5:
                    start = rng.integers(0, len(template) - 14)
                    words = template[start:start + int(rng.integers(14, len(template)))]
                if len(words) > 8:
                    words = [w for w in words if rng.random() > 0.08]
                texts.append(around(words) if rng.random() < 0.6 else words)
                classes.append(c)
            for _ in range(4):
                shuffled = [template[i] for i in rng.permutation(len(template))]
                if len(template) > 5:
                    texts.append(shuffled[:max(2, len(shuffled) // 2)])
                    classes.append(len(families) - 1)
    for line in corpus:
        texts.append(line)
        classes.append(len(families) - 1)
        if rng.random() < 0.3:  # stray template words
            at = rng.integers(0, len(line) + 1)
            stray = [flat[i] for i in rng.integers(0, len(flat), int(rng.integers(1, 4)))]
            texts.append(line[:at] + stray + line[at:])
            classes.append(len(families) - 1)
    return texts, classes, families


def fit(corpus: list[list[bytes]], seed: int = 42, l1: float = 0.01, steps: int = 100, rate: float = 0.1,
        false_rate: float = 1e-3, common: float = 0.01) -> LicenceModel:
    """Proximal Adam on four fifths of the training texts; calibration on the rest."""
    rng = np.random.default_rng(seed)
    corpus = [w for w in corpus if w and max(similarity(w, f) for f in TEMPLATES) < 0.5]
    texts, classes, families = training_texts(corpus, rng)
    lines_with = Counter(g for line in corpus for g in set(grams(line)))
    names = sorted(g for g in {g for ts in _TEMPLATE_WORDS.values() for t in ts for g in grams(t)}
                   if lines_with[g] <= common * len(corpus))
    number = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(texts), len(names)), np.float32)
    for i, words in enumerate(texts):
        x[i, [number[g] for g in grams(words) if g in number]] = 1
    y = np.eye(len(families), dtype=np.float32)[classes]
    held = rng.random(len(texts)) < 0.2
    xa, ya = x[~held], y[~held]
    w, b = np.zeros((len(names), len(families)), np.float32), np.zeros(len(families), np.float32)
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        error = (softmax(xa @ w + b) - ya) / len(xa)
        lr = rate / (1 + step / 50)
        for k, (p, g) in enumerate(((w, xa.T @ error), (b, error.sum(axis=0)))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
        w[:] = np.sign(w) * np.maximum(np.abs(w) - lr * l1, 0)
    scores, truth = x[held] @ w + b, y[held].argmax(axis=1)
    temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0),
                      key=lambda t: -np.log(softmax(scores / t)[np.arange(len(truth)), truth] + 1e-9).mean())
    known = 1 - softmax(scores / temperature)[truth == len(families) - 1, -1]
    cutoff = max(0.5, float(np.quantile(known, 1 - false_rate))) if len(known) else 0.5
    used = np.flatnonzero(np.abs(w).max(axis=1) > 0)
    often = Counter(word for line in corpus for word in line)
    keys = frozenset(min(names[i], key=lambda word: (often[word], word)) for i in used)
    return LicenceModel(families, {names[i]: k for k, i in enumerate(used)}, w[used].astype(float), b.astype(float),
                        float(temperature), min(cutoff, 0.95), keys)


def corpus_lines(docs: DataFrame, sample: int = 3000) -> list[list[bytes]]:
    """At most ``sample`` lines of 20 to 4000 characters, one per document, of the documents with the smallest hashes."""
    known = docs.where("text is not null and doc_id is not null").select("doc_id", "text")
    # ids first: texts of the sample only are moved
    ids = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    long = F.filter(F.split("text", "\n"), lambda x: F.length(x).between(20, 4000))
    picked = (known.join(F.broadcast(ids), "doc_id").select("doc_id", long.alias("lines")).where(F.size("lines") > 0)
              .select(F.element_at("lines", (F.pmod(F.xxhash64("doc_id"), F.size("lines")) + 1).cast("int")).alias("line"),
                      "doc_id").orderBy("doc_id", "line").limit(sample).collect())
    return [words_of(r["line"].encode()) for r in picked]


#: words of a paragraph that are classified together: twice the longest template
WINDOW = 2 * max(len(t) for ts in _TEMPLATE_WORDS.values() for t in ts)


def _stretch(model: LicenceModel, lines: list[list[bytes]], family: str) -> tuple[int, int, float] | None:
    """(first line, lines, share of the template) of the notice of a family that runs over some of the lines."""
    best = None
    for template in _TEMPLATE_WORDS[family]:
        masks, size = Item(0, template, []).masks(), len(template)

        def common(low, high):
            return lcs(masks, size, [w for line in lines[low:high] for w in line])

        low, high, whole = 0, len(lines), common(0, len(lines))
        if whole < model.min_similarity * size or best and whole / size <= best[2]:
            continue
        while high - low > 1 and common(low + 1, high) == whole:
            low += 1
        while high - low > 1 and common(low, high - 1) == whole:
            high -= 1
        if high - low > 1 and sum(map(len, lines[low:high])) <= 1.5 * size + 12:
            best = low, high - low, whole / size
    return best


def stretches(model: LicenceModel, lines: list[list[bytes]]):
    """(first line, lines, family, probability, share) of notices over several lines; a line is the list of its words."""
    found: dict[tuple[int, int, str], tuple[float, float]] = {}
    start = 0
    while start < len(lines):
        end = start
        while end < len(lines) and lines[end]:
            end += 1
        low = start
        while low < end - 1:  # windows of whole lines, overlapping by half
            high, words = low, 0
            while high < end and (words < WINDOW or high < low + 2):
                words += len(lines[high])
                high += 1
            part = [w for line in lines[low:high] for w in line]
            if not model.keys.isdisjoint(part):
                p = model.probabilities(part)
                # a window can hold notices of several families: all that are more likely than unknown
                score = model.scores(part)
                for c in np.flatnonzero(score[:-1] > score[-1]).tolist() if 1 - p[-1] >= model.cutoff else ():
                    family = model.families[c]
                    hit = _stretch(model, lines[low:high], family)
                    if hit:
                        found.setdefault((low + hit[0], hit[1], family), (float(1 - p[-1]), hit[2]))
            if high == end:
                break
            half, moved = 0, low
            while moved < high - 1 and half < words // 2:
                half += len(lines[moved])
                moved += 1
            low = max(low + 1, moved)
        start = end + 1
    for (first, count, family), (probability, share) in sorted(found.items()):
        yield first, count, family, probability, share


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """doc_id, line, lines, family, probability, similarity, confirmed of every line, and of every notice over
    several lines, called known."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the templates
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, line bigint, lines bigint, family string, probability double, similarity double, confirmed boolean"

    def run(batches):
        model = shared.value
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(utf8(batch.column(1))):
                if not text or model.keys.isdisjoint(words_of(text)):
                    continue
                lines = [words_of(line) for line in text.split(b"\n")]
                for number, words in enumerate(lines):
                    if model.keys.isdisjoint(words):
                        continue
                    p = model.probabilities(words)
                    if 1 - p[-1] < model.cutoff:
                        continue
                    family = model.families[int(p[:-1].argmax())]
                    alike = similarity(words, family)
                    confirmed = alike >= model.min_similarity
                    rows.append(row)
                    found.append((number, 1, family if confirmed else UNKNOWN, round(float(1 - p[-1]), 6),
                                  round(alike, 6), confirmed))
                for number, count, family, probability, share in stretches(model, lines):
                    if any(shares(words, family)[0] >= model.min_similarity for words in lines[number:number + count]):
                        continue  # a line of it holds the notice alone
                    rows.append(row)
                    found.append((number, count, family, round(probability, 6), round(share, 6), True))
            if rows:
                line, count, family, probability, alike, confirmed = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(line, pa.int64()), pa.array(count, pa.int64()), pa.array(family),
                     pa.array(probability), pa.array(alike), pa.array(confirmed)],
                    names=["doc_id", "line", "lines", "family", "probability", "similarity", "confirmed"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def licence_scan(docs: DataFrame, sample: int = 3000) -> DataFrame:
    """Fit on the templates and a bounded sample of corpus lines, then scan all lines."""
    return scan(docs, fit(corpus_lines(docs, sample)))
