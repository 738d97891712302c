"""Licence scans: a trained paragraph classifier with an unknown class, confirmed by templates.

Paragraphs are the lines of a text. Features are word n-grams (1 to 3). A multinomial logistic
regression with one class per licence family and one for everything else is trained on the
templates below, varied (cut, words lost, prefixed), against paragraphs of a bounded sample of
documents, words of the templates in any order, and templates without what is their family's own;
small weights are set to zero. A temperature fitted on variations kept aside calibrates the
probabilities. The most probable class decides, at ``THRESHOLD`` or more; it may be the unknown one.

The classifier judges first. A notice may stand anywhere in a paragraph: n-grams of two words or more, or names, that it
weighs for some family above the unknown class mark the words of spans, which may skip ``GAP`` words.
It judges the whole paragraph, every span, the spans from the first to the last, and every
window of ``WINDOW`` words, and of half as many, that starts or ends at a marked word; a paragraph without such n-grams is
unknown. Templates then confirm what it predicts: a prediction is
confirmed when at least ``CONFIRM`` of the n-grams judged stand in one template of the family, or they are as
large a part of those a window of the template holds, and one of them stands in no
template of other families. Predictions that no template confirms are returned as such, from a probability of ``ALONE``. Of
two families read from much the same words the more probable stays. A paragraph has each family once:
confirmed before not, then the most similar, then the most probable.

Defined cases: null text counts as empty; a text without licence paragraphs has null family, 0
licences; ties go to the earlier paragraph, in it to the earlier family of the templates; repeated
rows are scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import received, shipped

#: Documents whose paragraphs may serve as examples of no licence.
SAMPLE = 1000
OTHERS = 3000
VARIATIONS = 60
CONFIRM = 0.5
#: Words of a window at most; longer templates are found by their parts.
WINDOW = 12
THRESHOLD = 0.5
#: Probability of a prediction that no template confirms.
ALONE = 0.8
#: Words without a licence n-gram that a span may skip.
GAP = 4

# Notices by which works name their licence, as their licences word them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This software is made available under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This software is made available under the terms of the Apache License, version 2.0.",
        "Distributed under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "CC0": (
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under the CC0 1.0 Universal Public Domain Dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "EPL": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Proprietary": (
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
        "This document is proprietary and confidential. Unauthorized copying is strictly prohibited.",
    ),
}
FAMILIES = [None, *TEMPLATES]
TOKEN = re.compile(r"[a-z0-9]+(?:[-.][a-z0-9]+)*")


def grams(words: list[str]) -> list[str]:
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


KNOWN = {f: [set(grams(TOKEN.findall(t.lower()))) for t in texts] for f, texts in TEMPLATES.items()}
VOCABULARY = set().union(*(w for texts in KNOWN.values() for w in texts))
#: N-grams of each family that stand in no template of the others.
OWN = {f: set().union(*texts) - set().union(*(w for g in KNOWN if g != f for w in KNOWN[g])) for f, texts in KNOWN.items()}

# Templates as columns: their windows' words, the n-grams that a window of them holds, and which n-grams they have; row 0 has none.
PATTERNS = [(f, t) for f, texts in KNOWN.items() for t in texts]
WORDS = np.array([min(WINDOW, len(TOKEN.findall(t.lower()))) for texts in TEMPLATES.values() for t in texts])
HELD = np.array([min(len(t), len(grams(["w"] * n))) for (_, t), n in zip(PATTERNS, WORDS)])
ROW = {g: i for i, g in enumerate(sorted(VOCABULARY), 1)}
HAS = np.array([[False] * len(PATTERNS), *([g in t for _, t in PATTERNS] for g in sorted(VOCABULARY))])
OWN_ROWS = {ROW[g] for own in OWN.values() for g in own}
LEAST = CONFIRM * HELD.min()
LONGEST = max(len(t) for _, t in PATTERNS)


def words_of(paragraph: str) -> list[str]:
    return TOKEN.findall(paragraph.lower())


def similarity(words: list[str], family: str) -> float:
    """Largest share of the paragraph's n-grams that stand in one template of the family."""
    mine = set(grams(words))
    return max(len(mine & t) / len(mine) for t in KNOWN[family]) if mine else 0.0


def confirmation(words: list[str], family: str) -> tuple[float, bool]:
    """Similarity to the nearest template of the family, and whether an n-gram of no other family is among what they share.

    The larger of two shares: of the words' n-grams that stand in the template, and of those a window of the template holds that are among the words'.
    Single words count for names alone, in stretches of up to two words.
    """
    mine, best = {g for g in grams(words) if " " in g or len(words) < 3}, (0.0, False)
    for k, (other, known) in enumerate(PATTERNS):
        if other == family and mine:
            shared, held = mine & known, max(1, 2 * int(WORDS[k]) - 3)
            best = max(best, (min(1.0, max(len(shared) / len(mine), len(shared) / held)), bool(shared & OWN[family])))
    return best


def windows(words: list[str]) -> Iterator[tuple[str, list[str], float]]:
    """(family, words, similarity) of the window that each template matches best, if it confirms the family."""
    one = [ROW.get(w, 0) for w in words]
    two = [ROW.get(f"{words[i]} {words[i + 1]}", 0) if a and b else 0 for i, (a, b) in enumerate(zip(one, one[1:]))]
    three = [ROW.get(" ".join(words[i:i + 3]), 0) if a and b else 0 for i, (a, b) in enumerate(zip(two, two[1:]))]
    present = {*one, *two, *three}
    if len(present) <= LEAST or present.isdisjoint(OWN_ROWS):
        return
    near = HAS[list(present)].sum(0) >= CONFIRM * HELD
    for k in np.flatnonzero(near):
        family, known = PATTERNS[k]
        # hits before each place; n-grams that repeat count again, so this bounds the distinct ones from above
        before = [np.append(0, np.cumsum(HAS[np.array(x, np.int64), k])) for x in (one, two, three)]
        start = np.flatnonzero(HAS[np.array(one), k])
        end = np.minimum(start + WORDS[k], len(words))
        bound = sum(b[np.maximum(end - i, 0)] - b[np.minimum(start, np.maximum(end - i, 0))] for i, b in enumerate(before))
        best, most = None, CONFIRM * HELD[k]
        for j in np.argsort(-bound, kind="stable"):
            if bound[j] < most or best and bound[j] == most:
                break
            found = set(grams(words[start[j]:end[j]])) & known
            if len(found) >= most and (best is None or len(found) > most) and found & OWN[family]:
                best, most = (start[j], end[j]), len(found)
        if best:
            a, b = best  # the notice goes on as long as its word pairs do
            while a and HAS[two[a - 1], k]:
                a -= 1
            while b < len(words) and HAS[two[b - 1], k]:
                b += 1
            yield family, words[a:b], float(most / HELD[k])


def candidates(words: list[str]) -> Iterator[tuple[str, list[str], float]]:
    """(family, words, similarity) of what the templates confirm: the whole paragraph, and windows of it."""
    if not any(f"{a} {b}" in VOCABULARY for a, b in zip(words, words[1:])):
        return
    if len(words) <= LONGEST:  # else no template can hold half of its n-grams, or a window holds as many
        mine = set(grams(words))
        for family in KNOWN if len(mine & VOCABULARY) >= CONFIRM * len(mine) else ():
            if mine & OWN[family] and (same := similarity(words, family)) >= CONFIRM:
                yield family, words, same
    yield from windows(words)


def examples(others: list[list[str]], seed: int = 5) -> tuple[list[list[str]], np.ndarray]:
    """Varied templates and paragraphs of no licence, with class numbers."""
    draw = np.random.default_rng(seed)
    texts: list[list[str]] = []
    classes: list[int] = []
    for c, (_, family) in enumerate(TEMPLATES.items(), 1):
        for text in family:
            whole = words_of(text)
            # long templates have many parts, and every part is a notice
            for v in range(VARIATIONS * -(-len(whole) // WINDOW)):
                words = list(whole)
                if v and len(words) > WINDOW and draw.random() < 0.8:
                    cut = draw.integers(0, len(words) - 7)
                    words = words[cut:cut + int(draw.integers(8, len(words)))]
                if v and draw.random() < 0.5:
                    words = [w for w in words if draw.random() > 0.1] or words
                if others and draw.random() < 0.3:
                    stray = others[draw.integers(len(others))][:3]
                    words = stray + words if draw.random() < 0.5 else words + stray
                texts.append(words)
                classes.append(c)
    every = sorted({w for words in texts for w in words})
    for _ in range(len(texts) // 4):  # licence words without licence wording
        texts.append([every[i] for i in draw.integers(0, len(every), int(draw.integers(2, 12)))])
        classes.append(0)
    for family, known in TEMPLATES.items():  # notices that name another licence than these
        for whole in map(words_of, known):
            for _ in range(VARIATIONS // 4):
                name = others[draw.integers(len(others))][:2] if others else []
                texts.append([x for w in whole for x in (name if w in OWN[family] else [w])])
                classes.append(0)
    return texts + others, np.array(classes + [0] * len(others))


class Classifier:
    """Sparse multinomial logistic regression over word n-grams."""

    def __init__(self, others: list[list[str]], steps: int = 300, rate: float = 2.0, decay: float = 1e-4, least: float = 0.05) -> None:
        texts, y = examples(others)
        df = Counter(g for words in texts for g in set(grams(words)))
        self.at = {g: i for i, g in enumerate(sorted(g for g in df if g in VOCABULARY or df[g] >= 5))}
        rows, cols = [], []
        for r, words in enumerate(texts):
            for g in set(grams(words)):
                if g in self.at:
                    rows.append(r)
                    cols.append(self.at[g])
        rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
        norm = 1 / np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(texts))))
        k = len(FAMILIES)
        weights, bias = np.zeros((len(self.at), k)), np.zeros(k)
        train = np.arange(len(texts)) % 5 != 0
        truth = np.eye(k)[y]
        share = (train / np.maximum(1, np.bincount(y[train], minlength=k))[y])[:, None]  # every class weighs the same
        share = share / share.sum()
        for _ in range(steps):
            p = self._soft(self._sums(weights, rows, cols, norm) + bias)
            d = (p - truth) * share
            slope = np.stack([np.bincount(cols, d[rows, c] * norm[rows], minlength=len(self.at)) for c in range(k)], 1)
            weights -= rate * 20 * (slope + decay * weights)
            bias -= rate * d.sum(0)
        weights[np.abs(weights) < least] = 0
        self.weights, self.bias = weights, bias
        self.marks = self.marking()
        # one temperature over the variations kept aside
        logits = (self._sums(weights, rows, cols, norm) + bias)[~train]
        loss = {t: -np.log(self._soft(logits / t)[np.arange(len(logits)), y[~train]] + 1e-12).mean() for t in np.geomspace(0.2, 5, 30)}
        self.temperature = float(min(loss, key=loss.get))

    @staticmethod
    def _sums(weights: np.ndarray, rows: np.ndarray, cols: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(rows, weights[cols, c], minlength=len(norm)) for c in range(weights.shape[1])], 1) * norm[:, None]

    @staticmethod
    def _soft(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def probabilities(self, words: list[str]) -> np.ndarray:
        at = [self.at[g] for g in set(grams(words)) if g in self.at]
        logits = self.bias + (self.weights[at].sum(0) / np.sqrt(len(at)) if at else 0)
        return self._soft(logits[None, :] / self.temperature)[0]

    def marking(self) -> set[str]:
        """N-grams of licence wording that speak for some family: of two words or more, or a name with a digit, a dot or a hyphen.

        Variations hold stray words too, so n-grams that no template has mark nothing.
        """
        ahead = self.weights[:, 1:].max(1) > np.maximum(self.weights[:, 0], 0)
        return {g for g, i in self.at.items() if ahead[i] and g in VOCABULARY and (" " in g or re.search(r"[0-9.-]", g))}

    def units(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of a paragraph to be judged, none if no n-gram of it speaks for a family."""
        marks, n = self.marks, len(words)
        covered: list[tuple[int, int]] = []
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        for i, word in enumerate(words):
            if i < n - 1 and pairs[i] in marks:
                covered.append((i, i + 2))
            elif word in marks:
                covered.append((i, i + 1))
        if not covered:
            return []
        spans = [list(covered[0])]
        for a, b in covered[1:]:
            if a - spans[-1][1] <= GAP:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        # a notice may start a word before its first mark
        found = {(max(a - 1, 0), b) for a, b in spans} | {(a, b) for a, b in spans} | {(spans[0][0], spans[-1][1])}
        for size in (WINDOW // 2, WINDOW):
            found |= {(a, min(a + size, n)) for a, _ in covered} | {(max(b - size, 0), b) for _, b in covered}
        if n <= LONGEST:
            found.add((0, n))
        # two words are no notice, unless one of them is a licence's name
        return sorted((a, b) for a, b in found if b - a > 2 or any(w in marks for w in words[a:b]))

    def scan(self, text: str) -> list[tuple[int, str, float, float, bool]]:
        """(paragraph, family, probability, similarity, confirmed) of every paragraph that is predicted to name a licence, once for each family."""
        found = []
        for i, paragraph in enumerate(text.split("\n")):
            words = words_of(paragraph)
            said = []
            for a, b in self.units(words):
                p = self.probabilities(words[a:b])
                c = int(p.argmax())
                if c and p[c] >= THRESHOLD:
                    same, own = confirmation(words[a:b], FAMILIES[c])
                    if own and same >= CONFIRM or p[c] >= ALONE:
                        said.append((own and same >= CONFIRM, float(p[c]), same, FAMILIES[c], a, b))
            best: dict[str, tuple[bool, float, float]] = {}
            taken: list[tuple] = []
            for one in sorted(said, key=lambda x: (not x[0], -x[1], x[4], x[5])):
                sure, p, same, family, a, b = one
                # of two readings of much the same words, the more probable counts
                if not any(f != family and 2 * (min(b, d) - max(a, c)) > max(b - a, d - c) for *_, f, c, d in taken):
                    taken.append(one)
                    best[family] = max(best.get(family, (False, 0.0, 0.0)), (sure, same, p))
            found += [(i, f, best[f][2], best[f][1], best[f][0]) for f in TEMPLATES if f in best]
        return found


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Classifier:
    """The classifier, with paragraphs of a bounded sample of documents as its unknown class.

    Any line of them may be drawn, whole up to the length at which ``candidates`` judges it whole, longer ones in pieces of that length.
    """
    chosen = docs.select(F.col(key).alias("k"), F.xxhash64(key).alias("h")).orderBy("h", "k").limit(SAMPLE).select("k").distinct()
    texts = docs.join(F.broadcast(chosen), docs[key] == F.col("k")).select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line")).distinct()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = (words_of(value.as_py()) for value in batch.column(0))
            parts = (words[i:i + LONGEST] for words in lines for i in range(0, len(words), LONGEST))
            other = [" ".join(w) for w in parts if max(similarity(w, f) for f in TEMPLATES) < 0.3 and not any(candidates(w))]
            yield pa.RecordBatch.from_arrays([pa.array(other, pa.string())], ["words"])

    drawn = texts.mapInArrow(pieces, "words string").distinct().orderBy(F.xxhash64("words"), "words").limit(OTHERS)
    return Classifier([r.words.split(" ") for r in drawn.collect()])


def scan_documents(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_paragraphs, licences): licences hold paragraph, family, probability, similarity, and whether a template confirms them."""
    shared = shipped(docs.sparkSession, model)
    licence = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        for batch in batches:
            lines, found = [], []
            for value in batch.column(1):
                body = value.as_py() or ""
                lines.append(body.count("\n") + 1)
                found.append([dict(zip(("paragraph", "family", "probability", "similarity", "confirmed"), x)) for x in model.scan(body)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), pa.array(found, pa.list_(licence))], ["doc_id", "n_paragraphs", "licences"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(
        scanned, f"doc_id {kind}, n_paragraphs long, licences array<struct<paragraph int, family string, probability double, similarity double, confirmed boolean>>")
