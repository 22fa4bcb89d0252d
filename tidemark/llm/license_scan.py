"""License scans: a trained paragraph classifier, with an unknown class and a comparison with templates.

Looked at are lines, long ones in overlapping pieces, and the joined words of paragraphs (consecutive lines
with words) in overlapping windows, as licence texts are wrapped at any column. Sparse logistic regression over
hashed word n-grams says how likely a piece or window is to be of each licence family, or to be a notice of
another kind, the unknown class: terms of use, proprietary notices, near misses. Probabilities are calibrated on
examples that were not trained on. A prediction counts only if a template of the family confirms it: a piece of a
line must hold most of its words in order, a window must hold them close together, names included. What is
predicted and not confirmed, or more likely a notice of another kind, is unknown.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, mix64, small_batches, texts
from tidemark.llm.linear import Ftrl, train_classes

# Wordings that licence notices use, by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "licensed under the GNU Lesser General Public License",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": ("licensed under the GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 Universal."),
    "All-Rights-Reserved": ("All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the copyright holder."),
}
# Notices that are no licence of these families, examples of the unknown class.
OTHER_NOTICES = (
    "By accessing or using this website you agree to be bound by these terms of use and all applicable laws and regulations.",
    "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    "You may not modify, distribute, sell or lease any part of our services or included software without our written consent.",
    "We grant you a limited, non-exclusive, non-transferable, revocable license to use the application for personal purposes.",
    "Your use of this product is governed by the end user license agreement that accompanies it.",
    "This document is provided for information only and may be changed without notice.",
    "Licensed under the terms of the agreement between the customer and the vendor.",
    "Released under the terms agreed with the publisher.",
    "Permission is granted to print one copy of this article for private study only.",
    "The trademarks and logos shown here are the property of their owners and may not be used without permission.",
    "You are not allowed to redistribute the data or to use it in commercial products without a separate license.",
    "Subject to the license terms of the manufacturer, the firmware may be installed on one device.",
    "The content is licensed to subscribers only and may not be passed on.",
    "This work is protected by copyright law and international treaties.",
)
BITS = 16
# A line longer than PIECE words is looked at in pieces that begin every STEP words.
PIECE, STEP = 40, 20
# Corpus pieces taken as examples of no licence, at most; the hash of the id picks their documents.
NEGATIVES = 3_000
# A family or the unknown class is predicted from this probability on; the templates confirm what is a family's.
THRESHOLD = 0.3
# Share of a template's words that a piece must hold, in order, to confirm a prediction.
CONFIRM = 0.8
# Examples made of each template and notice.
VARIATIONS = 40
# Words that tell licences apart: a piece of a line must have those of the template, a match in a window the same ones.
NAMES = frozenset(b"apache mit bsd gnu gpl lesser lgpl library affero agpl mozilla mpl cc cc0 nc nd sa noncommercial noderivatives sharealike".split())
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def pieces(text: bytes) -> list[tuple[int, list[bytes]]]:
    """(line, words) of every piece of a text; lines without words have none."""
    out = []
    for number, line in enumerate(text.split(b"\n")):
        words = _words(line)
        for start in range(0, max(1, len(words) - PIECE + STEP), STEP):
            if part := words[start : start + PIECE]:
                out.append((number, part))
    return out


def windows(text: bytes) -> list[tuple[list[int], list[bytes]]]:
    """(line of each word, words) of the overlapping pieces of paragraphs that hold words of several lines."""
    out, numbers, words = [], [], []
    for number, line in enumerate([*text.split(b"\n"), b""]):
        if own := _words(line):
            numbers += [number] * len(own)
            words += own
            continue
        if words and numbers[0] != numbers[-1]:
            for start in range(0, max(1, len(words) - PIECE + STEP), STEP):
                of = numbers[start : start + PIECE]
                if of[0] != of[-1]:
                    out.append((of, words[start : start + PIECE]))
        numbers, words = [], []
    return out


def _features(parts: list[list[bytes]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, index, value) of single words and pairs of words of many pieces at once."""
    flat = hashes.of([w for p in parts for w in p])
    piece = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    same = piece[1:] == piece[:-1]
    pairs = mix64(flat[:-1] * np.uint64(3) + flat[1:])[same]
    piece = np.concatenate([piece, piece[1:][same]])
    index = (np.concatenate([mix64(flat), pairs]) >> np.uint64(64 - BITS)).astype(np.int64)
    return piece, index, 1 / np.sqrt(np.bincount(piece, minlength=len(parts)))[piece]


@dataclass
class Model:
    """A weight for each feature and class, the slopes and offsets of the calibration, templates.

    Classes are the families and, as the last one, the unknown notices.
    """

    families: list[str]
    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray
    templates: list[list[list[bytes]]]

    def probabilities(self, parts: list[list[bytes]], hashes: WordHashes) -> np.ndarray:
        piece, index, value = _features(parts, hashes)
        margin = np.zeros((len(parts), self.weights.shape[1]))
        order = np.argsort(piece, kind="stable")
        if len(order):
            starts = np.searchsorted(piece[order], np.arange(len(parts)))
            margin = np.add.reduceat(self.weights[index[order]] * value[order, None], starts, axis=0)
        margin = self.slope * (margin + self.weights[-1]) + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))

    def confirmed(self, family: int, part: list[bytes]) -> bool:
        """Whether the piece holds most of one of the family's templates, in order, and its names."""
        held = set(part)
        return any(NAMES.intersection(t) <= held and _common(t, part) >= CONFIRM * len(t) for t in self.templates[family])

    def place(self, family: int, part: list[bytes]) -> tuple[int, int] | None:
        """Where the window holds most of one of the family's templates close together: its best match."""
        best, held = (0, 0, 0), set(part)
        for t in self.templates[family]:
            if sum(w in held for w in t) >= CONFIRM * len(t):
                found, first, last = _closest(t, part)
                if found >= CONFIRM * len(t) and NAMES.intersection(part[first:last]) == NAMES.intersection(t):
                    best = max(best, (found, first - last, first))
        return (best[2], best[2] - best[1]) if best[0] else None


def _closest(a: list[bytes], b: list[bytes]) -> tuple[int, int, int]:
    """(length, start, end) of the longest common subsequence that spans little more than `a` in `b`,
    the shortest of equal ones."""
    limit, best = int(len(a) / CONFIRM) + 2, (0, 0, 0)
    for end in range(1, len(b) + 1):
        if b[end - 1] not in a:
            continue
        low = max(0, end - limit)
        # (length, first word) of the prefixes of `a`; a later first word is the closer match.
        row = [(0, 0)] * (len(a) + 1)
        for at in range(low, end):
            last = row[0]
            for k, x in enumerate(a, 1):
                here = row[k]
                if x == b[at]:
                    row[k] = max(here, row[k - 1], (last[0] + 1, last[1] if last[0] else at))
                else:
                    row[k] = max(here, row[k - 1])
                last = here
        found, first = row[-1]
        best = max(best, (found, first - end, first))
    return best[0], best[2], best[2] - best[1]


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence; both are pieces, so short."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def _template(text: str) -> list[bytes]:
    words = _words(text.encode())
    if len(words) > PIECE:
        raise ValueError(f"a template of more than {PIECE} words fits no piece; give its parts: {text}")
    return words


def _varied(words: list[bytes], negatives: list[list[bytes]], rng: random.Random) -> list[bytes]:
    """The words with a few lost, alone or with others before and after them, as far as a piece has room."""
    kept = [w for w in words if rng.random() > 0.05] or words
    around = rng.choice(negatives) if negatives and rng.random() < 0.75 else []
    room = rng.randrange(PIECE - len(kept) + 1) if around and len(kept) < PIECE else 0
    cut = rng.randrange(len(around) + 1) if around else 0
    before = around[max(0, cut - room // 2) : cut]
    return before + kept + around[cut : cut + room - len(before)]


def fit(negatives: list[list[bytes]], settings: Ftrl = Ftrl(bits=BITS, updates=24_000), seed: int = 7) -> Model:
    """Trains all classes at once on varied templates and notices against pieces that hold none; one example
    in four calibrates."""
    rng, hashes = random.Random(seed), WordHashes()
    families = list(TEMPLATES)
    templates = [[_template(t) for t in TEMPLATES[f]] for f in families]
    examples = [(part, None) for part in negatives]
    for k, group in enumerate([*templates, [_template(t) for t in OTHER_NOTICES]]):
        examples += [(_varied(words, negatives, rng), k) for words in group for _ in range(VARIATIONS)]
    rng.shuffle(examples)
    piece, index, value = _features([p for p, _ in examples], hashes)
    order = np.lexsort((index, piece))
    bounds = np.searchsorted(piece[order], np.arange(len(examples) + 1))
    rows = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own, inverse = np.unique(index[order[a:b]], return_inverse=True)
        rows.append((np.append(own, 1 << BITS), np.append(np.bincount(inverse, weights=value[order[a:b]], minlength=len(own)), 1.0)))
    classes = len(families) + 1
    labels = np.array([[float(k == c) for c in range(classes)] for _, k in examples])
    learned = np.arange(len(examples)) % 4 != 0
    weights = train_classes([r for r, used in zip(rows, learned, strict=True) if used], labels[learned], settings)
    margins = np.array([r[1] @ weights[r[0]] for r, used in zip(rows, learned, strict=True) if not used])
    fits = [_calibrate(margins[:, c], labels[~learned][:, c]) for c in range(classes)]
    return Model(families, weights.astype(np.float32), np.array([a for a, _ in fits]), np.array([b for _, b in fits]), templates)


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset by Newton's method, with a small pull to the uncalibrated margin."""
    a, b = 1.0, 0.0
    for _ in range(50 if len(margin) else 0):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - label) * margin).sum() + (a - 1), (p - label).sum() + b])
        h = np.array([[(w * margin * margin).sum() + 1, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def negative_pieces(docs: DataFrame, doc_id="doc_id", text="text", limit: int = NEGATIVES) -> list[list[bytes]]:
    """Pieces of the corpus that hold no template, one for each of at most `limit` documents.

    A piece has at most `PIECE` words, and a word at most 64 bytes here, so what the driver gets is
    bounded. Which piece of its text stands for a document is decided by the hash of its id.
    """
    known = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    ranked = known.select(F.xxhash64(doc_id).alias("rank"), F.col(text).alias("text"))
    smallest = ranked.select("rank").orderBy("rank").limit(limit).agg(F.max("rank")).first()[0]
    if smallest is None:
        return []

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rank, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                parts = pieces(text)
                out.append(b" ".join(w[:64] for w in parts[rank % len(parts)][1]) if parts else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["rank", "piece"])

    small_batches(docs)
    found = ranked.where(F.col("rank") <= smallest).mapInArrow(pick, "rank long, piece binary").where("piece IS NOT NULL")
    rows = [bytes(r["piece"]).split() for r in found.orderBy("rank", "piece").limit(limit).collect()]
    templates = [_template(t) for group in TEMPLATES.values() for t in group]
    return [r for r in rows if not any(_common(t, r) >= 0.5 * len(t) for t in templates)]


def _found(model: Model, text: bytes, hashes: WordHashes, threshold: float) -> tuple[int, int, set[str], set[int]]:
    """Units looked at, unknown ones, families found, and their lines."""
    parts, joined = pieces(text), windows(text)
    found, places, unknown = set(), set(), 0
    units = [words for _, words in parts] + [words for _, words in joined]
    if not units:
        return 0, 0, found, places
    chances = model.probabilities(units, hashes)
    for k in np.flatnonzero((chances >= threshold).any(axis=1)).tolist():
        confirmed = False
        # The last class is of other notices and has no templates.
        for f in np.flatnonzero(chances[k, :-1] >= threshold).tolist():
            if k < len(parts):
                lines = [parts[k][0]] if model.confirmed(f, units[k]) else []
            else:
                numbers, place = joined[k - len(parts)][0], model.place(f, units[k])
                lines = numbers[slice(*place)] if place else []
            if lines:
                confirmed = True
                found.add(model.families[f])
                places.update(lines)
        unknown += not confirmed
    return len(units), unknown, found, places


def scan_licenses(docs: DataFrame, doc_id="doc_id", text="text", model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, n_pieces, n_unknown, licenses, lines` of every row.

    `licenses` are the families found, sorted, and `lines` the numbers of the lines that name one, all
    those of a wrapped wording; `n_pieces` counts pieces of lines and windows of paragraphs, `n_unknown`
    those that look like a notice, of a family or another, and are confirmed as none. Null and empty texts
    have no pieces. Rows that repeat, and null ids, get results like any other row; a very long text is
    looked at whole, by one task. No rows, no result.
    """
    if model is None:
        model = fit(negative_pieces(docs, doc_id, text))
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, model = WordHashes(), sent.value
        for batch in batches:
            rows = [_found(model, t, hashes, threshold) for t in texts(batch.column(1))]
            columns = [[r[0] for r in rows], [r[1] for r in rows], [sorted(r[2]) for r in rows], [sorted(r[3]) for r in rows]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_pieces", "n_unknown", "licenses", "lines"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, n_pieces long, n_unknown long, licenses array<string>, lines array<int>")
