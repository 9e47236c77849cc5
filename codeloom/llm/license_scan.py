"""Licence families of paragraphs: a trained classifier, confirmed by comparison with templates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.words import byte_view, gram_hashes, mix, pieces, text_bytes, word_hashes, word_places

# Usual wordings of licence notices, by family.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License. See LICENSE in the project root for license information.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "GPL": ("This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL version 2 or later.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "LGPL": ("Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
             "as published by the Free Software Foundation."),
    "AGPL": ("Licensed under the GNU Affero General Public License, version 3.",
             "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    "BSD": ("Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met:"),
    "MPL-2.0": ("Licensed under the Mozilla Public License, version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": ("Dedicated to the public domain under CC0 1.0.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "ISC": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
}
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
BITS = 13
SAMPLE_TEXTS = 2000
SAMPLE_LINES = 4
SAMPLE_CHARS = 2000
VARIANTS = 40
CONFIRM = 0.6
SEED = 7

LETTERS = bytes(c if chr(c).isalnum() or c >= 128 or c == 10 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """Only letters, digits, other scripts and line breaks; the rest becomes space."""
    return text.translate(LETTERS)


def features(paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each paragraph's words and word pairs, its number of them, and where each paragraph starts."""
    data, rows = byte_view(pa.array(paragraphs, pa.large_binary()))
    starts, ends, first = word_places(data, rows)
    words = word_hashes(data, starts, ends, fold=True)
    owner = np.repeat(np.arange(len(paragraphs)), np.diff(first))
    pairs = gram_hashes(words, 2)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    grams = np.concatenate([mix(words), pairs[inside]])
    who = np.concatenate([owner, owner[1:][inside]])
    order = np.argsort(who, kind="stable")
    count = np.bincount(who, minlength=len(paragraphs))
    return grams[order], count, np.cumsum(count) - count


def places(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def variants(seed: int) -> tuple[list[bytes], list[int]]:
    """Each template with words left out at its ends and inside, or within other words, by a seeded rule."""
    draw, texts, labels = np.random.default_rng(seed), [], []
    for label, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            words = plain(template.encode()).split()
            texts.append(b" ".join(words)), labels.append(label)
            for _ in range(VARIANTS):
                keep = draw.random(len(words)) > (0.08 if len(words) > 8 else 0.02)
                own = [w for w, k in zip(words, keep) if k]
                noise = [bytes(draw.integers(97, 123, draw.integers(2, 9)).astype(np.uint8)) for _ in range(draw.integers(0, 5))]
                at = int(draw.integers(0, len(noise) + 1))
                texts.append(b" ".join([*noise[:at], *own, *noise[at:]])), labels.append(label)
    return texts, labels


@dataclass
class Classifier:
    weights: np.ndarray    # features x families
    intercept: np.ndarray
    temperature: float
    least: float           # the probability below which a paragraph is unknown
    templates: list[tuple[int, np.ndarray]]

    def logits(self, paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        grams, count, start = features(paragraphs)
        out = np.zeros((len(paragraphs), len(FAMILIES)))
        filled = np.flatnonzero(count)
        if len(filled):
            out[filled] = np.add.reduceat(self.weights[places(grams)], start[filled], axis=0)
        out = out / np.sqrt(np.maximum(count, 1))[:, None] + self.intercept
        return out, grams, count, start

    def predict(self, paragraphs: list[bytes]) -> Iterator[tuple[int, int, float, float]]:
        """(paragraph, family, probability, best share of pairs in common with a template) of those that are not unknown."""
        out, grams, count, start = self.logits(paragraphs)
        chance = np.exp((out - out.max(axis=1, keepdims=True)) / self.temperature)
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        for i in np.flatnonzero((best > 0) & (chance.max(axis=1) >= self.least) & (count > 0)):
            own = np.unique(grams[start[i]:start[i] + count[i]])
            share = max(len(np.intersect1d(own, t, assume_unique=True)) / min(len(own), len(t)) if min(len(own), len(t)) >= 5 else 0.0
                        for f, t in self.templates if f == best[i])
            yield int(i), int(best[i]), float(chance[i, best[i]]), share


def template_grams() -> list[tuple[int, np.ndarray]]:
    found = []
    for label, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            found.append((label, np.unique(features([plain(template.encode())])[0])))
    return found


def sampled_lines(docs: DataFrame, texts: int, lines: int, chars: int = SAMPLE_CHARS) -> list[bytes]:
    """At most ``texts`` texts chosen by a hash of their id, and ``lines`` of each by a hash of the line, up to ``chars`` characters of a line.

    Only ids whose hash is below a bound set by the number of rows are sorted, about four times as many as are wanted, and only
    chosen lines leave their task, so what reaches the driver does not grow with the corpus.
    """
    share = min(1.0, 4 * texts / max(1, docs.count()))
    draw = F.xxhash64("doc_id")
    rows = docs.filter(draw <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1)).select(
        draw.alias("draw"), "doc_id", F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: x != "").alias("lines"))
    by_hash = F.array_sort(F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x"))))
    cut = rows.select("draw", "doc_id", F.transform(F.slice(by_hash, 1, lines), lambda s: F.substring(s["x"], 1, chars)).alias("l"))
    return [x.encode() for row in cut.orderBy("draw", "doc_id", "l").limit(texts).select("l").collect() for x in row["l"]]


def fit(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_lines: int = SAMPLE_LINES,
        sample_chars: int = SAMPLE_CHARS) -> Classifier:
    """Fit on variants of the templates and on a bounded sample of the corpus's lines, which stand for "unknown".

    At most ``sample_texts`` x ``sample_lines`` lines are used, and of a longer line its first ``sample_chars`` characters, so that
    what reaches the driver has a bound; scoring takes whole lines. Sampled lines that share most pairs with a template are left
    out. Half of the data fits the model; on the other half a temperature is fitted and the least probability is the one that at
    most one in 500 unknown lines reaches.
    """
    spark: SparkSession = docs.sparkSession
    templates = template_grams()
    others = []
    for line in map(plain, sampled_lines(docs, sample_texts, sample_lines, sample_chars)):
        own = np.unique(features([line])[0])
        if all(len(np.intersect1d(own, t, assume_unique=True)) < CONFIRM / 2 * len(t) for _, t in templates):
            others.append(line)
    texts, labels = variants(SEED)
    texts, labels = [*others, *texts], np.array([*[0] * len(others), *labels])
    half = np.arange(len(texts)) % 2 == 0
    grams, count, start = features(texts)
    rows = []
    for i in np.flatnonzero(half & (count > 0)):
        at, n = np.unique(places(grams[start[i]:start[i] + count[i]]), return_counts=True)
        rows.append((float(labels[i]), Vectors.sparse(1 << BITS, at.tolist(), (n / np.sqrt(count[i])).tolist())))
    model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, standardization=False).fit(spark.createDataFrame(rows, ["label", "features"]))
    weights, intercept = np.zeros((1 << BITS, len(FAMILIES))), np.full(len(FAMILIES), -20.0)
    matrix = model.coefficientMatrix.toArray()
    weights[:, :len(matrix)], intercept[:len(matrix)] = matrix.T, model.interceptVector.toArray()
    fitted = Classifier(weights.astype(np.float32), intercept, 1.0, 0.5, templates)

    rest = [t for t, h in zip(texts, half) if not h]
    truth = labels[~half]
    out = fitted.logits(rest)[0]

    def log_chance(t: float) -> np.ndarray:
        scaled = (out - out.max(axis=1, keepdims=True)) / t
        return scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True))

    fitted.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: -log_chance(t)[np.arange(len(truth)), truth].mean())
    family = np.exp(log_chance(fitted.temperature))[truth == 0, 1:].max(axis=1, initial=0.0)
    fitted.least = float(max(0.5, np.quantile(family, 0.998))) if len(family) else 0.5
    return fitted


def scan_rows(shared):
    names = ["doc_id", "n_paragraphs", "found"]
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("likeness", pa.float64()),
                               ("confirmed", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Classifier = shared.value
        for batch in pieces(batches, "body", 256 * 1024):
            texts, owner, number, counts = [], [], [], []
            for i, body in enumerate(batch.column("body").to_pylist()):
                own = [x for x in plain(body).split(b"\n") if x.strip()]
                texts.extend(own)
                owner.extend([i] * len(own))
                number.extend(range(len(own)))
                counts.append(len(own))
            found: list[list[dict]] = [[] for _ in counts]
            for i, family, chance, share in model.predict(texts) if texts else ():
                found[owner[i]].append({"paragraph": number[i], "family": FAMILIES[family], "probability": chance, "likeness": share,
                                        "confirmed": share >= CONFIRM})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)], names)
    return run


def licences(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """One row a document: doc_id, n_paragraphs and ``found``, its paragraphs that the classifier gives a licence family.

    A paragraph is a line with a letter or digit. ``likeness`` is the share of words and word pairs that the smaller of the
    paragraph and the family's nearest template has in common with the other; from 0.6 on the family is confirmed. Null and empty
    texts have no paragraphs; null and repeated ids are kept; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    rows = docs.select("doc_id", text_bytes().alias("body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan_rows(shared), f"doc_id {kind}, n_paragraphs long, found array<struct<paragraph:int,family:string,"
                                              "probability:double,likeness:double,confirmed:boolean>>")
