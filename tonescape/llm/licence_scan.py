"""Licence notices in texts: a trained classifier of paragraphs, confirmed by templates.

A paragraph's word n-grams (one to three words) go through a multinomial logistic
regression over licence families and an unknown class. Its probabilities are calibrated
with a temperature, and a prediction stands only if a published notice of that family
shares enough word pairs with the paragraph. A paragraph is a line.

The model is small and trained in numpy from the notices below, cut, joined and disturbed.
Scanning is SQL throughout: n-grams are rows that meet the weights in a broadcast join
(the weights are bounded by the notices' n-grams). No list of words decides what is judged:
lines are left out only where the weights themselves prove that the answer is unknown
(``needed_grams``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Published short notices and headings of licence families.
NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE in the project root for license information.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language governing permissions",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU GPL v3.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Text is available under the Creative Commons Attribution-ShareAlike License, CC BY-SA 4.0.",
    ),
    "public-domain": (
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain.",
        "Licensed under CC0 1.0 Universal, public domain dedication.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this publication may be reproduced without permission.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
# Sentences with the cues of a notice that are none.
OTHERS = (
    "You need a driving license to rent a car in this country.",
    "The license plate of the car was found under the bridge.",
    "She holds a license to practice medicine and works in the city.",
    "Permission to enter the building was granted by the guard.",
    "The copyright debate in parliament went on for years.",
    "The warranty covers parts and labour for two years.",
    "Please contact us for license fees and the terms of the offer.",
    "They apply for a fishing licence, version or date are not needed.",
    "He worked at a public school under the general of the army.",
    "The apache helicopter landed on the field at noon.",
    "This software is licensed under its own terms, see the web page.",
    "The permission of the author and the public is asked for.",
)

_WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
_PY_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


@dataclass(frozen=True)
class LicenceOptions:
    """A family is predicted from probability ``least`` on, and confirmed from a share
    ``overlap`` of word pairs in common with one of its notices."""

    least: float = 0.5
    overlap: float = 0.5
    variants: int = 24
    steps: int = 150
    decay: float = 1e-4
    seed: int = 5


@dataclass(frozen=True)
class LicenceModel:
    families: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    temperature: float
    options: LicenceOptions


# --- Training -----------------------------------------------------------------------------


def grams(text: str) -> list[str]:
    """Distinct runs of one to three words."""
    words = _PY_WORD.findall(text.lower())
    return sorted({" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)})


def _examples(o: LicenceOptions, rng: np.random.Generator) -> list[tuple[str, str]]:
    """Notices cut short, joined with other words or copyright lines; and what is none."""
    every = [w for texts in NOTICES.values() for t in texts for w in t.split()]
    others = [w for t in OTHERS for w in t.split()]
    found = []

    def some(words: list[str], least: int, most: int) -> list[str]:
        return [str(w) for w in rng.choice(words, int(rng.integers(least, most)))]

    for family, texts in NOTICES.items():
        for text in texts:
            found += [(text, family)] * 3
            for _ in range(o.variants):
                words = text.split()
                if len(words) > 8:
                    size = int(rng.integers(8, len(words) + 1))
                    start = int(rng.integers(0, len(words) - size + 1))
                    words = words[start : start + size]
                if rng.random() < 0.5:
                    words = some(others, 1, 6) + words
                if rng.random() < 0.5:
                    words = words + some(others, 1, 6)
                found.append((" ".join(words), family))
    for _ in range(12 * o.variants):
        found.append((" ".join(some(every, 3, 20)), UNKNOWN))  # their words, out of order
        found.append((" ".join(some(others, 3, 20)), UNKNOWN))
    return found + [(t, UNKNOWN) for t in OTHERS for _ in range(o.variants)]


def train(o: LicenceOptions = LicenceOptions()) -> LicenceModel:
    """The regression by gradient descent with momentum; the same every time."""
    rng = np.random.default_rng(o.seed)
    data = _examples(o, rng)
    families = (*NOTICES, UNKNOWN)
    names = sorted({g for text, _ in data[:] for g in grams(text) if _in_notices(g)})
    column = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(data), len(names)), np.float32)
    y = np.zeros((len(data), len(families)), np.float32)
    for i, (text, family) in enumerate(data):
        own = grams(text)
        for g in own:
            if g in column:
                x[i, column[g]] = 1 / np.sqrt(len(own))
        y[i, families.index(family)] = 1
    keep = rng.random(len(data)) < 0.8
    w, b = np.zeros((len(names), len(families)), np.float32), np.zeros(len(families), np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(o.steps):
        d = (_softmax(x[keep] @ w + b) - y[keep]) / keep.sum()
        vw = 0.9 * vw - 8.0 * (x[keep].T @ d + o.decay * w)
        vb = 0.9 * vb - 1.0 * d.sum(0)
        w, b = w + vw, b + vb
    held = x[~keep] @ w + b
    loss = {t: -np.log(_softmax(held / t)[y[~keep] == 1] + 1e-9).mean() for t in np.arange(0.3, 3.01, 0.1)}
    weights = {g: tuple(round(float(v), 6) for v in w[i]) for g, i in column.items()}
    return LicenceModel(families, weights, tuple(round(float(v), 6) for v in b), round(float(min(loss, key=loss.get)), 2), o)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _in_notices(gram: str, known: set = set()) -> bool:
    if not known:
        known.update(g for texts in (*NOTICES.values(), OTHERS) for t in texts for g in grams(t))
    return gram in known


# --- What a prediction needs ------------------------------------------------------------------

# They only decide which of two n-grams is named first; any order gives a complete set.
_COMMON = frozenset(
    "the of is and under or a can are to this may in any that an not without with for by be have into all one it on "
    "from at as you your no was he she they its".split()
)


def needed_grams(model: LicenceModel) -> list[str]:
    """N-grams of which every paragraph that the model gives a family has at least one.

    A family needs the logit of the unknown class at least. Of n-grams outside this list let
    a paragraph have ``a`` words and ``k`` longer ones. It has at least a distinct words, a - 1
    pairs and a - 2 triples, so max(a + k, 3 * a - 3) n-grams, and its lead over unknown is at
    most the sum of the a and the k largest leads of their weights, over the root of that, plus
    the biases' difference. N-grams are listed until that is below 0 for all a and k.
    """
    names = list(model.weights)
    weights, bias = np.array([model.weights[g] for g in names]), np.array(model.bias)
    lead, gap = weights[:, :-1] - weights[:, -1:], bias[-1] - bias[:-1] - 1e-3
    single = np.array([" " not in g for g in names])
    common = np.array([all(w in _COMMON for w in g.split()) for g in names])
    liking = np.where(common, np.where(single, 0.05, 0.5), 1.0)
    listed = np.zeros(len(names), bool)

    def most(family: int) -> float:
        own = np.where(listed, 0, np.maximum(lead[:, family], 0))
        words, longer = (np.append(0, np.cumsum(x[x > 0])) for x in (-np.sort(-own[single]), -np.sort(-own[~single])))
        a, k = np.ogrid[: len(words), : len(longer)]
        return float(((words[a] + longer[k]) / np.sqrt(np.maximum(1, np.maximum(a + k, 3 * a - 3)))).max())

    for family in range(lead.shape[1]):
        while most(family) >= gap[family]:
            if listed[lead[:, family] > 0].all():
                raise ValueError("the biases alone give a family")
            listed[int(np.argmax(np.where(listed, -1, np.maximum(lead[:, family], 0) * liking)))] = True
    return [g for g, own in zip(names, listed) if own]


def pattern_of(phrases: list[str]) -> str:
    """A pattern that every lower-cased line with one of the phrases as its words matches.

    Others may match too: only ASCII letters and digits count as parts of a word.
    """
    tree: dict = {}
    for phrase in phrases:
        node = tree
        for char in phrase:
            node = node.setdefault(char, {})
        node[""] = {}

    def branch(node: dict) -> str:
        pieces = [
            "(?![a-z0-9])" if c == "" else ("[^a-z0-9]+" if c == " " else re.escape(c)) + branch(node[c]) for c in sorted(node)
        ]
        return pieces[0] if len(pieces) == 1 else f"(?:{'|'.join(pieces)})"

    return "(?<![a-z0-9])" + branch(tree)


# --- Scan -----------------------------------------------------------------------------------


def _runs(words: Column, n: int) -> Column:
    """Runs of n words, joined by blanks."""
    count = F.size(words) - (n - 1)
    return F.when(
        count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(n))))
    ).otherwise(F.array().cast("array<string>"))


def paragraphs(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """doc, text_hash, place, n (n-grams), n_pairs and the model's n-grams ``known`` of the
    paragraphs (lines) that can have a family.

    All others are unknown to the model (``needed_grams``). Rows that repeat give one line each.
    """
    possible = pattern_of(needed_grams(model))
    key = ["doc", "text_hash", "place"]
    lines = docs.select("doc", "text_hash", F.posexplode(F.split(F.lower("text"), "\n")).alias("place", "line"))
    word = F.col("words")
    words = lines.where(F.col("line").rlike(possible)).dropDuplicates(key).select(
        *key, F.regexp_extract_all("line", F.lit(_WORD), F.lit(0)).alias("words")
    )
    parts = words.select(
        *key, F.array_distinct(word).alias("ones"), F.array_distinct(_runs(word, 2)).alias("pairs"),
        F.array_distinct(_runs(word, 3)).alias("triples"),
    )
    grams, names = F.concat("ones", "pairs", "triples"), F.array(*(F.lit(g) for g in model.weights))
    return parts.select(*key, F.size(grams).alias("n"), F.size("pairs").alias("n_pairs"), F.array_intersect(grams, names).alias("known"))


def classify(lines: DataFrame, model: LicenceModel) -> DataFrame:
    """doc, text_hash, place, family, probability, confirmed for each of ``paragraphs``.

    Those without any of the model's n-grams are unknown, and left out.
    """
    spark: SparkSession = lines.sparkSession
    key = ["doc", "text_hash", "place"]
    own = [*key, "n", "n_pairs", "known"]
    weights = F.broadcast(spark.createDataFrame([(g, list(w)) for g, w in model.weights.items()], "gram string, w array<double>"))
    # The outer form, because for the inner one Spark would make all n-grams once more to see
    # whether a line has any.
    rows = lines.select(*own, F.explode_outer("known").alias("gram"))
    sums = [F.sum(F.round(F.col("w")[k] * 1_000_000).cast("long")).alias(f"s{k}") for k in range(len(model.families))]
    scored = rows.join(weights, "gram").groupBy(*own).agg(*sums)
    logits = [
        ((F.col(f"s{k}") / 1_000_000 / F.sqrt("n") + F.lit(b)) / model.temperature) for k, b in enumerate(model.bias)
    ]
    scored = scored.select(*own, F.array(*logits).alias("z"))
    top = F.array_max("z")
    total = F.aggregate("z", F.lit(0.0), lambda s, z: s + F.exp(z - top))
    place = F.array_position("z", top).cast("int")
    names = F.array(*(F.lit(f) for f in model.families))
    scored = scored.select(*own, F.element_at(names, place).alias("best"), (1 / total).alias("probability"))
    taken = (F.col("best") != UNKNOWN) & (F.col("probability") >= model.options.least)
    scored = scored.withColumn("family", F.when(taken, F.col("best")).otherwise(UNKNOWN))
    # what the family's notices share with the paragraph
    notices = [
        (f, f"{f} {i}", g, sum(h.count(" ") == 1 for h in grams(t)))
        for f, texts in NOTICES.items()
        for i, t in enumerate(texts)
        for g in grams(t)
        if g.count(" ") == 1
    ]
    notices = F.broadcast(spark.createDataFrame(notices, "family string, notice string, gram string, size int"))
    found = [*key, "family", "probability"]
    shared = scored.select(*found, "n_pairs", F.explode_outer(F.when(F.col("family") != UNKNOWN, F.col("known"))).alias("gram"))
    shared = shared.join(notices, ["family", "gram"], "left").groupBy(*found, "notice")
    least = F.least(F.max("n_pairs"), F.max("size"))
    shared = shared.agg(F.when(F.col("notice").isNotNull(), F.count("size") / least).alias("share"))
    return shared.groupBy(*found).agg(F.max("share").alias("share")).select(
        *key,
        "family",
        F.round("probability", 4).alias("probability"),
        (F.coalesce("share", F.lit(0.0)) >= model.options.overlap).alias("confirmed"),
    )


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """doc_id, licences (confirmed families, sorted), n_notices, n_unconfirmed of every row.

    n_notices: confirmed paragraphs; n_unconfirmed: paragraphs that the model gives a family
    and no notice of it confirms. Every paragraph counts; no list of words comes first.
    Null and empty texts have none. Null doc_ids are kept. Repeated rows are scanned each;
    of families with the same probability the first in the model's order is taken. An empty
    table gives no rows. Other columns are not read. Texts are read twice and never
    shuffled; only paragraphs with an n-gram that a family needs go on.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    judged = classify(paragraphs(rows, model), model).where(F.col("family") != UNKNOWN).groupBy("doc", "text_hash").agg(
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("licences"),
        F.sum(F.col("confirmed").cast("long")).alias("n_notices"),
        F.sum((~F.col("confirmed")).cast("long")).alias("n_unconfirmed"),
    )
    joined = rows.select("doc_id", "doc", "text_hash").join(judged, ["doc", "text_hash"], "left")
    return joined.select(
        "doc_id",
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"),
        F.coalesce("n_unconfirmed", F.lit(0).cast("long")).alias("n_unconfirmed"),
    )
