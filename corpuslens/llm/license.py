"""Licence paragraphs by a trained sparse n-gram classifier and template comparison.

A multinomial logistic regression over the presence of word unigrams and bigrams
is trained on cuts of the licence templates below, against paragraphs that use
similar words for other things.  The ``unknown`` class is then calibrated on cuts
and paragraphs that training has not seen: a temperature and the class's logit
minimise their log loss.  A predicted family stands only where a template of
that family shares enough bigrams with the paragraph, its version numbers among
them, and where the paragraph doesn't deny the licence.  Paragraphs are single
lines, and stretches of several lines where a template's bigrams stand close
together: wrapped notices.

The model, a few thousand weights, is trained on the driver from the templates
alone.  Documents without any of a few words, one of which every confirmed notice
has, are left out at first.  The others are scored with DataFrame functions only:
n-grams are hashed, filtered by a bitmap of those that have a weight, met with
the weights in an equi-join, and summed by paragraph.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.decontaminate import _bitmap, bit_word
from corpuslens.llm.scratch import stored

UNKNOWN = "unknown"
# Notices of public licences, and look-alike paragraphs (fixed values).
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GPL, version 3.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GPL, version 2.",
    ],
    "gpl": ["Licensed under the GNU General Public License.", "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."],
    "lgpl-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "Licensed under the GNU Lesser General Public License, version 2.1."],
    "lgpl-3.0": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.", "Licensed under the GNU Lesser General Public License, version 3."],
    "agpl-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.", "Licensed under the GNU Affero General Public License as published by the Free Software Foundation."],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "bsd-2-clause": ["Released under the BSD 2-Clause License."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Released under the ISC License."],
    "apache-1.1": ["Licensed under the Apache Software License, Version 1.1."],
    "bsl-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "Licensed under the Eclipse Public License, version 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by-3.0": ["This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "Licensed under CC BY 3.0."],
    "cc-by-sa-3.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "Licensed under CC BY-SA 3.0."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "cc-by-sa-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "cc-by-nc-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "cc0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.", "All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
OTHERS = [
    "He lost his driving license after the accident and applied for a new one at the public office.",
    "The software was released in version 2 and is distributed to customers under contract.",
    "Parents must give written permission before pupils may use the library.",
    "General conditions of the public library apply to any copy you make at work.",
    "The foundation published a free program of source material for its work in general education.",
    "Any person can use the above list of files, the copy of the document, and the terms at the end.",
    "Commercial licence fees of creative companies in common markets increased to 4.0 million.",
    "The above notice was included in the following documentation; the following conditions are met without warranty claims.",
    "MIT researchers and the Mozilla team met at the Apache museum with the GNU herd.",
]
#: Paragraphs of the same kind that only the calibration sees (fixed values).
UNSEEN = [
    "Drivers whose license was revoked may apply for a copy under the general terms of the public office.",
    "The committee granted permission to distribute the final version of the document to any person in attendance.",
    "All rights of passage were reserved for members of the public who had made a reservation.",
    "A common source of conflict is the notice period in contracts made under the terms of the foundation.",
    "Software version 3 ships with a library of general purpose tools, free of charge, for creative work.",
    "The public license plate database is a domain of the state and not of the commons.",
    "Merge the files, publish the copy, and include the above list in the program notes.",
    "Without limitation of speech the author deals with material conditions of attribution in art.",
]
#: Words before and in what denies a licence (fixed values).
DENIALS = [(a, b) for a in ("not", "never", "neither", "nor", "t", "longer") for b in ("licensed", "released", "covered", "distributed", "available", "dedicated")]
STOP = frozenset("the of to in and a or is this that for on with by be as at an are you it its any all not from was were has have had he she they may can will if no".split())


def tokens(text: str) -> list[str]:
    """Lower-cased runs of ASCII letters and digits."""
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """Unigrams and bigrams with a word that isn't common."""
    return {g for g in [*((w,) for w in words), *zip(words, words[1:])] if not STOP.issuperset(g)}


def examples(others: list[str], seed: int, families: list[str]) -> list[tuple[set, int]]:
    """Grams and class of cuts of all notices, of ``others``, and of mixtures of their words; the last class is ``unknown``."""
    rng = random.Random(seed)
    rows: list[tuple[set, int]] = []
    everyday = [w for o in others for w in tokens(o)]
    for f, notices in TEMPLATES.items():
        for notice in notices:
            words = tokens(notice)
            rows += [(grams(words), families.index(f))] * 4
            for _ in range(12):  # with foreign words around, and with words lost
                kept = [w for w in words if rng.random() > 0.08]
                extra = rng.choices(everyday, k=rng.randrange(0, 12))
                rows.append((grams(extra[::2] + kept + extra[1::2]), families.index(f)))
    licensed = [w for n in TEMPLATES.values() for t in n for w in tokens(t)]
    for o in others:
        rows += [(grams(tokens(o)), len(families))] * 6
    for _ in range(300):  # single licence words in other text
        rows.append((grams(rng.choices(everyday, k=rng.randrange(3, 40)) + rng.sample(licensed, 2)), len(families)))
    return rows


@dataclass(frozen=True)
class Classifier:
    """Families, weights by n-gram, biases, and the calibration: logits are divided by ``temperature``, ``unknown`` has the logit ``unknown``."""

    families: list[str]
    weights: dict[tuple[str, ...], np.ndarray]
    bias: np.ndarray
    temperature: float = 1.0
    unknown: float = 0.0

    def probabilities(self, features: set) -> np.ndarray:
        """Of all families, and at last of ``unknown``."""
        z = self.bias + sum((self.weights[g] for g in features if g in self.weights), np.zeros(len(self.bias)))
        z = np.append(z / self.temperature, self.unknown)
        p = np.exp(z - z.max())
        return p / p.sum()


def log_loss(model: Classifier, rows: list[tuple[set, int]]) -> float:
    return -float(np.mean([np.log(max(model.probabilities(f)[label], 1e-300)) for f, label in rows]))


def calibrated(model: Classifier, rows: list[tuple[set, int]]) -> Classifier:
    """``model`` with the temperature and unknown logit of least log loss on ``rows``, by a grid that narrows three times."""
    plain = Classifier(model.families, model.weights, model.bias)
    z = np.log(np.array([plain.probabilities(f) for f, _ in rows]) + 1e-300)
    z = z[:, :-1] - z[:, -1:]
    y = np.array([label for _, label in rows])

    def loss(t: float, u: float) -> float:
        s = np.column_stack([z / t, np.full(len(z), u)])
        s -= s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y]))

    centre, width = (0.0, 0.0), (1.5, 4.0)
    for _ in range(4):
        grid = [(centre[0] + width[0] * a / 6, centre[1] + width[1] * b / 6) for a in range(-6, 7) for b in range(-6, 7)]
        centre = min(grid, key=lambda g: loss(float(np.exp(g[0])), g[1]))
        width = (width[0] / 4, width[1] / 4)
    return Classifier(model.families, model.weights, model.bias, float(np.exp(centre[0])), centre[1])


@lru_cache
def train(seed: int = 11) -> Classifier:
    """The regression over ``examples``, calibrated on others of its kind that it hasn't seen."""
    families = sorted(TEMPLATES)
    rows = examples(OTHERS, seed, families)
    known = sorted(set().union(*(r[0] for r in rows if r[1] < len(families))))
    at = {g: i for i, g in enumerate(known)}
    x = np.zeros((len(rows), len(known)))
    y = np.zeros((len(rows), len(families) + 1))
    for i, (features, label) in enumerate(rows):
        x[i, [at[g] for g in features if g in at]] = 1
        y[i, label] = 1
    w, b = np.zeros((len(known), len(families))), np.full(len(families), -2.0)
    for _ in range(300):  # proximal gradient: the L1 threshold keeps the weights sparse
        z = np.column_stack([x @ w + b, np.zeros(len(rows))])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - y)[:, :-1] / len(rows)
        w -= 6.0 * (x.T @ d)
        w = np.sign(w) * np.maximum(np.abs(w) - 6.0 * 2e-5, 0)
        b -= 1.0 * d.sum(axis=0)
    model = Classifier(families, {g: w[i] for g, i in at.items() if np.abs(w[i]).max() > 0.01}, b)
    return calibrated(model, examples(UNSEEN, seed + 1, families))


def _hashed(words: Column) -> Column:
    """Hashes of the distinct unigrams and bigrams of a word array."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    two = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.array_distinct(F.concat(one, two))


def _model_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, Classifier]:
    """Weights by n-gram hash, template bigrams by hash, and the model.  Both tables have a fixed size.

    Bigrams that end in a number tell versions apart, so a notice needs all of its own.
    """
    model = train()
    k = len(model.families)
    rows = [(g[0], g[1] if len(g) > 1 else None, [float(v) / model.temperature for v in w]) for g, w in model.weights.items()]
    raw = spark.createDataFrame(rows, "a string, b string, w array<double>")
    gram = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    table = raw.select(gram.alias("gram"), *[F.get("w", i).alias(f"w{i}") for i in range(k)])
    shapes = []
    for f, notices in TEMPLATES.items():
        for n, notice in enumerate(notices):
            words = tokens(notice)
            pairs = set(zip(words, words[1:]))
            shapes += [(f, n, len(pairs), sum(b.isdigit() for _, b in pairs), 2 * len(words), a, b, b.isdigit()) for a, b in pairs]
    shape = spark.createDataFrame(shapes, "family string, notice int, pairs int, numbers int, span int, a string, b string, is_number boolean")
    return table, shape.select("family", "notice", "pairs", "numbers", "span", "is_number", F.xxhash64("a", "b").alias("gram")), model


def anchors(shared: float) -> list[str]:
    """Words of which a text has at least one if it has ``shared`` of the bigrams of any notice."""
    open_ = [set(zip(w, w[1:])) for notices in TEMPLATES.values() for w in map(tokens, notices)]
    whole = [len(pairs) for pairs in open_]
    chosen = []
    while rest := [p for p, n in zip(open_, whole) if len(p) >= shared * n and p]:
        gain = {}
        for pairs in rest:
            for pair in pairs:
                for w in set(pair):
                    gain[w] = gain.get(w, 0) + 1
        chosen.append(max(sorted(gain), key=lambda w: (w not in STOP, gain[w])))
        open_ = [{p for p in pairs if chosen[-1] not in p} for pairs in open_]
    return chosen


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def _stretches(texts: DataFrame, shape: DataFrame, shared: float) -> DataFrame:
    """Stretches over several lines, of up to twice a notice's words, with enough of its bigrams."""
    where = ["doc_id", "version"]
    flat = F.flatten(F.transform(F.split("text", "\n"), lambda line, i: F.transform(_words(line), lambda w: F.struct(i.alias("line"), w.alias("word")))))
    flat = texts.select(*where, flat.alias("flat")).filter(F.size("flat") > 1)
    both = F.zip_with(F.slice("flat", F.lit(1), F.size("flat") - 1), F.slice("flat", F.lit(2), F.size("flat") - 1), lambda x, y: F.struct(x["line"].alias("line"), y["line"].alias("last"), F.xxhash64(x["word"], y["word"]).alias("gram")))
    met = flat.select(*where, F.posexplode(both).alias("first", "pair")).select(*where, "first", "pair.*").join(F.broadcast(shape), "gram")
    near = Window.partitionBy(*where, "family", "notice").orderBy(F.floor(F.col("first") * 1000 / F.col("span"))).rangeBetween(0, 1000)
    met = met.select(*where, "first", "line", "pairs", F.size(F.collect_set("gram").over(near)).alias("n"), F.max("first").over(near).alias("stop"), F.max("last").over(near).alias("last"))
    met = met.filter((F.col("n") >= F.lit(shared) * F.col("pairs")) & (F.col("last") > F.col("line"))).select(*where, F.col("line").alias("paragraph"), "first", (F.col("stop") + 2).alias("stop"), "last").distinct()
    return met.join(flat, where).select(*met.columns, F.slice(F.col("flat.word"), F.col("first") + 1, F.col("stop") - F.col("first")).alias("words"))


def license_paragraphs(docs: DataFrame, *, probability: float = 0.5, shared: float = 0.6) -> DataFrame:
    """``doc_id, paragraph, family, probability, similarity`` of confirmed licence paragraphs.

    A paragraph is a line of the text, counted from 0, or a stretch of words over
    several lines, named by its first one; stretches of one family that overlap
    are one paragraph, and none if a line of theirs is confirmed by itself.
    ``similarity`` is the largest share of one notice's bigrams that the
    paragraph has; ``shared`` of them confirm the family.  Null and empty texts
    have no paragraphs; rows with one doc_id are read as one document's
    paragraphs only if their texts agree; a long text is as many paragraphs as
    it has lines; an empty table gives none; other columns are ignored.
    """
    spark = docs.sparkSession
    table, shape, model = _model_tables(spark)
    families = model.families
    denials = F.array(*[F.xxhash64(F.lit(a), F.lit(b)) for a, b in DENIALS])
    weighed = _bitmap(table.select(F.col("gram").alias("hash")).union(shape.select("gram")))
    texts = docs.filter(F.lower("text").rlike(f"(?<![a-z0-9])(?:{'|'.join(anchors(shared))})(?![a-z0-9])"))
    texts = stored(texts.select("doc_id", F.xxhash64("text").alias("version"), "text").dropDuplicates(["doc_id", "version"]), "anchored")
    none = F.lit(-1)
    lines = texts.select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    lines = lines.select("doc_id", "version", "paragraph", none.alias("first"), none.alias("stop"), F.col("paragraph").alias("last"), _words(F.col("line")).alias("words"))
    where = ["doc_id", "version", "paragraph", "first", "stop", "last"]
    units = lines.union(_stretches(texts, shape, shared)).select(*where, _hashed(F.col("words")).alias("grams"), weighed.alias("weighed"))
    kept = F.filter("grams", lambda g: F.getbit(F.get("weighed", bit_word(g)), g.bitwiseAND(F.lit(63)).cast("int")) == 1)
    seen = units.filter(~F.arrays_overlap("grams", denials)).select(*where, F.explode(kept).alias("gram"))
    sums = seen.join(F.broadcast(table), "gram").groupBy(*where).agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(families))])
    logits = [F.col(f"w{i}") + F.lit(float(model.bias[i]) / model.temperature) for i in range(len(families))]
    total = F.exp(F.lit(model.unknown))
    for z in logits:
        total = total + F.exp(F.least(z, F.lit(500.0)))
    best = F.greatest(*[F.struct(z.alias("z"), F.lit(f).alias("family")) for z, f in zip(logits, families)])
    judged = sums.select(*where, best.alias("best"), total.alias("total")).select(*where, "best.family", (F.exp(F.least(F.col("best.z"), F.lit(500.0))) / F.col("total")).alias("probability"))
    judged = judged.filter(F.col("probability") >= probability)
    found = stored(_confirm(seen, judged, shape, where, shared), "confirmed")
    found = _apart(found)
    # What names no version belongs to a notice of the same text that names one.
    versioned = found.filter(F.col("family").startswith("gpl-")).select("doc_id", "version").distinct()
    bare = found.filter("family = 'gpl'").join(versioned, ["doc_id", "version"], "left_anti").select(*found.columns)
    return found.filter("family <> 'gpl'").union(bare).select("doc_id", "paragraph", "family", "probability", "similarity")


def _confirm(seen: DataFrame, judged: DataFrame, shape: DataFrame, where: list[str], shared: float) -> DataFrame:
    """Keep predictions whose family has a notice with enough of its bigrams in the paragraph."""
    met = seen.join(judged, where).join(F.broadcast(shape), ["family", "gram"]).groupBy(*where, "family", "probability", "notice", "pairs", "numbers").agg((F.count("*") / F.col("pairs")).alias("share"), F.count("*").alias("hits"), F.count_if("is_number").alias("versions"))
    met = met.filter("versions = numbers")
    return met.groupBy(*where, "family", "probability").agg(F.max("share").alias("similarity"), F.max("hits").alias("hits")).filter(F.col("similarity") >= shared)


def _apart(found: DataFrame) -> DataFrame:
    """Confirmed lines, and the best of overlapping stretches that hold no confirmed line of their family.

    A stretch that lies by more than half in one of another family with more
    shared bigrams is a part of that notice.
    """
    one = found.filter("first < 0")
    key = ["doc_id", "version", "family"]
    a, b = found.filter("first >= 0").alias("a"), one.select(*key, "paragraph").alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in key]
    wrapped = a.join(b, [*same, F.col("b.paragraph").between(F.col("a.paragraph"), F.col("a.last"))], "left_anti")
    before = Window.partitionBy(*key).orderBy("first", "stop")
    wrapped = wrapped.withColumn("new", (F.col("first") >= F.coalesce(F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).cast("int"))
    wrapped = wrapped.withColumn("part", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    names = [c for c in found.columns if c not in key]
    wrapped = wrapped.groupBy(*key, "part").agg(F.max_by(F.struct(*names), F.struct("similarity", -F.col("first"))).alias("best")).select(*key, "best.*")
    wrapped = stored(wrapped, "wrapped")
    a, b = wrapped.alias("a"), wrapped.alias("b")
    inside = 2 * (F.least("a.stop", "b.stop") - F.greatest("a.first", "b.first")) > F.col("a.stop") - F.col("a.first")
    wrapped = a.join(b, [*same[:2], F.col("a.family") != F.col("b.family"), F.col("a.hits") < F.col("b.hits"), inside], "left_anti")
    return one.select(*found.columns).union(wrapped.select(*found.columns))


def license_documents(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_notices, families, probability`` of every distinct doc_id of ``docs``.

    ``families`` joins the confirmed families in alphabetical order, ``unknown``
    where there is none; ``probability`` is the least one of its notices.
    """
    found = license_paragraphs(docs, **options).groupBy("doc_id").agg(F.count("*").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.min("probability").alias("probability"))
    ids = docs.select("doc_id").distinct()
    return ids.join(found, ids["doc_id"].eqNullSafe(found["doc_id"]), "left").select(ids["doc_id"], F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), F.coalesce("families", F.lit(UNKNOWN)).alias("families"), "probability")
