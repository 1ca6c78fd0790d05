"""Licence scan: a trained paragraph classifier, by DataFrame functions only.

A paragraph is a line of text. Its features are the distinct words and word pairs that hold an
anchor word, any word of the licence notices but the function words of English (``FUNCTION``);
a line without anchors has no features and is no licence. Anchors depend on the notices only,
so no frequency in the corpus keeps a line from being looked at. A sparse multinomial logistic regression over the
licence families, an ``unknown`` licence class and ``none`` gives calibrated probabilities,
and a paragraph whose family is not probable enough is ``unknown``. A prediction is confirmed
when the paragraph holds enough of the words and pairs of one of the family's templates.

Notices that are wrapped over several lines are found in windows: in a run of consecutive
lines with anchors that hold no whole template alone, windows start at each line and end at
each of the next lines, up to as many words further as the longest template has. A window counts
if it is confirmed and holds more of its template than its first line or a line of its family
alone; of those that start at a line the most complete one is taken, the shortest of equal
ones. Windows of one family that start on consecutive lines are one notice, at the line from
which it is most complete. What that line says alone, and unconfirmed lines of the window that name no other
family, are no licences of their own.

Training rows are the templates, shortened and mixed variants of them, and a bounded sample of
lines of the corpus as ``none`` (about ``lines``, chosen by a hash of the id and the line
number). The weights are a table of a few thousand rows at most, which depends on the
templates only; lines, words, sums, probabilities and comparison are Spark expressions.

Defined results: null and empty texts have no paragraphs and no licences; rows without an id
or with equal ids and different texts are scanned one by one; repeated rows give repeated
results; an empty table gives an empty table.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LINES = 3000        # sampled corpus lines for training
FEW = 0.1           # largest share of anchors among the words of an ordinary line
NOTICE = 0.6        # share of a notice's words from which a sampled line is not taken as ordinary
SURE = 0.5          # probability below which a family is unknown
CONFIRM = 0.5       # share of a template's features that confirms a family
NONE, UNKNOWN = "none", "unknown"

# Notices by which the licence families are known.
TEMPLATES = {
    "agpl": ["licensed under the GNU Affero General Public License, version 3",
             "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License.",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
               "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Released under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer.",
            "SPDX-License-Identifier: BSD-3-Clause", "Use of this source code is governed by a BSD-style license"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and "
            "related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation; either version 2 of the License, "
            "or any later version.", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the GPL version 2"],
    "isc": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for "
            "any purpose with or without fee is hereby granted", "SPDX-License-Identifier: ISC"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-only"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.", "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain.",
                  "SPDX-License-Identifier: Unlicense"],
    UNKNOWN: ["Licensed under the terms of the vendor agreement.", "This software is proprietary and confidential.",
              "All rights reserved. Use is subject to license terms.", "Released under a custom license, see LICENSE.",
              "Licensed under the terms found in the license file.", "Distributed under the publisher's license."],
}
# Words that no notice consists of.
FUNCTION = set("all an and any are as at be been by can for has in is it may no not of on only or that the this to "
               "under with without you".split())
FAMILIES = sorted(f for f in TEMPLATES if f != UNKNOWN)
CLASSES = [*FAMILIES, UNKNOWN, NONE]


def words(line: str) -> list[str]:
    """The line's words; the Spark expression in :func:`_words` does the same."""
    return [w for w in re.split("[^a-z0-9]+", line.lower()) if w]


def _words(line):
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def features(ws: list[str], anchors: set[str]) -> set[str]:
    """Distinct words and pairs with an anchor."""
    pairs = [f"{a} {b}" for a, b in zip(ws, ws[1:]) if a in anchors or b in anchors]
    return {w for w in ws if w in anchors} | set(pairs)


class Model:
    """Anchors, weights and templates, fitted on the driver from bounded rows."""

    def __init__(self, lines: list[str]) -> None:
        notices = [set(words(t)) for texts in TEMPLATES.values() for t in texts]
        self.anchors = {w for n in notices for w in n if len(w) > 1 and not w.isdigit() and w not in FUNCTION}
        self.templates = [(f, n, g) for f in FAMILIES for n, t in enumerate(TEMPLATES[f])
                          for g in sorted(features(words(t), self.anchors))]
        rng = random.Random(7)
        rows: list[tuple[set[str], int]] = []
        # sampled lines that hold most of a notice, or are short and hold its words, are no ordinary text
        filler = [t for t in lines if self._ordinary(words(t), notices)] or ["plain words"]
        for name, texts in TEMPLATES.items():
            for t in texts:
                ws = words(t)
                for k in range(30):
                    v = list(ws)
                    if k >= 10:  # some words lost, other words around
                        v = [w for w in v if rng.random() > 0.08]
                        a, b = words(rng.choice(filler)), words(rng.choice(filler))
                        v = a[:rng.randint(0, 8)] + v + b[:rng.randint(0, 8)]
                    rows.append((features(v, self.anchors), CLASSES.index(name)))
        whole = {g for t in TEMPLATES.values() for x in t for g in features(words(x), self.anchors)}
        for t in filler:  # single anchors among other words are no licence
            ws = words(t)
            extra = [rng.choice(sorted(self.anchors))] if rng.random() < 0.5 and self.anchors else []
            # only grams of notices are held, as sampled lines may be long
            rows.append((features(ws[:20] + extra + ws[20:], self.anchors) & whole, CLASSES.index(NONE)))
        self.vocabulary = sorted({g for f, _ in rows for g in f} & whole)
        at = {g: n for n, g in enumerate(self.vocabulary)}
        x = np.zeros((len(rows), len(at) + 1))
        x[:, -1] = 1
        for r, (f, _) in enumerate(rows):
            x[r, [at[g] for g in f if g in at]] = 1
        y = np.eye(len(CLASSES))[[c for _, c in rows]]
        held = np.arange(len(rows)) % 5 == 0
        weight = (1 / np.maximum(y[~held].sum(axis=0), 1))[y[~held].argmax(axis=1)][:, None]
        w, m, t = np.zeros((x.shape[1], len(CLASSES))), np.zeros((x.shape[1], len(CLASSES))), 1.0
        rate = 1 / (0.5 * (weight * x[~held] ** 2 * x[~held].sum(axis=1, keepdims=True)).sum(axis=0).max() + 1e-3)
        for _ in range(400):
            p = self._softmax(x[~held] @ m)
            w2 = m - rate * (x[~held].T @ (weight * (p - y[~held])) + 1e-3 * m)
            w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * 2e-4, 0)  # sparse
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            m, w, t = w2 + (t - 1) / t2 * (w2 - w), w2, t2
        z, yh = x[held] @ w, y[held]
        self.scale = min((1, 1.5, 2, 3, 4, 6, 8), key=lambda s: -np.log(self._softmax(z * s)[yh > 0] + 1e-12).mean())
        self.weights, self.bias = w[:-1] * self.scale, w[-1] * self.scale

    def _ordinary(self, ws: list[str], notices: list[set[str]]) -> bool:
        held = set(ws)
        return (sum(w in self.anchors for w in ws) <= FEW * len(ws)
                and all(len(n & held) < NOTICE * len(n) for n in notices))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, lines: int = LINES) -> Model:
    """Fit with sampled lines of ``docs(doc_id, text)`` as ordinary text."""
    n = docs.count()
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("licence")), F.lit(1 << 30))
    some = (docs.where(place < int(min(1.0, lines / 4 / max(n, 1)) * (1 << 30)))
            .select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
            .orderBy(F.xxhash64("doc_id", "line"), "text").limit(lines)
            .select(F.concat_ws(" ", _words("text")).alias("t")))
    return Model([r["t"] for r in some.collect()])


def scan_lines(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Licence paragraphs: ``key, line, family, probability, confirmed``."""
    spark = docs.sparkSession
    k = len(CLASSES)
    anchors = F.array(*[F.lit(a) for a in sorted(model.anchors)])
    weights = spark.createDataFrame(
        [(g, *map(float, w)) for g, w in zip(model.vocabulary, model.weights)],
        "gram string, " + ", ".join(f"w{i} double" for i in range(k)))
    # the tables below depend on the templates only: a few hundred rows
    templates = spark.createDataFrame([(f"{f} {n}", f, g) for f, n, g in model.templates],
                                      "template string, family string, gram string")
    sizes = templates.groupBy("template").agg(F.count(F.lit(1)).alias("size"))
    # "+" marks the pair of a line's last word and the first word of the next line
    vocabulary = spark.createDataFrame([(e + g, g, bool(e)) for g in model.vocabulary for e in ("", "+")],
                                       "raw string, gram string, edge boolean")
    lines = (docs.select(key, F.split(F.lower("text"), "\n").alias("_ls"))
             .select(key, F.posexplode(F.transform("_ls", lambda t, i: F.struct(
                 t.alias("t"), F.regexp_extract(F.get("_ls", i + 1), "[a-z0-9]+", 0).alias("n")))).alias("line", "_l"))
             .select(key, "line", _words(F.col("_l.t")).alias("ws"), F.coalesce("_l.n", F.lit("")).alias("next"))
             .where(F.arrays_overlap("ws", anchors)))
    singles = F.filter("ws", lambda w: F.array_contains(anchors, w))
    pairs = F.transform(F.sequence(F.lit(0), F.size("ws") - 1),
                        lambda i: F.when(i < F.size("ws") - 1, F.concat_ws(" ", F.get("ws", i), F.get("ws", i + 1)))
                        .otherwise(F.concat(F.lit("+"), F.get("ws", i), F.lit(" "), F.col("next"))))
    grams = lines.select(key, "line", F.size("ws").alias("more"), F.explode(F.array_distinct(F.concat(singles, pairs))).alias("raw"))
    # repeated rows share their key: each gram counts once
    grams = (grams.join(F.broadcast(vocabulary), "raw").groupBy(key, "line", "gram")
             .agg(F.min("edge").alias("edge"), F.max("more").alias("more")))
    alone = _judged(grams.where(~F.col("edge")), [key, "line"], model, weights, templates, sizes)

    # windows of the lines that hold no whole template alone
    longest = max(len(words(t)) for texts in TEMPLATES.values() for t in texts)
    run = Window.partitionBy(key, "run").orderBy("line")
    rest = (alone.where(~F.col("confirmed") | (F.col("part") < 1))
            .withColumn("run", F.col("line") - F.row_number().over(Window.partitionBy(key).orderBy("line")))
            .withColumn("upto", F.sum("more").over(run))
            .withColumn("held", F.when(F.col("confirmed"), F.col("part")).otherwise(0.0)))
    # each line has a word at least, so no window has more lines than this
    rest = rest.select(key, F.col("line").alias("start"), "upto", "held", F.collect_list(
        F.struct("line", "upto", "more", "guess", "held")).over(run.rowsBetween(0, longest)).alias("ahead"))
    rest = rest.select(key, "start", "held", F.filter("ahead", lambda x: (x["line"] == F.col("start"))
                                                      | (x["upto"] - x["more"] - F.col("upto") < longest)).alias("ahead"))
    rivals = F.transform(F.filter("ahead", lambda x: x["held"] > 0), lambda x: F.struct(x["line"], x["guess"], x["held"]))
    members = (rest.where(F.size("ahead") > 1).withColumn("rivals", rivals)
               .withColumn("end", F.explode(F.slice("ahead.line", 2, longest)))
               .select(key, "start", "end", F.struct("held", "rivals").alias("more"),
                       F.explode(F.sequence("start", "end")).alias("line")))
    inside = (members.join(grams.drop("more"), [key, "line"]).where(~F.col("edge") | (F.col("line") < F.col("end")))
              .groupBy(key, F.col("start").alias("line"), "end", "gram").agg(F.max("more").alias("more")))
    wrapped = _judged(inside, [key, "line", "end"], model, weights, templates, sizes).where(
        F.col("confirmed") & (F.col("part") > F.col("more.held"))
        & ~F.exists("more.rivals", lambda x: (x["guess"] == F.col("guess")) & (x["held"] >= F.col("part"))
                    & (x["line"] <= F.col("end"))))
    wrapped = (wrapped.groupBy(key, "line").agg(F.max(F.struct(
        "part", (-F.col("end")).alias("before"), "guess", "probability")).alias("m")).select(key, "line", "m.*")
        .withColumn("island", F.col("line") - F.row_number().over(Window.partitionBy(key, "guess").orderBy("line")))
        .groupBy(key, "guess", "island").agg(F.max(F.struct("part", "line", "probability", "before")).alias("m"))
        .select(key, "m.line", F.col("guess").alias("family"), "m.probability", F.lit(True).alias("confirmed"),
                (-F.col("m.before")).alias("end")))
    taken = wrapped.select(key, F.col("family").alias("of"), F.col("line").alias("start"), F.explode(F.sequence("line", "end")).alias("line"))
    taken = taken.groupBy(key, "line").agg(F.collect_set("of").alias("of"),  # as many as there are families
                                           F.max(F.col("line") == F.col("start")).alias("head"))
    own = alone.where(F.col("guess") != NONE).select(
        key, "line", F.when(F.col("sure"), F.col("guess")).otherwise(UNKNOWN).alias("family"), "probability", "confirmed")
    own = own.join(taken, [key, "line"], "left").where(
        F.col("of").isNull() | (~F.col("head") & (F.col("confirmed") | (
            (F.col("family") != UNKNOWN) & ~F.expr("array_contains(of, family)"))))).drop("of", "head")
    return own.unionByName(wrapped.drop("end"))


def _judged(grams: DataFrame, by: list[str], model: Model, weights: DataFrame, templates: DataFrame, sizes: DataFrame) -> DataFrame:
    """``*by, more, guess, probability, sure, part, confirmed`` by ``grams(*by, gram, more)``."""
    k = len(CLASSES)
    total = grams.join(F.broadcast(weights), "gram").groupBy(*by).agg(
        F.max("more").alias("more"), *[(F.sum(f"w{i}") + float(model.bias[i])).alias(f"z{i}") for i in range(k)])
    total = total.select(*by, "more", F.array(*[F.col(f"z{i}") for i in range(k)]).alias("z"))
    total = total.select(*by, "more", "z", F.array_max("z").alias("top"))
    names = F.array(*[F.lit(c) for c in CLASSES])
    found = total.select(
        *by, "more", F.element_at(names, F.array_position("z", F.col("top")).cast("int")).alias("guess"),
        (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"))
    held = (grams.select(*by, "gram").join(F.broadcast(templates), "gram")
            .groupBy(*by, "template", "family").agg(F.count(F.lit(1)).alias("n"))
            .join(F.broadcast(sizes), "template")
            .groupBy(*by, "family").agg(F.max(F.col("n") / F.col("size")).alias("part")))
    out = found.join(held.withColumnRenamed("family", "guess"), [*by, "guess"], "left")
    sure = (F.col("probability") >= SURE) & (F.col("guess") != UNKNOWN)
    part = F.coalesce("part", F.lit(0.0))
    return out.select(*by, "more", "guess", "probability", sure.alias("sure"), part.alias("part"),
                      (sure & (part >= CONFIRM)).alias("confirmed"))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_paragraphs, n_licences, licences, family``.

    ``n_paragraphs`` counts lines, ``n_licences`` notices, wrapped ones once. ``licences`` lists ``line:family:confirmed`` (1 or 0) in the order of lines; ``family`` is the
    most probable confirmed one.
    """
    keyed = docs.select("doc_id", "text", F.struct("doc_id", F.xxhash64("text").alias("h")).alias("_k"))
    found = scan_lines(keyed.select(F.to_json("_k").alias("_k"), "text"), model, key="_k")
    per = found.groupBy("_k").agg(  # at most as many as the text has lines
        F.sort_array(F.collect_list(F.struct("line", "family", "confirmed"))).alias("l"),
        F.max(F.when(F.col("confirmed"), F.struct("probability", "family"))).alias("best"))
    shown = F.array_join(F.transform("l", lambda x: F.concat_ws(
        ":", x["line"].cast("string"), x["family"], x["confirmed"].cast("int").cast("string"))), ",")
    base = keyed.select("doc_id", F.to_json("_k").alias("_k"),
                        F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0)
                        .otherwise(F.size(F.split("text", "\n"))).cast("bigint").alias("n_paragraphs"))
    return base.join(per, "_k", "left").select(
        "doc_id", "n_paragraphs", F.coalesce(F.size("l"), F.lit(0)).cast("bigint").alias("n_licences"),
        F.coalesce(shown, F.lit("")).alias("licences"), F.col("best.family").alias("family"))
