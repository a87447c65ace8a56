"""Licence scans by a trained paragraph classifier (operator 6, DataFrame
functions only on the main path).

A paragraph is a line, or a run of lines between blank ones read as one line. In
lines of more than ``LONG`` words, every stretch of about a template's length
around a cue is one, too; in runs of lines, every such stretch that crosses a line
break, so that a notice is found however it is wrapped. Cues are words of which
every template holds one: where none stands, every template lacks a part.
Paragraphs become sparse sets of word uni- and bigrams. A softmax regression over
these, one class per licence family and one for ``unknown``, is trained on the
driver from the templates below, broken into parts and with words left out,
against ordinary sentences about rights and lines of about ``SAMPLE_TEXTS`` texts
(4 times as many at most) that no template confirms. Every fifth of these strangers is kept apart before anything is
repeated, and the threshold on the family's probability is calibrated so that none
of them passes. A prediction counts only if a template of the predicted family
confirms it: the words' bigrams overlap by ``CONFIRM``.

On the main path distinct lines are scored, so a licence line that a third of
all documents share is scored once: its n-grams are exploded, joined with the
weights (a broadcast of the built-in texts' n-grams, about a thousand rows)
and summed per line with map-side partial sums.

Defined cases: null and empty texts have no licence; a long line can name several
licences and is unknown if neither it nor a stretch of it is confirmed;
rows that repeat a doc_id are reported together, null doc_ids likewise; ties of
families go to the alphabetically first; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import json
import random
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, staged, text_or_empty

CUE = r"(?i)licen[cs]e|copyright|redistribut|permission|warrant|public\s+domain|all\s+rights\s+reserved|spdx|creative\s+commons|\bcc0\b|\bcc[\s-](by|0)|\bgpl|\blgpl|\bagpl"
BLANK = r"\n[ \t\r]*\n"   # between runs of lines
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
CONFIRM = 0.6          # least overlap of bigrams with a template
LONG = 50              # words above which a line is read in stretches, too
STRETCHES = (2, 3, 4, 6, 8, 12, 16, 24, 32, 44)  # words; a template of any length fills most of one
SAMPLE_TEXTS = 300     # texts whose cue-free lines train the unknown class
ROUNDS, RATE, SHRINK = 300, 0.5, 1e-4

# Public licence notices, by family. (These are the customary words
# of the notices themselves.)
TEMPLATES = {
    "agpl": ["GNU Affero General Public License",
             "This work is licensed under the GNU Affero General Public License, version 3.",
             "either version 3 of the GNU Affero General Public License, or (at your option) any later version.",
             "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "Released under the Apache License 2.0.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Released under the BSD License.", "Licensed under the BSD 3-Clause License.",
            "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc0": ["Released under CC0 1.0 Universal.", "Dedicated to the public domain under CC0 1.0.",
            "This work has been marked as dedicated to the public domain.", "SPDX-License-Identifier: CC0-1.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This work is licensed under the GNU General Public License, version 2.",
            "it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Released under the GPL license, version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "isc": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": ["This work is licensed under the GNU Lesser General Public License, version 3.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved.", "Copyright 2020 Example Company. All rights reserved.",
                    "No part of this publication may be reproduced without prior written permission of the publisher.",
                    "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited without permission."],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense license."],
}
FAMILIES = sorted(TEMPLATES)
CLASSES = [*FAMILIES, "unknown"]
#: Own sentences that hold cue words without naming a licence.
ORDINARY = [
    "You need a licence to drive a car in this country.", "The driving licence was renewed last week.",
    "She asked for permission to leave the room early.", "The shop offers a two year warranty on all parts.",
    "He was granted permission to build a house.", "Nothing here warrants further attention.",
    "The wealth was redistributed among the villagers.", "A fishing license costs ten pounds a year.",
    "The court discussed whether copyright applies to recipes.", "Please read the license agreement before you install.",
    "The software license expires at the end of the month.", "They licensed the song for a film.",
    "The copyright office is closed on Monday.", "Your license key is attached to this message.",
    "The bar lost its liquor license.", "An arrest warrant was issued in the morning.",
    "Permission denied while opening the file.", "The licence fee pays for public television.",
]


# ---- training, on the driver, from bounded examples ----

def tokens_of(line: str) -> list[str]:
    return re.findall(TOKEN, line.lower())


def pairs_of(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def grams(words: list[str]) -> list[str]:
    return sorted({*words, *pairs_of(words)})


def examples(strangers: list[str], seed: int = 11) -> list[tuple[list[str], int]]:
    """(words, class number) of templates, parts of them and unknown lines (own sentences six times)."""
    rng, out = random.Random(seed), []
    for number, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = tokens_of(template)
            out += [(words, number)] * 6
            for _ in range(10):
                kept = [w for w in words if rng.random() > 0.12]
                if len(kept) >= 2:
                    out.append((kept, number))
    for line in strangers:
        if words := tokens_of(line):
            out += [(words, len(FAMILIES))] * (6 if line in ORDINARY else 1)
    rng.shuffle(out)
    return out


class Classifier:
    """Softmax regression over n-gram sets, each of length one."""

    def __init__(self, lines: list[str]):
        strangers = sorted({*ORDINARY, *lines}, key=lambda x: zlib.crc32(x.encode()))
        kept_apart, own = strangers[::5], [x for i, x in enumerate(strangers) if i % 5]
        learned = examples(own)
        held = [(words, len(FAMILIES)) for x in kept_apart if (words := tokens_of(x))]
        # weights for the n-grams of the built-in texts it learns from; any other n-gram has weight 0
        known = [t for family in FAMILIES for t in TEMPLATES[family]] + [x for x in ORDINARY if x in own]
        vocabulary = sorted({g for line in known for g in grams(tokens_of(line))})
        self.column = {g: i for i, g in enumerate(vocabulary)}
        self.weights = np.zeros((len(vocabulary), len(CLASSES)))
        self.bias = np.zeros(len(CLASSES))
        rows, cols, values = self._sparse(learned)
        order = np.argsort(cols, kind="stable")
        first = np.flatnonzero(np.diff(cols[order], prepend=-1))
        truth = np.array([c for _, c in learned])
        share = np.bincount(truth, minlength=len(CLASSES))
        balance = (len(truth) / (len(CLASSES) * np.maximum(share, 1)))[truth]
        for _ in range(ROUNDS):
            error = self._softmax(self._scores(rows, cols, values, len(learned)))
            error[np.arange(len(truth)), truth] -= 1
            error *= balance[:, None] / len(truth)
            step = np.zeros_like(self.weights)
            step[cols[order][first]] = np.add.reduceat((error[rows] * values[:, None])[order], first, axis=0)
            self.weights -= RATE * 40 * (step + SHRINK * self.weights)
            self.bias -= RATE * error.sum(axis=0)
        self.weights, self.bias = self.weights.round(6), self.bias.round(6)
        rows, cols, values = self._sparse(held)
        chance = self._softmax(self._scores(rows, cols, values, len(held)))[:, :len(FAMILIES)]
        # above what any stranger kept apart reaches
        self.threshold = float(min(max(0.5, chance.max(initial=0.0) + 0.01), 0.9))

    def _sparse(self, data):
        rows, cols, values = [], [], []
        for i, (words, _) in enumerate(data):
            own = grams(words)
            for g in own:
                if g in self.column:
                    rows.append(i)
                    cols.append(self.column[g])
                    values.append(1 / np.sqrt(len(own)))
        return np.array(rows, int), np.array(cols, int), np.array(values)

    def _scores(self, rows, cols, values, n):
        out = np.tile(self.bias, (n, 1))
        if len(rows):  # entries come row by row
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            out[rows[first]] += np.add.reduceat(self.weights[cols] * values[:, None], first, axis=0)
        return out

    @staticmethod
    def _softmax(scores):
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def confirmed(line: str) -> bool:
    """Whether any template confirms a line."""
    own = set(pairs_of(words := tokens_of(line)) or words)
    return any(len(own & set(t)) >= CONFIRM * min(len(own), len(t)) for family in FAMILIES for template in TEMPLATES[family]
               if own and (t := pairs_of(tokens_of(template)) or tokens_of(template)))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Fit on the templates and the lines that no template confirms of about
    SAMPLE_TEXTS texts, those whose row hash falls into one of many classes."""
    classes = max(1, docs.count() // SAMPLE_TEXTS)
    sample = (docs.select(quoted(doc_id).alias("d"), quoted(text).cast("string").alias("t")).where(F.col("t").isNotNull())
              .where(F.pmod(F.xxhash64("d", "t"), F.lit(classes)) == 0).limit(4 * SAMPLE_TEXTS)
              .select(F.explode(F.split("t", "\n")).alias("line")).where(F.trim("line") != ""))
    return Classifier([r["line"] for r in sample.collect() if not confirmed(r["line"])])


# ---- the main path ----

def _literal_table(df: DataFrame, rows: list, schema: str) -> DataFrame:
    """A small table from driver values, as a literal of the plan."""
    one = df.sparkSession.range(1)
    return one.select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TOKEN), F.lit(0))


def _bigrams(words: str) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def classify_lines(lines: DataFrame, model: Classifier) -> DataFrame:
    """``lines(line)``, distinct → line, family (``unknown`` if not confirmed), probability, overlap,
    covered (of a template of the family), shared (bigrams with one)."""
    words = (lines.withColumn("words", _tokens(F.col("line"))).where(F.size("words") > 0)
             .withColumn("pairs", _bigrams("words"))
             .withColumn("grams", F.array_union("words", "pairs")))
    weights = F.broadcast(_literal_table(lines, [  # the n-grams of the built-in texts
        {"gram": g, "w": [float(x) for x in model.weights[i]]} for g, i in model.column.items()], "gram:string,w:array<double>"))
    scored = (words.select("line", F.explode("grams").alias("gram"), (1 / F.sqrt(F.size("grams"))).alias("value"))
              .join(weights, "gram", "left").groupBy("line")
              .agg(*[F.coalesce(F.sum(F.col("value") * F.col("w")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(CLASSES))]))
    scores = [F.col(f"s{i}") + float(b) for i, b in enumerate(model.bias)]
    top = F.greatest(*scores)
    total = sum((F.exp(s - top) for s in scores[1:]), F.exp(scores[0] - top))
    ranked = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("number")) for i, s in enumerate(scores)]))
    predicted = scored.select("line", (1 / total).alias("probability"), ranked["number"].alias("number")).select(
        "line", "probability", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), 1 - F.col("number")).alias("predicted"))
    parts = [{"template": f"{f}/{i}", "known": f, "pair": p, "size": len(pairs)} for f in FAMILIES for i, t in enumerate(TEMPLATES[f])
             if (pairs := pairs_of(tokens_of(t)) or tokens_of(t)) for p in pairs]
    templates = F.broadcast(_literal_table(lines, parts, "template:string,known:string,pair:string,size:int"))
    own = F.when(F.size("pairs") > 0, F.col("pairs")).otherwise(F.col("words"))
    overlap = (words.select("line", F.size(own).alias("own"), F.explode(own).alias("pair"))
               .join(templates, "pair").groupBy("line", "template", "known", "size", "own").agg(F.count(F.lit(1)).alias("shared"))
               .groupBy("line", F.col("known").alias("predicted"))
               .agg(F.max(F.col("shared") / F.least("size", "own")).alias("overlap"),
                    F.max(F.col("shared") / F.col("size")).alias("covered"), F.max("shared").alias("shared")))
    sure = (F.col("predicted") != "unknown") & (F.col("probability") >= model.threshold) & (F.col("overlap") >= CONFIRM)
    return (predicted.join(overlap, ["line", "predicted"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
            .select("line", F.when(sure, F.col("predicted")).otherwise("unknown").alias("family"), "probability", "overlap", "covered", "shared"))


def _stretches(words: str, lines: str | None = None) -> Column:
    """(cue, line): per cue of a long line the stretches of words around it, every
    quarter of their length, as texts; with the words' ``lines`` only those that cross a line break."""
    n = F.size(words)

    def has_cue(at: Column, length: int) -> Column:
        return F.concat_ws(" ", F.slice(words, at + 1, F.lit(length))).rlike(CUE)

    def around(i: Column, length: int) -> Column:
        step = max(1, length // 4)
        first = F.greatest(F.ceil((i + 1 - length) / step).cast("int"), F.lit(0))
        starts = F.sequence(first, F.floor(i / step).cast("int"))
        if lines:
            starts = F.filter(starts, lambda k: F.get(F.col(lines), k * step) < F.get(F.col(lines), F.least(k * step + length, n) - 1))
        return F.transform(starts, lambda k: F.struct(i.alias("cue"), F.concat_ws(" ", F.slice(words, k * step + 1, F.lit(length))).alias("line")))

    cues = F.filter(F.sequence(F.lit(0), n - 1), lambda i: has_cue(i, 3) & ~has_cue(i + 1, 2))
    return F.flatten(F.transform(cues, lambda i: F.concat(*[around(i, length) for length in STRETCHES])))


def scan(docs: DataFrame, model: Classifier | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a cue word: doc_id, line_no (from 0), line, family, probability, overlap, best;
    a long line has one more for each further family (``best`` is false there)."""
    model = model or train(docs, doc_id, text)
    cued = staged(docs.select(quoted(doc_id).alias("doc_id"), F.posexplode(F.split(text_or_empty(quoted(text)), "\n")).alias("line_no", "line"))
                  .where(F.col("line").rlike(CUE)).withColumn("key", F.md5(F.col("line").cast("binary"))), "cued")
    lines = cued.select("key", "line").distinct()
    parts = (lines.withColumn("words", _tokens(F.col("line"))).where(F.size("words") > LONG)
             .select("key", F.explode(_stretches("words")).alias("part")).select("key", "part.cue", "part.line"))
    units = staged(lines.select("key", F.lit(-1).alias("cue"), "line").unionByName(parts), "units")
    whole, known = F.col("cue") < 0, F.col("family") != "unknown"
    verdicts = (units.join(classify_lines(units.select("line").distinct(), model), "line")
                # a stretch is small by our cut: it must hold most of a template
                .withColumn("family", F.when(whole | (F.col("covered") >= CONFIRM), F.col("family")).otherwise("unknown")))
    # of the stretches around a cue the one that shares most with its family's templates counts
    best = F.max(F.struct(known.alias("known"), F.when(known, F.col("shared")).alias("shared"), "probability", "overlap", "family"))
    found = verdicts.groupBy("key", "cue").agg(best.alias("b")).select("key", "cue", "b.*").where(whole | known)
    # an unknown line has its own figures, a known one those of its best stretch
    figures = F.max(F.struct("probability", "overlap"))
    found = (found.groupBy("key", "family").agg(figures.alias("f"))
             .withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(known.desc(), F.col("f.probability").desc(), "family")))
             .where(known | (F.col("rank") == 1)).select("key", "family", "f.probability", "f.overlap", (F.col("rank") == 1).alias("best")))
    return cued.join(found, "key", "left").select(
        "doc_id", "line_no", "line", F.coalesce("family", F.lit("unknown")).alias("family"), "probability", "overlap",
        F.coalesce("best", F.lit(True)).alias("best"))


def wrapped(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph (number of the run of lines), family, overlap): confirmed
    notices that cross line breaks, once per paragraph and family."""
    runs = staged(docs.select(quoted(doc_id).alias("doc_id"), F.posexplode(F.split(text_or_empty(quoted(text)), BLANK)).alias("paragraph", "run"))
                  .where(F.contains("run", F.lit("\n")) & F.col("run").rlike(CUE)).withColumn("key", F.md5(F.col("run").cast("binary"))), "runs")
    by_line = F.transform(F.split("run", "\n"), lambda line, i: F.transform(_tokens(line), lambda w: F.struct(w.alias("w"), i.alias("l"))))
    parts = staged(runs.select("key", "run").distinct().withColumn("all", F.flatten(by_line)).where(F.size("all") > 0)
                   .select("key", F.transform("all", lambda x: x["w"]).alias("words"), F.transform("all", lambda x: x["l"]).alias("lines"))
                   .select("key", F.explode(_stretches("words", "lines")).alias("part")).select("key", "part.cue", "part.line"), "parts")
    sure = (F.col("family") != "unknown") & (F.col("covered") >= CONFIRM)
    # of the stretches around a cue the one that shares most with its family's templates counts
    found = (parts.join(classify_lines(parts.select("line").distinct(), model).where(sure), "line").groupBy("key", "cue")
             .agg(F.max(F.struct("shared", "probability", "overlap", "family")).alias("b"))
             .groupBy("key", "b.family").agg(F.max("b.overlap").alias("overlap")))
    return runs.join(found, "key").select("doc_id", "paragraph", "family", "overlap")


def document_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Classifier | None = None) -> DataFrame:
    """One row per doc_id: licences (families, sorted, by comma), n_licence_lines, n_unknown_lines, best_overlap."""
    model = model or train(docs, doc_id, text)
    found = scan(docs, model, doc_id, text).select("doc_id", "family", "overlap", "best").unionByName(
        wrapped(docs, model, doc_id, text).select("doc_id", "family", "overlap", F.lit(False).alias("best")))
    every = docs.select(quoted(doc_id).alias("doc_id"), F.lit(None).cast("string").alias("family"), F.lit(None).cast("double").alias("overlap"), F.lit(True).alias("best"))
    known = F.col("family") != "unknown"
    return (found.unionByName(every).groupBy("doc_id")
            .agg(F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("licences"),
                 F.count(F.when(known & F.col("best"), 1)).alias("n_licence_lines"),
                 F.count(F.when(F.col("family") == "unknown", 1)).alias("n_unknown_lines"),
                 F.max(F.when(known, F.col("overlap"))).alias("best_overlap")))
