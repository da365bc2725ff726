"""Licence scan: trained paragraph classifier with template comparison (DataFrame and MLlib only).

A paragraph is a run of lines that hold something, between blank lines.  It is read as word
windows of ``WINDOW`` words, one every ``STEP``, across its line ends, so wrapping a notice
changes nothing and a notice of one line inside a paragraph of prose still has a window of its
own size.  Features are hashed word 1- and 2-grams (presence); a sparse multinomial logistic
regression tells licence families, ``unknown`` (licence-like, no family's wording) and ``none``
apart.  Every window of every paragraph is scored, whatever words it holds.

Learning rows are pieces of the templates (whole, with missing words, alone and inside prose),
shuffled templates and other licences for ``unknown``, and for ``none`` at most
``SAMPLE_WINDOWS`` windows of ``SAMPLE_DOCS`` documents (smallest hash of doc_id), as they are
and with an anchor put in.  A fourth of the variants and other unknown wordings are held out:
on them the temperature of the probabilities is the one of least log loss, and the unknown
threshold the one of most balanced accuracy between known and unknown rows.

Licence-like windows that overlap make one passage.  It takes the family of the highest
calibrated probability over its windows, ``unknown`` below the threshold, and is confirmed
if it holds ``CONFIRM`` of the word pairs of one of the family's templates; ``held`` names every
family with a template held that way, so two notices in a row both show.

Defined results: null and empty texts have no paragraphs; repeated rows, and rows without a
doc_id, are each scanned; very long texts are scanned whole, window by window (a text and its
words have to fit into one row); further columns are ignored; equal probabilities go to the
first family by name; an empty table gives no rows (the classifier then learns from the
wordings below alone).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import let, saved, table

_NO_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")

#: Wordings by family.
TEMPLATES = (
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("bsd-3-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and "
                     "the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work under CC0 1.0 Universal."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("isc", "Released under the ISC License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software."),
    ("mit", _NO_WARRANTY),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
                  "means."),
)
#: Licence-like wordings of no family, for learning and held out for calibration.
UNKNOWN_WORDINGS = (
    "All rights reserved.", "All rights reserved under a custom license agreement.",
    "Use of this text is governed by the license terms.", "Licensed under terms agreed with the author.",
    "See the license file for details.", "Distributed under a proprietary license.", "Copyright by the author, licence on request.",
    "This software is the confidential property of its owner and may not be copied without written permission.",
    "Licensed under the Example Studio License, version 4.", "Released under the house license of the publisher.",
    "Permission to print this page is granted to members only.",
)
UNKNOWN_HELD_OUT = (
    "No part of this work may be reproduced without prior written permission of the publisher, all rights reserved.",
    "Licensed under the Northern Archive License, version 2.", "Released under the Community Data Agreement license.",
    "The software is licensed, not sold, and your use is subject to the end user agreement.",
    "Copyright of the museum, licensed for private study.", "Your license ends when the subscription does.",
    "This file is distributed under the vendor license found in the package.",
)
#: Sentences that hold an anchor and are no licence.
PLAIN = (
    "the weather was fine and they went for a long walk along the river",
    "the software crashed again after the last update and nobody could work that day",
    "she asked for permission to leave early and went home",
    "the new version of the program is faster and easier to use than the old one",
    "a domain of the function is the set of values for which it is defined",
    "they put a notice on the door and closed the public library for the day",
    "the warranty of the machine covers repairs for two years",
    "the apache helicopter landed behind the old barn",
    "students at mit built a small robot in one week",
    "he studied the rights and duties of citizens in the old town",
)
#: Words that notices often hold; learning puts them into prose too.
ANCHORS = (
    "agpl", "apache", "bsd", "cc", "cc0", "commons", "copies", "copy", "copyright", "copyrights", "distributed", "domain",
    "gnu", "gpl", "isc", "lgpl", "licence", "licenced", "licences", "license", "licensed", "licenses", "mit", "mozilla", "mpl",
    "notice", "permission", "permitted", "program", "public", "redistribute", "redistribution", "redistributions", "rights",
    "software", "sublicense", "unencumbered", "unlicense", "warranties", "warranty",
)
NONE, UNKNOWN = "none", "unknown"
FEATURES, SAMPLE_DOCS, SAMPLE_WINDOWS, COPIES, CONFIRM = 1 << 14, 300, 2000, 3, 0.8
WINDOW, STEP = 48, 24
TEMPERATURES = tuple(2.0 ** (k / 2) for k in range(-4, 7))
THRESHOLDS = tuple(k / 20 for k in range(6, 20))
FAMILIES = tuple(sorted({n for n, _ in TEMPLATES}))
CLASSES = (*FAMILIES, UNKNOWN, NONE)


@dataclass(frozen=True)
class Scanner:
    """Classifier, temperature of its probabilities and the least probability of a known family."""
    model: PipelineModel
    temperature: float
    threshold: float


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, joined by single hyphens or dots inside."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++(?:[-.][\p{L}\p{N}]++)*+"), F.lit(0))


def pairs_of(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(
        words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))


def paragraphs_of(docs: DataFrame) -> DataFrame:
    """(row_no, doc_id, para_no, first_line, lines): runs of lines that hold something; all numbers count from 0."""
    def cut(lines):
        full = let(F.transform(lines, lambda x: x.rlike(r"[^ \t-\r]")), lambda f: F.struct(
            _where(f, lambda i: f[i] & ((i == 0) | ~F.get(f, i - 1))).alias("a"),
            _where(f, lambda i: f[i] & ((i == F.size(f) - 1) | ~F.get(f, i + 1))).alias("b")))
        return let(full, lambda ends: F.zip_with(ends["a"], ends["b"], lambda a, b: F.struct(
            a.alias("first_line"), F.slice(lines, a + 1, b - a + 1).alias("lines"))))
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text").filter(F.col("text") != "")
    paras = rows.select("row_no", "doc_id", F.posexplode(let(F.split("text", "\n", -1), cut)).alias("para_no", "p"))
    return paras.select("row_no", "doc_id", "para_no", "p.first_line", "p.lines")


def _where(flags: Column, keep) -> Column:
    """Positions of ``flags`` that ``keep`` takes; null flags outside the array count as blank lines."""
    return F.filter(F.sequence(F.lit(0), F.size(flags) - 1), keep)


def _bound(value: Column, body) -> Column:
    """``let`` without a copy of what ``body`` returns, which here holds every word of a paragraph several times."""
    return F.aggregate(F.array(F.lit(0)), value, lambda v, _: v, body)


def windows_of(paragraphs: DataFrame, anchored: bool = True, grams: bool = False) -> DataFrame:
    """Adds (k, words, first_line, last_line): the paragraph's word windows, those with an anchor or all of them.

    With ``grams`` it adds what ``with_grams`` does, instead of the words, with which they begin (``words_in``); each
    word pair of a paragraph is then put together once, not once a window.
    """
    def cut(lines):
        return _bound(F.transform(lines, words_of), lambda pl: F.struct(F.flatten(pl).alias("w"), F.flatten(F.transform(
            pl, lambda x, i: F.array_repeat(i, F.size(x)))).alias("at")))

    def starts(w):
        last = F.greatest(F.ceil(F.size(w) / STEP).cast("int") - 2, F.lit(0))
        if not anchored:
            return F.sequence(F.lit(0), last)
        spots = F.filter(F.transform(w, lambda x, i: F.when(x.isin(*ANCHORS), F.floor(i / STEP).cast("int"))),
                         lambda i: i.isNotNull())
        near = F.flatten(F.transform(spots, lambda i: F.array(F.greatest(i - 1, F.lit(0)), F.least(i, last))))
        return F.array_sort(F.array_distinct(near))

    def parts(s, pairs=None):
        def part(k):
            own = F.slice(s["w"], k * STEP + 1, WINDOW)
            held = own.alias("words") if pairs is None else F.concat(own, F.slice(pairs, k * STEP + 1, WINDOW - 1)).alias("grams")
            return F.struct(k.alias("k"), held, F.get(s["at"], k * STEP).alias("a"),
                            F.get(s["at"], F.least(k * STEP + WINDOW, F.size(s["at"])) - 1).alias("b"))
        return F.transform(starts(s["w"]), part)

    rows = paragraphs
    if anchored:  # cheap test before words are cut; every anchored window passes it
        rows = rows.filter(F.exists("lines", lambda x: x.rlike("(?iu)" + "|".join(sorted({a[:5] for a in ANCHORS})))))
    keys = [c for c in rows.columns if c not in ("first_line", "lines")]
    made = _bound(cut(F.col("lines")), lambda s: _bound(pairs_of(s["w"]), lambda p: parts(s, p)) if grams else parts(s))
    held = "s.grams" if grams else "s.words"
    out = rows.select(*keys, "first_line", F.explode(made).alias("s")).filter(F.size(held) > 0)
    return out.select(*keys, "s.k", held, (F.col("first_line") + F.col("s.a")).alias("first_line"),
                      (F.col("first_line") + F.col("s.b")).alias("last_line"))


def words_in(grams: Column) -> Column:
    """The words that ``grams`` begin with: n of them before n - 1 pairs."""
    return F.slice(grams, F.lit(1), ((F.size(grams) + 1) / 2).cast("int"))


def with_grams(windows: DataFrame) -> DataFrame:
    return windows.withColumn("grams", F.concat("words", pairs_of(F.col("words"))))


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[-.][^\W_]+)*", text.lower())


def _pairs(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True)})


def shares(pairs: Column) -> Column:
    """By family, in order: largest share of a template's word pairs that ``pairs`` holds."""
    def share(text):
        own = _pairs(text)
        return F.size(F.array_intersect(pairs, F.array(*[F.lit(x) for x in own]))) / F.lit(float(len(own)))
    return F.array(*[F.array_max(F.array(*[share(t) for n, t in TEMPLATES if n == name])) for name in FAMILIES])


def _variants() -> list[tuple[str, str, bool]]:
    """(text, class, held out) made from the fixed wordings."""
    rows = []
    for name, text in TEMPLATES:
        w = _words(text)
        gaps = range(1, len(w) - 1, 1 + len(w) // 12)
        forms = [w, w[1:], w[:-1], *[w[:i] + w[i + 1:] for i in gaps]]
        forms += [w[i:i + STEP] for i in range(0, len(w) - STEP + 1, 6)]
        rows += [(" ".join(f), name, i % 4 == 2) for i, f in enumerate(forms) if len(f) > 2]
        rows += [(" ".join(f), UNKNOWN, i == 2) for i, f in enumerate((w[::-1], w[1::2] + w[::2], w[::2] + w[1::2]))]
    for text in UNKNOWN_WORDINGS:
        w = _words(text)
        rows += [(" ".join(f), UNKNOWN, False) for f in (w, w[1:], w[:-1], *[w[:i] + w[i + 1:] for i in range(1, len(w) - 1)])
                 if len(f) > 2]
    rows += [(" ".join(_words(t)), UNKNOWN, True) for t in UNKNOWN_HELD_OUT]
    return rows + [(t, NONE, False) for t in PLAIN]


def learning_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """(words, family, held_out): variants alone and inside prose, prose alone and with an anchor put in."""
    spark = docs.sparkSession
    made = spark.createDataFrame([(i, *v) for i, v in enumerate(_variants())], "n long, text string, family string, held_out boolean")
    made = made.withColumn("own", F.split("text", " "))
    some = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    prose = windows_of(paragraphs_of(docs.join(F.broadcast(some), "doc_id", "left_semi")), anchored=False)
    prose = prose.filter(~F.arrays_overlap("words", F.array(*[F.lit(a) for a in ANCHORS]))).select("words").distinct()
    prose = prose.orderBy(F.xxhash64("words"), "words").limit(sample_windows)
    # the window below sorts at most ``sample_windows`` rows
    prose = saved(prose.select("words", (F.row_number().over(Window.orderBy(F.xxhash64("words"), "words")) - 1).alias("n")))
    # each variant inside ``COPIES`` pieces of prose: behind it, in its midst and before it
    spots = made.select("own", "family", "held_out", F.posexplode(F.sequence(F.col("n") * COPIES, (F.col("n") + 1) * COPIES - 1))
                        .alias("side", "n")).withColumn("n", F.pmod("n", F.lit(max(prose.count(), 1))))
    before = F.col("side") * 12
    inside = spots.join(prose, "n").select(F.concat(F.slice("words", F.lit(1), before), "own", F.slice(
        "words", before + 1, 24 - before)).alias("words"), "family", "held_out")
    put = F.get(F.array(*[F.lit(a) for a in ANCHORS if not a.startswith(("licen", "copyr"))]), (F.col("n") % 30).cast("int"))
    with_anchor = F.concat(F.slice("words", 1, 20), F.array(put), F.slice("words", 21, WINDOW))
    none = prose.select(F.explode(F.array("words", with_anchor)).alias("words"), F.lit(NONE).alias("family"),
                        (F.col("n") % 4 == 3).alias("held_out"))
    return made.select(F.col("own").alias("words"), "family", "held_out").unionByName(inside).unionByName(none)


def _softmax(raw: Column, temperature: float) -> Column:
    def norm(x):
        top = F.array_max(x)
        e = F.transform(x, lambda v: F.exp((v - top) / F.lit(temperature)))
        return let(e, lambda y: let(F.aggregate(y, F.lit(0.0), lambda a, v: a + v), lambda s: F.transform(y, lambda v: v / s)))
    return let(raw, norm)


def _known(p: Column) -> Column:
    return F.slice(p, 1, len(FAMILIES))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> Scanner:
    """Classifier from the learning rows, calibrated on the rows held out."""
    at = F.element_at(F.create_map(*[F.lit(x) for i, n in enumerate(CLASSES) for x in (n, float(i))]), F.col("family"))
    rows = with_grams(learning_rows(docs, sample_docs, sample_windows)).withColumn("label", at)
    weight = F.when(F.col("family") == NONE, 0.5).when(F.col("family") == UNKNOWN, 2.0).otherwise(4.0)
    rows = saved(rows.select("grams", "label", "held_out", weight.alias("weight")))
    tf = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    lr = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.3, maxIter=60, weightCol="weight",
                            standardization=False)
    model = Pipeline(stages=[tf, lr]).fit(rows.filter(~F.col("held_out")))
    held = model.transform(rows.filter("held_out")).select("label", vector_to_array("rawPrediction").alias("raw"))
    own = (F.col("label") + 1).cast("int")
    loss = held.agg(*[F.avg(-F.log(F.greatest(F.element_at(_softmax(F.col("raw"), t), own), F.lit(1e-12)))).alias(f"t{i}")
                      for i, t in enumerate(TEMPERATURES)]).first()
    temperature = min(zip((x if x is not None else 0.0 for x in loss), TEMPERATURES, strict=True))[1]
    p = held.select("label", _softmax(F.col("raw"), temperature).alias("p"))
    p = p.select("label", _known(F.col("p")).alias("known"), F.element_at("p", -1).alias("none"), F.array_max("p").alias("top"))
    best = F.array_max("known")
    like = F.col("none") < F.col("top")
    right = F.array_position("known", best) == F.col("label") + 1
    is_known, is_unknown = F.col("label") < len(FAMILIES), F.col("label") == len(FAMILIES)
    score = p.agg(*[(F.avg(F.when(is_known, (like & right & (best >= t)).cast("double")))
                     + F.avg(F.when(is_unknown, (like & (best < t)).cast("double")))).alias(f"s{i}")
                    for i, t in enumerate(THRESHOLDS)]).first()
    threshold = max(zip((x if x is not None else 0.0 for x in score), THRESHOLDS, strict=True))[1]
    return Scanner(model, temperature, threshold)


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, para_no, first_line, last_line, passage, family, probability, template_score, confirmed, held)."""
    windows = windows_of(paragraphs_of(docs), anchored=False, grams=True)
    keys = ("row_no", "doc_id", "para_no", "k", "grams", "first_line", "last_line")
    # a filter on the scores would score each window again for every use of them; a generator scores it once.
    # Probabilities keep the order of the raw scores, so no window is lost before they are calibrated.
    beaten = F.filter(F.array(vector_to_array("rawPrediction")), lambda r: F.element_at(r, -1) < F.array_max(r))
    raw = scanner.model.transform(windows).select(*keys, F.explode(beaten).alias("raw"))
    scored = raw.withColumn("p", _softmax(F.col("raw"), scanner.temperature))
    like = scored.filter(F.element_at("p", -1) < F.array_max("p")).select(
        "row_no", "doc_id", "para_no", "k", words_in(F.col("grams")).alias("words"), "first_line", "last_line",
        _known(F.col("p")).alias("known"), F.element_at("p", len(CLASSES) - 1).alias("other"))
    order = Window.partitionBy("row_no", "para_no").orderBy("k")  # one paragraph's licence-like windows
    apart = (F.col("k") - F.lag("k", 1, -9).over(order) > 1).cast("int")
    like = like.withColumn("apart", apart).withColumn("run", F.sum("apart").over(order))
    runs = like.groupBy("row_no", "para_no", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"),
        F.array_sort(F.collect_list(F.struct("k", "words", "known", "other"))).alias("parts"))
    words = F.flatten(F.transform("parts", lambda s, i: F.when(i == 0, s["words"]).otherwise(
        F.slice(s["words"], WINDOW - STEP + 1, STEP))))
    # highest probability of each family over the windows
    peak = F.aggregate("parts", F.array_repeat(F.lit(0.0), len(FAMILIES)),
                       lambda a, s: F.zip_with(a, s["known"], lambda x, y: F.greatest(x, y)))
    out = runs.select("doc_id", "para_no", "first_line", "last_line", words.alias("words"), peak.alias("peak"),
                      F.array_max(F.transform("parts", lambda s: s["other"])).alias("other"))
    names = F.array(*[F.lit(n) for n in FAMILIES])
    best = F.array_max("peak")
    sure = best >= scanner.threshold
    place = F.array_position("peak", best).cast("int")
    out = out.select("*", sure.alias("sure"), place.alias("place"), F.round(F.when(sure, best).otherwise(
        F.greatest(best, "other")), 6).alias("probability"), shares(F.array_distinct(pairs_of(F.col("words")))).alias("shares"))
    score = F.when(F.col("sure"), F.round(F.element_at("shares", F.col("place")), 6)).otherwise(0.0)
    held = F.filter(F.transform(names, lambda n, i: F.when(F.get(F.col("shares"), i) >= CONFIRM, n)), lambda n: n.isNotNull())
    return out.select("doc_id", "para_no", "first_line", "last_line", F.array_join("words", " ").alias("passage"),
                      F.when(F.col("sure"), F.element_at(names, F.col("place"))).otherwise(UNKNOWN).alias("family"),
                      "probability", score.alias("template_score"), (score >= CONFIRM).alias("confirmed"), held.alias("held"))


@register("op7_license_scan")
def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))
