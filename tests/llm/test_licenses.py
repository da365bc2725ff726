"""Licence scan: wrapped notices, unknown wordings, held-out variants, windows by brute force, edge cases."""

import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from ranklift.llm import licenses as L

PROSE = "the river ran past the mill and the people of the town went down to see the boats come in".split()
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met:",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                 "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                 "binary, for any purpose, commercial or non-commercial, and by any means.",
}
ODD = ["All rights reserved.", "Used under the terms of the Harbour Press License, version 7.",
       "This text is licensed to readers of the weekly by its editors."]
LINES = {"mit": "Released under the MIT License.", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
         "apache-2.0": "Licensed under the Apache License, Version 2.0.",
         "gpl-3.0": "This work is licensed under the GNU General Public License, version 3."}


def prose(rng, n):
    return " ".join(rng.choice(PROSE) for _ in range(n))


@pytest.fixture(scope="module")
def plain(spark):
    rng = random.Random(3)
    return spark.createDataFrame([(i, "\n".join(prose(rng, rng.randint(1, 60)) for _ in range(4))) for i in range(60)],
                                 "doc_id long, text string")


@pytest.fixture(scope="module")
def scanner(plain):
    return L.fit(plain)


def found(scanner, spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return L.scan(docs, scanner).collect()


def test_wrapped_notices_are_confirmed(spark, scanner):
    cases = [(name, "\n".join(textwrap.wrap(t, width, initial_indent=pre, subsequent_indent=pre)))
             for name, t in NOTICES.items() for width in (30, 72) for pre in ("", " * ")]
    got = found(scanner, spark, [f"Some title\n\n{t}\n\nsome other words" for _, t in cases])
    assert {(r.doc_id, r.family) for r in got if r.confirmed} == {(i, n) for i, (n, _) in enumerate(cases)}
    for r in got:
        assert r.para_no == 1 and (r.first_line, r.last_line) == (2, 1 + len(cases[r.doc_id][1].split("\n")))


def test_lines_inside_prose_and_unknown_wordings(spark, scanner):
    rng = random.Random(5)
    known = [(n, f"{prose(rng, a)}\n{t}\n{prose(rng, b)}") for n, t in LINES.items() for a, b in ((40, 0), (9, 70), (200, 33))]
    odd = [f"{prose(rng, 30)}\n{t}" for t in ODD]
    got = found(scanner, spark, [t for _, t in known] + odd)
    assert {(r.doc_id, r.family) for r in got if r.confirmed} == {(i, n) for i, (n, _) in enumerate(known)}
    assert {(r.doc_id, r.family) for r in got if r.doc_id >= len(known)} == {(len(known) + i, L.UNKNOWN) for i in range(len(odd))}


def test_plain_texts_with_anchor_words_stay_clean(spark, scanner, plain):
    assert L.scan(plain, scanner).count() == 0
    rng = random.Random(6)
    near = ["they bought new software for the office", "the public met at the mill", "she had no permission to go in"]
    assert not found(scanner, spark, [f"{prose(rng, 20)} {t} {prose(rng, 20)}" for t in near])


def test_held_out_variants(spark, plain, scanner):
    rows = L.learning_rows(plain).filter("held_out").distinct()
    p = scanner.model.transform(L.with_grams(rows)).withColumn(
        "p", L._softmax(L.vector_to_array("rawPrediction"), scanner.temperature)).select("family", "p").collect()
    hits, n = {}, {}
    for r in p:
        best = max(r.p[:len(L.FAMILIES)])
        pred = L.NONE if r.p[-1] == max(r.p) else L.FAMILIES[r.p.index(best)] if best >= scanner.threshold else L.UNKNOWN
        kind = r.family if r.family in (L.NONE, L.UNKNOWN) else "known"
        hits[kind], n[kind] = hits.get(kind, 0) + (pred == r.family), n.get(kind, 0) + 1
    share = {k: hits[k] / n[k] for k in n}
    print(share, scanner.temperature, scanner.threshold)
    assert share["known"] >= 0.9 and share[L.UNKNOWN] >= 0.7 and share[L.NONE] >= 0.95


def test_windows_against_brute_force(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(40):
        lines = [" ".join(rng.choice([*PROSE, "license", "x"][:rng.choice((19, 21))]) for _ in range(rng.choice((0, 0, 1, 9, 80))))
                 for _ in range(rng.randint(1, 12))]
        texts.append("\n".join(x if x else rng.choice(("", " \t")) for x in lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        paras, start = [], True
        for n, line in enumerate(t.split("\n")):
            if not line.strip(" \t"):
                start = True
                continue
            if start:
                paras.append([])
            start = False
            paras[-1] += [(w, n) for w in re.findall(r"\w+", line)]
        for para_no, w in enumerate(paras):
            for k in range(max((len(w) + L.STEP - 1) // L.STEP - 1, 1)):
                part = w[k * L.STEP:k * L.STEP + L.WINDOW]
                want.add((i, para_no, k, " ".join(x for x, _ in part), part[0][1], part[-1][1]))
    cols = ["doc_id", "para_no", "k", F.array_join("words", " "), "first_line", "last_line"]
    paras = L.paragraphs_of(docs)
    assert {tuple(r) for r in L.windows_of(paras, anchored=False).select(*cols).collect()} == want
    with_anchor = {x for x in want if set(x[3].split()) & set(L.ANCHORS)}
    assert {tuple(r) for r in L.windows_of(paras).select(*cols).collect()} == with_anchor and with_anchor


def test_edge_cases(spark, scanner):
    t = "Released under the MIT License."
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " \n\t", 0), (None, t, 0), (5, t, 1), (5, t, 1),
                                  (6, "w " * 200000 + t, 2), (7, t + "\nLicensed under CC BY-SA 4.0.", 2)],
                                 "doc_id long, text string, k int")
    got = [(r.doc_id, r.family) for r in L.scan(docs, scanner).filter("confirmed").collect() if r.doc_id != 7]
    assert sorted(got, key=str) == [(5, "mit"), (5, "mit"), (6, "mit"), (None, "mit")]
    both = [r for r in L.scan(docs.filter("doc_id = 7"), scanner).collect()]
    assert [sorted(r.held) for r in both] == [["cc-by-sa-4.0", "mit"]]
    none = docs.filter("doc_id = 99")
    assert L.scan(none, scanner).count() == 0
    assert L.scan(docs.filter("doc_id = 5"), L.fit(none)).count() == 2


def test_wordings_without_any_anchor_are_scored(spark, scanner):
    text = ("Anyone is free to modify, publish, use, compile or sell this, either in source code form or as a compiled binary, "
            "for any purpose, commercial or non-commercial, and by any means.")
    assert not set(L._words(text)) & set(L.ANCHORS)
    assert [r.family for r in found(scanner, spark, [text])] == ["unlicense"]


def test_every_window_is_scored_once(spark, scanner):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, "\n".join(prose(rng, rng.choice((0, 1, 2, 24, 25, 48, 49, 97))) for _ in range(6))) for i in range(30)],
                                 "doc_id long, text string")
    paras = L.paragraphs_of(docs)
    cols = ["doc_id", "para_no", "k", "grams", L.words_in(F.col("grams")).alias("words"), "first_line", "last_line"]
    want = L.with_grams(L.windows_of(paras, anchored=False)).select(*[c if isinstance(c, str) else "words" for c in cols])
    got = L.windows_of(paras, anchored=False, grams=True).select(*cols)
    assert got.count() == want.count() > 60 and got.exceptAll(want).isEmpty()
    plan = L.scan(docs, scanner)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert any("UDF(" in x for x in plan) and not any("UDF(" in x for x in plan if x.lstrip(" :+-*()0123456789").startswith("Filter"))
