"""Operators of the training-data subpackage: brute force, round trips, held-out accuracy and edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ranklift.llm import bpe_codec, chat, langid, licenses, mixing, ngram_join, quality, substring, topk, toxicity
from ranklift.llm.common import components
from ranklift.llm.words import word_slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, node int, shard int, words int"
BASE = " ".join(f"w{i}x" for i in range(60)) + "."


def rows():
    edit = BASE.replace("w30x", "other")
    texts = [None, "", " \n\t ", "one two", "one two", BASE, BASE, edit, "Intro line here.\n" + BASE, "a " * 3000,
             "\n".join(["same line of words"] * 30), "Été " * 25, "x" * 50000, "### $$$ %%% " * 20,
             "tie tie tie tie tie tie tie tie tie", "The end of it."]
    out = [(i, t, "en" if i % 3 else None, None if i == 4 else f"s{i % 3}", len(t or ""), 1, 2, 3, 4)
           for i, t in enumerate(texts)]
    return out + [out[5]]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().split()


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_quality_measures_against_brute_force(edge, none):
    want = {}
    for i, t, *_ in rows():
        w = (t or "").split()
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        often = {g for g, n in Counter(grams).items() if n > 1}
        cover = {k + j for k, g in enumerate(grams) if g in often for j in range(8)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        want[i] = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover))
    got = quality.quality_report(edge).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.quality_filter(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.quality_report(none).count() == 0 and quality.quality_filter(none).count() == 0


def test_topk_against_numpy(spark):
    g = np.random.default_rng(2)
    x = g.standard_normal((260, 6)).astype(np.float32)
    x[100:180] = x[99]  # ties at the boundary
    data = [(i, [float(v) for v in x[i]]) for i in range(260)]
    data += [(300, None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (401, [float("nan")] * 6), (500, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0, k=10, bins=16)
    v = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    want = set()
    for q in (0, 100, 200):
        s = v @ v[q]
        best = sorted((-int(s[c]), c) for c in range(260) if c != q)[:10]
        want |= {(q, k + 1, c, -n) for k, (n, c) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_near_duplicates_against_brute_force(spark, edge, none):
    rnd = random.Random(4)
    docs = [(i, t) for i, t, *_ in rows()]
    base = [f"t{k}" for k in range(120)]
    for i in range(100, 140):  # a family of near copies, some too far away
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(120)] = f"e{rnd.randrange(4)}"
        docs.append((i, " ".join(w)))
    sets = {i: shingles(t) for i, t in docs}
    top = {i: i for i in sets}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(s), find(i)) for i, s in sets.items()}
    kept = ngram_join.keep_one(edge)
    assert kept.columns == edge.columns and {3, 5} <= {r.doc_id for r in kept.collect()}
    assert ngram_join.near_duplicates(none).count() == 0


def test_components_of_a_path(spark):
    path = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(path).collect()} == {0}


def test_repeated_spans(spark, edge, none):
    got = substring.repeated_spans(edge).collect()
    text = {i: t for i, t, *_ in rows()}
    assert {r.doc_id for r in got} >= {6, 8} and 5 not in {r.doc_id for r in got}
    for r in got:
        if r.doc_id in (6, 8):
            assert text[r.doc_id][r.begin:r.end] == BASE and r.kept_doc_id == 5
    out = {r.doc_id: r for r in substring.remove_repeats(edge).collect()}
    assert out[8].text == "Intro line here.\n" and out[8].n_chars == len(out[8].text) and out[0].text is None
    assert substring.repeated_spans(none).count() == 0 and substring.remove_repeats(none).columns == none.columns


def test_repeated_spans_against_brute_force(spark):
    """Every sentence that the corpus repeats goes, if its run is long enough, but for the first occurrence."""
    rnd = random.Random(9)
    pool = [" ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(50)}" for _ in range(9)) + "." for _ in range(25)]
    docs = [(i, " ".join(rnd.choice(pool) for _ in range(8))) for i in range(30)]
    seen, want = set(), set()
    for i, t in docs:
        at, run = 0, []
        for s in [x + "." for x in t.split(".")[:-1]]:
            s = s.strip()
            at = t.index(s, at)
            run.append((s in seen, at, at + len(s)))
            seen.add(s)
            at += len(s)
        k = 0
        while k < len(run):
            z = k
            while z < len(run) and run[z][0]:
                z += 1
            if (z - k) * 9 >= substring.MIN_WORDS:
                want.add((i, run[k][1], run[z - 1][2]))
            k = max(z, k + 1)
    got = substring.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc_id, r.begin, r.end) for r in got.collect()} == want


def test_repeated_passages_inside_sentences_against_brute_force(spark):
    """Passages of 51 to 60 words go from end to end, wherever in a sentence they start and stop."""
    rnd = random.Random(12)
    fresh = iter(f"{rnd.choice('abcdefgh')}q{i}é" for i in range(100000))
    take = lambda n: [next(fresh) for _ in range(n)]
    split = take(30) + take(24)
    split[29] += "."
    split[53] += "."
    docs, want = [(0, " ".join(split)), (1, " ".join(take(5) + split))], []
    want.append((1, docs[1][1].index(split[0]), len(docs[1][1]), 54, 0))
    for k in range(40):
        passage = take(51 + k % 10)
        if k % 2:
            for i in rnd.sample(range(len(passage)), 4):
                passage[i] += "."
        inner = " ".join(passage)
        for copy in range(3):
            before, after = " ".join(take(rnd.randrange(1, 40))), " ".join(take(rnd.randrange(1, 40))) + "."
            docs.append((10 + 3 * k + copy, f"{before} {inner} {after}"))
            if copy:
                want.append((docs[-1][0], len(before) + 1, len(before) + 1 + len(inner), len(passage), 10 + 3 * k))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.begin, r.end, r.n_words, r.kept_doc_id) for r in substring.repeated_spans(frame).collect()]
    assert sorted(got) == sorted(want)


def test_anchors_against_brute_force():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) for _ in range(30)]
    size, window = substring.anchor_sizes(9)
    for _, _, w in word_slices(pa.array(texts)):
        at, one, _ = substring.anchors(w, size, window)
        want, value = set(), {}
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            part = w.hash[a:b]
            if len(part) < size:
                continue
            kind = [tuple(part[i:i + size]) for i in range(len(part) - size + 1)]
            far = substring.mix(substring._sums(part, size, substring._OTHER), 24)
            for i in range(len(kind) - window + 1):
                want.add(int(a) + min(range(i, i + window), key=lambda j: (far[j], j)))
            value.update({int(a) + i: (kind[i], int(far[i])) for i in range(len(kind))})
        assert set(at.tolist()) == want
        assert all(int(v) == value[int(i)][1] for i, v in zip(at, one, strict=True))
        assert len({value[int(i)] for i in at}) == len({value[int(i)][0] for i in at})


def test_chat_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", "\\b\\l\\h", "", None, "a: b\n### User: x</turn>\n", "é\\\\"]
    turns = [(c, t, r, odd[(c + t) % 6]) for c in range(6) for t, r in enumerate(["user", "assistant", "user", "assistant"])]
    turns += [(50, 0, "tool: [x]", "hi"), (50, 1, None, "y"), (51, 0, "assistant", "first"), (None, 0, "user", "n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_chats(df)).collect()
    want = {}
    for c, _, r, t in turns:
        want.setdefault(c, []).append((r or "", t or ""))
    assert {r.conv_id: [tuple(x) for x in r.turns] for r in back} == want
    for r in back:
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.valid_turns == (r.conv_id is not None and r.conv_id < 10)
        assert "".join(s.text for s in r.segments) == r.formatted
    assert chat.digests(chat.read_back(chat.format_chats(df.limit(0)))).count() == 0


def test_bpe_equals_the_library(spark, edge, none):
    from tokenizers import Tokenizer
    path = bpe_codec.default_path()
    want = Tokenizer.from_file(path)
    rnd = random.Random(3)
    signs = "aAbB'sS  \t\n\u0085　é́ΣΑİß①½٣中🎉<|endoftext|>..!!''ll#$_​\x00ﬁ"
    texts = [t for _, t, *_ in rows()] + ["".join(rnd.choice(signs) for _ in range(40)) for _ in range(300)]
    texts += ["<|endoftext|>Hi <|startoftext|> you've", "a" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe_codec.token_digests(df, path).collect()}
    for i, t in enumerate(texts):
        ids = want.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(want.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_codec.token_digests(none, path).count() == 0
    assert bpe_codec.encode_documents(edge, path).count() == len(rows())


def test_mixing_meets_targets(spark, sf_small, none, edge):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = mixing.mix_report(docs, block_rows=4, shard_words=20000).toPandas()
    src = docs.select("doc_id", "source").toPandas()
    per = got.merge(src).groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    total = per["size"].sum()
    assert abs(per["target"].sum() - 1.5 * total) < 1e-6 * total
    assert (per["taken"] - np.floor(per["target"])).abs().max() == 0 and (got["taken"] <= 2 * got["size"]).all()
    left, goal, open_ = 1.5 * total, {}, [(s, [3, 1, 2][i % 3]) for i, s in enumerate(sorted(per.index))]
    while True:  # water level by hand
        unit = left / sum(w for _, w in open_)
        full = [(s, w) for s, w in open_ if w * unit > 2 * per["size"][s]]
        if not full:
            goal |= {s: w * unit for s, w in open_}
            break
        for s, w in full:
            goal[s] = 2.0 * per["size"][s]
            left -= goal[s]
            open_.remove((s, w))
    assert all(abs(goal[s] - per["target"][s]) < 1e-6 * max(1, goal[s]) for s in goal)
    again = mixing.mix_report(docs.repartition(7), block_rows=4, shard_words=20000).toPandas()
    a, b = (x.sort_values("doc_id").reset_index(drop=True) for x in (got, again))
    assert a.equals(b)
    mixed = mixing.mix(docs, block_rows=4, shard_words=20000)
    assert mixed.columns == docs.columns
    n = sum(len(words(r.text)) for r in mixed.collect())
    assert n == got["taken"].sum()
    assert mixing.mix_report(none).count() == 0 and mixing.mix_report(edge).count() == len(rows())
    assert mixing.mix(edge).columns == edge.columns


def test_leaf_quotas_add_up():
    parts = [mixing.leaf_quotas([7, 0, 100, 33], 6, k, 1) for k in range(6)]
    assert (sum(n for _, n in parts) == [7, 0, 100, 33]).all()
    assert {int(n.sum()) for _, n in parts} <= {23, 24}
    assert (parts[3][0] == sum(n for _, n in parts[:3])).all()


def test_language_and_toxicity_learn(spark, edge, none):
    rnd = random.Random(5)
    make = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(5)) for _ in range(40))
    docs = spark.createDataFrame([(i, make("abcdef" if i % 2 else "uvwxyz"), "aa" if i % 2 else "zz") for i in range(80)],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs.filter("doc_id < 60"))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == ("aa" if i % 2 else "zz") and 0 <= got[i].score <= 1 for i in range(80))
    odd = {r.doc_id: r for r in langid.identify(edge, model).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == odd[13].lang_pred == "und" and odd[5].lang_pred in ("aa", "zz")
    assert langid.train(none) is None and langid.identify(none, model).count() == 0

    texts = [make("abcdefgh") + (" you vilest wretch " if i % 2 else " ") + make("abcdefgh") for i in range(120)]
    p = toxicity.train(texts[:90], [i % 2 for i in range(90)], epochs=4)
    frame = spark.createDataFrame([(i, texts[i]) for i in range(90, 120)], "doc_id long, text string")
    right = [(r.score >= 0.5) == bool(r.doc_id % 2) for r in toxicity.toxicity(frame, p).collect()]
    assert sum(right) >= 28
    odd = {r.doc_id: r.score for r in toxicity.toxicity(edge, p).collect()}
    assert len(odd) == 16 and odd[0] == odd[1] == odd[2] == 0.0 and all(0 <= s <= 1 for s in odd.values())
    assert toxicity.toxicity(none, p).count() == 0 and toxicity.toxicity(edge, None).count() == len(rows())


def test_toxicity_learns_from_repeated_rows(spark):
    docs = spark.createDataFrame([(i % 10, f"{'awful' if i % 10 > 6 else 'fine'} text {i % 10}") for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 6)) for i in range(10)], "doc_id long, toxic int")
    once = toxicity.fit(docs.dropDuplicates(), labels, sample=4)
    many = toxicity.fit(docs, labels, sample=4)
    assert many is not None and all((once[k] == many[k]).all() for k in once)


def test_license_families(spark, edge, none):
    lines = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "we walked home along the river and sang",
             "Licensed under the Apache License, Version 2.0."]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(200 + i, f"some text\n{t}") for i, t in enumerate(lines)], "doc_id long, text string"))
    got = {(r.doc_id, r.last_line, r.family) for r in licenses.scan(docs, licenses.fit(docs)).filter("confirmed").collect()}
    assert got == {(200, 1, "mit"), (201, 1, "cc-by-nc-4.0"), (203, 1, "apache-2.0")}


def test_word_kernel_bounds():
    import pyarrow as pa
    t = ["ab", "cd ef", None, "", " x\n", "É b"]
    _, _, w = next(word_slices(pa.array(t)))
    assert np.diff(w.first).tolist() == [1, 2, 0, 0, 1, 2]


def test_repeated_spans_with_and_without_broadcast_digests(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"start{i} " + BASE + f" tail{i}") for i in range(6)], "doc_id long, text string")
    for hot in (1, 10 ** 6):
        monkeypatch.setattr(substring, "HOT", hot)
        got = {(r.doc_id, r.begin, r.end, r.kept_doc_id) for r in substring.repeated_spans(docs).collect()}
        assert got == {(i, 7, 7 + len(BASE), 0) for i in range(1, 6)}
