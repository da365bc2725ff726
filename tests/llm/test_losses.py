"""Small cases in which earlier versions lost rows, words or languages."""

import numpy as np

from ranklift.llm import langid, mixing, substring

ROW = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_repeated_document_does_not_push_languages_out(spark):
    rows = [(k, f"die der und {k} nicht", "qq", "s", 1) for k in range(30)] + [(100 + k, f"the and of {k} with", "zz", "s", 1) for k in range(30)]
    rows += [(500, "la le de et un", "aa", "s", 1)] * 420
    model = langid.train(spark.createDataFrame(rows, ROW))
    assert model.languages == ["aa", "qq", "zz"]
    assert 0.06 < model.temperature < 19  # not the end of its search
    got = langid.identify(spark.createDataFrame([(1, "\U0001F600 \U0001F680"), (2, "der und nicht"), (3, "the of and")], "doc_id long, text string"), model)
    assert {r.doc_id: (r.lang_pred, r.score == 0) for r in got.collect()} == {1: ("und", True), 2: ("qq", False), 3: ("zz", False)}


def test_weights_are_summed_in_pieces():
    rng = np.random.default_rng(3)
    weight = rng.normal(size=(50, 7)).astype(np.float32)
    size = rng.integers(0, 40, 25)
    first = np.r_[0, np.cumsum(size)]
    slots = rng.integers(0, 50, first[-1])
    want = np.array([weight[slots[a:z]].sum(axis=0, dtype=float) for a, z in zip(first[:-1], first[1:], strict=True)])
    for cells in (7, 50, 1 << 20):
        assert np.allclose(langid._sums(weight, slots, first, cells), want)


PASSAGE = " ".join(f"p{k}x" for k in range(60)) + "."


def test_two_texts_of_one_id_and_rows_without_id_are_documents_of_their_own(spark):
    intro = " ".join(f"intro{k}" for k in range(12)) + ". "
    other = " ".join(f"z{k}" for k in range(90)) + "."
    rows = [(1, "First here. " + PASSAGE), (9, intro + PASSAGE), (9, other), (None, PASSAGE + " A tail of some words."), (None, other + " More.")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], ROW)
    got = {(r.doc_id, r.text) for r in substring.remove_repeats(docs).collect()}
    tails = {t for i, t in got if i is None}
    assert (1, "First here. " + PASSAGE) in got and (9, other) in got
    assert {t.strip() for i, t in got if i == 9} == {intro.strip(), other}
    assert {t.strip() for t in tails} == {"A tail of some words.", "More."}
    spans = substring.repeated_spans(docs).collect()
    assert sorted((r.doc_id is None, r.kept_doc_id) for r in spans) == [(False, 1), (True, 1), (True, 9)]


def test_repeated_rows_share_all_words(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1)] * 1000 + [(2, " ".join("w" * 50), "en", "s", 1)]
    got = mixing.mix_report(spark.createDataFrame(rows, ROW)).collect()
    assert len(got) == 1001 and sum(r.taken for r in got) == 10575
    assert max(r.taken for r in got if r.doc_id == 1) - min(r.taken for r in got if r.doc_id == 1) <= 1
    assert all(r.taken <= 2 * r.size and (len(r.shards) > 0) >= (r.taken > 0) for r in got)
