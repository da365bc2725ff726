"""The pipeline's stages on a small table, each against its predecessor's rows."""

import hashlib

import corpus_pipeline as cp
import numpy as np

from ranklift.llm import bpe_codec, mixing, ngram_join


def test_null_and_repeated_ids_pass_the_pipeline(spark):
    text = lambda k, n=40: " ".join(f"word{k}x{i}" for i in range(n)) + "."
    rows = [(None, text(k, 40 + k % 2)) for k in range(8)] + [(5, text(20))] * 50 + [(7, text(20)), (None, text(20))]
    rows += [(9, text(30)), (9, text(31, 41)), (None, text(0)), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    single = ngram_join.keep_one(docs)
    want = sorted([text(k, 40 + k % 2) for k in range(1, 8)] + [text(0), text(20), text(30), text(31, 41), ""])
    kept = single.collect()
    assert sorted(r.text for r in kept if r.text is not None) == want and len(kept) == len(want) + 1
    assert [r.doc_id for r in kept if r.text == text(20)] == [5]
    single = single.checkpoint()
    report = mixing.mix_report(single).collect()
    size = sum(len((r.text or "").split()) for r in kept)
    assert sum(r.size for r in report) == size and sum(r.taken for r in report) == size * 3 // 2
    mixed = mixing.mix(cp.substring_dedup(spark, single, "")).collect()
    assert sum(len(r.text.split()) for r in mixed) == size * 3 // 2
    assert {r.text for r in kept if r.text} <= {r.text for r in mixed}


def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, frames = docs.columns, []
    for k, (_, stage) in enumerate(cp.STAGES[:-1]):
        docs = stage(spark, docs, sf_small).checkpoint()
        assert docs.columns == columns, k
        frames.append(docs.toPandas())
    clean, single, cut, mixed = frames
    assert set(single.doc_id) <= set(clean.doc_id) and set(cut.doc_id) == set(single.doc_id)
    assert not single.text.duplicated().any() and (cut.n_chars == cut.text.str.len()).all()
    assert set(mixed.doc_id) <= set(cut.doc_id) and mixed.doc_id.value_counts().max() <= 2
    size = lambda f: f.text.str.encode("utf-8").map(lambda b: len(b.split())).sum()
    assert abs(size(mixed) - 1.5 * size(cut)) <= len(mixed.source.unique())
    codec = bpe_codec.Codec(bpe_codec.load(bpe_codec.default_path()))
    want = sorted(hashlib.sha256(i).hexdigest() for i, _ in codec.encode(list(mixed.text)))
    got = cp.run(spark, sf_small).toPandas()
    assert sorted(got.ids_sha256) == want and np.all(got.n_tokens >= 0)
