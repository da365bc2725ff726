"""Solvers over packed rows, TF-IDF entries, first rows by hash, and what they spare."""

import os

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ranklift.functions.scalars import hash_bigint
from ranklift.operators import bpe, features, models, ordering, solvers, splits
from ranklift.operators import text as T
from ranklift.session import ensure_checkpoint_dir


def _rows(spark, n=400, d=6):
    r = np.random.default_rng(3)
    x = np.where(r.random((n, d)) < 0.5, r.normal(size=(n, d)), 0.0)
    y = (r.random(n) < 1 / (1 + np.exp(-(x @ np.arange(-2, d - 2) * 0.5 - 0.3)))).astype(int)
    kind = StructType([StructField("row_id", LongType()), StructField("query_id", LongType()), StructField("y", IntegerType()), StructField("v", VectorUDT())])
    rows = [(i, i // 4, int(y[i]), Vectors.dense(x[i]) if i % 2 else Vectors.sparse(d, [(j, x[i, j]) for j in np.flatnonzero(x[i])])) for i in range(n)]
    return spark.createDataFrame(rows, kind).repartition(3), x, y


@pytest.mark.parametrize(("direct", "wide"), [(2048, 256), (2048, 2), (2, 2)])
def test_newton_meets_the_minimum_of_mllib(spark, monkeypatch, direct, wide):
    monkeypatch.setattr(solvers, "DIRECT", direct)
    monkeypatch.setattr(solvers, "WIDE", wide)
    monkeypatch.setattr(solvers, "DIRECT_SUM", 8)
    df, x, y = _rows(spark)
    want = LogisticRegression(featuresCol="v", labelCol="y", regParam=1 / 400, standardization=False, maxIter=500, tol=1e-12).fit(df)
    got = solvers.fit_logistic(df, "v")
    assert np.allclose(got.weights, want.coefficients.toArray(), atol=2e-2 if direct == 2 else 1e-4) and got.intercept == pytest.approx(want.intercept, abs=2e-2)
    p = {r.row_id: r.p for r in got.transform(df, "v").collect()}
    assert np.allclose([p[i] for i in range(400)], 1 / (1 + np.exp(-(x @ got.weights + got.intercept))))
    assert not [f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if f.startswith("blocks")]


def test_one_class_and_bad_labels(spark):
    df, _, _ = _rows(spark, 40)
    assert {r.p for r in solvers.fit_logistic(df.withColumn("y", F.lit(1)), "v").transform(df, "v").collect()} == {1.0}
    for bad in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            solvers.fit_logistic(df.withColumn("y", bad), "v")
    with pytest.raises(ValueError):
        solvers.fit_logistic(df.where("y = 7"), "v")


def test_layers_learn_what_no_line_can(spark):
    r = np.random.default_rng(0)
    x = r.uniform(-1, 1, (600, 2))
    rows = [(i, i, int(x[i, 0] * x[i, 1] > 0), [0, 1], x[i].tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "row_id long, query_id long, y int, indices array<int>, values array<double>")
    df = df.select("row_id", "query_id", "y", F.struct("indices", "values").alias("features_sparse")).withMetadata("features_sparse", {"size": 2})
    got = models.mlp_tabular(df, df, hidden=8, max_iter=100).collect()
    assert np.mean([(r.p > 0.5) == (r.y == 1) for r in got]) > 0.9


def test_sparse_features_are_those_of_the_vector(spark, sf_small):
    from ranklift.sources.fixtures import impressions
    df = impressions(spark, sf_small).limit(300).cache()
    d = features.FeatureEstimator().fit(df).transform(df)
    size = d.schema["features_sparse"].metadata["size"]
    for r in d.select("features_sparse", "features_linear").collect():
        assert np.allclose(solvers.dense(1, size, np.zeros(len(r[0].indices), int), np.array(r[0].indices), np.array(r[0].values))[0], r[1].toArray())


def test_tfidf_entries_and_document_counts(spark):
    rows = [("a", "Red fish red"), ("a", "blue red fish"), ("b", "red fish"), ("c", None), (None, "red sky"), ("d", ""), (None, "sky")]
    docs = spark.createDataFrame(rows, "row_id string, t string")
    want = T.term_counts(docs, "row_id", "t").groupBy("term").count()
    assert {tuple(r) for r in T.document_counts(docs, "row_id", "t").collect()} == {tuple(r) for r in want.collect()}
    vocab = T.fit_tfidf(docs, "row_id", "t", 1)
    known = docs.where("t is not null").repartition(1)
    for a, b in zip(T.tfidf_entries(known, vocab, "row_id", "t").collect(), T.tfidf_vectors(known, vocab, "row_id", "t").collect(), strict=True):
        assert a.tfidf.indices == list(b.tfidf.indices) and np.allclose(a.tfidf["values"], b.tfidf.values)
    assert T.tfidf_entries(docs, vocab, "row_id", "t").where("t is null").first().tfidf.indices == []


def test_svd_of_vectors_is_that_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(solvers, "DIRECT_SUM", 100)
    r = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in r.integers(0, 12, 8))) for i in range(80)], "row_id long, t string")
    vocab = T.fit_tfidf(docs, "row_id", "t", 2, bigrams=False)
    v = T.tfidf_entries(docs, vocab, "row_id", "t", bigrams=False)
    weights = T.tfidf(docs, vocab, "row_id", "t", bigrams=False)
    one, two = T.vector_svd(v, "tfidf", vocab, k=5, rounds=8), T.truncated_svd(weights, "row_id", k=5, rounds=8)
    assert np.allclose(one.values, two.values)
    want = {x.row_id: x.v for x in two.transform(weights, "row_id").collect()}
    for x in v.withColumn("c", one.coordinates(solvers.vector_parts(v, "tfidf"))).collect():
        assert np.allclose(np.abs(x.c), np.abs(want[x.row_id]), atol=1e-6)  # a direction may be turned round


def test_first_rows_by_hash_need_no_sort(spark):
    rows = [(f"k{i % 90}",) for i in range(100)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "row_id string").cache()
    order = sorted((r.row_id is not None, r.h or 0, r.row_id or "") for r in df.select("row_id", hash_bigint("row_id", 42).alias("h")).collect())
    ranks = [0, 1, 3, 4, 50, 51, 102, 103, 200]
    for r, got in zip(ranks, ordering.first_by_hash(df, "row_id", 42, ranks), strict=True):
        assert sorted(x.row_id or "" for x in got.collect()) == sorted(k for *_, k in order[:r])


def test_epoch_keeps_only_the_columns_asked_for(spark):
    df = spark.createDataFrame([(f"r{i}", i % 2 == 0, "x" * 50) for i in range(40)], "row_id string, bought boolean, wide string")
    whole, narrow = splits.epoch_order(df, "row_id", 42, 1), splits.epoch_order(df, "row_id", 42, 1, keep=["bought"])
    assert narrow.columns == ["bought", "pos"] and set(whole.columns) == {"row_id", "bought", "wide", "pos"}
    assert sorted(tuple(r) for r in narrow.collect()) == sorted((r.bought, r.pos) for r in whole.collect())
    import pyarrow.parquet as pq
    assert not [f for f in narrow.inputFiles() if {"wide", "row_id"} & set(pq.read_schema(f.removeprefix("file://")).names)]


def test_permuted_rows_are_scored_once(spark):
    df = spark.createDataFrame([(f"r{i}", f"q{i // 3}", i % 2, float(i)) for i in range(30)], "row_id string, query_id string, y int, x double")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def p(x):
        seen.add(1)
        return x / 100

    got = models.permutation_importance(lambda d: d.withColumn("p", p("x")), df, ["x"], n_repeats=2).collect()
    assert len(got) == 1 and seen.value <= 30 * 6 + 60  # the base rows as often as its metrics read them, the others once


def test_quantile_scaling_by_batch_is_the_expression(spark):
    q = np.array([0.0, 0.0, 1.0, 2.0, 2.0, 2.0, 5.0, 9.0])
    x = [None, -1.0, 0.0, 0.5, 1.0, 1.999, 2.0, 4.0, 5.0, 8.99, 9.0, 12.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in x], "x double").coalesce(1)
    for table in (q, q[:1], np.linspace(-3, 9, 1000)):
        rows = df.select(features.quantile_normal(F.col("x"), table).alias("a"), features.normal_quantile(features.quantile_rank(F.col("x"), table)).alias("b")).collect()
        for r in rows:
            assert (r.a is None) == (r.b is None) and (r.a is None or r.a == pytest.approx(r.b, abs=1e-12))


def test_words_are_encoded_by_number(spark):
    texts = ["abab cd", "", None, "cd abab x!", "ab ab ab"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, t string").coalesce(1)
    words = bpe.word_type_counts(df, ["t"])
    merges = bpe.train_bpe(words, 30)
    vocab = bpe.vocabulary(words, merges)
    ranks, ids = bpe._segmenter(merges, vocab).value
    cuts = [merges.count(), 0, 1]
    tokens = bpe.encoder(merges, vocab, cuts)
    for r in df.select("t", tokens(F.col("t")).alias("ids"), bpe.pretokenize(F.coalesce("t", F.lit(""))).alias("w")).collect():
        want = [[ids[s] for w in r.w for s in bpe._merged(w, ranks, [c])[0]] for c in cuts]
        assert r.ids == want
    plan = df.select(tokens(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
