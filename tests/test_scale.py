"""Sides made once, prepared columns pruned, hashed duplicates, decoding in the row."""

import json

from pyspark.sql import functions as F

from ranklift.operators import audit, bpe, models, splits
from ranklift.operators.features import FeatureConfig, FeatureEstimator
from ranklift.sources.fixtures import impressions


def _tables(spark, sf_small):
    df = impressions(spark, sf_small).limit(600).cache()
    return df, splits.make_splits(df, k=2)


def test_sides_of_assigned_rows_are_those_of_the_assignment(spark, sf_small):
    df, sp = _tables(spark, sf_small)
    rows = splits.with_assignment(df, sp)
    for kw in ({"role": "test"}, {"role": ["train", "valid"]}, {"fold": 0, "fold_side": "train"}, {"fold": 1, "fold_side": "valid"}):
        a, b = splits.side(rows, **kw), splits.apply_assignment(df, sp, **kw)
        assert a.select(*df.columns).exceptAll(b.select(*df.columns)).isEmpty() and a.count() == b.count()
        assert "Join" not in a._jdf.queryExecution().executedPlan().toString()


def test_prepared_folds_keep_only_what_the_models_read(spark, sf_small):
    df, sp = _tables(spark, sf_small)
    folds = models.PreparedFolds(df, sp, limit=1, columns=models._union([models.BASELINES["gbdt_tabular"].columns, ()]))
    tr, va, n_train, n_eval = folds.get(0, FeatureConfig())
    assert tr.columns == va.columns == ["row_id", "query_id", "y", "features_tree"]
    assert tr.schema["features_tree"].metadata["ml_attr"] and n_train + n_eval == sp.where("role <> 'test'").join(df, "query_id").count()
    folds.close()
    assert models._union([("a",), None]) is None


def test_features_need_no_texts(spark, sf_small):
    df, _ = _tables(spark, sf_small)
    whole, bare = (FeatureEstimator().fit(d).transform(d).select("row_id", F.col("features_linear").cast("string").alias("v"))
                   for d in (df, df.drop("title", "description", "ingredients")))
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in bare.collect()}


def test_duplicates_by_hash(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (None, 1, 0.0), (None, 1, float("nan")), (None, 1, float("nan")), (2, 2, 2.0), (1, None, 0.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    n = lambda d, s=None: spark.range(1).select(audit.duplicate_count(d, s).alias("n")).first().n
    assert n(df) == 3 and n(df, ["a", "b"]) == 4 and n(df.where("a = 2")) == 0 and n(df.where("a = 9")) is None


def test_decoding_in_the_row(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate([*bpe.SPECIALS, "a", "\"b\\", "é", "\U0001F600", "ab"])], "token string, id int")
    enc = spark.createDataFrame([("x", [2, 4, 5, 3, 6, 3]), ("y", [2, 3, 3]), ("z", [2, 8, 1, 7, 99]), ("w", [2, 4, 3]), ("w", [2, 6, 8])],
                                "k string, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decoded(enc, "k", vocab).collect()}
    assert got == {"x": "a\"b\\é", "z": "ab\U0001F600", "w": "aéab"}, json.dumps(got)
    assert "BroadcastHashJoin" not in bpe.decoded(enc, "k", vocab)._jdf.queryExecution().executedPlan().toString()


def test_index_of_the_planned_pairs_gives_the_same_changes():
    words, freqs = [[1, 2, 1, 2, 3], [2, 3, 1, 2], [1, 1, 2, 3]], [3, 2, 5]
    plan = [((1, 2), 10), ((10, 3), 11), ((2, 3), 12), ((10, 10), 13)]
    whole, some = bpe.PairIndex([list(w) for w in words], freqs), bpe.PairIndex([list(w) for w in words], freqs, {p for p, _ in plan})
    assert [whole.merge(*m) for m in plan] == [some.merge(*m) for m in plan] and whole.words == some.words
