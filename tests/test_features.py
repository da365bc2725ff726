"""Fit discipline, unseen values, null as category, one-hot layout, scaler."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ranklift.operators import splits as S
from ranklift.operators.audit import REGISTRY, admitted, check_audit
from ranklift.operators.features import FeatureConfig, FeatureEstimator, feature_coverage, prepare
from ranklift.sources.fixtures import IMPRESSION_COLUMNS, impressions


@pytest.fixture(scope="module")
def parts(spark, sf_small):
    df = impressions(spark, sf_small).cache()
    sp = S.make_splits(df).cache()
    return S.apply_assignment(df, sp, role="train").cache(), S.apply_assignment(df, sp, role="valid").cache()


def test_second_fit_is_an_error(parts):
    train, _ = parts
    est = FeatureEstimator()
    est.fit(train)
    with pytest.raises(RuntimeError):
        est.fit(train)


def test_scaler_uses_population_sd(parts):
    train, _ = parts
    m = FeatureEstimator(FeatureConfig(numeric=("price",))).fit(train)
    got = m.stats.first()
    prices = np.array([r["price"] for r in train.select("price").collect()])
    assert got["mean"] == pytest.approx(prices.mean())
    assert got["sd"] == pytest.approx(prices.std(ddof=0))


def test_unseen_and_null_levels(spark, parts):
    train, valid = parts
    m = FeatureEstimator().fit(train)
    odd = valid.limit(3).withColumn("brand", F.lit("Brand#never")).withColumn("allergens", F.lit(None).cast("string"))
    enc = m.encode(prepare(odd, m.cfg)).collect()
    assert all(r["brand_code"] == 0 for r in enc)
    none_code = m.vocab.where("feature = 'allergens' AND value = 'NONE'").first()
    if none_code is not None:
        assert all(r["allergens_code"] == none_code["code"] for r in enc)


def test_one_hot_has_one_active_slot_per_column(parts):
    train, valid = parts
    m = FeatureEstimator().fit(train)
    out = m.transform(valid).select(vector_to_array("features_linear").alias("a"))
    n_num = len(m.cfg.numeric_cols())
    sums = {round(sum(r["a"][n_num:])) for r in out.collect()}
    assert sums == {len(m.cfg.categorical_cols())}
    width = sum(r["width"] for r in m.layout().collect())
    assert len(out.first()["a"]) == n_num + width


def test_transform_does_not_change_the_model(parts):
    train, valid = parts
    m = FeatureEstimator().fit(train)
    before = sorted(map(tuple, m.vocab.collect()))
    m.transform(valid).count()
    assert sorted(map(tuple, m.vocab.collect())) == before


def test_audit_and_coverage():
    assert check_audit(REGISTRY, list(IMPRESSION_COLUMNS)) == []
    assert check_audit(REGISTRY, list(IMPRESSION_COLUMNS) + ["surprise"]) == ["column without audit: surprise"]
    cov = feature_coverage(admitted(), FeatureConfig())
    assert cov == {"unaccounted": [], "extra": [], "both": []}


def test_quantile_scaler_against_numpy(spark):
    """Exact grid, two-sided interpolation, ties in the middle, clipped tails, null stays null."""
    from statistics import NormalDist

    import numpy as np

    from ranklift.operators import features as FE
    r = np.random.default_rng(6)
    data = {"a": np.round(r.normal(size=400), 2), "b": np.repeat([1.0, 2.0, 5.0], [300, 60, 40]), "c": np.full(50, 7.0)}
    rows = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v], "feature string, value double")
    grid = {x.feature: np.array(x.quantiles) for x in FE.quantile_grid(rows, "feature", "value").collect()}
    refs = np.linspace(0, 1, 1000)
    for k, v in data.items():
        assert np.allclose(grid[k], np.quantile(v, refs), atol=1e-8)
        q = grid[k]
        x = np.r_[v[:40], v.min() - 1, v.max() + 1, np.mean(v), np.quantile(v, [0.123, 0.77])].round(9)
        u = 0.5 * (np.interp(x, q, refs) - np.interp(-x, -q[::-1], -refs[::-1]))
        want = [NormalDist().inv_cdf(min(max(t, 1e-7), 1 - 1e-7)) for t in u]
        df = spark.createDataFrame([(i, float(t)) for i, t in enumerate(x)] + [(999, None)], "i int, x double")
        got = {s.i: s.z for s in df.select("i", FE.normal_quantile(FE.quantile_rank(F.col("x"), q)).alias("z")).collect()}
        assert got[999] is None and np.allclose([got[i] for i in range(len(x))], want, atol=1e-6)
