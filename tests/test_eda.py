"""Crosstab shares, noise ratios of several keys and derived tiers on small tables."""

import pytest
from pyspark.sql import functions as F

from ranklift.operators import derive, eda


def test_contingency_shares_with_nulls(spark):
    df = spark.createDataFrame([("x", "u")] * 3 + [("x", "v"), (None, "v"), ("y", None)], "a string, b string")
    got = {(r.a, r.b): (r.n, r.share) for r in eda.contingency_shares(df, "a", "b").collect()}
    assert got[("x", "u")] == (3, 0.75) and got[("x", "v")] == (1, 0.25) and got[("x", "total")] == (4, 1.0)
    assert got[(None, "v")] == (1, 1.0) and got[("y", None)] == (1, 1.0)
    assert got[("total", "v")] == (2, pytest.approx(1 / 3)) and got[("total", "total")] == (6, 1.0)


def test_noise_ratios_equal_the_single_form(spark):
    df = spark.createDataFrame([(i % 7, i % 3, i % 5 == 0) for i in range(500)], "a int, b int, bought boolean")
    got = {r.feature: r for r in eda.noise_ratios(df, {"a": F.col("a"), "b": F.col("b")}).collect()}
    for key in ("a", "b"):
        one = eda.noise_ratio(df, F.col(key)).first()
        assert [got[key][c] for c in ("sd_observed", "sd_chance", "ratio")] == pytest.approx(list(one))


def test_derived_tiers_cut_by_rate(spark):
    rows = [("hi", i < 5) for i in range(10)] + [("mid", i < 1) for i in range(10)] + [("no", False)] * 4
    df = spark.createDataFrame(rows, "level string, bought boolean")
    got = {(r.level, r.tier) for r in derive.derive_tiers(df, "level", "bought").distinct().collect()}
    assert got == {("hi", "ALTO"), ("mid", "MEDIO"), ("no", "CERO")}
