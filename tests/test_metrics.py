"""Metrics against closed forms and a NumPy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklift.operators import metrics as V


def _pred(spark, y, p, grp=None):
    grp = grp if grp is not None else [f"g{i // 5}" for i in range(len(y))]
    rows = [(f"r{i:05d}", str(g), int(a), float(b)) for i, (g, a, b) in enumerate(zip(grp, y, p))]
    return spark.createDataFrame(rows, "row_id string, grp string, y int, p double")


def _np_auc_ap(y, p):
    y, p = np.asarray(y), np.asarray(p)
    P, N = y.sum(), len(y) - y.sum()
    auc = 0.0
    for s in np.unique(p):
        neg = ((p == s) & (y == 0)).sum()
        auc += neg * (((p > s) & (y == 1)).sum() + 0.5 * ((p == s) & (y == 1)).sum())
    auc /= P * N
    ap = 0.0
    for s in np.unique(p)[::-1]:
        tp = ((p >= s) & (y == 1)).sum()
        fp = ((p >= s) & (y == 0)).sum()
        ap += ((p == s) & (y == 1)).sum() / P * tp / (tp + fp)
    return auc, ap


def test_constant_scores(spark):
    y = [1] * 13 + [0] * 87
    m = V.binary_metrics(_pred(spark, y, [0.3] * 100)).first()
    assert m["roc_auc"] == 0.5
    assert m["pr_auc"] == pytest.approx(0.13)
    assert m["brier"] == pytest.approx(0.13 * 0.49 + 0.87 * 0.09)


def test_perfect_scores(spark):
    y = [1] * 13 + [0] * 87
    p = [0.9] * 13 + [0.1] * 87
    m = V.binary_metrics(_pred(spark, y, p)).first()
    assert m["roc_auc"] == pytest.approx(1.0)
    assert m["pr_auc"] == pytest.approx(1.0)


def test_matches_bruteforce_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400), 1)  # heavy ties
    m = V.binary_metrics(_pred(spark, y, p)).first()
    auc, ap = _np_auc_ap(y, p)
    assert m["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert m["pr_auc"] == pytest.approx(ap, abs=1e-12)
    ll = -np.mean(y * np.log(np.clip(p, V.EPS, 1 - V.EPS)) + (1 - y) * np.log(1 - np.clip(p, V.EPS, 1 - V.EPS)))
    assert m["log_loss"] == pytest.approx(ll, rel=1e-9)


def test_logits_rejected(spark):
    with pytest.raises(V.PredictionError):
        V.check_predictions(_pred(spark, [0, 1, 0], [-1.2, 0.5, 2.0]))


def test_ranking_closed_form(spark):
    y = [1, 0, 0, 1, 0, 0]
    grp = ["a", "a", "a", "b", "b", "b"]
    perfect = [0.9, 0.1, 0.2, 0.8, 0.3, 0.1]
    inverted = [0.1, 0.9, 0.8, 0.1, 0.5, 0.6]
    pk = V.precision_recall_at_k(_pred(spark, y, perfect, grp), (1,)).first()
    assert pk["precision_at_k"] == 1.0 and pk["recall_at_k"] == 1.0
    pk = V.precision_recall_at_k(_pred(spark, y, inverted, grp), (1,)).first()
    assert pk["precision_at_k"] == 0.0
    assert V.map_by_group(_pred(spark, y, perfect, grp)).first()["map"] == pytest.approx(1.0)
    assert V.map_by_group(_pred(spark, y, inverted, grp)).first()["map"] == pytest.approx(1 / 3)


def test_calibrated_scores_have_small_ece(spark):
    rng = np.random.default_rng(0)
    p = rng.random(20000)
    y = (rng.random(20000) < p).astype(int)
    e = V.ece(V.calibration(_pred(spark, y, p), 10)).first()["ece"]
    assert e < 0.02


def test_global_top_k_uses_all_groups(spark):
    y = [1, 0, 0, 1, 0, 0]
    grp = ["a", "a", "a", "b", "b", "b"]
    p = [0.9, 0.1, 0.2, 0.8, 0.3, 0.1]
    r = {x["k"]: x for x in V.global_top_k(_pred(spark, y, p, grp), (1,)).collect()}
    assert r[1]["precision_global"] == 1.0 and r[1]["recall_global"] == 1.0


def test_curves_end_points(spark):
    y = [1, 0, 1, 0, 0]
    p = [0.9, 0.8, 0.7, 0.2, 0.1]
    roc = V.roc_curve(_pred(spark, y, p)).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    pr = V.pr_curve(_pred(spark, y, p)).where(F.col("threshold").isNull()).first()
    assert (pr["precision"], pr["recall"]) == (1.0, 0.0)


def test_map_ranks_whole_groups_in_one_shuffle_and_large_ones_by_ranges(spark, monkeypatch):
    rng = np.random.default_rng(11)
    n = 900
    y, p = rng.integers(0, 2, n), np.round(rng.random(n), 2)
    grp = ["hot" if i < 300 else f"g{i // 3}" for i in range(n)]
    pred = _pred(spark, y, p, grp).unionByName(spark.createDataFrame([("x", None, 1, 0.5)], "row_id string, grp string, y int, p double"))
    by = {}
    for g, a, b in zip(grp, y, p):
        by.setdefault(g, []).append((a, b))
    aps = [_np_auc_ap(*zip(*rows))[1] if 0 < sum(a for a, _ in rows) < len(rows) else 1.0 for rows in by.values() if sum(a for a, _ in rows)]
    for rows in (10 ** 6, 100):  # all groups whole; "hot" by ranges
        monkeypatch.setattr(V, "WHOLE_ROWS", rows)
        m = V.map_by_group(pred)
        assert m.first()["groups"] == len(aps) and m.first()["map"] == pytest.approx(np.mean(aps), abs=1e-12)
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert ("percentile_approx" in plan) == (rows == 100)
        assert plan.count("Exchange hashpartitioning(grp") == 1 or rows == 100
    monkeypatch.setattr(V, "WHOLE_ROWS", 10 ** 6)
    monkeypatch.setattr(V, "TASK_ROWS", 10)  # partitions go with the rows
    assert ", 90), REPARTITION_BY_NUM" in V.map_by_group(pred)._jdf.queryExecution().executedPlan().toString()
