"""Run log semantics, decision rules, early stopping replay and the clustered bootstrap."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklift.operators import runs as RU
from ranklift.operators.metrics import binary_metrics
from ranklift.sources import io


def test_results_log_replace_semantics(spark, tmpdir_path):
    path = f"{tmpdir_path}/results"
    assert io.read_results(spark, path).columns == RU.RESULT_COLUMNS
    a = spark.createDataFrame([("base", 0, 0, "valid", 0.5)], "run_name string, seed int, fold int, split string, pr_auc double")
    io.append_results(spark, a, path)
    b = spark.createDataFrame([("base", 0, 0, "valid", 0.7), ("other", 0, 1, "valid", 0.6)],
                              "run_name string, seed int, fold int, split string, pr_auc double")
    io.append_results(spark, b, path)
    got = {(r["run_name"], r["fold"]): r["pr_auc"] for r in io.read_results(spark, path).collect()}
    assert got == {("base", 0): 0.7, ("other", 1): 0.6}
    with pytest.raises(io.SchemaError):
        io.append_results(spark, a.withColumn("bogus", F.lit(1)), path)


def test_compare_and_select(spark):
    rows = [("base", 0.80 + 0.01 * (i % 5 - 2)) for i in range(25)] + [("big", 0.95 + 0.01 * (i % 5 - 2)) for i in range(25)] \
        + [("same", 0.801 + 0.01 * (i % 5 - 2)) for i in range(25)]
    res = spark.createDataFrame([(n, v, 0.13, 0.5, 0.1, 0.1, "f") for n, v in rows],
                                "run_name string, pr_auc double, prevalence double, roc_auc double, log_loss double, brier double, features string")
    s = RU.summarize(res)
    verdict = {r["run_name"]: r["verdict"] for r in RU.compare_to_base(s, "base").collect()}
    assert verdict == {"base": "base", "big": "better", "same": "indistinguishable"}
    assert RU.select_config(s, "base").first()["selected"] == "big"
    assert RU.select_config(s, "base", disqualified=["big"]).first()["selected"] == "base"


def test_best_iteration_replay(spark):
    vals = [0.1, 0.3, 0.5, 0.4, 0.5, 0.45, 0.44, 0.43, 0.6]
    curve = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(vals)], "run string, epoch int, pr_auc double")
    b = RU.best_iteration(curve, patience=3).first()
    assert b["best_epoch"] == 3 and b["epochs_ran"] == 6


def _brute_bootstrap(y, p, g, draws):
    """Same draws as the Spark job: multiplicity per replicate and group."""
    out = []
    for rep in sorted(draws):
        idx = np.concatenate([np.repeat(np.flatnonzero(g == grp), m) for grp, m in draws[rep].items()])
        yy, pp = y[idx], p[idx]
        if yy.sum() == 0:
            continue
        out.append(np.mean((pp - yy) ** 2))
    return np.array(out)


def test_bootstrap_matches_bruteforce(spark):
    rng = np.random.default_rng(5)
    g = np.repeat(np.arange(30), 5)
    y = (rng.random(150) < 0.3).astype(int)
    p = np.round(rng.random(150), 2)
    pred = spark.createDataFrame([(f"r{i}", f"g{g[i]:02d}", int(y[i]), float(p[i])) for i in range(150)],
                                 "row_id string, grp string, y int, p double")
    mult = RU.bootstrap_multiplicities(pred.select("grp").distinct(), "grp", 40, 7).collect()
    draws = {}
    for r in mult:
        draws.setdefault(r["rep"], {})[int(r["grp"][1:])] = r["w"]
    assert all(sum(d.values()) == 30 for d in draws.values())
    brier = _brute_bootstrap(y, p, g, draws)
    got = {r["metric"]: r for r in RU.clustered_bootstrap(pred, 40, 7).collect()}
    assert got["brier"]["replicates"] == len(brier)
    assert got["brier"]["mean"] == pytest.approx(brier.mean(), rel=1e-9)
    assert got["brier"]["ci_low"] == pytest.approx(np.quantile(brier, 0.025), rel=1e-9)


def test_grouped_interval_wider_for_duplicated_groups(spark):
    rng = np.random.default_rng(2)
    rows = []
    for gi in range(80):
        yv, pv = int(rng.random() < 0.4), float(np.round(rng.random(), 2))
        rows += [(f"r{gi}_{j}", f"g{gi}", yv, pv) for j in range(5)]
    pred = spark.createDataFrame(rows, "row_id string, grp string, y int, p double")
    grouped = {r["metric"]: r for r in RU.clustered_bootstrap(pred, 60, 3).collect()}["brier"]
    single = pred.withColumn("grp", F.col("row_id"))
    rowwise = {r["metric"]: r for r in RU.clustered_bootstrap(single, 60, 3).collect()}["brier"]
    assert grouped["ci_high"] - grouped["ci_low"] > rowwise["ci_high"] - rowwise["ci_low"]


def test_experiment_grid(spark):
    base = {"lr": 0.1, "layers": 1}
    g = RU.experiment_grid(spark, base, {"deep": {"layers": 2}, "same": {"lr": 0.1}}, seeds=(0, 1), folds=3, shards=2)
    assert g.count() == 3 * 2 * 3
    changed = {r["config"]: r["changed"] for r in g.select("config", "changed").distinct().collect()}
    assert changed == {"base": "", "deep": "layers", "same": ""}
    with pytest.raises(ValueError):
        RU.experiment_grid(spark, base, {"bad": {"nope": 1}})


def test_weighted_metrics_equal_repeated_rows(spark):
    rows = [("a", "g", 1, 0.9, 2), ("b", "g", 0, 0.4, 3), ("c", "g", 1, 0.4, 1)]
    w = spark.createDataFrame(rows, "row_id string, grp string, y int, p double, w long")
    rep = spark.createDataFrame([(r[0] + str(i), r[1], r[2], r[3]) for r in rows for i in range(r[4])],
                                "row_id string, grp string, y int, p double")
    a, b = binary_metrics(w).first(), binary_metrics(rep).first()
    for k in ("roc_auc", "pr_auc", "brier", "log_loss"):
        assert a[k] == pytest.approx(b[k])


def test_bootstrap_batches_and_poisson_weights(spark):
    rng = np.random.default_rng(4)
    rows = [(f"r{i}", f"g{rng.integers(0, 25)}", int(rng.random() < 0.3), float(np.round(rng.random(), 1))) for i in range(300)]
    pred = spark.createDataFrame(rows, "row_id string, grp string, y int, p double")
    one = sorted(tuple(r) for r in RU.bootstrap_replicates(pred, 20, 5).collect())
    few = sorted(tuple(r) for r in RU.bootstrap_replicates(pred, 20, 5, batch=7).collect())
    assert np.allclose(np.array(one), np.array(few))
    for mode in ("exact", "poisson"):  # each replicate against the weighted metrics
        got = {r.rep: r for r in RU.bootstrap_replicates(pred, 6, 5, mode).collect()}
        w = RU._group_weights(pred.select("grp").distinct(), range(6), 5, mode).collect()
        for k in range(6):
            own = {r.grp: r.w[k] for r in w}
            if mode == "exact":
                assert sum(own.values()) == pred.select("grp").distinct().count()
            weighted = spark.createDataFrame([(*r, own.get(r[1], 0)) for r in rows if own.get(r[1], 0)], "row_id string, grp string, y int, p double, w long")
            want = binary_metrics(weighted).first()
            for m in ("prevalence", *RU.METRICS):
                assert got[k][m] == pytest.approx(want[m])
    many = RU._group_weights(spark.range(4000).select(F.col("id").cast("string").alias("grp")), range(2), 1, "poisson")
    w = np.array([r.w for r in many.collect()])
    assert abs(w.mean() - 1) < 0.05 and abs(w.var() - 1) < 0.1
    with pytest.raises(ValueError):
        RU.bootstrap_replicates(pred, 2, mode="other")


def test_verdict_goes_by_delta_without_spread(spark):
    rows = [(n, m, 0.0, 5) for n, m in (("base", 0.4), ("up", 0.8), ("down", 0.1), ("same", 0.4))]
    s = spark.createDataFrame(rows, "run_name string, pr_auc_mean double, pr_auc_sd double, runs long")
    got = {r.run_name: r.verdict for r in RU.compare_to_base(s, "base").collect()}
    assert got == {"base": "base", "up": "better", "down": "worse", "same": "indistinguishable"}
    with pytest.raises(ValueError):
        RU.select_config(s.filter("false"), "base")
    with pytest.raises(ValueError):
        RU.select_config(s, "base", disqualified=["base"])


def test_declared_keys_have_to_be_the_changed_ones(spark):
    base, over = {"lr": 0.1, "layers": 1}, {"deep": {"layers": 2, "lr": 0.1}}
    assert RU.experiment_grid(spark, base, over, declared={"deep": ["layers"]}).count() == 50
    with pytest.raises(ValueError):
        RU.experiment_grid(spark, base, over, declared={"deep": ["layers", "lr"]})


@pytest.mark.parametrize("p, y", [(3.2, 1), (-0.1, 0), (None, 1), (float("nan"), 1), (0.5, None), (0.5, 2)])
def test_metrics_refuse_what_is_no_prediction(spark, p, y):
    pred = spark.createDataFrame([("a", "g", 1, 0.3), ("b", "g", y, p)], "row_id string, grp string, y int, p double")
    with pytest.raises(Exception, match="outside"):
        binary_metrics(pred).collect()
