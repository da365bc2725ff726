"""Run logs, summaries, decisions and the clustered bootstrap.

A run log is a DataFrame with one row per (run_name, seed, fold, split) and the
metric columns.  Summaries are grouped aggregations; the bootstrap is a table of
group multiplicities joined to the collapsed predictions and scored with the
weighted exact metrics, a batch of replicates at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.functions.scalars import hash_bigint
from ranklift.operators.metrics import CONSTANT_RANGE, EPS, checked_p, checked_y
from ranklift.operators.ordering import range_buckets
from ranklift.operators.splits import factorize
from ranklift.session import written

RESULT_COLUMNS = ["run_name", "config", "features", "seed", "fold", "split", "n_train", "n_eval", "prevalence",
                  "roc_auc", "pr_auc", "log_loss", "brier", "epochs_ran", "seconds", "commit", "notes"]
METRICS = ["roc_auc", "pr_auc", "log_loss", "brier"]


# V3 / V4 ---------------------------------------------------------------------
def summarize(results: DataFrame, by: str = "run_name") -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("runs"), F.min("features").alias("features") if "features" in results.columns
            else F.lit(None).cast("string").alias("features"), F.avg("prevalence").alias("prevalence")]
    for m in METRICS:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_sd")]
    return results.groupBy(by).agg(*aggs).withColumn("lift", F.col("pr_auc_mean") / F.col("prevalence"))


def format_summary(summary: DataFrame, by: str = "run_name") -> DataFrame:
    cols = [F.format_string("%.4f +- %.4f", F.col(f"{m}_mean"), F.col(f"{m}_sd")).alias(m) for m in METRICS]
    return summary.select(by, "runs", *cols, F.format_string("%.2fx", F.col("lift")).alias("lift"))


# V5 --------------------------------------------------------------------------
def fold_pivot(results: DataFrame, metric: str = "pr_auc", by: str = "run_name", folds=None) -> DataFrame:
    p = results.groupBy(by).pivot("fold", folds).agg(F.first(metric))
    stats = results.groupBy(by).agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"),
                                    (F.max(metric) - F.min(metric)).alias("range"))
    return p.join(stats, by)


# V16 / V17 -------------------------------------------------------------------
def compare_to_base(summary: DataFrame, base: str, metric: str = "pr_auc", by: str = "run_name") -> DataFrame:
    b = summary.where(F.col(by) == base).select(F.col(f"{metric}_mean").alias("_bm"), F.col(f"{metric}_sd").alias("_bs"),
                                                F.col("runs").alias("_bn"))
    bm, bs, bn = (b.select(c).scalar() for c in ("_bm", "_bs", "_bn"))
    se = F.sqrt(F.col(f"{metric}_sd") ** 2 / F.col("runs") + bs * bs / bn)
    delta = F.col(f"{metric}_mean") - bm
    z = F.try_divide(delta, se)  # null if both spreads are 0: then any difference counts
    same = F.coalesce(F.abs(z) < 2, delta == 0)
    verdict = F.when(same, "indistinguishable").when(delta > 0, "better").when(delta < 0, "worse")
    return summary.select(by, (F.col(f"{metric}_mean") - bm).alias("delta"), se.alias("se"), z.alias("z"),
                          F.when(F.col(by) == base, "base").otherwise(verdict).alias("verdict"))


def select_config(summary: DataFrame, base: str, disqualified: list[str] = (), by: str = "run_name",
                  metric: str = "pr_auc") -> DataFrame:
    """Best mean AP among qualified runs; keep the base unless the advantage exceeds sd/sqrt(n) of the best."""
    s = summary.where(~F.col(by).isin(list(disqualified)) if disqualified else F.lit(True))
    names = {x[0] for x in s.select(by).collect()}  # one row a config
    if not names:
        raise ValueError("no qualified run in the log")
    if base not in names:
        raise ValueError(f"no run of the base configuration {base!r} in the log")
    best = s.agg(F.max_by(F.struct(by, f"{metric}_mean", f"{metric}_sd", "runs"),
                          F.struct(F.col(f"{metric}_mean"), F.col(by))).alias("b")).select("b.*")
    base_mean = s.where(F.col(by) == base).select(f"{metric}_mean").scalar()
    margin = F.col(f"{metric}_sd") / F.sqrt(F.col("runs"))
    keep_base = (F.col(f"{metric}_mean") - base_mean) <= margin
    return best.select(F.when(keep_base & base_mean.isNotNull(), F.lit(base)).otherwise(F.col(by)).alias("selected"),
                       F.col(by).alias("best"), (F.col(f"{metric}_mean") - base_mean).alias("advantage"),
                       margin.alias("margin"))


# V19 / V20 -------------------------------------------------------------------
def assert_single_test_run(results: DataFrame) -> DataFrame:
    n = results.where(F.col("split") == "test").count()
    if n != 1:
        raise AssertionError(f"expected exactly one test run in the log, found {n}")
    return results


def one_row_per_config(results: DataFrame, by: str = "config", order: list[str] = ("run_name", "seed", "fold")) -> DataFrame:
    w = Window.partitionBy(by).orderBy(*order)
    return results.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


# M15 / M16 -------------------------------------------------------------------
def best_iteration(curve: DataFrame, metric: str = "pr_auc", patience: int = 10, run: str = "run") -> DataFrame:
    """Replay early stopping: first strict maximum before ``patience`` non-improving epochs."""
    w = Window.partitionBy(run).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    c = curve.withColumn("_prev_best", F.max(metric).over(w))
    c = c.withColumn("_improved", F.col("_prev_best").isNull() | (F.col(metric) > F.col("_prev_best")))
    wi = Window.partitionBy(run).orderBy("epoch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = c.withColumn("_last_imp", F.max(F.when(F.col("_improved"), F.col("epoch"))).over(wi))
    stop = c.where(F.col("epoch") - F.col("_last_imp") >= patience).groupBy(run).agg(F.min("epoch").alias("_stop"))
    c = c.join(stop, run, "left").where(F.col("_stop").isNull() | (F.col("epoch") <= F.col("_stop")))
    return c.groupBy(run).agg(F.max_by("epoch", F.struct(F.col(metric), -F.col("epoch"))).alias("best_epoch"),
                              F.max(metric).alias("best_value"), F.max("epoch").alias("epochs_ran"))


def loss_aggregates(pred: DataFrame, pos_weight: float = 1.0, gamma: float = 2.0, eps: float = 1e-7) -> DataFrame:
    p = F.least(F.greatest(F.col("p"), F.lit(eps)), F.lit(1 - eps))
    y = F.col("y").cast("double")
    bce = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    wbce = -(pos_weight * y * F.log(p) + (1 - y) * F.log(1 - p))
    pt = y * p + (1 - y) * (1 - p)
    focal = F.pow(1 - pt, gamma) * bce
    return pred.agg(F.avg(bce).alias("bce"), F.avg(wbce).alias("weighted_bce"), F.avg(focal).alias("focal"))


# M13 -------------------------------------------------------------------------
def experiment_grid(spark, base: dict, overrides: dict[str, dict], seeds=(0, 1, 2, 3, 4), folds=5, shards=1,
                    declared: dict[str, list[str]] | None = None) -> DataFrame:
    """Configs x seeds x folds, declared keys checked against the real diff, shard = index mod n."""
    for name, keys in (declared or {}).items():
        real = sorted(k for k, v in overrides.get(name, {}).items() if base.get(k) != v)
        if sorted(keys) != real:
            raise ValueError(f"{name}: declares {sorted(keys)}, changes {real}")
    names = list(overrides)
    if len(set(names)) != len(names):
        raise ValueError("duplicate config names")
    for name, ov in overrides.items():
        bad = [k for k in ov if k not in base]
        if bad:
            raise ValueError(f"{name}: unknown keys {bad}")
    rows = [("base", "")] + [(n, ",".join(sorted(k for k, v in ov.items() if base[k] != v))) for n, ov in overrides.items()]
    cfg = spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(rows)], "config_idx int, config string, changed string")
    runs = (cfg.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
            .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))))
    return runs.withColumn("shard", F.pmod(F.col("config_idx"), F.lit(shards)))


# V7 --------------------------------------------------------------------------
def bootstrap_multiplicities(groups: DataFrame, grp: str, n_boot: int, seed: int = 7, first: int = 0) -> DataFrame:
    """(rep, grp, w): how many times each group is drawn in each replicate from ``first`` on (G draws with replacement)."""
    spark = groups.sparkSession
    codes = factorize(groups, grp, out="gidx")
    G = codes.select(F.count(F.lit(1))).first()[0]
    draws = spark.range(first * G, (first + n_boot) * G).select((F.col("id") / G).cast("bigint").alias("rep"),
                                          (F.col("id") % G).alias("j"))
    u = hash_bigint(F.concat_ws(":", "rep", "j"), seed) / F.lit(4294967296.0)
    draws = draws.withColumn("gidx", F.floor(u * G).cast("bigint"))
    mult = draws.groupBy("rep", "gidx").agg(F.count(F.lit(1)).alias("w"))
    return mult.join(codes, "gidx").select("rep", grp, "w")


#: Probabilities that a Poisson(1) count is at most 0, 1, 2, ... (to the last double below 1).
POISSON_CDF = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(18)]


def _group_weights(groups: DataFrame, reps: range, seed: int, mode: str) -> DataFrame:
    """(grp, w): for every group its weight in each replicate of ``reps``, as an array."""
    if mode == "poisson":  # independent weights by hash: no draws, no shuffle
        def weight(rep):
            u = hash_bigint(F.concat_ws(":", rep.cast("string"), "grp"), seed) / F.lit(4294967296.0)
            return sum((F.when(u >= c, 1).otherwise(0) for c in POISSON_CDF[1:]), F.when(u >= POISSON_CDF[0], 1).otherwise(0))
        return groups.select("grp", F.transform(F.array(*[F.lit(r) for r in reps]), weight).alias("w"))
    drawn = bootstrap_multiplicities(groups, "grp", len(reps), seed, first=reps.start)
    at = F.map_from_entries(F.collect_list(F.struct((F.col("rep") - reps.start).cast("int").alias("k"), F.col("w").cast("int").alias("w"))))
    return drawn.groupBy("grp").agg(at.alias("at")).select("grp", F.transform(
        F.sequence(F.lit(0), F.lit(len(reps) - 1)), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0))).alias("w"))


def _by_score(batches):
    """(bucket, p, pos, neg): weighted positives and negatives of each replicate, added up by score in a batch."""
    for b in batches:
        if not len(b):
            continue
        w = np.stack(b["w"].to_numpy()).astype(float)
        p, at = np.unique(b["p"].to_numpy(), return_inverse=True)
        pos, neg = np.zeros((len(p), w.shape[1])), np.zeros((len(p), w.shape[1]))
        np.add.at(pos, at, w * b["y1"].to_numpy(float)[:, None])
        np.add.at(neg, at, w * (b["n"] - b["y1"]).to_numpy(float)[:, None])
        bucket = np.zeros(len(p))
        bucket[at] = b["bucket"]
        yield pd.DataFrame({"bucket": bucket, "p": p, "pos": list(pos), "neg": list(neg)})


def _totals(key, b: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"bucket": [key[0]], "pos": [np.sum(np.stack(b["pos"]), axis=0)], "neg": [np.sum(np.stack(b["neg"]), axis=0)]})


def _bucket_metrics(above, n_reps: int):
    """Sums of a bucket's scores towards each replicate's metrics; ``above`` has the totals of all higher buckets."""
    def run(key, b: pd.DataFrame) -> pd.DataFrame:
        p, at = np.unique(-b["p"].to_numpy(), return_inverse=True)  # high scores first
        p = -p
        pos, neg = np.zeros((len(p), n_reps)), np.zeros((len(p), n_reps))
        np.add.at(pos, at, np.stack(b["pos"]))
        np.add.at(neg, at, np.stack(b["neg"]))
        cp, cn = (x.cumsum(axis=0) + a for x, a in zip((pos, neg), above.value[key[0]], strict=True))
        q, n = np.clip(p, EPS, 1 - EPS)[:, None], pos + neg
        here = n > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            ap = np.where(here, pos * cp / (cp + cn), 0.0)
        col = p[:, None]
        return pd.DataFrame({"rep": np.arange(n_reps), "u": (neg * (cp - pos / 2)).sum(axis=0), "ap": ap.sum(axis=0),
                             "ll": (-pos * np.log(q) - neg * np.log(1 - q)).sum(axis=0),
                             "br": (pos * (1 - col) ** 2 + neg * col ** 2).sum(axis=0), "pos": pos.sum(axis=0), "neg": neg.sum(axis=0),
                             "lo": np.where(here, col, np.inf).min(axis=0), "hi": np.where(here, col, -np.inf).max(axis=0)})
    return run


def bootstrap_replicates(pred: DataFrame, n_boot: int = 1000, seed: int = 7, mode: str = "exact", batch: int = 100) -> DataFrame:
    """(rep, prevalence, metrics) of every replicate that has positives.

    ``exact`` draws G of the G groups with replacement; ``poisson`` gives every group its own
    Poisson(1) weight, so the number of draws is G only on average, and needs no draws table.
    ``batch`` replicates are done at a time: a group's weights are one array, predictions are
    cells (group, score), and the arrays are added up by score in range buckets.  No table has
    more than cells x batch numbers; the driver sees one row for each bucket and replicate.
    """
    if mode not in ("exact", "poisson"):
        raise ValueError(f"unknown bootstrap mode {mode!r}")
    spark = pred.sparkSession
    cells = pred.withColumns({"p": checked_p(), "y": checked_y()}).groupBy("grp", "p").agg(F.sum("y").alias("y1"), F.count("*").alias("n"))
    cells = written(range_buckets(cells, "p", out="bucket"), "cells")
    groups = written(cells.select("grp").distinct(), "groups")
    out = None
    for a in range(0, n_boot, batch):
        reps = range(a, min(n_boot, a + batch))
        rows = cells.join(_group_weights(groups, reps, seed, mode), "grp").select("bucket", "p", "y1", "n", "w")
        sums = written(rows.mapInPandas(_by_score, "bucket double, p double, pos array<double>, neg array<double>"), "scores")
        totals = sums.groupBy("bucket").applyInPandas(_totals, "bucket double, pos array<double>, neg array<double>").collect()
        above, run = {}, [np.zeros(len(reps)), np.zeros(len(reps))]
        for t in sorted(totals, key=lambda t: -t.bucket):
            above[(t.bucket)] = tuple(run)
            run = [run[0] + np.array(t.pos), run[1] + np.array(t.neg)]
        one = sums.groupBy("bucket").applyInPandas(_bucket_metrics(spark.sparkContext.broadcast(above), len(reps)), ", ".join(
            ["rep int", *[f"{c} double" for c in ("u", "ap", "ll", "br", "pos", "neg", "lo", "hi")]]))
        one = one.groupBy("rep").agg(*[F.sum(c).alias(c) for c in ("u", "ap", "ll", "br", "pos", "neg")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        n = F.col("pos") + F.col("neg")
        one = written(one.filter("pos > 0").select(
            (F.col("rep") + a).cast("bigint").alias("rep"), (F.col("pos") / n).alias("prevalence"),
            F.when(F.col("neg") == 0, F.lit(None)).when(F.col("hi") - F.col("lo") < CONSTANT_RANGE, 0.5)
            .otherwise(F.col("u") / (F.col("pos") * F.col("neg"))).alias("roc_auc"),
            (F.col("ap") / F.col("pos")).alias("pr_auc"), (F.col("ll") / n).alias("log_loss"), (F.col("br") / n).alias("brier")), "replicates")
        out = one if out is None else out.unionByName(one)
    return out


def clustered_bootstrap(pred: DataFrame, n_boot: int = 1000, seed: int = 7, mode: str = "exact", batch: int = 100) -> DataFrame:
    """Mean, 2.5% and 97.5% per metric over replicates that contain positives."""
    long = bootstrap_replicates(pred, n_boot, seed, mode, batch).unpivot(["rep"], METRICS, "metric", "value").filter("value is not null")
    ci = long.groupBy("metric").agg(F.percentile("value", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"))  # n_boot values a metric
    return (long.groupBy("metric").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("replicates")).join(ci, "metric")
            .select("metric", "mean", "replicates", F.col("ci")[0].alias("ci_low"), F.col("ci")[1].alias("ci_high")))


# V6 --------------------------------------------------------------------------
def check_expected(summary: DataFrame, expected: DataFrame, by: str = "run_name") -> DataFrame:
    """(run, metric, expected, tol) -> measured delta and ok flag."""
    long = summary.select(by, *[F.col(f"{m}_mean").alias(m) for m in METRICS]).unpivot(
        [by], METRICS, "metric", "measured")
    j = expected.join(long, [by, "metric"])
    delta = F.abs(F.col("measured") - F.col("expected"))
    return j.select(by, "metric", "expected", delta.alias("delta"), (delta <= F.col("tol")).alias("ok"))
