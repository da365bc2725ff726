"""Catalog entries for run logs, decisions, losses and the clustered bootstrap.

The run log is derived from the data: two scorers of the lineitem fixture
(discount, tax) evaluated on 5 hash folds of the order key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklift.functions.scalars import hash_bigint, rnd
from ranklift.operators import runs as RU
from ranklift.operators.metrics import binary_metrics
from ranklift.plans.catalog import register
from ranklift.plans.q_metrics import EPS, metrics_sql, two_models
from ranklift.plans.q_splits import H
from ranklift.plans.sqlutil import R
from ranklift.sources.fixtures import PRED_FIXTURES, with_sql

TWO_FOLDS = ("two AS (SELECT model, y, p, CAST(" + H("grp", 42) + " % 5 AS INTEGER) AS fold FROM ("
             "SELECT 'discount' AS model, CAST(l_orderkey AS VARCHAR) AS grp, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS p FROM lineitem "
             "UNION ALL SELECT 'tax', CAST(l_orderkey AS VARCHAR), CAST(l_returnflag = 'R' AS INTEGER), l_tax FROM lineitem))")


def run_log(spark, sf_dir):
    t = two_models(spark, sf_dir).withColumn("fold", (hash_bigint("grp", 42) % 5).cast("int"))
    m = binary_metrics(t, ["model", "fold"])
    return m.select(F.col("model").alias("run_name"), F.col("model").alias("config"), F.lit("p").alias("features"),
                    F.lit(0).alias("seed"), "fold", F.lit("valid").alias("split"), "prevalence", "roc_auc", "pr_auc",
                    "log_loss", "brier")


_CLIP = f"least(greatest(p, {EPS}), 1.0 - {EPS})"
RUNLOG_CTE = f""",
runlog AS (WITH sc AS (SELECT model, fold, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM two GROUP BY ALL),
  cum AS (SELECT *, sum(pos) OVER (PARTITION BY model, fold ORDER BY p DESC) AS cum_pos,
                 sum(neg) OVER (PARTITION BY model, fold ORDER BY p DESC) AS cum_neg FROM sc)
  SELECT model, fold, sum(pos) / (sum(pos) + sum(neg)) AS prevalence,
    CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL WHEN max(p) - min(p) < 1e-12 THEN 0.5
         ELSE sum(neg * (cum_pos - pos + pos / 2)) / (sum(pos) * sum(neg)) END AS roc_auc,
    CASE WHEN sum(pos) = 0 THEN NULL ELSE sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END AS pr_auc,
    sum(-pos * ln({_CLIP}) - neg * ln(1 - {_CLIP})) / (sum(pos) + sum(neg)) AS log_loss,
    sum(pos * (1 - p) * (1 - p) + neg * p * p) / (sum(pos) + sum(neg)) AS brier
  FROM cum GROUP BY model, fold)"""


SUMMARY_SQL = ", s AS (SELECT model AS run_name, count(*) AS runs, avg(prevalence) AS prevalence, " + ", ".join(
    f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_sd" for m in RU.METRICS) + " FROM runlog GROUP BY model)"


@register("run_summary", with_sql(SUMMARY_SQL + "\nSELECT run_name, runs, " + ", ".join(
    f"{R(f'{m}_mean')} AS {m}_mean, {R(f'{m}_sd')} AS {m}_sd" for m in RU.METRICS) + f", {R('pr_auc_mean / prevalence')} AS lift FROM s",
    TWO_FOLDS + RUNLOG_CTE))
def q_run_summary(spark, sf_dir):
    s = RU.summarize(run_log(spark, sf_dir)).drop("features", "prevalence")
    return s.withColumns({c: rnd(c) for c in s.columns if c not in ("run_name", "runs")})


@register("compare_to_base", with_sql(SUMMARY_SQL + f"""
, b AS (SELECT pr_auc_mean AS bm, pr_auc_sd AS bs, runs AS bn FROM s WHERE run_name = 'discount')
SELECT run_name, {R('pr_auc_mean - bm')} AS delta, {R('sqrt(pr_auc_sd * pr_auc_sd / runs + bs * bs / bn)')} AS se,
       {R('(pr_auc_mean - bm) / sqrt(pr_auc_sd * pr_auc_sd / runs + bs * bs / bn)')} AS z,
       CASE WHEN run_name = 'discount' THEN 'base'
            WHEN abs((pr_auc_mean - bm) / sqrt(pr_auc_sd * pr_auc_sd / runs + bs * bs / bn)) < 2 THEN 'indistinguishable'
            WHEN pr_auc_mean > bm THEN 'better' ELSE 'worse' END AS verdict
FROM s, b""", TWO_FOLDS + RUNLOG_CTE))
def q_compare_to_base(spark, sf_dir):
    c = RU.compare_to_base(RU.summarize(run_log(spark, sf_dir)), "discount")
    return c.withColumns({k: rnd(k) for k in ("delta", "se", "z")})


@register("fold_pivot", with_sql(f"""
SELECT model AS run_name, {", ".join(R(f"max(pr_auc) FILTER (WHERE fold = {k})") + f' AS "{k}"' for k in range(5))},
       {R('avg(pr_auc)')} AS mean, {R('stddev_samp(pr_auc)')} AS sd, {R('max(pr_auc) - min(pr_auc)')} AS range
FROM runlog GROUP BY model""", TWO_FOLDS + RUNLOG_CTE))
def q_fold_pivot(spark, sf_dir):
    p = RU.fold_pivot(run_log(spark, sf_dir), "pr_auc", "run_name", list(range(5)))
    return p.withColumns({c: rnd(c) for c in p.columns if c != "run_name"})


@register("loss_aggregates_ev", with_sql(f"""
, c AS (SELECT y, least(greatest(p, 1e-7), 1 - 1e-7) AS q FROM pred_ev)
SELECT {R('avg(-(y * ln(q) + (1 - y) * ln(1 - q)))')} AS bce,
       {R('avg(-(3.0 * y * ln(q) + (1 - y) * ln(1 - q)))')} AS weighted_bce,
       {R('avg(pow(1 - (y * q + (1 - y) * (1 - q)), 2) * -(y * ln(q) + (1 - y) * ln(1 - q)))')} AS focal FROM c""", "pred_ev"))
def q_loss_aggregates(spark, sf_dir):
    l = RU.loss_aggregates(PRED_FIXTURES["ev"](spark, sf_dir), pos_weight=3.0)
    return l.withColumns({c: rnd(c) for c in l.columns})


BOOT = 1000


@register("bootstrap_ev", with_sql(f"""
, gi AS (SELECT grp, dense_rank() OVER (ORDER BY grp) - 1 AS gidx FROM (SELECT DISTINCT grp FROM pred_ev))
, gn AS (SELECT count(*) AS G FROM gi)
, draws AS (SELECT r.range // G AS rep, r.range % G AS j, G FROM range({BOOT} * (SELECT G FROM gn)) r, gn)
, mult AS (SELECT rep, CAST(floor({H("CAST(rep AS VARCHAR) || ':' || CAST(j AS VARCHAR)", 7)} / 4294967296.0 * G) AS BIGINT) AS gidx,
                  count(*) AS w FROM draws GROUP BY ALL)
, cells AS (SELECT grp, p, sum(y) AS y1, count(*) AS n FROM pred_ev GROUP BY grp, p)
, wt AS (SELECT m.rep, c.p, c.y1 * m.w AS pos, (c.n - c.y1) * m.w AS neg FROM mult m JOIN gi ON m.gidx = gi.gidx JOIN cells c ON c.grp = gi.grp)
, sc AS (SELECT rep, p, CAST(sum(pos) AS DOUBLE) AS pos, CAST(sum(neg) AS DOUBLE) AS neg FROM wt GROUP BY rep, p)
, cum AS (SELECT *, sum(pos) OVER (PARTITION BY rep ORDER BY p DESC) AS cum_pos, sum(neg) OVER (PARTITION BY rep ORDER BY p DESC) AS cum_neg FROM sc)
, met AS (SELECT rep, sum(pos) / (sum(pos) + sum(neg)) AS prevalence,
        CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL WHEN max(p) - min(p) < 1e-12 THEN 0.5 ELSE sum(neg * (cum_pos - pos + pos / 2)) / (sum(pos) * sum(neg)) END AS roc_auc,
        CASE WHEN sum(pos) = 0 THEN NULL ELSE sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END AS pr_auc,
        sum(-pos * ln(least(greatest(p, {EPS}), 1.0 - {EPS})) - neg * ln(1 - least(greatest(p, {EPS}), 1.0 - {EPS}))) / (sum(pos) + sum(neg)) AS log_loss,
        sum(pos * (1 - p) * (1 - p) + neg * p * p) / (sum(pos) + sum(neg)) AS brier
        FROM cum GROUP BY rep HAVING sum(pos) > 0)
, long AS (UNPIVOT met ON roc_auc, pr_auc, log_loss, brier INTO NAME metric VALUE value)
SELECT metric, {R('avg(value)')} AS mean, count(*) AS replicates, {R('quantile_cont(value, 0.025)')} AS ci_low,
       {R('quantile_cont(value, 0.975)')} AS ci_high FROM long GROUP BY metric""", "pred_ev"))
def q_bootstrap(spark, sf_dir):
    b = RU.clustered_bootstrap(PRED_FIXTURES["ev"](spark, sf_dir), BOOT, 7)
    return b.withColumns({c: rnd(c) for c in ("mean", "ci_low", "ci_high")})


@register("format_summary", with_sql(SUMMARY_SQL + "\nSELECT run_name, runs, " + ", ".join(
    f"printf('%.4f +- %.4f', {m}_mean, {m}_sd) AS {m}" for m in RU.METRICS)
    + ", printf('%.2fx', pr_auc_mean / prevalence) AS lift FROM s", TWO_FOLDS + RUNLOG_CTE))
def q_format_summary(spark, sf_dir):
    """V4: 'mean +- sd' text at 4 decimals and the lift."""
    return RU.format_summary(RU.summarize(run_log(spark, sf_dir)))


EXPECTED = [("discount", "pr_auc", 0.33, 0.02), ("discount", "roc_auc", 0.5, 0.02),
            ("tax", "pr_auc", 0.33, 0.02), ("tax", "roc_auc", 0.5, 0.02)]


@register("check_expected", with_sql(SUMMARY_SQL + """
, e(run_name, metric, expected, tol) AS (VALUES """ + ", ".join(f"('{a}', '{b}', {c}, {d})" for a, b, c, d in EXPECTED) + f""")
, l AS (SELECT run_name, 'pr_auc' AS metric, pr_auc_mean AS measured FROM s
        UNION ALL SELECT run_name, 'roc_auc', roc_auc_mean FROM s)
SELECT e.run_name, e.metric, CAST(e.expected AS DOUBLE) AS expected, {R('abs(measured - e.expected)')} AS delta,
       abs(measured - e.expected) <= e.tol AS ok
FROM e JOIN l ON e.run_name = l.run_name AND e.metric = l.metric""", TWO_FOLDS + RUNLOG_CTE))
def q_check_expected(spark, sf_dir):
    """V6: measured summary against (run, metric, expected, tolerance)."""
    s = RU.summarize(run_log(spark, sf_dir))
    exp = spark.createDataFrame(EXPECTED, "run_name string, metric string, expected double, tol double")
    return RU.check_expected(s, exp).withColumn("delta", rnd("delta"))


@register("one_row_per_config", with_sql(f"""
SELECT model AS config, fold, {R('pr_auc')} AS pr_auc FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY model, fold) AS rn FROM runlog) WHERE rn = 1""",
    TWO_FOLDS + RUNLOG_CTE))
def q_one_row_per_config(spark, sf_dir):
    """The first row of each config under an explicit order."""
    r = RU.one_row_per_config(run_log(spark, sf_dir), "config", ["run_name", "seed", "fold"])
    return r.select("config", "fold", rnd("pr_auc").alias("pr_auc"))
