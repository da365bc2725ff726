"""Catalog entries for the evaluation operators (V0-V15, V18) on the prediction fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklift.functions.scalars import rnd
from ranklift.operators import eda, metrics
from ranklift.plans.catalog import register
from ranklift.plans.sqlutil import R
from ranklift.sources.fixtures import PRED_FIXTURES, lineitem_row_id, with_sql
from ranklift.session import read_table

EPS = "2.220446049250313e-16"
METRIC_COLS = ["prevalence", "roc_auc", "pr_auc", "log_loss", "brier"]


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: rnd(c) for c in cols})


def metrics_sql(pred_cte: str, by: str = "", cte: str | None = None) -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    clip = f"least(greatest(p, {EPS}), 1.0 - {EPS})"
    return with_sql(f"""
, sc AS (SELECT {g}p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM {pred_cte} GROUP BY {g}p)
, cum AS (SELECT *, sum(pos) OVER ({part}ORDER BY p DESC) AS cum_pos, sum(neg) OVER ({part}ORDER BY p DESC) AS cum_neg FROM sc)
SELECT {g}CAST(sum(pos) + sum(neg) AS BIGINT) AS n,
  {R('sum(pos) / (sum(pos) + sum(neg))')} AS prevalence,
  {R('CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL WHEN max(p) - min(p) < 1e-12 THEN 0.5 ELSE sum(neg * (cum_pos - pos + pos / 2)) / (sum(pos) * sum(neg)) END')} AS roc_auc,
  {R('CASE WHEN sum(pos) = 0 THEN NULL ELSE sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END')} AS pr_auc,
  {R(f'sum(-pos * ln({clip}) - neg * ln(1 - {clip})) / (sum(pos) + sum(neg))')} AS log_loss,
  {R('sum(pos * (1 - p) * (1 - p) + neg * p * p) / (sum(pos) + sum(neg))')} AS brier
FROM cum {"GROUP BY " + by if by else ""}""", cte or pred_cte)


# V1 / V2 on each fixture ----------------------------------------------------
def _metrics_query(fixture: str):
    def q(spark, sf_dir):
        m = metrics.with_lift(metrics.binary_metrics(PRED_FIXTURES[fixture](spark, sf_dir)))
        return _round(m, METRIC_COLS + ["lift"])
    return q


for _fx in ("ev", "li", "doc"):
    _sql = metrics_sql(f"pred_{_fx}").replace(
        "AS brier\nFROM cum", f"AS brier,\n  {R('(sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos)) / (sum(pos) / (sum(pos) + sum(neg)))')} AS lift\nFROM cum")
    register(f"binary_metrics_{_fx}", _sql)(_metrics_query(_fx))


# V0 --------------------------------------------------------------------------
@register("prediction_checks_ev", with_sql("""
SELECT count(*) AS n, min(p) AS p_min, max(p) AS p_max, CAST(sum(CAST(p IS NULL AS INTEGER)) AS BIGINT) AS null_p,
       CAST(sum(CAST(y IS NULL OR y NOT IN (0, 1) AS INTEGER)) AS BIGINT) AS bad_y FROM pred_ev""", "pred_ev"))
def q_prediction_checks(spark, sf_dir):
    return metrics.prediction_checks(metrics.check_predictions(PRED_FIXTURES["ev"](spark, sf_dir)))


# V8 / V9 ---------------------------------------------------------------------
CALIB_SQL = f"""
, e AS (SELECT quantile_cont(p, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM pred_ev)
, b AS (SELECT p, y, 1 + len(list_filter(edges, lambda x: p >= x)) AS bin FROM pred_ev, e)
, c AS (SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, avg(p) AS mean_p, avg(CAST(y AS DOUBLE)) AS observed,
               avg(p) - avg(CAST(y AS DOUBLE)) AS gap FROM b GROUP BY bin)"""


@register("calibration_ev", with_sql(CALIB_SQL + f"""
SELECT bin, n, {R('mean_p')} AS mean_p, {R('observed')} AS observed, {R('gap')} AS gap FROM c""", "pred_ev"))
def q_calibration(spark, sf_dir):
    c = metrics.calibration(PRED_FIXTURES["ev"](spark, sf_dir), 10)
    return _round(c.withColumn("bin", F.col("bin").cast("int")), ["mean_p", "observed", "gap"])


@register("ece_ev", with_sql(CALIB_SQL + f"""
SELECT {R('sum(n * abs(gap)) / sum(n)')} AS ece FROM c""", "pred_ev"))
def q_ece(spark, sf_dir):
    return _round(metrics.ece(metrics.calibration(PRED_FIXTURES["ev"](spark, sf_dir), 10)), ["ece"])


# V10 -------------------------------------------------------------------------
def _prk_sql(fx: str) -> str:
    return with_sql(f"""
, r AS (SELECT grp, y, row_number() OVER (PARTITION BY grp ORDER BY p DESC, row_id ASC) AS rk FROM pred_{fx})
, g AS (SELECT grp, count(*) AS size, sum(y) AS positives,
               sum(CASE WHEN rk <= 1 THEN y ELSE 0 END) AS h1, sum(CASE WHEN rk <= 2 THEN y ELSE 0 END) AS h2,
               sum(CASE WHEN rk <= 3 THEN y ELSE 0 END) AS h3 FROM r GROUP BY grp HAVING sum(y) > 0)
, l AS (SELECT 1 AS k, h1 / least(1, size) AS prec, h1 / positives AS rec FROM g
        UNION ALL SELECT 2, h2 / least(2, size), h2 / positives FROM g
        UNION ALL SELECT 3, h3 / least(3, size), h3 / positives FROM g)
SELECT k, {R('avg(prec)')} AS precision_at_k, {R('avg(rec)')} AS recall_at_k FROM l GROUP BY k""", f"pred_{fx}")


def _prk_query(fx):
    def q(spark, sf_dir):
        return _round(metrics.precision_recall_at_k(PRED_FIXTURES[fx](spark, sf_dir), (1, 2, 3)),
                      ["precision_at_k", "recall_at_k"])
    return q


for _fx in ("ev", "li"):
    register(f"precision_recall_at_k_{_fx}", _prk_sql(_fx))(_prk_query(_fx))


# V11 -------------------------------------------------------------------------
def _global_sql(fx: str) -> str:
    return with_sql(f"""
, r AS (SELECT y, row_number() OVER (ORDER BY p DESC, row_id ASC) - 1 AS idx FROM pred_{fx})
, g AS (SELECT count(DISTINCT grp) AS g, sum(y) AS tp FROM pred_{fx})
, ks AS (SELECT unnest([1, 2, 3]) AS k)
SELECT k, {R('avg(CAST(y AS DOUBLE))')} AS precision_global, {R('sum(y) / min(tp)')} AS recall_global
FROM r, g, ks WHERE idx < g * k GROUP BY k""", f"pred_{fx}")


def _global_query(fx):
    def q(spark, sf_dir):
        return _round(metrics.global_top_k(PRED_FIXTURES[fx](spark, sf_dir), (1, 2, 3)),
                      ["precision_global", "recall_global"])
    return q


for _fx in ("ev", "li"):
    register(f"global_top_k_{_fx}", _global_sql(_fx))(_global_query(_fx))


# V12 -------------------------------------------------------------------------
def _map_sql(fx: str) -> str:
    return with_sql(f"""
, sc AS (SELECT grp, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM pred_{fx} GROUP BY grp, p)
, cum AS (SELECT *, sum(pos) OVER (PARTITION BY grp ORDER BY p DESC) AS cp, sum(neg) OVER (PARTITION BY grp ORDER BY p DESC) AS cn FROM sc)
, ap AS (SELECT grp, sum(pos) AS P, sum(pos * cp / (cp + cn)) AS s FROM cum GROUP BY grp)
SELECT {R('avg(s / P)')} AS map, count(*) AS groups FROM ap WHERE P > 0""", f"pred_{fx}")


def _map_query(fx):
    def q(spark, sf_dir):
        return _round(metrics.map_by_group(PRED_FIXTURES[fx](spark, sf_dir)), ["map"])
    return q


for _fx in ("ev", "li", "doc"):
    register(f"map_by_group_{_fx}", _map_sql(_fx))(_map_query(_fx))


# V13 / V14 -------------------------------------------------------------------
CURVE_CTE = """
, sc AS (SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM pred_ev GROUP BY p)
, cum AS (SELECT p, sum(pos) OVER (ORDER BY p DESC) AS cp, sum(neg) OVER (ORDER BY p DESC) AS cn,
                 sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM sc)"""


@register("roc_curve_ev", with_sql(CURVE_CTE + f"""
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT p, {R('cn / tot_neg')}, {R('cp / tot_pos')} FROM cum""", "pred_ev"))
def q_roc_curve(spark, sf_dir):
    return _round(metrics.roc_curve(PRED_FIXTURES["ev"](spark, sf_dir)), ["fpr", "tpr"])


@register("pr_curve_ev", with_sql(CURVE_CTE + f"""
SELECT p AS threshold, {R('cp / (cp + cn)')} AS precision, {R('cp / tot_pos')} AS recall FROM cum
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE""", "pred_ev"))
def q_pr_curve(spark, sf_dir):
    return _round(metrics.pr_curve(PRED_FIXTURES["ev"](spark, sf_dir)), ["precision", "recall"])


# V15 -------------------------------------------------------------------------
@register("score_histogram_ev", with_sql(f"""
, b AS (SELECT min(p) AS lo, max(p) AS hi FROM pred_ev)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((p - lo) / ((hi - lo) / 40.0)), 39) END AS INTEGER) AS bin, y,
       count(*) AS n FROM pred_ev, b GROUP BY ALL""", "pred_ev"))
def q_score_histogram(spark, sf_dir):
    return eda.histogram(PRED_FIXTURES["ev"](spark, sf_dir), "p", 40, by="y").select("bin", "y", "n")


# V18 -------------------------------------------------------------------------
def two_models(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    base = li.select(lineitem_row_id().alias("row_id"), F.col("l_orderkey").cast("string").alias("grp"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount", "l_tax")
    return base.select("row_id", "grp", "y", F.col("l_discount").alias("p"), F.lit("discount").alias("model")).unionByName(
        base.select("row_id", "grp", "y", F.col("l_tax").alias("p"), F.lit("tax").alias("model")))


@register("compare_models_li", metrics_sql("two", "model", cte=(
    "two AS (SELECT 'discount' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS p FROM lineitem "
    "UNION ALL SELECT 'tax', CAST(l_returnflag = 'R' AS INTEGER), l_tax FROM lineitem)")))
def q_compare_models(spark, sf_dir):
    return _round(metrics.binary_metrics(two_models(spark, sf_dir), ["model"]), METRIC_COLS)
