"""Evaluation operators over prediction tables ``(row_id, grp, y, p)``.

Threshold metrics are computed exactly: rows collapse to one row per distinct
score first (a partial aggregation, so ties and hot scores cost nothing), then
X1 running sums give the counts above every threshold.  Per-group rankings use
``row_number() <= k`` filters, which Catalyst turns into a map-side
``WindowGroupLimit`` so a huge group is cut to k rows per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.operators.ordering import dense_index, prefix_sums, prefix_sums_by, quantiles

EPS = 2.220446049250313e-16  # float64 machine epsilon: log-loss clipping
CONSTANT_RANGE = 1e-12       # scores spanning less than this are "constant"
GROUP_BUCKETS = 1 << 12      # hash buckets in which the rows of groups are counted
TASK_ROWS = 1 << 21          # rows of whole groups that one task ranks
WHOLE_ROWS = 1 << 20         # a group of more rows is not ranked in one task


class PredictionError(ValueError):
    pass


# V0 --------------------------------------------------------------------------
def prediction_checks(pred: DataFrame) -> DataFrame:
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("p").alias("p_min"), F.max("p").alias("p_max"),
        F.sum(F.col("p").isNull().cast("int")).cast("bigint").alias("null_p"),
        F.sum((F.col("y").isNull() | ~F.col("y").isin(0, 1)).cast("int")).cast("bigint").alias("bad_y"))


def check_predictions(pred: DataFrame) -> DataFrame:
    """Raise when p leaves [0, 1] (looks like logits) or y/p are missing."""
    r = prediction_checks(pred).first()
    if r["null_p"] or r["bad_y"]:
        raise PredictionError(f"predictions with null p ({r['null_p']}) or y outside {{0,1}} ({r['bad_y']})")
    if r["n"] and (r["p_min"] < 0 or r["p_max"] > 1):
        raise PredictionError(f"p outside [0, 1] ({r['p_min']}, {r['p_max']}): looks like logits")
    return pred


# V1 / V2 ---------------------------------------------------------------------
def checked_p() -> Column:
    """``p``, or an error from the running job where it is missing or no probability (V0 in the same pass)."""
    p = F.col("p")
    sound = F.coalesce((p >= 0) & (p <= 1), F.lit(False))  # NaN is above 1
    return F.when(sound, p).otherwise(F.raise_error(F.concat(
        F.lit("p outside [0, 1] or missing (looks like logits?): "), F.coalesce(p.cast("string"), F.lit("null")))).cast("double"))


def checked_y() -> Column:
    y = F.col("y").cast("double")
    return F.when(F.coalesce(y.isin(0.0, 1.0), F.lit(False)), y).otherwise(F.raise_error(F.concat(
        F.lit("y outside {0, 1} or missing: "), F.coalesce(F.col("y").cast("string"), F.lit("null")))).cast("double"))


def score_counts(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or []
    # p is checked inside the sums: a check in the key would go down with filters on the key, below the joins
    # that made ``pred``, and meet rows that are none of it
    pred = pred.withColumns({"p": F.col("p").cast("double"), "y": checked_y(), "_ok": checked_p() * 0.0 + 1.0})
    y = F.col("y")
    w = F.col("_ok") * (F.col("w").cast("double") if "w" in pred.columns else F.lit(1.0))
    return pred.groupBy(*by, "p").agg(F.sum(y * w).alias("pos"), F.sum((1 - y) * w).alias("neg"))


def _metric_exprs(n_pos: Column, n_neg: Column, p_span: Column) -> list[Column]:
    n = n_pos + n_neg
    pos, neg, cp, cn = F.col("pos"), F.col("neg"), F.col("cum_pos"), F.col("cum_neg")
    clip = F.least(F.greatest(F.col("p"), F.lit(EPS)), F.lit(1 - EPS))
    auc = F.sum(neg * (cp - pos + pos / 2)) / (n_pos * n_neg)
    return [
        n.cast("bigint").alias("n"),
        (n_pos / n).alias("prevalence"),
        F.when((n_pos == 0) | (n_neg == 0), F.lit(None)).when(p_span < CONSTANT_RANGE, F.lit(0.5))
        .otherwise(auc).alias("roc_auc"),
        F.when(n_pos == 0, F.lit(None)).otherwise(F.sum(pos * cp / (cp + cn)) / n_pos).alias("pr_auc"),
        (F.sum(-pos * F.log(clip) - neg * F.log(1 - clip)) / n).alias("log_loss"),
        (F.sum(pos * (1 - F.col("p")) * (1 - F.col("p")) + neg * F.col("p") * F.col("p")) / n).alias("brier"),
    ]


def binary_metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """n, prevalence, ROC-AUC (ties = 1/2), AP (step, no interpolation), log loss, Brier.

    ``by`` evaluates several prediction sets at once (models, bootstrap replicates).
    An optional weight column ``w`` counts each row w times.
    """
    sc = score_counts(pred, by)
    if by:
        cum = prefix_sums_by(sc.withColumn("_neg_p", -F.col("p")), by, "_neg_p", ["pos", "neg"]).drop("_neg_p")
        return cum.groupBy(*by).agg(*_metric_exprs(F.sum("pos"), F.sum("neg"), F.max("p") - F.min("p")))
    cum = prefix_sums(sc, "p", ["pos", "neg"], descending=True)
    return cum.agg(*_metric_exprs(F.sum("pos"), F.sum("neg"), F.max("p") - F.min("p")))


def with_lift(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("lift", F.col("pr_auc") / F.col("prevalence"))


# V8 / V9 ---------------------------------------------------------------------
def calibration(pred: DataFrame, n_bins: int = 10) -> DataFrame:
    """Bins from linear quantiles of p (ends open), left-closed; empty bins dropped."""
    probs = [i / n_bins for i in range(1, n_bins)]
    edges = sorted(r["value"] for r in quantiles(pred, "p", probs).collect())  # n_bins - 1 values
    b = sum((F.when(F.col("p") >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0)) + 1
    return (pred.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"), F.avg(F.col("y").cast("double")).alias("observed"))
            .withColumn("gap", F.col("mean_p") - F.col("observed")))


def ece(calib: DataFrame) -> DataFrame:
    return calib.agg((F.sum(F.col("n") * F.abs("gap")) / F.sum("n")).alias("ece"))


# V10 -------------------------------------------------------------------------
def _ranked(pred: DataFrame, k_max: int) -> DataFrame:
    w = Window.partitionBy("grp").orderBy(F.desc("p"), F.asc("row_id"))
    return pred.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k_max)


def precision_recall_at_k(pred: DataFrame, ks=(1, 2, 3)) -> DataFrame:
    """Per group with positives: hits@k / min(k, size) and hits@k / positives, averaged."""
    ks = list(ks)
    top = _ranked(pred, max(ks))
    hits = top.groupBy("grp").agg(*[F.sum(F.when(F.col("rank") <= k, F.col("y")).otherwise(0)).alias(f"h{k}") for k in ks])
    sizes = pred.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum("y").alias("positives"))
    g = sizes.where(F.col("positives") > 0).join(hits, "grp")
    rows = [g.select(F.lit(k).alias("k"),
                     (F.col(f"h{k}") / F.least(F.lit(k), F.col("size"))).alias("prec"),
                     (F.col(f"h{k}") / F.col("positives")).alias("rec")) for k in ks]
    long = rows[0]
    for r in rows[1:]:
        long = long.unionByName(r)
    return long.groupBy("k").agg(F.avg("prec").alias("precision_at_k"), F.avg("rec").alias("recall_at_k"))


# V11 -------------------------------------------------------------------------
def global_top_k(pred: DataFrame, ks=(1, 2, 3)) -> DataFrame:
    """Top k x (number of all groups) rows overall; precision and recall.  Ties: row_id."""
    g = pred.select(F.countDistinct("grp")).scalar()
    total_pos = pred.select(F.sum("y")).scalar()
    idx = dense_index(pred.select("row_id", "p", "y"), [F.desc("p"), F.asc("row_id")])
    rows = None
    for k in ks:
        sel = idx.where(F.col("idx") < g * k).agg(F.avg(F.col("y").cast("double")).alias("precision_global"),
                                                   (F.sum("y") / total_pos).alias("recall_global"))
        sel = sel.withColumn("k", F.lit(k))
        rows = sel if rows is None else rows.unionByName(sel)
    return rows


# V12 -------------------------------------------------------------------------
def map_by_group(pred: DataFrame) -> DataFrame:
    """AP inside each group with positives (all-positive group = 1), averaged; rows without a group are left out.

    Groups are ranked whole, in one shuffle by group whose partitions hold about ``TASK_ROWS`` rows: a task's memory
    does not grow with the table.  Groups whose hash bucket has more than ``WHOLE_ROWS`` rows are ranked by value ranges.
    """
    bucket = F.pmod(F.xxhash64("grp"), F.lit(GROUP_BUCKETS))
    pred = pred.where(F.col("grp").isNotNull())
    sizes = {r["b"]: r["n"] for r in pred.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(pred.sparkSession.sparkContext.defaultParallelism, -(-sum(sizes.values()) // TASK_ROWS))
    large = [b for b, n in sizes.items() if n > WHOLE_ROWS]  # at most one for each WHOLE_ROWS rows

    whole = pred.where(~bucket.isin(large)) if large else pred
    upto = Window.partitionBy("grp").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = score_counts(whole.select("grp", "p", "y", *[c for c in pred.columns if c == "w"]).repartition(parts, "grp"), ["grp"])
    ap = _group_ap(cum.withColumns({f"cum_{c}": F.sum(c).over(upto) for c in ("pos", "neg")}))
    if large:
        sc = score_counts(pred.where(bucket.isin(large)), ["grp"]).withColumn("_neg_p", -F.col("p"))
        ap = ap.unionByName(_group_ap(prefix_sums_by(sc, ["grp"], "_neg_p", ["pos", "neg"], n_buckets=16)))
    return ap.where(F.col("P") > 0).agg(F.avg(F.col("s") / F.col("P")).alias("map"),
                                        F.count(F.lit(1)).alias("groups"))


def _group_ap(cum: DataFrame) -> DataFrame:
    return cum.groupBy("grp").agg(F.sum("pos").alias("P"),
                                  F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("s"))


# V13 / V14 -------------------------------------------------------------------
def _curve_base(pred: DataFrame) -> DataFrame:
    return prefix_sums(score_counts(pred), "p", ["pos", "neg"], descending=True)


def roc_curve(pred: DataFrame) -> DataFrame:
    cum = _curve_base(pred)
    P = pred.select(F.sum(F.col("y").cast("double"))).scalar()
    N = pred.select(F.sum(1 - F.col("y").cast("double"))).scalar()
    pts = cum.select(F.col("p").alias("threshold"), F.try_divide("cum_neg", N).alias("fpr"),
                     F.try_divide("cum_pos", P).alias("tpr"))
    start = pred.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                              F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(pred: DataFrame) -> DataFrame:
    cum = _curve_base(pred)
    P = pred.select(F.sum(F.col("y").cast("double"))).scalar()
    pts = cum.select(F.col("p").alias("threshold"),
                     (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                     F.try_divide("cum_pos", P).alias("recall"))
    end = pred.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                            F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)
