"""Exploratory aggregations (inventory F1-F20).

Every table is a grouped aggregation with map-side partial aggregation; the
global scalars (overall rate, totals) are scalar subqueries, and orderings of
small result tables carry a key tiebreak.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.operators.ordering import quantiles, quantiles_by


def _y(target: str) -> Column:
    return F.col(target).cast("double")


# F1 --------------------------------------------------------------------------
def rate_table(df: DataFrame, col: str, target: str = "bought") -> DataFrame:
    return (df.groupBy(F.col(col).alias("level"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(_y(target)).cast("bigint").alias("positives"),
                 F.avg(_y(target)).alias("rate"))
            .orderBy(F.desc("rate"), F.asc("level")))


# F2 --------------------------------------------------------------------------
def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Unpivot numeric columns to (column, value)."""
    return df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "value")


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample sd, min, median, max, sample-corrected skew and excess kurtosis."""
    long = _long(df, cols).where(F.col("value").isNotNull())
    n = F.count("value").cast("double")
    g1, g2 = F.skewness("value"), F.kurtosis("value")
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2).alias("skew"),
        (F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"))
    medians = quantiles_by(long, ["feature"], "value", [0.5]).select("feature", F.col("value").alias("median"))
    return moments.join(medians, "feature")


# F3 / V15 --------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 40, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed on the right (numpy)."""
    x = F.col(col).cast("double")
    base = df.where(x.isNotNull())
    lo = base.select(F.min(x)).scalar()
    hi = base.select(F.max(x)).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    keys = [b.alias("bin")] + ([F.col(by)] if by else [])
    out = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumns({"lo": lo + F.col("bin") * width, "hi": lo + (F.col("bin") + 1) * width})


# F4 --------------------------------------------------------------------------
def categorical_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """cardinality, null %, mode (ties -> smallest), top-1 coverage % of non-null, median rows per level."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    nn = counts.where(F.col("value").isNotNull())
    per_col = nn.groupBy("feature").agg(
        F.count(F.lit(1)).alias("cardinality"),
        F.sum("n").alias("non_null"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        F.max("n").alias("mode_n"))
    # median of rows-per-level from X1 counts (no single-task buffer of all levels)
    med = quantiles_by(nn, ["feature"], "n", [0.5]).select("feature", F.col("value").alias("median_rows"))
    per_col = per_col.join(med, "feature")
    nulls = counts.groupBy("feature").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"))
    return per_col.join(nulls, "feature").select(
        "feature", "cardinality", (F.col("nulls") / F.col("rows") * 100).alias("null_pct"), "mode",
        (F.col("mode_n") / F.col("non_null") * 100).alias("top1_pct"),
        F.floor("median_rows").cast("bigint").alias("median_rows_per_level"))


# F5 --------------------------------------------------------------------------
def group_sizes(df: DataFrame, grp: str, target: str = "bought") -> DataFrame:
    return df.groupBy(grp).agg(F.count(F.lit(1)).alias("rows"), F.sum(_y(target)).cast("bigint").alias("positives"))


def group_structure(df: DataFrame, grp: str, target: str = "bought") -> DataFrame:
    g = group_sizes(df, grp, target)
    return g.agg(F.count(F.lit(1)).alias("groups"), F.min("rows").alias("min_rows"), F.max("rows").alias("max_rows"),
                 F.avg("rows").alias("mean_rows"),
                 F.sum(F.when(F.col("positives") == 0, 1).otherwise(0)).cast("bigint").alias("groups_without_positive"))


def group_histograms(df: DataFrame, grp: str, target: str = "bought") -> DataFrame:
    """Number of groups per positives count and per rows count (long form)."""
    g = group_sizes(df, grp, target)
    a = g.groupBy(F.lit("positives").alias("kind"), F.col("positives").alias("value")).agg(F.count(F.lit(1)).alias("groups"))
    b = g.groupBy(F.lit("rows").alias("kind"), F.col("rows").alias("value")).agg(F.count(F.lit(1)).alias("groups"))
    return a.unionByName(b)


# F6 / F7 ---------------------------------------------------------------------
def group_time_span(df: DataFrame, grp: str, ts: str = "timestamp") -> DataFrame:
    # timestamp_diff on wall-clock values: no session time zone (and no DST) involved
    secs = F.timestamp_diff("SECOND", F.min(ts), F.max(ts))
    return df.groupBy(grp).agg(F.floor(secs / 86400).cast("bigint").alias("days"))


def time_span_summary(df: DataFrame, grp: str, ts: str = "timestamp") -> DataFrame:
    spans = group_time_span(df, grp, ts)
    med = quantiles(spans, "days", [0.5]).select("value").scalar()
    whole = df.select(F.floor(F.timestamp_diff("SECOND", F.min(ts), F.max(ts)) / 86400).cast("bigint")).scalar()
    s = spans.agg(F.avg("days").alias("mean_days"), F.max("days").alias("max_days"),
                  F.avg((F.col("days") > 365).cast("double")).alias("share_over_year"))
    # a temporal split is rejected when groups themselves span much of the whole range
    return (s.withColumns({"median_days": med, "whole_span_days": whole})
            .withColumn("temporal_split_ok", F.col("median_days") < F.col("whole_span_days") * 0.05))


# F8 --------------------------------------------------------------------------
def correlations(df: DataFrame, cols: list[str], target: str, where: Column | None = None) -> DataFrame:
    """Pearson r with the target, overall and inside a subset (``where``), long form."""
    long = df.select(_y(target).alias("_y"), (where if where is not None else F.lit(False)).alias("_in"),
                     *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(["_y", "_in"], cols, "feature", "value")
    return long.groupBy("feature").agg(
        F.corr("value", "_y").alias("r_all"),
        F.corr(F.when(F.col("_in"), F.col("value")), F.when(F.col("_in"), F.col("_y"))).alias("r_subset"))


# F9 --------------------------------------------------------------------------
def decile_rates(df: DataFrame, col: str, target: str, q: int = 10) -> DataFrame:
    """pd.qcut semantics: right-closed bins, lowest included, duplicate edges dropped."""
    probs = [i / q for i in range(1, q)]
    # at most q-1 edge values reach the driver
    edges = sorted({r["value"] for r in quantiles(df, col, probs).collect()})
    x = F.col(col).cast("double")
    bin_ = sum((F.when(F.col("x") > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    binned = df.where(x.isNotNull()).select(x.alias("x"), _y(target).alias("y")).withColumn("bin", bin_)
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"), F.avg("y").alias("rate"))


def decile_contrast(df: DataFrame, col: str, target: str, q: int = 10) -> DataFrame:
    rates = decile_rates(df, col, target, q)
    return rates.agg(F.min_by("rate", "bin").alias("first_rate"), F.max_by("rate", "bin").alias("last_rate"),
                     (F.max("rate") - F.min("rate")).alias("spread"))


# F10 / F11 / F12 -------------------------------------------------------------
def crosstab(df: DataFrame, a: str, b: str, levels: list[str] | None = None) -> DataFrame:
    return df.groupBy(a).pivot(b, levels).count().na.fill(0)


def level_purity(df: DataFrame, x: str, level: str) -> DataFrame:
    per = df.groupBy(x).agg(F.count_distinct(level).alias("levels"))
    return per.agg(F.sum((F.col("levels") > 1).cast("int")).cast("bigint").alias("values_in_several_levels"),
                   F.count(F.lit(1)).alias("values"))


def mode_coverage(df: DataFrame, grp: str, col: str) -> DataFrame:
    counts = df.groupBy(grp, col).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(grp).agg(
        F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias("mode"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.round(F.max("n") / F.sum("n"), 3).alias("mode_share"))


# F13 / F14 / F15 -------------------------------------------------------------
def tier_table(df: DataFrame, tier_col: str = "tier", target: str = "bought",
               order: tuple[str, ...] = ("ALTO", "MEDIO", "CERO")) -> DataFrame:
    total_pos = df.select(F.sum(_y(target))).scalar()
    pos = F.array(*[F.lit(o) for o in order])
    return (df.groupBy(tier_col).agg(F.count(F.lit(1)).alias("rows"), F.sum(_y(target)).cast("bigint").alias("positives"),
                                     F.avg(_y(target)).alias("rate"))
            .withColumn("pct_of_positives", F.col("positives") / total_pos * 100)
            .orderBy(F.array_position(pos, F.col(tier_col))))


def conditioned_rates(df: DataFrame, tier_col: str, tier_value: str, col: str, target: str = "bought") -> DataFrame:
    sub = df.where(F.col(tier_col) == tier_value)
    base = sub.select(F.avg(_y(target))).scalar()
    return rate_table(sub, col, target).withColumn("tier_rate", base)


def marginal_rates(df: DataFrame, cols: list[str], target: str = "bought") -> DataFrame:
    long = df.select(_y(target).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["_y"], cols, "feature", "value")
    per = long.groupBy("feature", "value").agg(F.avg("_y").alias("rate"))
    return per.groupBy("feature").agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
                                     (F.max("rate") - F.min("rate")).alias("spread"))


# F16 / F17 -------------------------------------------------------------------
def noise_ratio(df: DataFrame, key: Column, target: str = "bought", name: str = "key") -> DataFrame:
    g = df.groupBy(key.alias(name)).agg(F.avg(_y(target)).alias("rate"), F.count(F.lit(1)).alias("n"))
    p = df.select(F.avg(_y(target))).scalar()
    return g.agg(F.stddev_samp("rate").alias("sd_observed"), F.avg("n").alias("mean_n")).select(
        "sd_observed", F.sqrt(p * (1 - p) / F.col("mean_n")).alias("sd_chance"),
        (F.col("sd_observed") / F.sqrt(p * (1 - p) / F.col("mean_n"))).alias("ratio"))


def noise_ratios(df: DataFrame, keys: dict[str, Column], target: str = "bought") -> DataFrame:
    """``noise_ratio`` for several keys from one scan: one row per name in ``keys``.

    Rows collapse to one per (name, key value) before they are shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), c.cast("string").alias("key")) for n, c in keys.items()])
    g = (df.select(_y(target).alias("_y"), F.explode(pairs).alias("_k")).groupBy("_k.feature", "_k.key")
         .agg(F.avg("_y").alias("rate"), F.sum("_y").alias("pos"), F.count(F.lit(1)).alias("n"),
              F.count("_y").alias("known")))
    p = F.sum("pos") / F.sum("known")
    chance = F.sqrt(p * (1 - p) / F.avg("n"))
    return g.groupBy("feature").agg(F.stddev_samp("rate").alias("sd_observed"), chance.alias("sd_chance"),
                                    F.try_divide(F.stddev_samp("rate"), chance).alias("ratio"))


def rate_intervals(df: DataFrame, key: Column, target: str = "bought", name: str = "key") -> DataFrame:
    p = df.select(F.avg(_y(target))).scalar()
    g = df.groupBy(key.alias(name)).agg(F.avg(_y(target)).alias("rate"), F.count(F.lit(1)).alias("n"))
    half = F.lit(1.96) * F.sqrt(p * (1 - p) / F.col("n"))
    return g.withColumns({"band_lo": p - half, "band_hi": p + half})


# F18 / F19 -------------------------------------------------------------------
def length_percentiles(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    names = list(cols)
    long = df.select(*[cols[n].cast("double").alias(n) for n in names]).unpivot([], names, "feature", "v")
    q = quantiles_by(long, ["feature"], "v", [0.95, 0.99])
    pct = q.groupBy("feature").agg(F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("p95"),
                                   F.max(F.when(F.col("q") == 0.99, F.col("value"))).alias("p99"))
    s = long.groupBy("feature").agg(F.min("v").alias("min"), F.avg("v").alias("mean"), F.max("v").alias("max"))
    return s.join(pct, "feature")


def negatives_summary(df: DataFrame, target: str = "bought") -> DataFrame:
    return df.agg(F.avg(_y(target)).alias("prevalence"), F.sum(_y(target)).alias("pos"),
                  F.count(F.lit(1)).alias("n")).select(
        "prevalence", F.when(F.col("pos") > 0, (F.col("n") - F.col("pos")) / F.col("pos")).alias("neg_per_pos"))


# F20 / B8 --------------------------------------------------------------------
def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts for every (a, b) cell plus 'total' margins on both axes (cube)."""
    c = df.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).cube("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("a").alias("ga"), F.grouping("b").alias("gb"))
    return c.select(F.when(F.col("ga") == 1, F.lit("total")).otherwise(F.col("a")).alias(a),
                    F.when(F.col("gb") == 1, F.lit("total")).otherwise(F.col("b")).alias(b), "n")


def contingency_shares(df: DataFrame, a: str, b: str) -> DataFrame:
    """``contingency`` with ``share``: the cell's part of its row total, P(b | a); 1 in the margin of b."""
    c = df.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).cube("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("a").alias("ga"), F.grouping("b").alias("gb"))
    of_row = F.max(F.when(F.col("gb") == 1, F.col("n"))).over(Window.partitionBy("ga", "a"))  # levels of b + 1 rows
    return c.withColumn("share", F.col("n") / of_row).select(
        F.when(F.col("ga") == 1, F.lit("total")).otherwise(F.col("a")).alias(a),
        F.when(F.col("gb") == 1, F.lit("total")).otherwise(F.col("b")).alias(b), "n", "share")
