"""Catalog entries for the exploratory tables (F1-F20) over the impressions adapter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklift.functions.scalars import rnd, tier
from ranklift.operators import derive, eda
from ranklift.plans.catalog import register
from ranklift.plans.sqlutil import HIGH_MARKERS, MARKER_SQL, MID_MARKERS, TIER_SQL, R
from ranklift.sources.fixtures import impressions, with_sql

NUMERIC = ["price", "net_weight_oz", "nutrition_score", "filter_price_min", "filter_price_max"]
CATEGORICAL = ["category", "brand", "storage_type", "country_of_origin", "unit_of_measure",
               "package_size", "ingredients", "allergens"]


def impressions_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derive.add_derived(impressions(spark, sf_dir))
    return df.withColumn("tier", tier("marker", HIGH_MARKERS, MID_MARKERS))


def _round_cols(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})


# F1 -- the flagship query -----------------------------------------------------
@register("marker_rates", with_sql(f"""
SELECT {MARKER_SQL} AS level, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives,
       {R('avg(CAST(bought AS DOUBLE))')} AS rate
FROM impressions GROUP BY 1""", "impressions"))
def q_marker_rates(spark, sf_dir):
    return _round_cols(eda.rate_table(impressions_derived(spark, sf_dir), "marker", "bought"), ["rate"])


# F14 -------------------------------------------------------------------------
@register("tier_conditioned_rates", with_sql(f"""
, t AS (SELECT *, {TIER_SQL} AS tier FROM impressions)
SELECT brand AS level, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives,
       {R('avg(CAST(bought AS DOUBLE))')} AS rate,
       {R("(SELECT avg(CAST(bought AS DOUBLE)) FROM t WHERE tier = 'ALTO')")} AS tier_rate
FROM t WHERE tier = 'ALTO' GROUP BY brand""", "impressions"))
def q_tier_conditioned(spark, sf_dir):
    df = impressions_derived(spark, sf_dir)
    return _round_cols(eda.conditioned_rates(df, "tier", "ALTO", "brand"), ["rate", "tier_rate"])


def _cte(*blocks: str) -> str:
    return ",\n".join(blocks)


TIER_CTE = f"t AS (SELECT *, {TIER_SQL} AS tier FROM impressions)"


# F13 -------------------------------------------------------------------------
@register("tier_table", with_sql(f"""
SELECT tier, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives,
       {R('avg(CAST(bought AS DOUBLE))')} AS rate,
       {R('sum(CAST(bought AS DOUBLE)) / (SELECT sum(CAST(bought AS DOUBLE)) FROM t) * 100')} AS pct_of_positives
FROM t GROUP BY tier""", "impressions", TIER_CTE))
def q_tier_table(spark, sf_dir):
    return _round_cols(eda.tier_table(impressions_derived(spark, sf_dir)), ["rate", "pct_of_positives"])


# F2 --------------------------------------------------------------------------
def _unpivot_sql(cols: list[str], cast: str = "DOUBLE") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS value FROM impressions" for c in cols)


@register("numeric_summary", with_sql(f"""
SELECT feature, count(value) AS count, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS std,
       min(value) AS min, max(value) AS max, {R('skewness(value)')} AS skew, {R('kurtosis(value)')} AS kurtosis,
       {R('quantile_cont(value, 0.5)')} AS median
FROM long WHERE value IS NOT NULL GROUP BY feature""", "impressions", f"long AS ({_unpivot_sql(NUMERIC)})"))
def q_numeric_summary(spark, sf_dir):
    s = eda.numeric_summary(impressions(spark, sf_dir), NUMERIC)
    return _round_cols(s, ["mean", "std", "skew", "kurtosis", "median"])


# F3 --------------------------------------------------------------------------
@register("price_histogram", with_sql(f"""
, b AS (SELECT min(price) AS lo, max(price) AS hi FROM impressions)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((price - lo) / ((hi - lo) / 40.0)), 39) END AS INTEGER) AS bin,
       count(*) AS n, {R('min(lo) + CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((price - lo) / ((hi - lo) / 40.0)), 39) END AS INTEGER) * ((min(hi) - min(lo)) / 40.0)')} AS lo
FROM impressions, b GROUP BY 1""", "impressions"))
def q_price_histogram(spark, sf_dir):
    h = eda.histogram(impressions(spark, sf_dir), "price", 40)
    return h.select("bin", "n", rnd("lo").alias("lo"))


# F4 --------------------------------------------------------------------------
@register("categorical_summary", with_sql(f"""
, counts AS (SELECT feature, value, count(*) AS n FROM long GROUP BY feature, value)
, per AS (SELECT feature, count(*) AS cardinality, sum(n) AS non_null, first(value ORDER BY n DESC, value ASC) AS mode,
                 max(n) AS mode_n, median(n) AS median_rows FROM counts WHERE value IS NOT NULL GROUP BY feature)
, nul AS (SELECT feature, sum(n) AS rows, sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS nulls FROM counts GROUP BY feature)
SELECT per.feature, cardinality, {R('nulls / rows * 100')} AS null_pct, mode, {R('mode_n / non_null * 100')} AS top1_pct,
       CAST(floor(median_rows) AS BIGINT) AS median_rows_per_level
FROM per JOIN nul ON per.feature = nul.feature""", "impressions",
    f"long AS ({_unpivot_sql(CATEGORICAL, 'VARCHAR')})"))
def q_categorical_summary(spark, sf_dir):
    s = eda.categorical_summary(impressions(spark, sf_dir), CATEGORICAL)
    return _round_cols(s, ["null_pct", "top1_pct"])


# F5 --------------------------------------------------------------------------
GROUPS_CTE = ("g AS (SELECT query_id, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives "
              "FROM impressions GROUP BY query_id)")


@register("group_structure", with_sql(f"""
SELECT count(*) AS groups, min(rows) AS min_rows, max(rows) AS max_rows, {R('avg(rows)')} AS mean_rows,
       CAST(sum(CASE WHEN positives = 0 THEN 1 ELSE 0 END) AS BIGINT) AS groups_without_positive FROM g""",
    "impressions", GROUPS_CTE))
def q_group_structure(spark, sf_dir):
    return _round_cols(eda.group_structure(impressions(spark, sf_dir), "query_id"), ["mean_rows"])


@register("group_histograms", with_sql("""
SELECT 'positives' AS kind, positives AS value, count(*) AS groups FROM g GROUP BY positives
UNION ALL SELECT 'rows' AS kind, rows AS value, count(*) AS groups FROM g GROUP BY rows""", "impressions", GROUPS_CTE))
def q_group_histograms(spark, sf_dir):
    return eda.group_histograms(impressions(spark, sf_dir), "query_id")


# F6 / F7 ---------------------------------------------------------------------
@register("group_time_span", with_sql(f"""
, s AS (SELECT query_id, CAST(floor((epoch(max("timestamp")) - epoch(min("timestamp"))) / 86400) AS BIGINT) AS days
        FROM impressions GROUP BY query_id)
SELECT {R('avg(days)')} AS mean_days, max(days) AS max_days, {R('avg(CAST(days > 365 AS DOUBLE))')} AS share_over_year,
       quantile_cont(days, 0.5) AS median_days,
       (SELECT CAST(floor((epoch(max("timestamp")) - epoch(min("timestamp"))) / 86400) AS BIGINT) FROM impressions) AS whole_span_days
FROM s""", "impressions"))
def q_group_time_span(spark, sf_dir):
    s = eda.time_span_summary(impressions(spark, sf_dir), "query_id")
    return _round_cols(s.drop("temporal_split_ok"), ["mean_days", "share_over_year"])


# F8 --------------------------------------------------------------------------
@register("correlations", with_sql(f"""
SELECT feature, {R('corr(value, y)')} AS r_all,
       {R('corr(CASE WHEN sub THEN value END, CASE WHEN sub THEN y END)')} AS r_subset
FROM long GROUP BY feature""", "impressions", "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(bought AS DOUBLE) AS y, "
    f"{TIER_SQL} = 'ALTO' AS sub FROM impressions" for c in NUMERIC) + ")"))
def q_correlations(spark, sf_dir):
    df = impressions_derived(spark, sf_dir)
    c = eda.correlations(df, NUMERIC, "bought", F.col("tier") == "ALTO")
    return _round_cols(c, ["r_all", "r_subset"])


# F9 --------------------------------------------------------------------------
@register("decile_rates", with_sql(f"""
, e AS (SELECT list_sort(list_distinct(quantile_cont(price, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]))) AS edges FROM impressions)
SELECT CAST(len(list_filter(edges, lambda x: x < price)) AS INTEGER) AS bin, count(*) AS rows,
       {R('avg(CAST(bought AS DOUBLE))')} AS rate
FROM impressions, e GROUP BY 1""", "impressions"))
def q_decile_rates(spark, sf_dir):
    d = eda.decile_rates(impressions(spark, sf_dir), "price", "bought", 10)
    return _round_cols(d.withColumn("bin", F.col("bin").cast("int")), ["rate"])


@register("decile_contrast", with_sql(f"""
, e AS (SELECT list_sort(list_distinct(quantile_cont(price, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]))) AS edges FROM impressions)
, d AS (SELECT len(list_filter(edges, lambda x: x < price)) AS bin, avg(CAST(bought AS DOUBLE)) AS rate FROM impressions, e GROUP BY 1)
SELECT {R('min_by(rate, bin)')} AS first_rate, {R('max_by(rate, bin)')} AS last_rate,
       {R('max(rate) - min(rate)')} AS spread FROM d""", "impressions"))
def q_decile_contrast(spark, sf_dir):
    return _round_cols(eda.decile_contrast(impressions(spark, sf_dir), "price", "bought"), ["first_rate", "last_rate", "spread"])


# F10 -------------------------------------------------------------------------
@register("crosstab_category_storage", with_sql("""
SELECT category, count(*) FILTER (WHERE storage_type = 'F') AS "F", count(*) FILTER (WHERE storage_type = 'O') AS "O"
FROM impressions GROUP BY category""", "impressions"))
def q_crosstab(spark, sf_dir):
    return eda.crosstab(impressions(spark, sf_dir), "category", "storage_type", ["F", "O"])


# F11 -------------------------------------------------------------------------
@register("level_purity", with_sql("""
, per AS (SELECT brand, count(DISTINCT category) AS levels FROM impressions GROUP BY brand)
SELECT CAST(sum(CAST(levels > 1 AS INTEGER)) AS BIGINT) AS values_in_several_levels, count(*) AS "values" FROM per
""", "impressions"))
def q_level_purity(spark, sf_dir):
    return eda.level_purity(impressions(spark, sf_dir), "brand", "category")


# F12 -------------------------------------------------------------------------
@register("mode_coverage", with_sql("""
, c AS (SELECT query_id, country_of_origin, count(*) AS n FROM impressions GROUP BY ALL)
SELECT query_id, first(country_of_origin ORDER BY n DESC, country_of_origin) AS mode, count(*) AS distinct_values,
       round(max(n) / sum(n), 3) AS mode_share
FROM c GROUP BY query_id""", "impressions"))
def q_mode_coverage(spark, sf_dir):
    return eda.mode_coverage(impressions(spark, sf_dir), "query_id", "country_of_origin")


# F15 -------------------------------------------------------------------------
MARGINAL = ["category", "brand", "storage_type", "allergens"]


@register("marginal_rates", with_sql(f"""
, per AS (SELECT feature, value, avg(y) AS rate FROM long GROUP BY feature, value)
SELECT feature, {R('min(rate)')} AS min_rate, {R('max(rate)')} AS max_rate, {R('max(rate) - min(rate)')} AS spread
FROM per GROUP BY feature""", "impressions",
    "long AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, CAST(bought AS DOUBLE) AS y FROM impressions"
        for c in MARGINAL) + ")"))
def q_marginal_rates(spark, sf_dir):
    return _round_cols(eda.marginal_rates(impressions(spark, sf_dir), MARGINAL), ["min_rate", "max_rate", "spread"])


# F16 -------------------------------------------------------------------------
@register("noise_ratio_weekday", with_sql(f"""
, g AS (SELECT isodow("timestamp") - 1 AS key, avg(CAST(bought AS DOUBLE)) AS rate, count(*) AS n FROM impressions GROUP BY 1)
, p AS (SELECT avg(CAST(bought AS DOUBLE)) AS p FROM impressions)
SELECT {R('stddev_samp(rate)')} AS sd_observed, {R('sqrt(min(p) * (1 - min(p)) / avg(n))')} AS sd_chance,
       {R('stddev_samp(rate) / sqrt(min(p) * (1 - min(p)) / avg(n))')} AS ratio
FROM g, p""", "impressions"))
def q_noise_ratio(spark, sf_dir):
    n = eda.noise_ratio(impressions(spark, sf_dir), F.weekday("timestamp"), "bought", "weekday")
    return _round_cols(n, ["sd_observed", "sd_chance", "ratio"])


@register("noise_ratio_tier", with_sql(f"""
, t AS (SELECT *, CAST(bought AS DOUBLE) AS y FROM impressions WHERE {TIER_SQL} = 'ALTO')
, k AS (SELECT 'hour' AS feature, hour("timestamp") AS key, y FROM t
        UNION ALL SELECT 'weekday', isodow("timestamp") - 1, y FROM t
        UNION ALL SELECT 'month', month("timestamp"), y FROM t)
, g AS (SELECT feature, key, avg(y) AS rate, count(*) AS n FROM k GROUP BY 1, 2)
, p AS (SELECT avg(y) AS p FROM t)
SELECT feature, {R('stddev_samp(rate)')} AS sd_observed, {R('sqrt(min(p) * (1 - min(p)) / avg(n))')} AS sd_chance,
       {R('stddev_samp(rate) / sqrt(min(p) * (1 - min(p)) / avg(n))')} AS ratio
FROM g, p GROUP BY feature""", "impressions"))
def q_noise_ratio_tier(spark, sf_dir):
    """F16: hour, weekday and month against chance, inside the high tier."""
    df = impressions_derived(spark, sf_dir).where("tier = 'ALTO'")
    n = eda.noise_ratios(df, {"hour": F.hour("timestamp"), "weekday": F.weekday("timestamp"), "month": F.month("timestamp")})
    return _round_cols(n, ["sd_observed", "sd_chance", "ratio"])


# F17 -------------------------------------------------------------------------
@register("rate_intervals_month", with_sql(f"""
, p AS (SELECT avg(CAST(bought AS DOUBLE)) AS p FROM impressions)
SELECT month("timestamp") AS key, {R('avg(CAST(bought AS DOUBLE))')} AS rate, count(*) AS n,
       {R('min(p) - 1.96 * sqrt(min(p) * (1 - min(p)) / count(*))')} AS band_lo,
       {R('min(p) + 1.96 * sqrt(min(p) * (1 - min(p)) / count(*))')} AS band_hi
FROM impressions, p GROUP BY 1""", "impressions"))
def q_rate_intervals(spark, sf_dir):
    r = eda.rate_intervals(impressions(spark, sf_dir), F.month("timestamp"), "bought", "key")
    return _round_cols(r, ["rate", "band_lo", "band_hi"])


# F18 -------------------------------------------------------------------------
@register("length_percentiles", with_sql(f"""
, w AS (SELECT len(string_split(trim(title), ' ')) AS t, len(string_split(trim(description), ' ')) AS d FROM impressions)
SELECT 'title_words' AS feature, CAST(min(t) AS DOUBLE) AS min, {R('avg(t)')} AS mean, CAST(max(t) AS DOUBLE) AS max,
       {R('quantile_cont(t, 0.95)')} AS p95, {R('quantile_cont(t, 0.99)')} AS p99 FROM w
UNION ALL
SELECT 'total_words', CAST(min(t + d) AS DOUBLE), {R('avg(t + d)')}, CAST(max(t + d) AS DOUBLE),
       {R('quantile_cont(t + d, 0.95)')}, {R('quantile_cont(t + d, 0.99)')} FROM w
""", "impressions"))
def q_length_percentiles(spark, sf_dir):
    from ranklift.functions.scalars import word_count
    cols = {"title_words": word_count("title"), "total_words": word_count("title") + word_count("description")}
    lp = eda.length_percentiles(impressions(spark, sf_dir), cols)
    return _round_cols(lp, ["mean", "p95", "p99"])


# F19 -------------------------------------------------------------------------
@register("negatives_summary", with_sql(f"""
SELECT {R('avg(CAST(bought AS DOUBLE))')} AS prevalence,
       {R('(count(*) - sum(CAST(bought AS DOUBLE))) / sum(CAST(bought AS DOUBLE))')} AS neg_per_pos FROM impressions""",
    "impressions"))
def q_negatives_summary(spark, sf_dir):
    return _round_cols(eda.negatives_summary(impressions(spark, sf_dir)), ["prevalence", "neg_per_pos"])


# F20 / B8 --------------------------------------------------------------------
@register("contingency_cart_bought", with_sql("""
SELECT COALESCE(CAST(cart AS VARCHAR), 'total') AS cart, COALESCE(CAST(bought AS VARCHAR), 'total') AS bought, count(*) AS n
FROM impressions GROUP BY CUBE (cart, bought)""", "impressions"))
def q_contingency(spark, sf_dir):
    return eda.contingency(impressions(spark, sf_dir), "cart", "bought")


@register("contingency_shares_cart_bought", with_sql(f"""
, c AS (SELECT CAST(cart AS VARCHAR) AS cart, CAST(bought AS VARCHAR) AS bought, count(*) AS n FROM impressions GROUP BY CUBE (1, 2))
SELECT COALESCE(c.cart, 'total') AS cart, COALESCE(c.bought, 'total') AS bought, c.n, {R('c.n / r.n')} AS share
FROM c JOIN c r ON r.bought IS NULL AND r.cart IS NOT DISTINCT FROM c.cart""", "impressions"))
def q_contingency_shares(spark, sf_dir):
    """The crosstab with P(bought | cart)."""
    return _round_cols(eda.contingency_shares(impressions(spark, sf_dir), "cart", "bought"), ["share"])


# C16 -------------------------------------------------------------------------
@register("derived_tiers", with_sql(f"""
, r AS (SELECT {MARKER_SQL} AS marker, avg(CAST(bought AS DOUBLE)) AS rate FROM impressions GROUP BY 1)
, t AS (SELECT row_id, bought, CASE WHEN rate > 0.4 THEN 'ALTO' WHEN rate > 0.005 THEN 'MEDIO' ELSE 'CERO' END AS tier
        FROM impressions JOIN r ON r.marker = {MARKER_SQL})
SELECT tier, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives,
       min(row_id) AS first_row, max(row_id) AS last_row FROM t GROUP BY tier""", "impressions"))
def q_derived_tiers(spark, sf_dir):
    """Tiers cut from the markers' own rates, joined back to every row."""
    df = derive.derive_tiers(derive.add_derived(impressions(spark, sf_dir)), "marker", "bought")
    return df.groupBy("tier").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("bought").cast("int")).cast("bigint").alias("positives"),
                                  F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"))
