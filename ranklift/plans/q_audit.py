"""Catalog entries for the audit and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklift.functions.scalars import rnd
from ranklift.operators import audit as A
from ranklift.operators.features import NUMERIC
from ranklift.plans.catalog import register
from ranklift.plans.q_eda import impressions_derived
from ranklift.plans.q_features import _dim
from ranklift.plans.sqlutil import R
from ranklift.session import written
from ranklift.sources.fixtures import IMPRESSION_COLUMNS, impressions, with_sql

REG_SQL = "reg(column_name, verdict, role) AS (VALUES " + ", ".join(
    f"('{a.column}', '{a.verdict}', '{a.role}')" for a in A.REGISTRY) + ")"


@register("column_profile", with_sql(", p AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CAST(\"{c}\" IS NULL AS INTEGER)) AS BIGINT) AS nulls, "
    f"{R(f'avg(CAST(\"{c}\" IS NULL AS DOUBLE)) * 100')} AS null_pct, count(DISTINCT \"{c}\") AS distinct_values FROM impressions"
    for c in IMPRESSION_COLUMNS) + """)
SELECT p.column_name, nulls, null_pct, distinct_values, verdict, role FROM p JOIN reg ON p.column_name = reg.column_name""",
    "impressions", REG_SQL))
def q_column_profile(spark, sf_dir):
    df = impressions(spark, sf_dir).select(*IMPRESSION_COLUMNS)
    issues = A.check_audit(A.REGISTRY, df.columns)
    if issues:
        raise ValueError(f"audit registry does not match the table: {issues}")
    prof = A.column_profile(df)
    reg = A.audit_table(spark).select(F.col("column").alias("column_name"), "verdict", "role")
    return (prof.select(F.col("column").alias("column_name"), "nulls", rnd("null_pct").alias("null_pct"),
                        F.col("distinct").alias("distinct_values"))
            .join(reg, "column_name"))


@register("structural_facts", with_sql(f"""
, c AS (SELECT (SELECT count(*) FROM impressions) - count(*) + 1 AS c FROM (SELECT DISTINCT * FROM impressions))
, d AS (SELECT count(*) AS c FROM impressions GROUP BY query_id, title)
SELECT fact, {R('value')} AS value FROM (
  SELECT 'n_rows' AS fact, CAST(count(*) AS DOUBLE) AS value FROM impressions
  UNION ALL SELECT 'groups', CAST(count(DISTINCT query_id) AS DOUBLE) FROM impressions
  UNION ALL SELECT 'prevalence_target', avg(CAST(bought AS DOUBLE)) FROM impressions
  UNION ALL SELECT 'prevalence_leak', avg(CAST(cart AS DOUBLE)) FROM impressions
  UNION ALL SELECT 'p_target_given_leak_true', avg(CASE WHEN cart THEN CAST(bought AS DOUBLE) END) FROM impressions
  UNION ALL SELECT 'p_target_given_leak_false', avg(CASE WHEN NOT cart THEN CAST(bought AS DOUBLE) END) FROM impressions
  UNION ALL SELECT 'nulls_pct', avg(CAST(allergens IS NULL AS DOUBLE)) * 100 FROM impressions
  UNION ALL SELECT 'n_columns', {len(IMPRESSION_COLUMNS)}.0
  UNION ALL SELECT 'exact_duplicates', CAST(sum(c - 1) AS DOUBLE) FROM c
  UNION ALL SELECT 'duplicates_group_title', CAST(sum(c - 1) AS DOUBLE) FROM d)""", "impressions"))
def q_structural_facts(spark, sf_dir):
    df = written(impressions(spark, sf_dir).select(*IMPRESSION_COLUMNS))  # read four times
    return A.structural_facts(df).withColumn("value", rnd("value"))


@register("leak_check", with_sql("""
SELECT CAST(sum(CAST(NOT cart AND bought AS INTEGER)) AS BIGINT) AS violations, count(*) AS rows FROM impressions""",
    "impressions"))
def q_leak_check(spark, sf_dir):
    return A.necessary_condition(impressions(spark, sf_dir), "cart", "bought")


@register("predicate_coverage", with_sql(f"""
, t AS (SELECT CAST(COALESCE(category = filter_category, false) AS INTEGER) AS a,
               CAST(COALESCE(storage_type = filter_storage_type, false) AS INTEGER) AS b,
               CAST(COALESCE(filter_price_min <= price AND price <= filter_price_max, false) AS INTEGER) AS c FROM impressions)
SELECT 'category_matches_filter' AS predicate, {R('avg(a) * 100')} AS pct_true, CAST(sum(1 - a) AS BIGINT) AS failing_rows, sum(1 - a) = 0 AS constant_feature FROM t
UNION ALL SELECT 'storage_matches_filter', {R('avg(b) * 100')}, CAST(sum(1 - b) AS BIGINT), sum(1 - b) = 0 FROM t
UNION ALL SELECT 'price_inside_filter', {R('avg(c) * 100')}, CAST(sum(1 - c) AS BIGINT), sum(1 - c) = 0 FROM t""", "impressions"))
def q_predicate_coverage(spark, sf_dir):
    c = F.col
    preds = {"category_matches_filter": c("category") == c("filter_category"),
             "storage_matches_filter": c("storage_type") == c("filter_storage_type"),
             "price_inside_filter": (c("filter_price_min") <= c("price")) & (c("price") <= c("filter_price_max"))}
    return A.predicate_coverage(impressions(spark, sf_dir), preds).withColumn("pct_true", rnd("pct_true"))


@register("functional_dependency", with_sql("""
, d AS (SELECT DISTINCT category AS a, array_to_string(list_sort(list_distinct(list_transform(string_split(ingredients, ','), lambda s: trim(s)))), ',') AS b FROM impressions)
, ab AS (SELECT max(k) AS m FROM (SELECT a, count(*) AS k FROM d GROUP BY a))
, ba AS (SELECT max(k) AS m FROM (SELECT b, count(*) AS k FROM d GROUP BY b))
SELECT ab.m = 1 AS a_determines_b, ba.m = 1 AS b_determines_a, ab.m = 1 AND ba.m = 1 AS one_to_one FROM ab, ba""", "impressions"))
def q_functional_dependency(spark, sf_dir):
    from ranklift.functions.scalars import normalise_list
    df = impressions(spark, sf_dir)
    return A.functional_dependency(df, F.col("category"), F.array_join(normalise_list("ingredients"), ","))


@register("containment_membership", with_sql(f"""
SELECT {R('avg(CAST(COALESCE(contains(title, brand), false) AS DOUBLE))')} AS title_has_brand,
       {R('avg(CAST(COALESCE(contains(lower(description), lower(package_size)), false) AS DOUBLE))')} AS description_has_size,
       {R("avg(CASE WHEN category = 'PROMO' THEN CAST(storage_type = 'F' AS DOUBLE) END)")} AS p_member_given_cond,
       {R("avg(CASE WHEN storage_type = 'F' THEN CAST(category = 'PROMO' AS DOUBLE) END)")} AS p_cond_given_member
FROM impressions""", "impressions"))
def q_containment(spark, sf_dir):
    df = impressions(spark, sf_dir)
    cm = A.conditional_membership(df, F.col("category") == "PROMO", F.col("storage_type") == "F")
    rates = df.agg(A.containment_rate(df, "brand", "title").alias("title_has_brand"),
                   A.containment_rate(df, "package_size", "description", lower=True).alias("description_has_size"))
    out = rates.withColumns({"p_member_given_cond": cm.select("p_member_given_cond").scalar(),
                             "p_cond_given_member": cm.select("p_cond_given_member").scalar()})
    return out.withColumns({c: rnd(c) for c in out.columns})


DERIVED = ["price_pos", "price_per_oz", "dim_length", "dim_width", "dim_height", "dim_volume"]


@register("derived_matrix_check", with_sql(", dv AS (SELECT "
    "CASE WHEN filter_price_max <> filter_price_min THEN (price - filter_price_min) / (filter_price_max - filter_price_min) END AS price_pos, "
    "CASE WHEN net_weight_oz <> 0 THEN price / net_weight_oz END AS price_per_oz, "
    f"{_dim(1)} AS dim_length, {_dim(2)} AS dim_width, {_dim(3)} AS dim_height, "
    f"({_dim(1)}) * ({_dim(2)}) * ({_dim(3)}) AS dim_volume FROM impressions)\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(sum(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS nulls, "
        f"CAST(sum(CAST(COALESCE(isnan({c}), false) AS INTEGER)) AS BIGINT) AS nans, "
        f"CAST(sum(CAST(COALESCE(isinf({c}), false) AS INTEGER)) AS BIGINT) AS infs, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM dv"
        for c in DERIVED), "impressions"))
def q_derived_matrix(spark, sf_dir):
    m = A.check_matrix(impressions_derived(spark, sf_dir), DERIVED)
    return m.withColumns({"min": rnd("min"), "max": rnd("max")})


# Facts stated for the sf0.01 adapter (FIXTURES.md), checked against the data.
EXPECTED_FACTS = {"n_columns": 22.0, "prevalence_target": 0.3341, "prevalence_leak": 0.6679,
                  "p_target_given_leak_false": 0.0, "nulls_pct": 20.1}


@register("verify_facts", with_sql(f"""
, m AS (SELECT 'n_columns' AS fact, {len(IMPRESSION_COLUMNS)}.0 AS value
        UNION ALL SELECT 'prevalence_target', avg(CAST(bought AS DOUBLE)) FROM impressions
        UNION ALL SELECT 'prevalence_leak', avg(CAST(cart AS DOUBLE)) FROM impressions
        UNION ALL SELECT 'p_target_given_leak_false', avg(CASE WHEN NOT cart THEN CAST(bought AS DOUBLE) END) FROM impressions
        UNION ALL SELECT 'nulls_pct', avg(CAST(allergens IS NULL AS DOUBLE)) * 100 FROM impressions)
, e(fact, expected) AS (VALUES """ + ", ".join(f"('{k}', {v})" for k, v in EXPECTED_FACTS.items()) + f""")
SELECT e.fact, CAST(expected AS DOUBLE) AS expected, {R('value')} AS measured, {R('abs(value - expected)')} AS delta,
       abs(value - expected) <= CASE WHEN e.fact LIKE '%\\_pct' ESCAPE '\\' THEN 5e-3
                                     WHEN expected = floor(expected) AND expected > 1 THEN 0.0 ELSE 5e-4 END AS ok
FROM e JOIN m ON e.fact = m.fact""", "impressions"))
def q_verify_facts(spark, sf_dir):
    """B5 + B7: measured facts against the stated ones (counts exact, proportions 5e-4, _pct 5e-3)."""
    facts = A.structural_facts(written(impressions(spark, sf_dir).select(*IMPRESSION_COLUMNS)))
    v = A.verify_facts(facts, EXPECTED_FACTS)
    return v.withColumns({"measured": rnd("measured"), "delta": rnd("delta")})
