"""Column audit, profiles and data-quality checks (inventory B1-B15, C19-C20).

The audit registry is a small typed list (one entry per column); everything that
measures the data is one aggregation pass over the table.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklift.operators.features import maybe_broadcast
from ranklift.session import written

ADMITTED, EXCLUDED, TARGET, GROUP = "ADMITIDA", "EXCLUIDA", "TARGET", "GRUPO"
TEXT, NUMERIC, CATEGORICAL, DERIVED, NONE = "texto", "numerica", "categorica", "derivada", "-"
BEFORE = "before the search (catalogue attribute)"
AT_QUERY = "when the query is built (filters chosen by the user)"
AT_IMPRESSION = "when the impression is generated"
AFTER = "after the prediction moment"


@dataclass(frozen=True)
class ColumnAudit:
    column: str
    moment: str
    available: bool
    verdict: str
    role: str
    reason: str


# Verdict and role of every column of the impressions table.
REGISTRY: tuple[ColumnAudit, ...] = (
    ColumnAudit("title", BEFORE, True, ADMITTED, TEXT, "main text input; carries the marker"),
    ColumnAudit("description", BEFORE, True, ADMITTED, TEXT, "templated text; last sentence repeats the level"),
    ColumnAudit("price", BEFORE, True, ADMITTED, NUMERIC, "product attribute; enters price_pos"),
    ColumnAudit("category", BEFORE, True, ADMITTED, CATEGORICAL, "product attribute"),
    ColumnAudit("timestamp", AT_IMPRESSION, True, ADMITTED, DERIVED, "cyclic features only; does not order groups"),
    ColumnAudit("query_id", AT_QUERY, True, GROUP, NONE, "grouping key for the split, never a feature"),
    ColumnAudit("filter_category", AT_QUERY, True, EXCLUDED, NONE, "identical to category"),
    ColumnAudit("filter_price_min", AT_QUERY, True, ADMITTED, NUMERIC, "query context; enters price_pos"),
    ColumnAudit("filter_price_max", AT_QUERY, True, ADMITTED, NUMERIC, "query context; enters price_pos"),
    ColumnAudit("filter_storage_type", AT_QUERY, True, EXCLUDED, NONE, "identical to storage_type"),
    ColumnAudit("cart", AFTER, False, EXCLUDED, NONE, "leak: necessary condition of the target"),
    ColumnAudit("bought", AFTER, False, TARGET, NONE, "the outcome"),
    ColumnAudit("brand", BEFORE, True, ADMITTED, CATEGORICAL, "product attribute"),
    ColumnAudit("package_size", BEFORE, True, ADMITTED, CATEGORICAL, "product attribute"),
    ColumnAudit("unit_of_measure", BEFORE, True, ADMITTED, CATEGORICAL, "suffix of package_size"),
    ColumnAudit("net_weight_oz", BEFORE, True, ADMITTED, NUMERIC, "enters price_per_oz"),
    ColumnAudit("dimensions_in", BEFORE, True, ADMITTED, DERIVED, "parsed to length, width, height, volume"),
    ColumnAudit("storage_type", BEFORE, True, ADMITTED, CATEGORICAL, "kept; its filter copy is excluded"),
    ColumnAudit("ingredients", BEFORE, True, ADMITTED, CATEGORICAL, "list in text; dropped as redundant"),
    ColumnAudit("allergens", BEFORE, True, ADMITTED, CATEGORICAL, "null is its own level"),
    ColumnAudit("nutrition_score", BEFORE, True, ADMITTED, NUMERIC, "product attribute"),
    ColumnAudit("country_of_origin", BEFORE, True, ADMITTED, CATEGORICAL, "product attribute"),
)


def audit_table(spark: SparkSession, registry=REGISTRY) -> DataFrame:
    """B1: one row per column."""
    return spark.createDataFrame([asdict(a) for a in registry],
                                 "column string, moment string, available boolean, verdict string, role string, reason string")


def admitted(registry=REGISTRY) -> list[str]:
    """B2: the only source of feature columns."""
    return [a.column for a in registry if a.verdict == ADMITTED]


def excluded(registry=REGISTRY) -> dict[str, str]:
    return {a.column: a.reason for a in registry if a.verdict == EXCLUDED}


def check_audit(registry, columns: list[str]) -> list[str]:
    """Problems (empty list = ok)."""
    names = [a.column for a in registry]
    issues = [f"duplicate entry {c}" for c in sorted({c for c in names if names.count(c) > 1})]
    issues += [f"column without audit: {c}" for c in columns if c not in names]
    issues += [f"audit of a missing column: {c}" for c in names if c not in columns]
    issues += [f"admitted but not available: {a.column}" for a in registry if a.verdict == ADMITTED and not a.available]
    issues += [f"{a.verdict} with a feature role: {a.column}" for a in registry
               if a.verdict in (TARGET, GROUP) and a.role != NONE]
    return issues


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Dtype, nulls, null %, distinct non-null, one example per column.

    Long form (column, value) with a partial count per value before the shuffle,
    so low-cardinality columns collapse map-side; no per-column distinct Expand.
    """
    dtypes = dict(df.dtypes)
    cols = list(df.columns)
    if approx:  # one pass, HyperLogLog sketches, no shuffle of the values
        n = F.count(F.lit(1))
        wide = df.agg(n.alias("_rows"), *[F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__nulls") for c in cols],
                      *[F.approx_count_distinct(c).alias(f"{c}__distinct") for c in cols],
                      *[F.min(F.col(c).cast("string")).alias(f"{c}__example") for c in cols])
        rows = [F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                         F.col(f"{c}__nulls").alias("nulls"), (F.col(f"{c}__nulls") / F.col("_rows") * 100).alias("null_pct"),
                         F.col(f"{c}__distinct").cast("bigint").alias("distinct"), F.col(f"{c}__example").alias("example"))
                for c in cols]
        return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    prof = counts.groupBy("column").agg(
        F.sum("n").alias("_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).cast("bigint").alias("nulls"),
        F.count("value").cast("bigint").alias("distinct"),
        F.min("value").alias("example"))
    types = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in cols], "column string, dtype string")
    return prof.join(F.broadcast(types), "column").select(
        "column", "dtype", "nulls", (F.col("nulls") / F.col("_rows") * 100).alias("null_pct"), "distinct", "example")


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> Column:
    """B6 helper: rows minus distinct keys (nulls compare equal) as a scalar column.

    Only a 64-bit hash of each row is shuffled; rows whose hash comes twice are then compared
    by all columns, so that equal hashes of different rows do not count.
    """
    if df.isEmpty():
        return F.lit(None).cast("bigint")
    cols = subset or df.columns
    kinds = dict(df.dtypes)
    d = df.select(*cols, F.xxhash64(*[F.col(c) + F.lit(0.0) if kinds[c] == "double" else F.col(c) for c in cols]).alias("_h"))
    twice = written(d.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), "twice")
    g = d.join(maybe_broadcast(twice), "_h", "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.select(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint")).scalar()


def structural_facts(df: DataFrame, grp: str = "query_id", target: str = "bought", leak: str = "cart",
                     nullable: str = "allergens") -> DataFrame:
    """One row per fact (fact, value)."""
    y, x = F.col(target).cast("double"), F.col(leak)
    wide = df.agg(
        F.count(F.lit(1)).cast("double").alias("n_rows"),
        F.count_distinct(grp).cast("double").alias("groups"),
        F.avg(y).alias("prevalence_target"),
        F.avg(x.cast("double")).alias("prevalence_leak"),
        F.avg(F.when(x, y)).alias("p_target_given_leak_true"),
        F.avg(F.when(~x, y)).alias("p_target_given_leak_false"),
        (F.avg(F.col(nullable).isNull().cast("double")) * 100).alias("nulls_pct"))
    wide = wide.withColumns({"n_columns": F.lit(float(len(df.columns))),
                             "exact_duplicates": duplicate_count(df).cast("double"),
                             "duplicates_group_title": duplicate_count(df, [grp, "title"]).cast("double")})
    return wide.unpivot([], wide.columns, "fact", "value")


def verify_facts(facts: DataFrame, expected: dict[str, float], tol: float = 5e-4) -> DataFrame:
    """Counts exact, proportions within ``tol``, ``_pct`` facts within 5e-3."""
    spark = facts.sparkSession
    exp = spark.createDataFrame([(k, float(v)) for k, v in expected.items()], "fact string, expected double")
    j = exp.join(facts, "fact", "left")
    is_count = (F.col("expected") == F.floor("expected")) & (F.col("expected") > 1)
    limit = F.when(F.col("fact").endswith("_pct"), 5e-3).when(is_count, 0.0).otherwise(tol)
    delta = F.abs(F.col("value") - F.col("expected"))
    return j.select("fact", "expected", F.col("value").alias("measured"), delta.alias("delta"),
                    F.coalesce(delta <= limit, F.lit(False)).alias("ok"))


def necessary_condition(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows where y holds without x (must be exactly 0 for a leak rule)."""
    return df.agg(F.sum((~F.col(x) & F.col(y)).cast("int")).cast("bigint").alias("violations"),
                  F.count(F.lit(1)).alias("rows"))


def predicate_coverage(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """% true, failing rows, constant flag; null counts as false."""
    aggs = []
    for name, p in preds.items():
        ok = F.coalesce(p, F.lit(False)).cast("int")
        aggs += [F.avg(ok).alias(f"{name}__pct"), F.sum(1 - ok).alias(f"{name}__fail")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("predicate"), (F.col(f"{n}__pct") * 100).alias("pct_true"),
                     F.col(f"{n}__fail").cast("bigint").alias("failing_rows"),
                     (F.col(f"{n}__fail") == 0).alias("constant_feature")) for n in preds]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def functional_dependency(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Does a determine b, b determine a, one-to-one."""
    d = df.select(a.alias("a"), b.alias("b")).distinct()
    ab = d.groupBy("a").agg(F.count(F.lit(1)).alias("k")).select(F.max("k")).scalar()
    ba = d.groupBy("b").agg(F.count(F.lit(1)).alias("k")).select(F.max("k")).scalar()
    return df.sparkSession.range(1).select((ab == 1).alias("a_determines_b"), (ba == 1).alias("b_determines_a"),
                                           ((ab == 1) & (ba == 1)).alias("one_to_one"))


def containment_rate(df: DataFrame, needle: str, hay: str, lower: bool = False) -> Column:
    """Share of rows where ``hay`` contains ``needle``."""
    n, h = F.col(needle), F.col(hay)
    if lower:
        n, h = F.lower(n), F.lower(h)
    return F.avg(F.coalesce(F.contains(h, n), F.lit(False)).cast("double"))


def conditional_membership(df: DataFrame, cond: Column, member: Column) -> DataFrame:
    """P(member | cond) and P(cond | member)."""
    return df.agg(F.avg(F.when(cond, member.cast("double"))).alias("p_member_given_cond"),
                  F.avg(F.when(member, cond.cast("double"))).alias("p_cond_given_member"))


def check_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null / NaN / infinite counts and range per derived numeric column."""
    rows = []
    for c in cols:
        x = F.col(c).cast("double")
        rows.append(F.struct(F.lit(c).alias("feature"),
                             F.sum(x.isNull().cast("int")).cast("bigint").alias("nulls"),
                             F.sum(F.coalesce(F.isnan(x), F.lit(False)).cast("int")).cast("bigint").alias("nans"),
                             F.sum(F.coalesce(F.abs(x) == float("inf"), F.lit(False)).cast("int")).cast("bigint").alias("infs"),
                             F.min(x).alias("min"), F.max(x).alias("max")))
    return df.agg(F.array(*rows).alias("a")).select(F.explode("a").alias("r")).select("r.*")
