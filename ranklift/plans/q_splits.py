"""Catalog entries for splits, folds, samples and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklift.functions.scalars import rnd
from ranklift.operators import eda, splits as S
from ranklift.plans.catalog import register
from ranklift.plans.q_eda import impressions_derived
from ranklift.plans.sqlutil import MARKER_SQL, R
from ranklift.session import written
from ranklift.sources.fixtures import impressions, with_sql


def H(key: str, seed) -> str:
    """DuckDB twin of ``hash_bigint``."""
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


SPLITS_CTE = f"""
, g AS (SELECT query_id, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives FROM impressions GROUP BY 1)
, o AS (SELECT *, {H('query_id', 42)} AS h1,
               CASE WHEN row_number() OVER (ORDER BY {H('query_id', 42)}, query_id) - 1 < ceil(0.2 * (SELECT count(*) FROM g))
                    THEN 'test' ELSE 'dev' END AS outer_role FROM g)
, d AS (SELECT * FROM o WHERE outer_role = 'dev')
, v AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {H('query_id', 43)}, query_id) - 1 < ceil(0.2 * (SELECT count(*) FROM d))
                       THEN 'valid' ELSE 'train' END AS role,
               row_number() OVER (ORDER BY rows DESC, h1, query_id) - 1 AS r FROM d)
, splits AS (SELECT query_id, 'test' AS role, -1 AS fold FROM o WHERE outer_role = 'test'
             UNION ALL SELECT query_id, role, CAST(CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) FROM v)"""


def _splits(spark, sf_dir, *columns):
    """(impressions, splits); only ``columns`` and those that the splits need are joined and written, once."""
    df = impressions(spark, sf_dir)
    if columns:
        df = df.select("query_id", "bought", *[c for c in columns if c not in ("query_id", "bought")])
    df = written(df, "impressions")
    return df, S.make_splits(df, "query_id", "bought", 0.2, 0.2, 5, 42)


def _assigned(spark, sf_dir, *columns):
    """Impressions with role and fold."""
    return S.with_assignment(*_splits(spark, sf_dir, *columns))


@register("split_summary", with_sql(SPLITS_CTE + f"""
, p AS (SELECT count(*) AS n_all, avg(CAST(bought AS DOUBLE)) AS p_all FROM impressions)
SELECT role, fold, count(*) AS rows, count(DISTINCT i.query_id) AS groups,
       CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives, {R('avg(CAST(bought AS DOUBLE))')} AS prevalence,
       {R('count(*) / min(n_all) * 100')} AS pct_rows, {R('(avg(CAST(bought AS DOUBLE)) - min(p_all)) * 100')} AS delta_pp
FROM impressions i JOIN splits s ON i.query_id = s.query_id, p GROUP BY role, fold""", "impressions"))
def q_split_summary(spark, sf_dir):
    df, sp = _splits(spark, sf_dir, "query_id")
    d = S.describe_splits(df, sp)
    return d.withColumns({c: rnd(c) for c in ("prevalence", "pct_rows", "delta_pp")})


@register("split_threshold", with_sql(f"""
SELECT CASE WHEN {H('query_id', 42)} / 4294967296.0 < 0.2 THEN 'test' ELSE 'dev' END AS role, count(*) AS groups
FROM (SELECT DISTINCT query_id FROM impressions) GROUP BY 1""", "impressions"))
def q_split_threshold(spark, sf_dir):
    groups = impressions(spark, sf_dir).select("query_id").distinct()
    return S.group_split(groups, "query_id", 0.2, 42, mode="threshold").groupBy("role").agg(
        F.count(F.lit(1)).alias("groups"))


@register("split_checks", with_sql(SPLITS_CTE + """
, per AS (SELECT query_id, list(DISTINCT role) AS roles FROM splits GROUP BY query_id)
, nf AS (SELECT query_id, count(DISTINCT fold) AS nf FROM splits WHERE role <> 'test' GROUP BY query_id)
SELECT CAST(sum(CASE WHEN list_contains(roles, 'test') AND list_contains(roles, 'train') THEN 1 ELSE 0 END) AS BIGINT) AS test_train,
       CAST(sum(CASE WHEN list_contains(roles, 'test') AND list_contains(roles, 'valid') THEN 1 ELSE 0 END) AS BIGINT) AS test_valid,
       CAST(sum(CASE WHEN list_contains(roles, 'train') AND list_contains(roles, 'valid') THEN 1 ELSE 0 END) AS BIGINT) AS train_valid,
       (SELECT CAST(sum(CAST(nf > 1 AS INTEGER)) AS BIGINT) FROM nf) AS fold_groups_in_two_folds
FROM per""", "impressions"))
def q_split_checks(spark, sf_dir):
    _, sp = _splits(spark, sf_dir, "query_id")
    return S.group_overlap(sp)


@register("split_fingerprint", with_sql(SPLITS_CTE + """
, rowh AS (SELECT CAST('0x' || substr(md5(concat_ws('|', query_id, role, CAST(fold AS VARCHAR))), 1, 15) AS BIGINT) AS h FROM splits)
, a AS (SELECT count(*) AS n, sum(h % 1099511627776) AS s, bit_xor(h) AS x FROM rowh)
SELECT substr(sha256(CAST(n AS VARCHAR) || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(x AS VARCHAR)), 1, 16) AS fingerprint FROM a""",
    "impressions"))
def q_split_fingerprint(spark, sf_dir):
    _, sp = _splits(spark, sf_dir, "query_id")
    return S.split_fingerprint(sp)


@register("split_cover", with_sql(SPLITS_CTE + """
, a AS (SELECT query_id, count(*) AS times FROM splits GROUP BY query_id)
SELECT CAST(sum(CAST(times > 1 AS INTEGER)) AS BIGINT) AS repeated,
       (SELECT count(*) FROM (SELECT DISTINCT query_id FROM impressions) k ANTI JOIN a ON k.query_id = a.query_id) AS missing,
       (SELECT count(*) FROM a ANTI JOIN (SELECT DISTINCT query_id FROM impressions) k ON k.query_id = a.query_id) AS extra
FROM a""", "impressions"))
def q_split_cover(spark, sf_dir):
    df, sp = _splits(spark, sf_dir, "query_id")
    return S.cover_check(df, sp)


@register("fold_sides", with_sql(SPLITS_CTE + """
, f AS (SELECT unnest([0, 1, 2, 3, 4]) AS k)
SELECT k AS fold, count(*) FILTER (WHERE s.fold <> k) AS train_rows, count(*) FILTER (WHERE s.fold = k) AS valid_rows
FROM impressions i JOIN splits s ON i.query_id = s.query_id, f WHERE s.role <> 'test' GROUP BY k""", "impressions"))
def q_fold_sides(spark, sf_dir):
    rows = _assigned(spark, sf_dir, "query_id")
    parts = []
    for k in range(5):  # k folds: a fixed, small driver loop
        tr, va = (S.side(rows, fold=k, fold_side=x).select(F.count(F.lit(1))).scalar() for x in ("train", "valid"))
        parts.append(spark.range(1).select(F.lit(k).alias("fold"), tr.alias("train_rows"), va.alias("valid_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("fraction_samples", with_sql(f"""
, r AS (SELECT bought, row_number() OVER (ORDER BY {H('row_id', 42)}, row_id) - 1 AS rk FROM impressions)
, f AS (SELECT unnest([0.1, 0.25, 0.5, 0.75, 1.0]) AS fraction)
SELECT CAST(fraction AS DOUBLE) AS fraction, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives
FROM r, f WHERE rk < floor(fraction * (SELECT count(*) FROM impressions)) GROUP BY fraction""", "impressions"))
def q_fraction_samples(spark, sf_dir):
    rows = written(impressions(spark, sf_dir).select("row_id", "bought"))
    s = S.fraction_samples(rows, "row_id")
    return s.groupBy("fraction").agg(F.count(F.lit(1)).alias("rows"),
                                     F.sum(F.col("bought").cast("int")).cast("bigint").alias("positives"))


@register("sample_groups_rates", with_sql(f"""
, k AS (SELECT query_id FROM (SELECT DISTINCT query_id FROM impressions) ORDER BY {H('query_id', 42)}, query_id LIMIT 200)
SELECT {MARKER_SQL} AS level, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives,
       {R('avg(CAST(bought AS DOUBLE))')} AS rate
FROM impressions SEMI JOIN k ON impressions.query_id = k.query_id GROUP BY 1""", "impressions"))
def q_sample_groups(spark, sf_dir):
    s = S.sample_groups(impressions_derived(spark, sf_dir), "query_id", 200)
    r = eda.rate_table(s, "marker")
    return r.withColumn("rate", rnd("rate"))


@register("factorize_query", with_sql("""
SELECT query_id, dense_rank() OVER (ORDER BY query_id) - 1 AS code FROM (SELECT DISTINCT query_id FROM impressions)""",
    "impressions"))
def q_factorize(spark, sf_dir):
    return S.factorize(impressions(spark, sf_dir), "query_id")


@register("epoch_batches", with_sql(f"""
, o AS (SELECT bought, row_number() OVER (ORDER BY {H('row_id', '42-1')}, row_id) - 1 AS pos FROM impressions)
SELECT CAST(floor(pos / 512) AS BIGINT) AS batch, count(*) AS rows, CAST(sum(CAST(bought AS INTEGER)) AS BIGINT) AS positives
FROM o WHERE floor(pos / 512) < floor((SELECT count(*) FROM impressions) / 512) GROUP BY 1""", "impressions"))
def q_epoch_batches(spark, sf_dir):
    o = S.epoch_order(impressions(spark, sf_dir), "row_id", 42, epoch=1, keep=["bought"])
    b = S.batch_assign(o, 512, drop_last=True)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(F.col("bought").cast("int")).cast("bigint").alias("positives"))


@register("pack_groups", with_sql(f"""
, z AS (SELECT query_id, count(*) AS rows, {H('query_id', 42)} AS h FROM impressions GROUP BY 1)
, c AS (SELECT greatest(1, CAST(ceil(count(DISTINCT query_id) / {S.SHARD_GROUPS}) AS BIGINT)) AS shards FROM impressions)
, o AS (SELECT query_id, rows, CAST(coalesce(h % shards, 0) AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY coalesce(h % shards, 0) ORDER BY h, query_id) AS pos FROM z, c)
, t AS (SELECT shard, pos, sum(rows) OVER (PARTITION BY shard ORDER BY pos) AS used, rows FROM o)
, near AS (SELECT shard, pos, used - rows + 64 AS room, unnest(range(pos + 1, pos + 66)) AS other FROM t)
, link AS (SELECT n.shard, n.pos, min(n.other) AS nxt FROM near n JOIN t ON t.shard = n.shard AND t.pos = n.other
           WHERE t.used > n.room GROUP BY 1, 2)
, opens AS (WITH RECURSIVE walk(shard, pos) AS (
    SELECT DISTINCT shard, CAST(1 AS BIGINT) FROM o
    UNION ALL SELECT l.shard, l.nxt FROM walk p JOIN link l ON l.shard = p.shard AND l.pos = p.pos) SELECT * FROM walk)
SELECT query_id, o.shard, CAST(count(p.pos) OVER (PARTITION BY o.shard ORDER BY o.pos) - 1 AS BIGINT) AS batch, rows
FROM o LEFT JOIN opens p ON p.shard = o.shard AND p.pos = o.pos""", "impressions"))
def q_pack_groups(spark, sf_dir):
    return S.pack_groups(impressions(spark, sf_dir), "query_id", 64)
