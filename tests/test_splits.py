"""Split properties: disjoint groups, cover, determinism, balance, corruption detection."""

import random

import pytest
from pyspark.sql import functions as F

from ranklift.functions.scalars import hash_bigint
from ranklift.operators import splits as S
from ranklift.sources import io
from ranklift.sources.fixtures import impressions


@pytest.fixture(scope="module")
def built(spark, sf_small):
    df = impressions(spark, sf_small).cache()
    sp = S.make_splits(df).cache()
    return df, sp


def test_disjoint_and_cover(built):
    df, sp = built
    ov = S.group_overlap(sp).first()
    assert ov["test_train"] == ov["test_valid"] == ov["train_valid"] == 0
    assert ov["fold_groups_in_two_folds"] == 0
    cov = S.cover_check(df, sp).first()
    assert cov["repeated"] == 0 and cov["missing"] == 0 and cov["extra"] == 0


def test_sizes_are_exact(built):
    df, sp = built
    G = df.select("query_id").distinct().count()
    n_test = sp.where("role = 'test'").count()
    assert n_test == -(-G * 2 // 10)  # ceil(0.2 G)
    dev = G - n_test
    assert sp.where("role = 'valid'").count() == -(-dev * 2 // 10)


def test_deterministic(spark, built, sf_small):
    _, sp = built
    again = S.make_splits(impressions(spark, sf_small))
    assert S.split_fingerprint(sp).first()[0] == S.split_fingerprint(again).first()[0]


def test_folds_balanced(built):
    df, sp = built
    rows = df.join(sp.where("role <> 'test'"), "query_id").groupBy("fold").count().collect()
    sizes = [r["count"] for r in rows]
    largest = df.groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= largest


def test_corrupted_split_file_is_rejected(spark, built, tmpdir_path):
    _, sp = built
    io.save_splits(sp, tmpdir_path, {"seed": 42, "test_frac": 0.2})
    loaded, manifest = io.load_splits(spark, tmpdir_path)
    assert manifest["seed"] == 42 and loaded.count() == sp.count()
    first = sp.orderBy("query_id").first()["query_id"]
    bad = sp.withColumn("fold", F.when(F.col("query_id") == first, F.col("fold") + 7).otherwise(F.col("fold")))
    bad.write.mode("overwrite").parquet(f"{tmpdir_path}/tampered")
    spark.read.parquet(f"{tmpdir_path}/tampered").write.mode("overwrite").parquet(f"{tmpdir_path}/assignment")
    with pytest.raises(ValueError, match="fingerprint"):
        io.load_splits(spark, tmpdir_path)


def test_missing_splits_error(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        io.load_splits(spark, f"{tmpdir_path}/nothing")


def test_pack_groups_never_splits_a_group(spark, built):
    df, _ = built
    packed = S.pack_groups(df, "query_id", 20, shards=4)
    assert packed.groupBy("query_id").count().agg(F.max("count")).first()[0] == 1
    over = packed.groupBy("shard", "batch").agg(F.sum("rows").alias("r"), F.count("*").alias("g"))
    assert over.where("r > 20 AND g > 1").count() == 0


@pytest.mark.parametrize("batch_rows, shards", [(1, 1), (7, 1), (20, 3), (1000, 2), (5, None)])
def test_pack_groups_equals_the_greedy_loop(spark, batch_rows, shards):
    rng = random.Random(batch_rows)
    sizes = {f"g{i}": rng.choice((1, 1, 2, 3, 5, 8, 13)) for i in range(120)}
    sizes["hot"] = 200
    sizes[None] = 4
    rows = [(g,) for g, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "k string").repartition(4)
    h = {r.k: r.h for r in df.select("k", hash_bigint("k", 42).alias("h")).distinct().collect()}
    want = set()
    for shard in range(shards or 1):
        batch, used = 0, 0
        own = [g for g in sizes if (h[g] or 0) % (shards or 1) == shard]
        for g in sorted(own, key=lambda g: (h[g] is not None, h[g] or 0, g or "")):
            if used and used + sizes[g] > batch_rows:
                batch, used = batch + 1, 0
            used += sizes[g]
            want.add((g, shard, batch, sizes[g]))
    assert {tuple(r) for r in S.pack_groups(df, "k", batch_rows, shards).collect()} == want
    assert S.pack_groups(df.limit(0), "k", batch_rows, shards).count() == 0
