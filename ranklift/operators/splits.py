"""Group-disjoint splits, folds, samples and batches (inventory E1-E13, J4-J6, J8).

Randomness is a hash of ``seed:key`` (X2), so an assignment is a pure function
of the key: the same on any cluster size, partitioning or rerun.  Count-exact
cuts ("the first ceil(f x G) groups in hash order") use the distributed dense
index (X3) instead of a global sort into one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.functions.scalars import hash_bigint
from ranklift.operators.ordering import dense_index
from ranklift.session import written


def group_table(df: DataFrame, grp: str, target: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    if target:
        aggs.append(F.sum(F.col(target).cast("int")).cast("bigint").alias("positives"))
    return df.groupBy(grp).agg(*aggs)


# E1 / E2 ---------------------------------------------------------------------
def group_split(groups: DataFrame, grp: str, frac: float, seed: int = 42, mode: str = "exact",
                role_in: str = "test", role_out: str = "dev", out: str = "role") -> DataFrame:
    """Two-way split of a table of distinct groups.

    ``exact``: the first ceil(frac x G) groups in (hash, key) order get ``role_in``.
    ``threshold``: hash/2^32 < frac, one pass, count only in expectation.
    """
    h = hash_bigint(grp, seed)
    g = groups.withColumn("_h", h)
    if mode == "threshold":
        cut = F.col("_h") / F.lit(4294967296.0) < F.lit(frac)
        return g.withColumn(out, F.when(cut, role_in).otherwise(role_out)).drop("_h")
    if mode != "exact":
        raise ValueError(f"unknown split mode {mode!r}")
    n_in = F.ceil(F.lit(frac) * groups.select(F.count(F.lit(1))).scalar())
    idx = dense_index(g, ["_h", grp], out="_i")
    return idx.withColumn(out, F.when(F.col("_i") < n_in, role_in).otherwise(role_out)).drop("_h", "_i")


# E3 --------------------------------------------------------------------------
def group_kfold(groups: DataFrame, grp: str, k: int = 5, seed: int = 42, size_col: str = "rows",
                out: str = "fold") -> DataFrame:
    """Deal groups to k folds in snake order of (size desc, hash, key): balanced rows."""
    g = groups.withColumn("_h", hash_bigint(grp, seed))
    idx = dense_index(g, [F.desc(size_col), F.asc("_h"), F.asc(grp)], out="_r")
    cycle, pos = F.floor(F.col("_r") / k), F.col("_r") % k
    fold = F.when(cycle % 2 == 0, pos).otherwise(F.lit(k - 1) - pos).cast("int")
    return idx.withColumn(out, fold).drop("_h", "_r")


# E4 --------------------------------------------------------------------------
def make_splits(df: DataFrame, grp: str = "query_id", target: str = "bought", test_frac: float = 0.2,
                valid_frac: float = 0.2, k: int = 5, seed: int = 42) -> DataFrame:
    """One assignment row per group: role (test/train/valid) and fold (dev only, else -1)."""
    groups = written(group_table(df, grp, target), "groups")  # one row per group, read by three dense-index passes
    outer = written(group_split(groups, grp, test_frac, seed, role_in="test", role_out="dev", out="outer"), "groups")
    dev = outer.where(F.col("outer") == "dev")
    inner = group_split(dev, grp, valid_frac, seed + 1, role_in="valid", role_out="train", out="role")
    folds = group_kfold(dev, grp, k, seed)
    test = outer.where(F.col("outer") == "test").select(grp, F.lit("test").alias("role"), F.lit(-1).alias("fold"))
    devrows = inner.select(grp, "role").join(folds.select(grp, "fold"), grp)
    return test.unionByName(devrows)


def apply_assignment(df: DataFrame, splits: DataFrame, grp: str = "query_id", role: str | None = None,
                     fold: int | None = None, fold_side: str | None = None) -> DataFrame:
    """Rows of one partition (J8).  ``fold_side``: 'train' or 'valid' of fold ``fold`` inside dev."""
    s = splits
    if role is not None:
        s = s.where(F.col("role").isin(role) if isinstance(role, (list, tuple)) else F.col("role") == role)
    if fold is not None:
        s = s.where(F.col("role") != "test")
        s = s.where(F.col("fold") == fold) if fold_side == "valid" else s.where(F.col("fold") != fold)
    return df.join(s.select(grp), grp, "left_semi")


def with_assignment(df: DataFrame, splits: DataFrame, grp: str = "query_id") -> DataFrame:
    """Rows of ``df`` with their ``role`` and ``fold``, written once: every side is a filter of it (see ``side``)."""
    return written(df.join(splits.select(grp, "role", "fold"), grp), "assigned")


def side(assigned: DataFrame, role: str | list[str] | None = None, fold: int | None = None, fold_side: str | None = None) -> DataFrame:
    """What ``apply_assignment`` gives, from the rows of ``with_assignment``."""
    s = assigned
    if role is not None:
        s = s.where(F.col("role").isin(*([role] if isinstance(role, str) else role)))
    if fold is not None:
        s = s.where(F.col("role") != "test")
        s = s.where(F.col("fold") == fold) if fold_side == "valid" else s.where(F.col("fold") != fold)
    return s.drop("role", "fold")


# E5 --------------------------------------------------------------------------
def describe_splits(df: DataFrame, splits: DataFrame, grp: str = "query_id", target: str = "bought") -> DataFrame:
    y = F.col(target).cast("double")
    # rows of a group share their side: they are added up first, so the join and the count of groups see one row a group
    per = df.groupBy(grp).agg(F.count(F.lit(1)).alias("_n"), F.count(y).alias("_m"), F.sum(y).alias("_y"))
    rows = per.join(splits.select(grp, "role", "fold"), grp)
    one = df.agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("p")).first()
    n_all, p_all = F.lit(one.n), F.lit(one.p).cast("double")
    return (rows.groupBy("role", "fold")
            .agg(F.sum("_n").alias("rows"), F.count_distinct(grp).alias("groups"),
                 F.sum("_y").cast("bigint").alias("positives"), F.try_divide(F.sum("_y"), F.sum("_m")).alias("prevalence"))
            .withColumns({"pct_rows": F.col("rows") / n_all * 100,
                          "delta_pp": (F.col("prevalence") - p_all) * 100}))


# E6 --------------------------------------------------------------------------
def split_fingerprint(splits: DataFrame, grp: str = "query_id") -> DataFrame:
    """Order-free fingerprint: sha256 over (count, sum, xor) of per-row md5 prefixes, 16 hex."""
    row = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(grp).cast("string"), "role", F.col("fold").cast("string"))),
                             1, 15), 16, 10).cast("bigint")
    agg = splits.agg(F.count(F.lit(1)).alias("n"), F.sum(row % F.lit(1 << 40)).alias("s"), F.bit_xor(row).alias("x"))
    return agg.select(F.substring(F.sha2(F.concat_ws(":", "n", "s", "x"), 256), 1, 16).alias("fingerprint"))


# J5 / E7 ---------------------------------------------------------------------
PAIRS = [("test", "train"), ("test", "valid"), ("train", "valid")]


def group_overlap(splits: DataFrame, grp: str = "query_id") -> DataFrame:
    """Shared groups for every pair of roles that must be disjoint (and fold train/valid)."""
    roles = splits.select(grp, "role").distinct()
    per = roles.groupBy(grp).agg(F.collect_set("role").alias("roles"))  # at most 3 roles per group
    exprs = [F.sum(F.when(F.array_contains("roles", a) & F.array_contains("roles", b), 1).otherwise(0))
             .cast("bigint").alias(f"{a}_{b}") for a, b in PAIRS]
    folds = splits.where(F.col("role") != "test").groupBy(grp).agg(F.count_distinct("fold").alias("nf"))
    return per.agg(*exprs).withColumn(
        "fold_groups_in_two_folds", folds.select(F.sum((F.col("nf") > 1).cast("int")).cast("bigint")).scalar())


def check_splits(df: DataFrame, splits: DataFrame, grp: str = "query_id", target: str = "bought",
                 tol_pp: float = 1.5) -> DataFrame:
    ov = group_overlap(splits, grp)
    desc = describe_splits(df, splits, grp, target)
    worst = desc.select(F.max(F.abs("delta_pp"))).scalar()
    fold_pos = desc.where(F.col("fold") >= 0).groupBy("fold").agg(F.sum("positives").alias("p"))
    no_pos = fold_pos.select(F.sum((F.col("p") == 0).cast("int"))).scalar()
    return ov.withColumns({"max_delta_pp": worst, "folds_without_positive": no_pos,
                           "ok": (F.col("test_train") + F.col("test_valid") + F.col("train_valid")
                                  + F.col("fold_groups_in_two_folds") == 0) & (worst <= tol_pp) & (no_pos == 0)})


def cover_check(df: DataFrame, splits: DataFrame, grp: str = "query_id") -> DataFrame:
    """Every row is assigned exactly once; missing and extra groups counted."""
    keys = df.select(grp).distinct()
    assigned = splits.groupBy(grp).agg(F.count(F.lit(1)).alias("times"))
    missing = keys.join(assigned, grp, "left_anti").select(F.count(F.lit(1))).scalar()
    extra = assigned.join(keys, grp, "left_anti").select(F.count(F.lit(1))).scalar()
    return assigned.agg(F.sum((F.col("times") > 1).cast("int")).cast("bigint").alias("repeated")).withColumns(
        {"missing": missing, "extra": extra})


# E8 / E9 / E10 / E12 / E13 ---------------------------------------------------
def fraction_samples(df: DataFrame, key: str, fracs=(0.1, 0.25, 0.5, 0.75, 1.0), seed: int = 42) -> DataFrame:
    """Nested samples without replacement: a row is in sample f when its hash rank < int(f x N)."""
    n = F.lit(df.count())
    idx = dense_index(df.withColumn("_h", hash_bigint(key, seed)), ["_h", key], out="_rank")
    arr = F.array(*[F.lit(float(f)) for f in fracs])
    return (idx.withColumn("fraction", F.explode(arr))
            .where(F.col("_rank") < F.floor(F.col("fraction") * n)).drop("_h"))


def sample_groups(df: DataFrame, grp: str, n: int, seed: int = 42) -> DataFrame:
    """n groups drawn by hash order (a TakeOrdered of n keys) and their rows (J4 semi join)."""
    keys = (df.select(grp).distinct().withColumn("_h", hash_bigint(grp, seed))
            .orderBy("_h", grp).limit(n).select(grp))
    return df.join(keys, grp, "left_semi")


def factorize(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """Dense integer code per distinct key in sorted order."""
    return dense_index(df.select(col).distinct(), [col], out=out)


def epoch_order(df: DataFrame, key: str = "row_id", seed: int = 42, epoch: int = 0, out: str = "pos",
                keep: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` with their place in an epoch; only the columns ``keep`` (None: all) go with them."""
    h = hash_bigint(key, f"{seed}-{epoch}")
    keep = list(df.columns if keep is None else keep)
    return dense_index(df.select(*{key: 0, **dict.fromkeys(keep)}).withColumn("_h", h), ["_h", key], out=out, keep=keep)


def batch_assign(ordered: DataFrame, size: int, drop_last: bool = False, pos: str = "pos") -> DataFrame:
    n = ordered.select(F.count(F.lit(1))).scalar()
    out = ordered.withColumn("batch", F.floor(F.col(pos) / size).cast("bigint"))
    if drop_last:
        out = out.where(F.col("batch") < F.floor(n / size))
    return out


# E11 -------------------------------------------------------------------------
SHARD_GROUPS = 100_000


def pack_groups(df: DataFrame, grp: str, batch_rows: int, shards: int | None = None, seed: int = 42) -> DataFrame:
    """Training-export layout: batches that never split a group.

    Groups are hashed to shards, by default as many as keep a shard near ``SHARD_GROUPS`` groups,
    so a shard's group sizes stay bounded however many groups there are.  Inside a shard groups are
    packed in hash order, closing a batch when the next group would overflow; a group above
    ``batch_rows`` is a batch of its own.  Each group points to the one that would open the next
    batch if it opened one itself; the groups that do are those the first one reaches, found by
    doubling the pointers.  Output: (grp, shard, batch, rows).  A null key is a group.
    """
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    sizes = df.groupBy(grp).agg(F.count(F.lit(1)).alias("rows")).withColumn("_h", hash_bigint(grp, seed))
    n_shards = F.lit(shards) if shards else F.greatest(F.lit(1), F.ceil(
        df.select(F.count_distinct(grp)).scalar() / SHARD_GROUPS))
    sizes = sizes.withColumn("shard", F.coalesce(F.col("_h") % n_shards, F.lit(0)).cast("int"))
    by_hash = Window.partitionBy("shard").orderBy("_h", grp)
    start = F.sum("rows").over(by_hash.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    placed = written(sizes.withColumns({"pos": F.row_number().over(by_hash), "start": start})
                     .select(grp, "shard", "rows", "pos", "start"), "pack")

    reach = Window.partitionBy("shard").orderBy("start").rangeBetween(Window.unboundedPreceding, batch_rows)
    ends = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("total"))
    to = F.greatest(F.col("pos") + 1, F.col("_m"))  # the last group within reach need not fit
    fits = (F.col("_m") == F.col("n")) & (F.col("total") <= F.col("start") + batch_rows)
    links = placed.select("shard", "pos", "start", F.count(F.lit(1)).over(reach).alias("_m")).join(ends, "shard")
    links = written(links.where(~fits).select("shard", F.col("pos").cast("long").alias("pos"), to.alias("to"))
                    .where(F.col("to") <= F.col("n")), "pack")
    opens = placed.where("pos = 1").select("shard", F.col("pos").cast("long").alias("pos"))
    while links.limit(1).count():  # log2 of the largest number of batches in a shard
        opens = written(opens.union(opens.join(links, ["shard", "pos"]).select("shard", F.col("to").alias("pos"))), "pack")
        onward = links.select("shard", F.col("pos").alias("to"), F.col("to").alias("far"))
        links = written(links.join(onward, ["shard", "to"]).select("shard", "pos", F.col("far").alias("to")), "pack")
    flagged = placed.join(opens.withColumn("_open", F.lit(1)), ["shard", "pos"], "left")
    upto = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.select(grp, "shard", (F.sum(F.coalesce("_open", F.lit(0))).over(upto) - 1).alias("batch"), "rows")
