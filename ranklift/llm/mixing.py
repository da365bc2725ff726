"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: source shares fill up like water.  Every source gets words in proportion to its
weight until it reaches ``most`` times its size; the excess goes to the others by weight.

Draws: the documents of a source fall into blocks by hash; every pass over a source takes
its blocks in a pseudo-random order, whole passes first, then a part of one more, whose
last block is cut inside one document so that the source's words meet its target exactly.
The block quotas of all sources are then dealt among the output shards by a binary tree:
a node splits its quotas between its two halves with one multivariate-hypergeometric
draw, so each shard gets an exact number of blocks and each source its exact quota.  A
leaf walks its own path from the root (draws are seeded by the node), hence all leaves
run side by side; shards draw disjoint ranges of the permuted block list, and documents
are shuffled inside their shard.  All randomness is hashing and seeded by node: reruns
agree.

Per source there is one row (sources are named in a mix's weights, so they are few); per
block of about ``block_rows`` documents there is one row; a hot source is many blocks.

Defined results: null text has size 0; sources stand in code point order, null last, and
take the weights in turn; an all-empty table has targets 0; a document with size 0 is in
no mix; repeated rows are taken together and share
what they take, to a word (rows without a doc_id are the same row if their texts are equal); further columns pass through ``mix``; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import WORD, saved, table

#: Random pieces of an output shard; each is shuffled by itself.
PIECES = 32
#: Equal rows that one step hands out.
ROWS = 1 << 16


def word_count():
    """Number of words in ``text``; null has none."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(seed: int, *cells):
    """Hash of ``cells`` and the doc_id, of the text in place of a null doc_id."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text", *cells)).otherwise(
        F.xxhash64(F.lit(seed), "doc_id", *cells))


def _same_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, sid, key), a null doc_id being equal to null; ``right``'s copies of them go."""
    right = right.withColumnsRenamed({c: f"__{c}" for c in ("doc_id", "sid", "key")})
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("sid") == F.col("__sid")) & (F.col("key") == F.col("__key"))
    return left.join(right, same, how).drop("__doc_id", "__sid", "__key")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(sid, source, source_size, n_docs, target) for each source; sid counts sources from 0."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", (F.row_number().over(order) - 1).cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                F.col("sid") % len(weights) + 1))
    cap = F.col("source_size") * most
    full = Window.orderBy(cap / F.col("weight"), "sid")
    per = per.withColumns({
        "before": F.coalesce(F.sum(cap).over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "others": F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(Window.partitionBy()) * share})
    # the level if all sources before this one are full; the first that stays below its cap sets it
    level = (F.col("all") - F.col("before")) / F.col("others")
    per = per.withColumn("at", F.when(level * F.col("weight") <= cap, F.struct(
        F.row_number().over(full).alias("i"), level.alias("level"))))
    per = per.withColumn("level", F.min("at").over(Window.partitionBy())["level"])
    return per.select("sid", "source", "source_size", "n_docs", F.coalesce(
        F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def leaf_quotas(quotas: Sequence[int], shards: int, leaf: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) for each source: the range of its permuted draws that belongs to shard ``leaf``."""
    have, first = np.array(quotas, np.int64), np.zeros(len(quotas), np.int64)
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(have.sum())
        left = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        part = rng.multivariate_hypergeometric(have, left, method="marginals") if total else have * 0
        if leaf < mid:
            have, hi = part, mid
        else:
            have, first, lo = have - part, first + part, mid
    return first, have


def draws(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
          block_rows: int = 256, shard_words: int = 16_000_000, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(documents, takes).

    documents: (doc_id, sid, block, size, source_size, target, whole, key): ``whole`` full passes.
    takes: (sid, block, pass, shard, words): how many words of the block each draw takes.
    """
    spark = docs.sparkSession
    sizes = docs.select("doc_id", "source", "text", word_count().alias("size"))
    sizes = saved(sizes.select("doc_id", "source", "size", row_hash(seed, "size").alias("key"), row_hash(seed + 1).alias("spot")))
    per = saved(targets(sizes, weights, share, most))
    per = per.withColumns({
        "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        "blocks": F.ceil(F.col("n_docs") / block_rows)})
    per = per.withColumn("rest", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    placed = sizes.join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "block", F.pmod("spot", "blocks"))
    placed = saved(placed.select("doc_id", "sid", "block", "size", "source_size", "target", "whole", "rest", "key"))
    block = placed.groupBy("sid", "block").agg(F.sum("size").alias("words"), F.first("whole").alias("whole"),
                                               F.first("rest").alias("rest"))
    block = block.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), "whole")))
    mine = Window.partitionBy("sid", "pass").orderBy(F.xxhash64(F.lit(seed + 2), "sid", "pass", "block"), "block")
    upto = F.sum("words").over(mine) - F.col("words")
    block = block.withColumn("take", F.when(F.col("pass") < F.col("whole"), F.col("words")).otherwise(
        F.greatest(F.lit(0).cast("long"), F.least("words", F.col("rest") - upto)))).filter("take > 0")
    dealt = Window.partitionBy("sid").orderBy("pass", F.xxhash64(F.lit(seed + 3), "sid", "pass", "block"), "block")
    block = saved(block.withColumn("at", F.row_number().over(dealt) - 1))

    quota = {r.sid: r.n for r in block.groupBy("sid").agg(F.count("*").alias("n")).collect()}  # one row a source
    names, counts = sorted(quota), [quota[s] for s in sorted(quota)]
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(total * share) // shard_words))

    def leaves(parts):
        for part in parts:
            for leaf in part["id"]:
                first, n = leaf_quotas(counts, shards, int(leaf), seed)
                yield pd.DataFrame({"sid": np.array(names, np.int32), "first": first, "n": n, "shard": int(leaf)})

    dealt_out = (spark.range(shards).mapInPandas(leaves, "sid int, first long, n long, shard long").filter("n > 0")
                 .select("sid", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("at")))
    takes = block.join(dealt_out, ["sid", "at"]).select("sid", "block", "pass", "shard", F.col("take").alias("words"))
    return placed, saved(takes)


def taken_rows(placed: DataFrame, takes: DataFrame) -> DataFrame:
    """(doc_id, sid, size, shard, pass, words, copies): one row for each time a document is in the mix."""
    mine = Window.partitionBy("sid", "block").orderBy("key", "doc_id")
    at = placed.withColumn("upto", F.sum("size").over(mine.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    words = F.least("size", F.col("words") - F.col("upto"))
    return (at.join(takes, ["sid", "block"]).withColumn("words", words).filter("words > 0")
            .select("doc_id", "sid", "size", "key", "shard", "pass", "words"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) for every row of ``docs``; shards: where its words go."""
    placed, takes = draws(docs, **options)
    got = taken_rows(placed, takes).groupBy("doc_id", "sid", "key").agg(
        F.sum("words").alias("got"), F.array_sort(F.collect_set("shard")).alias("shards"))
    same = placed.groupBy("doc_id", "sid", "key", "size", "source_size", "target").agg(F.count("*").alias("rows"))
    # repeated rows share what their copies take, the first ones a word more where it doesn't divide; they are
    # one row here and come back in blocks
    per = _same_row(same, got, "left").withColumn("got", F.coalesce("got", F.lit(0)))
    per = per.withColumn("block", F.explode(F.expr(f"sequence(0, (rows - 1) div {ROWS})")))
    per = per.repartition("key", "block").withColumn("at", F.explode(F.expr(
        f"sequence(block * {ROWS}, least(rows, (block + 1) * {ROWS}) - 1)")))
    taken = F.floor(F.col("got") / F.col("rows")) + (F.col("at") < F.col("got") % F.col("rows")).cast("long")
    return per.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
                      F.coalesce("shards", F.array().cast("array<long>")).alias("shards"))


def mix(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a row for each time a document is taken.

    Rows are placed by shard and shuffled inside it: a hash of the draw gives each row its
    order and one of ``PIECES`` random pieces of its shard, and each piece is sorted by
    itself, so that no task holds a whole shard.  A document cut at its source's target
    keeps its first words, joined by spaces; ``n_chars``, if there, follows the text.
    """
    placed, takes = draws(docs, seed=seed, **options)
    rows = taken_rows(placed, takes).dropDuplicates(["doc_id", "key", "pass"]).select(
        *[F.col(c).alias(f"__{c}") for c in ("doc_id", "key", "shard", "pass", "words", "size")])
    out = docs.withColumn("__mine", row_hash(seed, word_count()))
    out = out.join(rows, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__mine") == F.col("__key")))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__words").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("__words") < F.col("__size"), first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    own = F.when(F.col("__doc_id").isNull(), F.xxhash64(F.lit(seed + 4), "__shard", "__pass", "__key"))
    out = out.withColumn("__order", own.otherwise(F.xxhash64(F.lit(seed + 4), "__shard", "__pass", "__doc_id")))
    out = out.withColumn("__piece", F.pmod("__order", F.lit(PIECES)))
    out = out.repartition("__shard", "__piece").sortWithinPartitions("__shard", "__piece", "__order")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


@register("op10_mixing")
def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
