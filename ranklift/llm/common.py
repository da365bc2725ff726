"""Small helpers shared by the operators: word pattern, bindings, checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklift.session import ensure_checkpoint_dir

#: A word is a run of bytes other than space, \t, \n, \v, \f and \r.
WORD = r"[^ \t-\r]+"
WORD_SQL = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and evaluate ``body`` on the bound variable.

    A column referenced inside a higher-order function's lambda may be inlined by
    the optimizer and evaluated again for every element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def written(df: DataFrame, folder: str = "rows") -> DataFrame:
    """``df`` as compressed Parquet in the shared folder of ``spark.checkpoint.dir``; cuts the lineage."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{folder}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written and read again: fewer and smaller files than a checkpoint, read in fewer tasks."""
    return written(df, "saved")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slot_sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Byte array of 2**bits slots; each holds the largest ``level`` of the keys that fall into it.

    ``rows`` has key (long) and level (int, 0 to 255); a key's slot is its low ``bits``
    bits.  The size is fixed by ``bits``, whatever the number of keys, so the array may
    be broadcast.  Several keys may share a slot: a level is an upper bound, and 0 means
    that no key with a level is there.
    """
    low = min(bits, 14)
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    top = rows.groupBy(slot.alias("slot")).agg(F.max("level").alias("level"))

    def pack(part):
        data = np.zeros(1 << low, np.uint8)
        data[(part["slot"].to_numpy() & ((1 << low) - 1))] = part["level"].to_numpy()
        return pd.DataFrame({"seg": [int(part["slot"].iloc[0]) >> low], "data": [data.tobytes()]})

    out = np.zeros(1 << bits, np.uint8)
    packed = top.groupBy(F.shiftright("slot", low).alias("g")).applyInPandas(pack, "seg long, data binary")
    for r in packed.toLocalIterator():  # 2**(bits - 14) rows of 16 KB at most
        out[r.seg << low:(r.seg + 1) << low] = np.frombuffer(r.data, np.uint8)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the undirected edges (a, b); a component is named by its smallest node.

    Smallest label over the neighbours, then pointer jumping; about log2(longest path) rounds,
    each over the edges and nodes alone, checkpointed.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    state = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component"))
    while True:
        state = saved(state)
        near = (both.join(state.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        low = state.join(near, "node").select("node", F.least("component", "near").alias("low"), "component")
        jump = state.select(F.col("node").alias("low"), F.col("component").alias("far"))
        after = saved(low.join(jump, "low").select("node", F.least("low", "far").alias("component"),
                                                   (F.least("low", "far") < F.col("component")).alias("moved")))
        state = after.select("node", "component")
        if not after.filter("moved").limit(1).count():
            return state
