"""Stateless, target-blind derived columns (inventory C14, C16, C7).

One projection: runs on batch and streaming frames alike and never looks at
the target or at any statistic of the data set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklift.functions import scalars as S


def add_derived(df: DataFrame, use_temporal: bool = False) -> DataFrame:
    dl, dw, dh = S.parse_dimensions("dimensions_in")
    cols = {
        "price_pos": S.position_in_range("price", "filter_price_min", "filter_price_max"),
        "price_per_oz": S.price_per_unit("price", "net_weight_oz"),
        "dim_length": dl,
        "dim_width": dw,
        "dim_height": dh,
        "dim_volume": S.dim_volume(dl, dw, dh),
        "allergens": S.null_as_category("allergens"),
    }
    if "title" in df.columns:
        cols["marker"] = S.extract_marker("title")
    if use_temporal:
        cols.update(S.cyclic_time("timestamp"))
    return df.withColumns(cols)


def add_text(df: DataFrame, keep_marker: bool = True, keep_tail: bool = True) -> DataFrame:
    """Two text segments and their combined ``a [SEP] b`` form."""
    a, b = S.text_segments("title", "description", keep_marker, keep_tail)
    return df.withColumns({"text_a": a, "text_b": b, "text": F.concat_ws(" [SEP] ", a, b)})


def derive_tiers(df: DataFrame, level_col: str, target: str, high: float = 0.4, mid: float = 0.005,
                 out: str = "tier") -> DataFrame:
    """Data-driven tiers (C16): rate > high -> ALTO, > mid -> MEDIO, else CERO.

    The per-level rate table is small (one row per level); it is joined back.
    """
    rates = df.groupBy(level_col).agg(F.avg(F.col(target).cast("double")).alias("_rate"))
    t = F.when(F.col("_rate") > high, "ALTO").when(F.col("_rate") > mid, "MEDIO").otherwise("CERO")
    return df.join(rates.select(level_col, t.alias(out)), level_col, "left")
