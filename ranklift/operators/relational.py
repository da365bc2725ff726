"""Relational helpers that the other operators share (inventory J1-J8).

J2 (code lookup), J3/J7 (replace by key + union) and J4/J8 (semi joins on a key
set) live next to their users: ``features.FeatureModel.encode``,
``sources.io.merge_results`` and ``operators.splits``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_group_count(df: DataFrame, grp: str, out: str = "group_rows") -> DataFrame:
    """Each row gets the number of rows of its group (partial aggregation + equi join).

    An aggregate joined back, rather than a window over the group, so a hot group
    is pre-aggregated map-side and the join can be split by AQE's skew handling.
    """
    counts = df.groupBy(grp).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, grp)


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """J3 + J7: rows of ``old`` whose key appears in ``new`` are replaced by ``new``'s."""
    keep = old.join(new.select(key).distinct(), key, "left_anti")
    return keep.unionByName(new, allowMissingColumns=True)


def restrict_to_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is in a key set (semi join, no duplication)."""
    return df.join(keys.select(key), key, "left_semi")
