"""Ordered keep-first deduplication without a window over the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmleaf.runtime import distributed_rank, free_name


def mark_first(df: DataFrame, keys: list, pos: str, out: str = "is_first") -> DataFrame:
    """df with a flag on the row of each key that has the smallest pos (unique per row).

    The smallest pos per key is found with a map-side combine, so a key of a third of all rows costs one row per task;
    the flag comes back through pos, which has no hot value.
    """
    names = [free_name(df, f"_key{k}") for k in range(len(keys))]
    firsts = df.select(*(c.alias(n) for c, n in zip(keys, names)), pos).groupBy(*names).agg(F.min(pos).alias(pos)).select(pos, F.lit(True).alias(out))
    return df.join(firsts, pos, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def keep_first(df: DataFrame, keys: list, pos: str) -> DataFrame:
    flag = free_name(df, "_first")
    return mark_first(df, keys, pos, flag).filter(flag).drop(flag)


def reindex(df: DataFrame, pos: str, out: str = "row_index") -> DataFrame:
    """Row numbers 0..n-1 in the order of pos, without a single-task sort."""
    return distributed_rank(df, None, [F.col(pos)], out)
