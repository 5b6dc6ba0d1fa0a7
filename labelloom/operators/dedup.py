"""Exact duplicates. "Keep the first" always means first by an explicit order column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.hashing import as_list, order_key


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the earliest one, with all its columns.

    A plain aggregate, so copies collapse before the shuffle and a heavily repeated key costs one
    row per input task. When the key and the order column are all there is, it hashes only.
    """
    keys, order = list(keys), as_list(order)
    rest = [c for c in df.columns if c not in keys]
    if rest == order and len(order) == 1:
        return df.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*df.columns)
    first = F.min_by(F.struct(*rest), order_key(order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(before, after, removed) of a dedup on ``keys``, in one pass over the key groups."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
            F.count("*").alias("after"),
        )
        .withColumn("removed", F.col("before") - F.col("after"))
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
