"""First-k per class, top-k, seeded order and exact ranks without a hot partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from labelloom.config import LABELS
from labelloom.functions.hashing import as_list, seeded_hash
from labelloom.session import bounded, label_table, small_table, small_window

HEX_DIGITS = 4
BUCKETS = 16**HEX_DIGITS
# Spark cuts row_number() <= k before the shuffle up to this k (its default).
GROUP_LIMIT = 1000
SPREAD = 64


def first_per_class(df: DataFrame, k: int, order: str | Sequence[str], label: str = "label") -> DataFrame:
    """The first ``k`` rows of every class, with their 1-based position.

    Up to GROUP_LIMIT, ``row_number() <= k`` is cut to k rows per class in each task before the shuffle. For a
    larger k the optimizer has no such cut: then each of SPREAD hash parts of a class is cut to k rows first, so the
    last sort of a class sees SPREAD * k rows at most, whatever its size.
    """
    return _first(df, k, label, as_list(order), "pos")


def _first(df: DataFrame, k: int, label: str, order: Sequence[str], pos: str) -> DataFrame:
    if k > GROUP_LIMIT:
        part = W.Window.partitionBy(label, "_part").orderBy(*order)
        df = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(SPREAD)))
        df = df.withColumn(pos, F.row_number().over(part)).where(F.col(pos) <= k).drop("_part", pos)
    window = W.Window.partitionBy(label).orderBy(*order)
    return df.withColumn(pos, F.row_number().over(window)).where(F.col(pos) <= k)


def examples_per_class(
    df: DataFrame, k: int, order: str | Sequence[str], labels: Sequence[str] = LABELS
) -> DataFrame:
    """(label, pos, text) of the first k texts per label; labels without rows give one null row."""
    picked = first_per_class(df.select("text", "label", *as_list(order)), k, order)
    dim = label_table(df.sparkSession, labels).select("label")
    return dim.join(picked.select("label", "pos", "text"), "label", "left")


def focused_examples(
    df: DataFrame, focus: Sequence[str], k: int, order: str | Sequence[str]
) -> DataFrame:
    """As above for chosen classes only, with the caller's class order as ``class_pos``."""
    wanted = label_table(df.sparkSession, focus).withColumnRenamed("label_id", "class_pos")
    chosen = df.where(F.col("label").isin(*focus)).select("text", "label", *as_list(order))
    return wanted.join(first_per_class(chosen, k, order).select("label", "pos", "text"), "label", "left")


def source_groups(
    df: DataFrame, sources_by_target: dict[str, list[str]], k: int, order: str | Sequence[str]
) -> DataFrame:
    """(target, source, count, examples) for every configured source, also those without rows."""
    pairs = [(t, s) for t, sources in sources_by_target.items() for s in sources]
    configured = small_table(
        df.sparkSession, {"target": [p[0] for p in pairs], "source": [p[1] for p in pairs]}
    )
    counts = df.groupBy(F.col("source_label").alias("source")).agg(F.count("*").alias("count"))
    firsts = (
        first_per_class(df.select("source_label", "text", *as_list(order)), k, order, "source_label")
        .groupBy(F.col("source_label").alias("source"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("items"))
    )
    none = F.array().cast(T.ArrayType(T.StringType()))
    return (
        configured.join(counts, "source", "left")
        .join(firsts, "source", "left")
        .select(
            "target", "source",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce(F.transform("items", lambda e: e["text"]), none).alias("examples"),
        )
    )


def cap_per_class(df: DataFrame, k: int, order: str | Sequence[str], label: str = "label") -> DataFrame:
    return first_per_class(df, k, order, label).drop("pos")


def shuffled_head(df: DataFrame, k: int, key: str | Sequence[str], seed: int, label: str = "label") -> DataFrame:
    """The first ``k`` rows of every class after a seeded shuffle; ``shuffle_pos`` keeps the order."""
    hashed = df.withColumn("_h", seeded_hash(seed, *as_list(key)))
    return _first(hashed, k, label, ["_h", *as_list(key)], "shuffle_pos").drop("_h")


def seeded_shuffle(df: DataFrame, key: str | Sequence[str], seed: int) -> DataFrame:
    """Whole table in seeded order: a range-partitioned sort on the hash."""
    h = seeded_hash(seed, *as_list(key))
    return df.orderBy(h, *as_list(key))


def bucket_of(hashed: Column) -> Column:
    return F.substring(hashed, 1, HEX_DIGITS)


def seeded_positions(
    df: DataFrame, key: str | Sequence[str], seed: int, position: str = "position"
) -> DataFrame:
    """Exact 1-based position of every row in the seeded order, without one global sort task.

    Rows are ranked inside hash buckets, which are even by construction, and shifted by the number
    of rows in the buckets before. Only the bucket counts (at most 65,536) pass through one task.
    """
    keys = as_list(key)
    hashed = df.withColumn("_h", seeded_hash(seed, *keys)).withColumn("_b", bucket_of(F.col("_h")))
    counts = hashed.groupBy("_b").agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(small_window().orderBy("_b").rowsBetween(W.Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    offsets = counts.select("_b", before.alias("_before"))
    inside = F.row_number().over(W.Window.partitionBy("_b").orderBy("_h", *keys))
    return (
        hashed.join(bounded(offsets, BUCKETS), "_b")
        .withColumn(position, F.col("_before") + inside)
        .drop("_h", "_b", "_before")
    )


def top_by_confidence(predictions: DataFrame, n: int, order: str | Sequence[str]) -> DataFrame:
    """Best n rows: per-task heaps, then one merge of n rows per task. Ties by the order column."""
    return predictions.orderBy(F.desc("confidence"), *as_list(order)).limit(n)


def sorted_by_confidence(predictions: DataFrame, order: str | Sequence[str]) -> DataFrame:
    return predictions.orderBy(F.desc("confidence"), *as_list(order))
