"""Sharding by jump consistent hashing.

A key's shard follows from the key and the number of shards alone, without a table: a pseudo-random walk over shard
counts tells where the key would jump next. With one shard more, a row either stays or moves into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

# Fixed values of the jump hash: the multiplier of its generator and the scale of its 31-bit fractions.
MULTIPLIER = 2862933555777941757
SCALE = float(1 << 31)

BUCKET_ROWS = 4_000  # different rows that one task sorts at a time
CHUNK_ROWS = 4_096  # copies of a row that are numbered at a time


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of every 64-bit key."""
    if shards < 1:
        raise ValueError("there must be one shard at least")
    state, at, ahead = keys.astype(np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        fraction = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((at[moving] + 1) * (SCALE / fraction)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def _half(mark: Column, start: int) -> Column:
    return F.conv(F.substring(mark, start, 8), 16, 10).cast("long")


def with_shards(rows: DataFrame, id_col: str, shards: int, grown: bool = False) -> DataFrame:
    """Add shard (int) and, on request, grown_shard (int): the shard if there were one more. No shuffle.

    The key is the first 64 bits of the md5 of the id as text, so that a number and its text agree. A null id counts as
    the empty text. Rows with equal ids share a shard. Columns of these names are replaced, others pass unchanged.
    """
    added = ["shard", "grown_shard"] if grown else ["shard"]

    @F.pandas_udf(", ".join(f"{c} int" for c in added))
    def of(high: pd.Series, low: pd.Series) -> pd.DataFrame:
        keys = (high.to_numpy(np.uint64) << np.uint64(32)) | low.to_numpy(np.uint64)
        return pd.DataFrame({c: jump(keys, shards + i) for i, c in enumerate(added)})

    mark = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    kept = [c for c in rows.columns if c not in added]
    found = rows.select(*kept, of(_half(mark, 1), _half(mark, 9)).alias("__of"))
    return found.select(*kept, *[F.col(f"__of.{c}").alias(c) for c in added])


def numbered(rows: DataFrame, order: list[str], group_col: str = "shard", bucket_rows: int = BUCKET_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add slot (long): the place of a row in its group, from 0 without gaps.

    Rows come in the order of the md5 of the ``order`` columns as text (joined by commas, null as the empty text), then
    of all columns. Equal rows are interchangeable: they are counted first and numbered in chunks, so that a row that
    makes up a third of the table costs no more to sort than another. A column named slot is replaced. A null group
    is a group of its own; an empty table stays empty. All columns travel: give narrow rows.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.drop("slot")
    names = rows.columns
    mark = F.md5(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    different = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).withColumn("__mark", mark).checkpoint()
    largest = different.groupBy(group_col).agg(F.count(F.lit(1)).alias("rows"), F.max("__n").alias("copies"))
    most, copies = largest.agg(F.max("rows"), F.max("copies")).first()
    buckets = max(1, -(-(most or 0) // bucket_rows))
    bucket = F.floor(_half(F.col("__mark"), 1) * F.lit(buckets) / F.lit(1 << 32)).cast("int")
    spread = different.withColumn("__bucket", bucket)
    sizes = spread.groupBy(F.col(group_col).alias("__g"), F.col("__bucket").alias("__b")).agg(F.sum("__n").alias("__size"))
    earlier = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__ahead", F.coalesce(F.sum("__size").over(earlier), F.lit(0))).drop("__size")
    before = Window.partitionBy(group_col, "__bucket").orderBy("__mark", *names).rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumn("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    placed = placed.join(offsets, F.col(group_col).eqNullSafe(F.col("__g")) & (F.col("__bucket") == F.col("__b")))
    placed = placed.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / chunk_rows))))
    if (copies or 0) > chunk_rows:
        placed = placed.repartition("__mark", "__chunk")
    first = F.col("__chunk") * chunk_rows
    copy = F.explode(F.sequence(first, F.least(first + chunk_rows, F.col("__n")) - 1))
    return placed.withColumn("__copy", copy).withColumn("slot", F.col("__ahead") + F.col("__r") + F.col("__copy")).select(*names, "slot")


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", shards: int = 24, files: int = 1) -> None:
    """Write whole rows below ``folder``, one directory shard=i for each shard, ``files`` files in each at most.

    Rows of a shard are dealt to its files by the hash of the whole row; equal rows share a file. Empty shards have no
    directory. The folder must be new.
    """
    sharded = with_shards(docs, id_col, shards)
    spread = sharded.withColumn("__file", F.pmod(F.xxhash64(*docs.columns), F.lit(files)))
    spread.repartition(shards * files, "shard", "__file").drop("__file").write.partitionBy("shard").parquet(folder)
