"""Session helpers: checkpoint folder, small driver-side tables, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

# A table is only broadcast on our own hint when its row count is bounded by configuration.
MAX_HINTED_ROWS = 500_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, benches) gets a scratch folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running this job")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="labelloom-ckpt-"))


def stored(df: DataFrame) -> DataFrame:
    """The table without its lineage, like a checkpoint, but in compressed columns: texts take a third of the disk."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return widened(spark.read.schema(df.schema).parquet(folder))


def small_table(spark: SparkSession, columns: dict[str, Sequence], types: dict[str, pa.DataType] | None = None) -> DataFrame:
    """A configuration-sized table. Arrow makes it a local relation, so the optimizer knows its size."""
    types = types or {}
    arrays = {name: pa.array(list(values), types.get(name, pa.string())) for name, values in columns.items()}
    return spark.createDataFrame(pa.table(arrays))


def label_table(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """The closed label set as a dimension table (label, label_id)."""
    return small_table(
        spark,
        {"label": labels, "label_id": range(len(labels))},
        {"label_id": pa.int32()},
    )


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a table with at most ``max_rows`` rows, a bound the caller can prove."""
    return F.broadcast(df) if max_rows <= MAX_HINTED_ROWS else df


def side_by_side(*tables: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row, by union and aggregate instead of a join."""
    tall = tables[0]
    for table in tables[1:]:
        tall = tall.unionByName(table, allowMissingColumns=True)
    return tall.agg(*[F.first(c, ignorenulls=True).alias(c) for c in tall.columns])


def small_window() -> WindowSpec:
    """One window over everything, for label-sized or otherwise bounded results only."""
    return Window.partitionBy(F.lit(0))


def widened(scan: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer input splits than cores, as one small file has.

    Text cleaning costs far more than moving such a file. A scan with enough splits is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
