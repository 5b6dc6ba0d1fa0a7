"""Smaller Arrow batches for jobs on wide rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _lower(spark: SparkSession, key: str, limit: int) -> None:
    before = int(spark.conf.get(key).removesuffix("b"))
    spark.conf.set(key, str(min(limit, before) if before > 0 else limit))


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send at most ``rows`` rows at a time to Python; the session's setting returns afterwards."""
    before = spark.conf.get(BATCH_ROWS)
    _lower(spark, BATCH_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def lower_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Send at most ``rows`` rows, or the rows that reach ``size`` bytes, at a time to Python for the rest of the session.

    For results that the caller computes later, when ``small_batches`` has ended. Limits already lower stay.
    """
    _lower(spark, BATCH_ROWS, rows)
    _lower(spark, BATCH_BYTES, size)
