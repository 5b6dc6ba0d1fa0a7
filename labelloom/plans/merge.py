"""Merging a main and an additional table with provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from labelloom.config import ADDITIONAL_SOURCE, LABELS, MAIN_SOURCE
from labelloom.operators.checks import require_labels
from labelloom.operators.dedup import duplicate_stats, keep_first
from labelloom.operators.distribution import merge_distributions
from labelloom.operators.ranking import seeded_shuffle
from labelloom.operators.rows import drop_invalid_rows, with_source
from labelloom.session import side_by_side
from labelloom.sources.writers import write_report, write_table

KEYS = ("text", "label")


def concatenated(
    main: DataFrame,
    additional: DataFrame,
    order: str = "ord",
    names: tuple[str, str] = (MAIN_SOURCE, ADDITIONAL_SOURCE),
) -> DataFrame:
    """Both tables, each cleaned and de-duplicated, under one schema with ``data_source`` and
    ``source_rank`` (main first)."""
    parts = []
    for rank, (table, name) in enumerate(zip((main, additional), names, strict=True)):
        unique = keep_first(drop_invalid_rows(table), KEYS, order)
        parts.append(with_source(unique, name).withColumn("source_rank", F.lit(rank)))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def merged_table(both: DataFrame, order: str = "ord") -> DataFrame:
    """One row per (text, label); the main table's row wins."""
    return keep_first(both, KEYS, ["source_rank", order])


def merge_summary(both: DataFrame, merged: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row: total_rows, duplicate_rows_removed, label_counts, data_source_counts."""
    stats = duplicate_stats(both, KEYS).select(
        F.col("after").alias("total_rows"), F.col("removed").alias("duplicate_rows_removed")
    )
    counts = merge_distributions(merged, labels)

    def folded(report: str, key: str) -> DataFrame:
        pairs = F.sort_array(F.collect_list(F.struct(key, "count")))
        return counts.where(F.col("report") == report).agg(F.map_from_entries(pairs).alias(f"{key}_counts"))

    return side_by_side(stats, folded("label", "label"), folded("data_source", "data_source"))


def merge_datasets(
    main: DataFrame,
    additional: DataFrame,
    output: str,
    reports: str,
    order: str = "ord",
    seed: int = 42,
    fmt: str = "parquet",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Merge, shuffle, write the table and four reports; returns the merged table as written."""
    for table in (main, additional):
        require_labels(drop_invalid_rows(table), "label", labels)
    both = concatenated(main, additional, order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        merged = merged_table(both, order).persist(StorageLevel.MEMORY_AND_DISK)
        write_table(seeded_shuffle(merged, KEYS, seed).drop("source_rank", order), output, fmt)
        counts = merge_distributions(merged, labels)
        for report, columns in (
            ("label", ["label", "count"]),
            ("data_source", ["data_source", "count"]),
            ("source_label", ["data_source", "label", "count"]),
        ):
            table = counts.where(F.col("report") == report).select(*columns).orderBy(*columns[:-1])
            write_table(table.coalesce(1), f"{reports}/{report}_distribution", "csv")
        write_report(merge_summary(both, merged, labels), f"{reports}/merge_summary")
        merged.unpersist()
    finally:
        both.unpersist()
    return main.sparkSession.read.format(fmt).options(header=True, multiLine=True, escape='"').load(output)
