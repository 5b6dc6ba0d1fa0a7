"""Constraints. Each has a table form with all offenders; the raising forms name some and say how many there are."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from labelloom.config import LABELS, MappingSpec
from labelloom.session import label_table, small_table

SHOWN = 100


def _listed(offenders: DataFrame, order: Sequence[str], text: Callable[[Row], str]) -> str | None:
    """The first SHOWN offenders as text, with the full count where there are more; None without any."""
    found = offenders.orderBy(*order).take(SHOWN + 1)
    if not found:
        return None
    more = f", ... ({offenders.count()} in all)" if len(found) > SHOWN else ""
    return ", ".join(text(r) for r in found[:SHOWN]) + more


def missing_columns(present: Iterable[str], required: Iterable[str]) -> list[str]:
    return sorted(set(required).difference(present))


def require_columns(columns: Iterable[str] | DataFrame, required: Iterable[str]) -> None:
    present = columns.columns if isinstance(columns, DataFrame) else columns
    gone = missing_columns(present, required)
    if gone:
        raise ValueError("missing required columns: " + ", ".join(gone))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def unsupported_labels(df: DataFrame, label: str, allowed: Sequence[str] = LABELS) -> DataFrame:
    """Distinct labels outside the closed set, as table (label)."""
    dim = label_table(df.sparkSession, allowed).select("label")
    return df.select(F.col(label).alias("label")).distinct().join(dim, "label", "left_anti")


def require_labels(df: DataFrame, label: str, allowed: Sequence[str] = LABELS) -> DataFrame:
    shown = _listed(unsupported_labels(df, label, allowed), ["label"], lambda r: str(r["label"]))
    if shown:
        raise ValueError(f"unsupported labels: {shown}; expected: {', '.join(allowed)}")
    return df


def require_two_labels(df: DataFrame, label: str) -> DataFrame:
    if len(df.select(label).distinct().take(2)) < 2:
        raise ValueError("at least two distinct labels are needed")
    return df


def label_variety(df: DataFrame, label: str) -> DataFrame:
    """(labels, enough): how many distinct labels there are and whether that is at least two."""
    counted = df.agg(F.countDistinct(label).alias("labels"))
    return counted.withColumn("enough", F.col("labels") >= 2)


def small_classes(df: DataFrame, label: str, minimum: int) -> DataFrame:
    """Labels with fewer than ``minimum`` rows, as (label, count)."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    return counted.where(F.col("count") < minimum)


def require_class_sizes(df: DataFrame, label: str, minimum: int) -> DataFrame:
    listed = _listed(small_classes(df, label, minimum), ["count", "label"], lambda r: f"{r['label']} ({r['count']})")
    if listed:
        raise ValueError(f"every label needs at least {minimum} rows; too few: {listed}")
    return df


def mapping_table(spark: SparkSession, spec: MappingSpec) -> DataFrame:
    """(source_label, target_label, action) with action accept or drop."""
    rows = [(s, t, "accept") for s, t in sorted(spec.accepted.items())]
    rows += [(s, None, "drop") for s in spec.dropped]
    names = ["source_label", "target_label", "action"]
    return small_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)})


def mapping_problems(mapping: DataFrame, allowed: Sequence[str] = LABELS) -> DataFrame:
    """Rule violations of a mapping table as (problem, value)."""
    accepted = mapping.where("action = 'accept'")
    dropped = mapping.where("action = 'drop'")
    dim = label_table(mapping.sparkSession, allowed).select(F.col("label").alias("target_label"))
    bad_targets = accepted.select("target_label").distinct().join(dim, "target_label", "left_anti")
    both = accepted.select("source_label").intersect(dropped.select("source_label"))
    return bad_targets.select(F.lit("unsupported_target").alias("problem"), F.col("target_label").alias("value")).union(
        both.select(F.lit("mapped_and_dropped"), "source_label")
    )


def label_contract_breaks(left: DataFrame, right: DataFrame) -> DataFrame:
    """Disagreements of two (label, label_id) dictionaries, names case-folded; empty = consistent.

    Both directions are compared: a label with two ids and an id with two labels both show up.
    """
    def folded(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lower("label").alias("label"), F.col("label_id").cast("long").alias(name))

    return (
        folded(left, "left_id")
        .join(folded(right, "right_id"), "label", "full_outer")
        .where(~F.col("left_id").eqNullSafe(F.col("right_id")))
    )


def require_label_contract(left: DataFrame, right: DataFrame) -> None:
    for side in (left, right):
        require_rows(side, "label dictionary is empty")
    breaks = label_contract_breaks(left, right)
    listed = _listed(breaks, ["label"], lambda r: f"{r['label']}: {r['left_id']} vs {r['right_id']}")
    if listed:
        raise ValueError("label dictionaries disagree: " + listed)
