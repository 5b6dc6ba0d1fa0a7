"""Counts, percentages and weights per label, and the reports built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.config import DOMINANT_PERCENT, LABELS, MAX_SOURCES_PER_TARGET
from labelloom.functions.numeric import percent, round_even
from labelloom.functions.text import normal_form, word_array
from labelloom.session import bounded, label_table, side_by_side, small_table, small_window
# Report texts that readers of the warnings file expect word for word.
IMBALANCE = "Class imbalance warning: '%s' represents %.2f%% of the final dataset."
BREADTH = "Mapping breadth warning: '%s' contains %s source labels (%s)."


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def counts_on_labels(df: DataFrame, labels: Sequence[str] = LABELS, label: str = "label") -> DataFrame:
    """(label, label_id, count) for every label of the closed set, absent ones with 0."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    return (
        label_table(df.sparkSession, labels)
        .join(counted, "label", "left")
        .select("label", "label_id", F.coalesce("count", F.lit(0)).alias("count"))
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, count, percentage) of the labels present; the denominator is the row count."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    total = F.sum("count").over(small_window())
    return counted.withColumn("percentage", percent(F.col("count"), total)).where(F.col("label").isNotNull())


def class_distribution_full(df: DataFrame, labels: Sequence[str] = LABELS, label: str = "label") -> DataFrame:
    """Same over the whole label list with zeros. Rows with other labels count in the denominator."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    with_total = counted.withColumn("total", F.sum("count").over(small_window()))
    total = F.greatest(F.max("total").over(small_window()), F.lit(1))
    return (
        label_table(df.sparkSession, labels)
        .join(with_total, "label", "left")
        .select(
            "label",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce(percent(F.col("count"), total), F.lit(0.0)).alias("percentage"),
        )
    )


def distribution_block(df: DataFrame, title: str, label: str = "label") -> DataFrame:
    """Readable text block, one row."""
    line = F.format_string("  - %s: %d (%.2f%%)", "label", "count", "percentage")
    lines = class_distribution(df, label).agg(F.sort_array(F.collect_list(F.struct("label", line.alias("line")))).alias("l"))
    return lines.select(F.concat_ws("\n", F.lit(title), F.transform("l", lambda e: e["line"])).alias("block"))


def class_weights(df: DataFrame, labels: Sequence[str] = LABELS, label: str = "label") -> DataFrame:
    """(label, count, weight): n / (classes * count), 6 decimals, 0.0 for an absent class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    with_total = counts.withColumn("total", F.sum("count").over(small_window()))
    weight = F.col("total") / (F.lit(len(labels)) * F.col("count"))
    return (
        label_table(df.sparkSession, labels)
        .join(with_total, "label", "left")
        .select(
            "label",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce(round_even(weight, 6), F.lit(0.0)).alias("weight"),
        )
    )


def strict_class_weights(df: DataFrame, labels: Sequence[str] = LABELS, label: str = "label") -> DataFrame:
    """As ``class_weights``, but a class without rows fails the job."""
    absent = F.concat(F.lit("no training rows for label: "), F.col("label"))
    return class_weights(df, labels, label).withColumn(
        "weight",
        F.when(F.col("count") == 0, F.raise_error(absent).cast("double")).otherwise(F.col("weight")),
    )


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, count, weight) over the classes present: n / (present * count), unrounded."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    total, present = F.sum("count").over(small_window()), F.count("*").over(small_window())
    return counts.withColumn("weight", total / (present * F.col("count")))


def attach_weights(df: DataFrame, weights: DataFrame, n_labels: int, label: str = "label") -> DataFrame:
    """Row weights from a label-sized table; ``n_labels`` is its proven row bound."""
    slim = weights.select(F.col("label").alias(label), "weight")
    return df.join(bounded(slim, n_labels), label)


def merge_distributions(df: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Counts per label (zero-filled), per data source and per observed pair, in one pass.

    Rows are (report, label, data_source, count).
    """
    grouped = (
        df.groupingSets([["label"], ["data_source"], ["data_source", "label"]], "label", "data_source")
        .agg(F.count("*").alias("count"), F.grouping_id().alias("g"))
    )
    named = grouped.select(
        F.when(F.col("g") == 1, "label").when(F.col("g") == 2, "data_source").otherwise("source_label").alias("report"),
        "label", "data_source", "count",
    )
    zeros = small_table(df.sparkSession, {"label": labels}).select(
        F.lit("label").alias("report"), "label", F.lit(None).cast("string").alias("data_source"),
        F.lit(0).cast("long").alias("count"),
    )
    return (
        named.unionByName(zeros)
        .groupBy("report", "label", "data_source")
        .agg(F.sum("count").alias("count"))
    )


def dominant_class(distribution: DataFrame) -> DataFrame:
    """The class with the largest percentage; equal ones go to the first by name."""
    best = F.max_by(F.struct("label", "count", "percentage"), F.struct("percentage", "_rev"))
    ranked = distribution.withColumn("_rev", -F.row_number().over(small_window().orderBy("label")))
    return ranked.agg(best.alias("b")).select("b.*")


def distribution_warnings(distribution: DataFrame, sources_by_target: Mapping[str, Sequence[str]]) -> DataFrame:
    """(pos, warning): a class with 40 % or more, and targets fed by more than four sources."""
    spark = distribution.sparkSession
    dominant = dominant_class(distribution).where(F.col("percentage") >= DOMINANT_PERCENT).select(
        F.lit(0).alias("pos"),
        F.format_string(IMBALANCE, "label", "percentage").alias("warning"),
    )
    broad = small_table(
        spark,
        {
            "target": sorted(sources_by_target),
            "sources": [", ".join(sources_by_target[t]) for t in sorted(sources_by_target)],
            "n": [str(len(sources_by_target[t])) for t in sorted(sources_by_target)],
        },
    ).where(F.col("n").cast("int") > MAX_SOURCES_PER_TARGET)
    numbered = broad.select(
        F.row_number().over(small_window().orderBy("target")).alias("pos"),
        F.format_string(BREADTH, "target", "n", "sources").alias("warning"),
    )
    return dominant.unionByName(numbered)


def text_diversity(df: DataFrame, text: str = "text") -> DataFrame:
    """(rows, vocabulary_size, average_words_per_example) on normalised texts.

    Words are counted once per task before the shuffle; the word list never leaves the executors.
    """
    words = df.select(word_array(normal_form(F.col(text))).alias("words"))
    totals = words.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("word_rows"))
    vocabulary = words.select(F.explode(F.array_distinct("words")).alias("word")).distinct().agg(
        F.count("*").alias("vocabulary_size")
    )
    return side_by_side(totals, vocabulary).select(
        "rows", "vocabulary_size",
        round_even(F.col("word_rows") / F.greatest("rows", F.lit(1)), 2).alias("average_words_per_example"),
    )


def counts_as_map(counts: DataFrame, key: str = "label") -> DataFrame:
    """Label-sized (key, count) folded to one row with a map."""
    entries = F.sort_array(F.collect_list(F.struct(key, "count")))
    return counts.agg(F.map_from_entries(entries).alias(f"{key}_counts"))
