"""Source label -> target label, with an audit that adds up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.config import MappingSpec
from labelloom.functions.numeric import round_even
from labelloom.functions.text import fold_label
from labelloom.operators.checks import mapping_table
from labelloom.session import side_by_side


def annotate_labels(df: DataFrame, spec: MappingSpec, label: str = "label") -> DataFrame:
    """Adds source_label, mapped_label and drop_reason (configured_drop / unknown_label) to all rows.

    The mapping is a local relation of known size, so the optimizer broadcasts it by itself while it
    is under the broadcast threshold and shuffles otherwise. A missing label reads ``nan``.
    """
    rules = mapping_table(df.sparkSession, spec)
    tagged = df.withColumn("source_label", fold_label(F.coalesce(F.col(label), F.lit("nan"))))
    reason = (
        F.when(F.col("action") == "drop", F.lit("configured_drop"))
        .when(F.col("target_label").isNull(), F.lit("unknown_label"))
    )
    return (
        tagged.join(rules, "source_label", "left")
        .withColumn("drop_reason", reason)
        .withColumnRenamed("target_label", "mapped_label")
        .select(*tagged.columns, "mapped_label", "drop_reason")
    )


def mapped_rows(annotated: DataFrame, label: str = "label") -> DataFrame:
    """Rows that got a target; the target replaces the label and source_label stays."""
    return (
        annotated.where(F.col("mapped_label").isNotNull())
        .withColumn(label, F.col("mapped_label"))
        .drop("mapped_label", "drop_reason")
    )


def dropped_rows(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("drop_reason").isNotNull())


def label_counts(annotated: DataFrame) -> DataFrame:
    """The one pass the audit needs: (source_label, mapped_label, drop_reason, n)."""
    return annotated.groupBy("source_label", "mapped_label", "drop_reason").agg(F.count("*").alias("n"))


def _counts_map(key: str, value: str, keep: Column) -> Column:
    entries = F.sort_array(F.collect_list(F.when(keep, F.struct(F.col(key), F.col(value)))))
    return F.map_from_entries(entries)


def mapping_audit(counts: DataFrame, spec: MappingSpec, warnings: DataFrame | None = None) -> DataFrame:
    """One nested row rolled up from ``label_counts``, whose size is the number of source labels."""
    spark = counts.sparkSession
    per_source = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(F.col("mapped_label").isNotNull(), F.col("n"))), F.lit(0)).alias("mapped_rows"),
        F.coalesce(F.sum(F.when(F.col("drop_reason").isNotNull(), F.col("n"))), F.lit(0)).alias("dropped_rows"),
        _counts_map("source_label", "n", F.lit(True)).alias("original_label_counts"),
        _counts_map("source_label", "n", F.col("drop_reason").isNotNull()).alias("dropped_label_counts"),
        F.sort_array(
            F.collect_list(F.when(F.col("drop_reason") == "unknown_label", F.col("source_label")))
        ).alias("unknown_labels"),
        F.collect_list(
            F.when(F.col("mapped_label").isNotNull(), F.struct("mapped_label", "n"))
        ).alias("_mapped"),
    )
    def total_of(target: str) -> Column:
        mine = F.filter("_mapped", lambda e: e["mapped_label"] == target)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, e: acc + e["n"])

    totals = [
        F.struct(F.lit(target).alias("label"), total_of(target).alias("n"))
        for target in sorted(set(spec.accepted.values()))
    ]
    by_target = (
        F.map_from_entries(F.filter(F.array(*totals), lambda e: e["n"] > 0))
        if totals
        else F.create_map().cast("map<string,bigint>")
    )
    strings = T.ArrayType(T.StringType())
    lit_strings = lambda values: F.array(*[F.lit(v) for v in values]).cast(strings)
    sources = [v for t, s in spec.sources_by_target().items() for v in (F.lit(t), lit_strings(s))]
    audit = per_source.select(
        "input_rows", "mapped_rows", "dropped_rows",
        round_even(F.col("dropped_rows") / F.col("input_rows") * 100, 2).alias("dropped_percentage"),
        "original_label_counts",
        by_target.alias("mapped_label_counts"),
        "dropped_label_counts",
        lit_strings(spec.dropped).alias("configured_dropped_labels"),
        lit_strings(spec.excluded).alias("runtime_excluded_labels"),
        "unknown_labels",
        (F.create_map(*sources) if sources else F.create_map().cast("map<string,array<string>>")).alias(
            "source_labels_by_target"
        ),
    )
    if warnings is None:
        return audit.withColumn("warnings", lit_strings([]))
    listed = warnings.agg(F.sort_array(F.collect_list(F.struct("pos", "warning"))).alias("w")).select(
        F.transform("w", lambda e: e["warning"]).alias("warnings")
    )
    return side_by_side(audit, listed)


def encode_labels(df: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    """Label -> id through a (label, label_id) table; an unmatched label fails the job."""
    names = dictionary.select(F.col("label").alias(label), "label_id")
    joined = df.join(names, label, "left")
    missing = F.concat(F.lit("label without id: "), F.coalesce(F.col(label), F.lit("null")))
    checked = F.when(F.col("label_id").isNull(), F.raise_error(missing).cast("int")).otherwise(F.col("label_id"))
    return joined.withColumn("label_id", checked)


def decode_labels(df: DataFrame, dictionary: DataFrame, label_id: str = "label_id", label: str = "label") -> DataFrame:
    ids = dictionary.select(F.col("label_id").alias(label_id), F.col("label").alias(label))
    joined = df.join(ids, label_id, "left")
    missing = F.concat(F.lit("id without label: "), F.coalesce(F.col(label_id).cast("string"), F.lit("null")))
    checked = F.when(F.col(label).isNull(), F.raise_error(missing).cast("string")).otherwise(F.col(label))
    return joined.withColumn(label, checked)
