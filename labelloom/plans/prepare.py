"""Preparing a raw labelled table: mapping, audit, clean-up, dedup, checks and reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from labelloom.config import ANNOTATION_COLUMNS, FOCUS_LABELS, LABELS, MappingSpec
from labelloom.operators.annotations import single_label_rows
from labelloom.operators.checks import require_labels, require_rows, require_two_labels
from labelloom.operators.dedup import keep_first
from labelloom.operators.distribution import class_distribution_full, class_weights, distribution_warnings
from labelloom.operators.mapping import annotate_labels, label_counts, mapped_rows, mapping_audit
from labelloom.operators.ranking import examples_per_class, focused_examples, source_groups
from labelloom.operators.rows import drop_invalid_rows, standardize_columns
from labelloom.session import label_table
from labelloom.sources.readers import read_annotation_parts, read_csv, read_label_mapping, read_labelled_csv
from labelloom.sources.writers import report_lines, write_report, write_table, write_text_blocks


def prepared_table(annotated: DataFrame, order: str | Sequence[str], remove_duplicates: bool = True) -> DataFrame:
    """Mapped, cleaned and de-duplicated rows of an annotated table. Lazy."""
    cleaned = drop_invalid_rows(mapped_rows(annotated))
    return keep_first(cleaned, ["text", "label"], order) if remove_duplicates else cleaned


def load_labelled(
    spark: SparkSession,
    path: str,
    text: str = "text",
    label: str = "label",
    allowed: Sequence[str] = LABELS,
    remove_duplicates: bool = False,
    rename: bool = False,
    order: str = "ord",
) -> DataFrame:
    """A checked labelled CSV with an ``ord`` column for its row order."""
    raw = read_labelled_csv(spark, path, order=order)
    table = standardize_columns(raw, text, label, rename)
    if rename:
        text, label = "text", "label"
    cleaned = drop_invalid_rows(table, text, label)
    require_rows(cleaned, f"{path} has no rows with text and label")
    if remove_duplicates:
        cleaned = keep_first(cleaned, [text, label], order)
    return require_two_labels(require_labels(cleaned, label, allowed), label)


@dataclass
class PreparationReports:
    """The report tables of one preparation run, all label-sized."""

    audit: DataFrame
    distribution: DataFrame
    weights: DataFrame
    warnings: DataFrame
    samples: DataFrame
    focused: DataFrame
    groups: DataFrame
    focus: Sequence[str]

    def write(self, path: str) -> None:
        write_report(self.audit, f"{path}/mapping_audit")
        by_label = label_table(self.distribution.sparkSession, LABELS)
        for name, table in (("class_distribution", self.distribution), ("class_weights", self.weights)):
            ordered = table.join(by_label, "label").orderBy("label_id").drop("label_id").coalesce(1)
            write_table(ordered, f"{path}/{name}", "csv")
        nested = (
            self.groups.groupBy("target")
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", F.struct("count", "examples"))))).alias("s"))
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("target", F.map_entries("s"))))).alias("m"))
            .select(F.transform_values("m", lambda _, v: F.map_from_entries(v)).alias("source_label_groups"))
        )
        write_report(nested, f"{path}/source_label_groups")
        write_text_blocks(report_lines(self.samples.where("pos is not null"), LABELS), f"{path}/sample_examples_per_class", "\n")
        write_text_blocks(report_lines(self.focused.where("pos is not null"), self.focus), f"{path}/focused_examples_per_class", "\n")
        lines = self.warnings.select("pos", F.col("warning").alias("block"))
        write_text_blocks(lines, f"{path}/warnings", "")


def preparation_reports(
    annotated: DataFrame,
    prepared: DataFrame,
    spec: MappingSpec,
    order: str | Sequence[str],
    samples: int = 3,
    focus: Sequence[str] = FOCUS_LABELS,
    focus_samples: int = 8,
    group_samples: int = 3,
) -> PreparationReports:
    """The audit looks at all input rows; everything else at the prepared rows."""
    distribution = class_distribution_full(prepared)
    warnings = distribution_warnings(distribution, spec.sources_by_target())
    return PreparationReports(
        audit=mapping_audit(label_counts(annotated), spec, warnings),
        distribution=distribution,
        weights=class_weights(prepared),
        warnings=warnings,
        samples=examples_per_class(prepared, samples, order),
        focused=focused_examples(prepared, focus, focus_samples, order),
        groups=source_groups(prepared, spec.sources_by_target(), group_samples, order),
        focus=focus,
    )


def prepare_dataset(
    raw: DataFrame,
    spec: MappingSpec,
    order: str | Sequence[str],
    output: str,
    reports: str | None = None,
    text: str = "text",
    label: str = "label",
    remove_duplicates: bool = True,
    fmt: str = "parquet",
    **report_options,
) -> DataFrame:
    """Map, clean, de-duplicate, check, write the table and its reports; returns the written table."""
    spark = raw.sparkSession
    annotated = annotate_labels(standardize_columns(raw, text, label), spec)

    def written(folder: str) -> DataFrame:
        return read_csv(spark, output_parts(spark, folder), na_tokens=()) if fmt == "csv" else spark.read.parquet(folder)

    def checked(folder: str) -> None:
        require_rows(written(folder), "no rows remain after label mapping and clean-up")
        require_labels(written(folder), "label")

    # Checked before it is published: a bad run leaves the table of an earlier one alone.
    write_table(prepared_table(annotated, order, remove_duplicates), output, fmt, checked)
    prepared = written(output)
    if reports:
        kept = prepared.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            preparation_reports(annotated, kept, spec, order, **report_options).write(reports)
        finally:
            kept.unpersist()
    return prepared


def output_parts(spark: SparkSession, folder: str) -> list[str]:
    """Part files of a written CSV folder."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*.csv")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in fs.globStatus(path))


def prepare_from_annotations(
    spark: SparkSession,
    parts: Sequence[str],
    mapping_path: str,
    output: str,
    reports: str | None = None,
    excluded: Sequence[str] = (),
    columns: Sequence[str] = ANNOTATION_COLUMNS,
    **options,
) -> DataFrame:
    """Wide annotation parts to a prepared table in one plan, with no file in between."""
    wide = read_annotation_parts(spark, parts, columns, order="ord")
    folded = require_rows(single_label_rows(wide, columns, order="ord"), "no single-label rows found")
    spec = read_label_mapping(spark, mapping_path, excluded)
    return prepare_dataset(folded, spec, "ord", output, reports, **options)
