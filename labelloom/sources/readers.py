"""Readers. Text tables are read with an explicit schema; nothing is inferred from the data."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.config import ANNOTATION_COLUMNS, NA_TOKENS, MappingSpec
from labelloom.functions.text import strip
from labelloom.operators.checks import require_columns, require_rows
from labelloom.session import small_table
from labelloom.sources.records import csv_records

LABELLED = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])


def annotation_schema(columns: Sequence[str] = ANNOTATION_COLUMNS) -> T.StructType:
    """Indicators are read as doubles: files mix 1, 1.0 and blanks."""
    return T.StructType(
        [T.StructField("text", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in columns]
    )


def _check_suffix(path: str, suffix: str) -> None:
    if PurePosixPath(path).suffix.lower() != suffix:
        raise ValueError(f"expected a {suffix} file, got {path}")


def _check_exists(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(hadoop_path):
        raise FileNotFoundError(f"no such dataset: {path}")


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line; only that line is read."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    order: str | None = None,
) -> DataFrame:
    """Read one or several CSV parts as one table.

    Quoted cells may hold commas, quotes and line breaks. Without a schema every column is text,
    named by the header. Cells spelling a missing value become null, as dataframe readers do.
    A large file is read by many tasks (see ``records``). ``order`` adds a column that sorts rows as they stand in
    the files, and the files as they are listed.
    """
    parts = [paths] if isinstance(paths, str) else list(paths)
    for path in parts:
        _check_exists(spark, path)
        _check_suffix(path, ".csv")
    declared = schema.fieldNames() if schema else []
    names = _header(spark, parts[0])
    require_columns(names, declared)
    for other in parts[1:]:
        if _header(spark, other) != names:
            raise ValueError(f"part {other} has different columns than {parts[0]}")
    cells = F.from_csv(
        "record", ", ".join(f"c{i} string" for i in range(len(names))),
        {"multiLine": "true", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"},
    )
    raw = csv_records(spark, parts).select(F.struct("place", "start", "no").alias("_at"), cells.alias("_cells"))
    types = {f.name: f.dataType for f in schema} if schema else {}

    def cell(i: int, name: str) -> Column:
        value = F.col(f"_cells.c{i}")
        given = F.when(~value.isin(*na_tokens), value) if na_tokens else value
        return given.cast(types.get(name, T.StringType())).alias(name)

    return raw.select(*[cell(i, n) for i, n in enumerate(names)], *([F.col("_at").alias(order)] if order else []))


def read_labelled_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """A raw labelled file: exists, is .csv, has rows."""
    table = read_csv(spark, path, **options)
    require_rows(table, f"{path} has no rows")
    return table


def read_annotation_parts(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] = ANNOTATION_COLUMNS,
    forbid_empty_parts: bool = False,
    order: str | None = None,
) -> DataFrame:
    """All part files of a wide one-hot table."""
    if forbid_empty_parts:
        for path in paths:
            require_rows(read_csv(spark, path), f"{path} has no rows")
    return read_csv(spark, paths, annotation_schema(columns), order=order)


def parse_label_mapping(raw: object, excluded: Iterable[str] = ()) -> MappingSpec:
    """Structured ({accepted_mappings, dropped_labels}) or flat ({source: target}) mapping."""
    if not isinstance(raw, dict) or not raw:
        raise ValueError("a label mapping must be a non-empty JSON object")
    if "accepted_mappings" not in raw:
        return MappingSpec.build(raw, (), excluded)
    accepted, dropped = raw["accepted_mappings"], raw.get("dropped_labels", [])
    if not isinstance(accepted, dict) or not isinstance(dropped, list):
        raise ValueError("accepted_mappings must be an object and dropped_labels an array")
    return MappingSpec.build(accepted, dropped, excluded)


def _read_text_file(spark: SparkSession, path: str) -> str:
    _check_exists(spark, path)
    return spark.read.text(path, wholetext=True).first()["value"]


def read_label_mapping(spark: SparkSession, path: str, excluded: Iterable[str] = ()) -> MappingSpec:
    _check_suffix(path, ".json")
    return parse_label_mapping(json.loads(_read_text_file(spark, path)), excluded)


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A report written by ``write_report``: one row, nested fields. Fields it lacks read null."""
    _check_exists(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sentences(spark: SparkSession, path: str, group: str = "Custom file examples") -> DataFrame:
    """One sentence per line; blank lines are skipped; a file without sentences is an error."""
    _check_exists(spark, path)
    lines = spark.read.text(path).select(F.lit(group).alias("group"), strip(F.col("value")).alias("text"))
    sentences = lines.where("text <> ''")
    require_rows(sentences, f"{path} has no non-empty lines")
    return sentences


def read_phrase_pools(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrase pools as JSON: {label: {openers, middles, endings, templates, extras}}.

    Returns (phrases: label, slot, pos, phrase), (templates: label, pos, template) and
    (extras: label, pos, text).
    """
    return phrase_pool_tables(spark, json.loads(_read_text_file(spark, path)))


def phrase_pool_tables(spark: SparkSession, pools: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    slots = {"openers": "opener", "middles": "middle", "endings": "ending"}
    phrases = [
        (label, slot, pos, phrase)
        for label, pool in pools.items()
        for field, slot in slots.items()
        for pos, phrase in enumerate(pool[field])
    ]
    templates = [(label, p, t) for label, pool in pools.items() for p, t in enumerate(pool["templates"])]
    extras = [(label, p, t) for label, pool in pools.items() for p, t in enumerate(pool.get("extras", []))]
    pos = {"pos": pa.int32()}

    def table(names: Sequence[str], rows: list[tuple]) -> DataFrame:
        return small_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)}, pos)

    return (
        table(["label", "slot", "pos", "phrase"], phrases),
        table(["label", "pos", "template"], templates),
        table(["label", "pos", "text"], extras),
    )


def guideline_table(spark: SparkSession, guidelines: dict[str, dict[str, list[str]]]) -> DataFrame:
    """{label: {include: [...], exclude: [...]}} as rows (label, kind, pos, rule)."""
    rows = [
        (label, kind, pos, rule)
        for label, kinds in guidelines.items()
        for kind, rules in kinds.items()
        for pos, rule in enumerate(rules)
    ]
    names = ["label", "kind", "pos", "rule"]
    return small_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)}, {"pos": pa.int32()})


def probe_table(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    """{group: [sentence, ...]} as rows (group, pos, text)."""
    rows = [(g, pos, text) for g, texts in groups.items() for pos, text in enumerate(texts)]
    names = ["group", "pos", "text"]
    return small_table(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)}, {"pos": pa.int32()})
