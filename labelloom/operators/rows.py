"""Row-wise table operators: renames, constants, validity filters, cleaning a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions import text as t
from labelloom.operators.checks import require_columns


def standardize_columns(df: DataFrame, text: str, label: str, rename: bool = True) -> DataFrame:
    require_columns(df, [text, label])
    return df.withColumnsRenamed({text: "text", label: "label"}) if rename else df


def with_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("data_source", F.lit(name))


def drop_invalid_rows(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Rows with a usable text and label; text stripped, label stripped and lowercased."""
    return (
        df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
        .withColumns({text: t.strip(F.col(text)), label: t.fold_label(F.col(label))})
        .where((F.col(text) != "") & (F.col(label) != ""))
    )


def long_enough(df: DataFrame, min_words: int, normalized: str = "normalized_text") -> DataFrame:
    return df.where(t.word_count(F.col(normalized)) >= min_words)


def clean_table(
    df: DataFrame,
    text: str = "text",
    output: str | None = None,
    drop_empty: bool = False,
    **options: bool,
) -> DataFrame:
    """Clean a text column in place or into ``output``; unusable texts become empty."""
    require_columns(df, [text])
    target = output or text
    value = t.clean(F.col(text), **options)
    if not drop_empty:
        return df.withColumn(target, value)
    # A filter on the new column would be pushed below it and clean every text twice. Unnesting an
    # array of at most one value cleans once.
    columns = df.columns if target in df.columns else [*df.columns, target]
    one = F.filter(F.array(F.struct(value.alias("_cleaned"))), lambda e: e["_cleaned"] != "")
    unnested = df.select("*", F.inline(one))
    return unnested.drop(*([target] if target in df.columns else [])).withColumnRenamed("_cleaned", target).select(*columns)


def correct_rows(predictions: DataFrame) -> DataFrame:
    return predictions.where("is_correct")


def wrong_rows(predictions: DataFrame) -> DataFrame:
    return predictions.where("not is_correct")
