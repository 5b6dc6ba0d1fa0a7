"""Folding wide one-hot annotation tables into labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.config import ANNOTATION_COLUMNS
from labelloom.functions.text import strip
from labelloom.operators.checks import require_columns
from labelloom.operators.dedup import keep_first


def _indicator(name: str) -> Column:
    """Missing counts as 0; fractions are cut off."""
    return F.coalesce(F.col(name), F.lit(0)).cast("int")


def _first_maximum(columns: Sequence[str]) -> Column:
    best = F.greatest(*[_indicator(c) for c in columns]) if len(columns) > 1 else _indicator(columns[0])
    chain = F
    for name in columns:
        chain = chain.when(_indicator(name) == best, F.lit(name))
    return chain


def single_label_rows(
    wide: DataFrame, columns: Sequence[str] = ANNOTATION_COLUMNS, text: str = "text", order: str | None = None
) -> DataFrame:
    """Rows whose indicators sum to exactly one, as distinct (text, label).

    The text is turned into a string before it is checked, so a missing text reads ``nan``. With an
    order column the first position of every pair is kept next to it.
    """
    require_columns(wide, [text, *columns])
    total = sum((_indicator(c) for c in columns[1:]), _indicator(columns[0]))
    folded = wide.where(total == 1).select(
        strip(F.coalesce(F.col(text), F.lit("nan"))).alias("text"),
        F.lower(_first_maximum(columns)).alias("label"),
        *([F.col(order)] if order else []),
    ).where("text <> ''")
    return keep_first(folded, ["text", "label"], order) if order else folded.distinct()


def label_rows(wide: DataFrame, columns: Sequence[str] = ANNOTATION_COLUMNS, text: str = "text") -> DataFrame:
    """One (text, label) row per positive indicator; keeps multi-label rows and repeats."""
    require_columns(wide, [text, *columns])
    positives = F.array(*[F.when(_indicator(c) == 1, F.lit(c)) for c in columns])
    return (
        wide.select(
            strip(F.coalesce(F.col(text), F.lit("nan"))).alias("text"),
            F.explode(F.array_compact(positives)).alias("label"),
        )
        .where("text <> ''")
    )
