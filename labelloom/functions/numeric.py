"""Rounding, probabilities and number formatting as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(c: Column, places: int) -> Column:
    """Half-even rounding, as the usual Python tools do."""
    return F.bround(c, places)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def percent(part: Column, whole: Column) -> Column:
    return round_even(part / whole * 100, 2)


def percent_text(fraction: Column) -> Column:
    return F.format_string("%.2f%%", fraction * 100)


def softmax(logits: Column) -> Column:
    """Stable softmax of an array<double>."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda e: e / total)


def argmax_label(scores: Column, labels: Sequence[str]) -> Column:
    """Label at the first maximum."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def ranked_labels(scores: Column, labels: Sequence[str], by: Column | None = None) -> Column:
    """array<struct<label, score>>, best first; equal scores keep the label order.

    ``by`` orders in place of the scores: logits stay apart where their probabilities round to the same number.
    """
    by = scores if by is None else by
    entries = F.array(
        *[
            F.struct(by[i].alias("by"), F.lit(-i).alias("tie"), F.lit(label).alias("label"), scores[i].alias("score"))
            for i, label in enumerate(labels)
        ]
    )
    return F.transform(
        F.sort_array(entries, asc=False),
        lambda e: F.struct(e["label"].alias("label"), e["score"].alias("score")),
    )


def top_lines(ranked: Column, n: int = 3) -> Column:
    """Console block with an arrow on the best label."""
    def line(entry: Column, i: Column) -> Column:
        return F.concat(
            F.when(i == 0, F.lit("->")).otherwise(F.lit("  ")),
            F.lit(" Top "), (i + 1).cast("string"), F.lit(": "),
            entry["label"], F.lit(" ("), percent_text(entry["score"]), F.lit(")"),
        )

    return F.array_join(F.transform(F.slice(ranked, 1, n), line), "\n")


def all_probabilities_line(ranked: Column) -> Column:
    return F.array_join(
        F.transform(ranked, lambda e: F.concat(e["label"], F.lit(": "), percent_text(e["score"]))),
        " | ",
    )


def probe_lines(ranked: Column, n: int = 3) -> Column:
    return F.transform(
        F.slice(ranked, 1, n), lambda e: F.concat(e["label"], F.lit(": "), percent_text(e["score"]))
    )
