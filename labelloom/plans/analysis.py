"""Error analysis of a prediction table and of raw logits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from labelloom.functions.numeric import argmax_label, ranked_labels, round_even, softmax
from labelloom.operators import metrics
from labelloom.operators.ranking import sorted_by_confidence, top_by_confidence
from labelloom.operators.rows import correct_rows, wrong_rows
from labelloom.sources.writers import write_report, write_table


@dataclass
class ErrorAnalysis:
    """All views on one prediction table (text, true_label, predicted_label, confidence, is_correct)."""

    predictions: DataFrame
    correct: DataFrame
    wrong: DataFrame
    confusion: DataFrame
    confusions: DataFrame

    def write(self, path: str) -> None:
        write_table(self.predictions, f"{path}/test_predictions")
        write_table(self.correct, f"{path}/correct_examples", "csv")
        # The same rows under two names, as report readers expect both.
        write_table(self.wrong, f"{path}/wrong_examples", "csv")
        write_table(self.wrong, f"{path}/misclassified_examples", "csv")
        write_table(self.confusion.orderBy("true_label", "predicted_label").coalesce(1), f"{path}/confusion_matrix", "csv")
        write_report(self.confusions.orderBy("rank"), f"{path}/top_confusions")


def error_analysis(
    predictions: DataFrame, order: str | Sequence[str], top_n: int | None = 20, labels: Sequence[str] | None = None
) -> ErrorAnalysis:
    """``top_n=None`` keeps every wrong row and every confusion; ``labels=None`` uses those observed."""
    right, wrong = correct_rows(predictions), wrong_rows(predictions)
    if top_n is None:
        best_right, best_wrong = sorted_by_confidence(right, order), sorted_by_confidence(wrong, order)
    else:
        best_right, best_wrong = top_by_confidence(right, top_n, order), top_by_confidence(wrong, top_n, order)
    return ErrorAnalysis(
        predictions,
        best_right,
        best_wrong,
        metrics.confusion_grid(metrics.pair_counts(predictions), labels),
        metrics.top_confusions(predictions, top_n),
    )


def write_error_analysis(predictions: DataFrame, path: str, order: str | Sequence[str], top_n: int | None = 20) -> None:
    kept = predictions.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        error_analysis(kept, order, top_n).write(path)
    finally:
        kept.unpersist()


def predictions_from_logits(
    df: DataFrame, labels: Sequence[str], logits: str = "logits", label: str = "label", keep: Sequence[str] = ()
) -> DataFrame:
    """Softmax, arg-max and confidence of an array<double> column, as a prediction table."""
    return (
        df.withColumn("probabilities", softmax(F.col(logits)))
        .withColumn("predicted_label", argmax_label(F.col("probabilities"), labels))
        .select(
            *keep,
            F.col(label).alias("true_label"),
            "predicted_label",
            round_even(F.array_max("probabilities"), 4).alias("confidence"),
            (F.col(label) == F.col("predicted_label")).alias("is_correct"),
            "probabilities",
        )
    )


def labelled_probabilities(df: DataFrame, labels: Sequence[str], logits: str = "logits") -> DataFrame:
    """Adds probabilities as map label -> score, the best label, and the ranked list."""
    p = softmax(F.col(logits))
    names = F.array(*[F.lit(label.lower()) for label in labels])
    return (
        df.withColumn("probabilities", p)
        .withColumn("label_scores", F.map_from_arrays(names, F.col("probabilities")))
        .withColumn("predicted_label", argmax_label(F.col("probabilities"), [v.lower() for v in labels]))
        .withColumn("scored", ranked_labels(F.col("probabilities"), [v.lower() for v in labels]))
    )
