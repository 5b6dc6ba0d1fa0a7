"""Scoring and explaining with a linear model given as a table: (term, idf, coefs array<double>).

Both work inside the row: weights, logits and contributions are arrays over the known terms of one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from labelloom.functions.numeric import argmax_label, ranked_labels, softmax
from labelloom.operators.features import constants, held, known_terms, with_weights

# Fixed value: shown instead of an empty explanation.
NO_FEATURES = "  No strong positive feature contributions were found."


def _coefficients(known: list[Row], n_labels: int) -> Column:
    """All coefficients as one array; that of term i and label c is at i * n_labels + c."""
    return constants([c for row in known for c in row["coefs"]] or [0.0] * n_labels)


def _logits(coefficients: Column, intercepts: Sequence[float]) -> Column:
    n = len(intercepts)

    def one(c: int) -> Column:
        total = F.aggregate(
            "weights", F.lit(0.0), lambda acc, e: acc + e["weight"] * F.get(coefficients, e["i"] * n + c)
        )
        return total + F.lit(float(intercepts[c]))

    return F.array(*[one(c) for c in range(n)])


def linear_scores(
    df: DataFrame, model: DataFrame, labels: Sequence[str], intercepts: Sequence[float], key: str, max_features: int
) -> DataFrame:
    """(key, predicted_label, probabilities, scored) for a table with ``terms``."""
    known = known_terms(model, max_features, "idf", "coefs")
    weighted = with_weights(df.select(key, "terms"), known)
    scored = held(weighted, logits=_logits(_coefficients(known, len(labels)), intercepts))
    return (
        held(scored, probabilities=softmax(F.col("logits")))
        .withColumn("predicted_label", argmax_label(F.col("logits"), labels))
        .withColumn("scored", ranked_labels(F.col("probabilities"), labels, F.col("logits")))
        .select(key, "predicted_label", "probabilities", "scored")
    )


def explain(
    df: DataFrame,
    model: DataFrame,
    labels: Sequence[str],
    intercepts: Sequence[float],
    key: str,
    max_features: int,
    top_n: int = 5,
) -> DataFrame:
    """(key, predicted_label, contributions): the largest positive weight x coefficient of the
    predicted label, best first; an empty list when no term is known or none is positive."""
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    known = known_terms(model, max_features, "idf", "coefs")
    chosen = _chosen(df.select(key, "terms"), known, intercepts)
    return chosen.select(key, _label(labels).alias("predicted_label"), _contributions(known, labels, top_n).alias("contributions"))


def _chosen(df: DataFrame, known: list[Row], intercepts: Sequence[float]) -> DataFrame:
    """Adds weights, logits and ``at``, the place of the largest logit, to a table with ``terms``."""
    scored = held(with_weights(df, known), logits=_logits(_coefficients(known, len(intercepts)), intercepts))
    return held(scored, at=F.array_position("logits", F.array_max("logits")).cast("int") - 1)


def _label(labels: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(label) for label in labels]), F.col("at"))


def _contributions(known: list[Row], labels: Sequence[str], top_n: int) -> Column:
    names = constants([r["term"] for r in known] or [""])
    coefficients = _coefficients(known, len(labels))

    def entry(e: Column) -> Column:
        # Sorts by falling score, then by term: terms are numbered in their order.
        score = e["weight"] * F.get(coefficients, e["i"] * len(labels) + F.col("at"))
        return F.struct((-score).alias("rank"), e["i"].alias("i"), score.alias("score"))

    positive = F.filter(F.transform("weights", entry), lambda e: e["score"] > 0)
    best = F.slice(F.sort_array(positive), 1, top_n)
    return F.transform(best, lambda e: F.struct(F.get(names, e["i"]).alias("feature"), e["score"].alias("score")))


def judged(
    df: DataFrame, model: DataFrame, labels: Sequence[str], intercepts: Sequence[float], max_features: int, top_n: int = 5
) -> DataFrame:
    """Adds predicted_label, probabilities, scored and contributions to every row of a table with ``terms``.

    One projection without state, key or shuffle, so it works on streams. ``terms`` is dropped; rows without any
    known term are judged by the intercepts and have no contributions.
    """
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    known = known_terms(model, max_features, "idf", "coefs")
    chosen = held(_chosen(df, known, intercepts), probabilities=softmax(F.col("logits")))
    return (
        chosen.withColumn("predicted_label", _label(labels))
        .withColumn("scored", ranked_labels(F.col("probabilities"), labels, F.col("logits")))
        .withColumn("contributions", _contributions(known, labels, top_n))
        .drop("terms", "weights", "logits", "at")
    )


def contribution_lines(contributions: Column) -> Column:
    line = lambda e: F.format_string("  - %s (%.4f)", e["feature"], e["score"])
    return F.when(F.size(contributions) == 0, F.lit(NO_FEATURES)).otherwise(
        F.array_join(F.transform(contributions, line), "\n")
    )
