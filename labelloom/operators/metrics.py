"""Classification metrics from (true_label, predicted_label) rows.

Every report starts from the same aggregate, the pair counts, which has at most labels^2 rows;
everything after it is label-sized.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.numeric import ratio_or_zero, round_even
from labelloom.session import label_table, side_by_side, small_table, small_window

_SCORES = "struct<precision:double,recall:double,`f1-score`:double,support:bigint>"
_HEADLINE = "accuracy double, macro_precision double, macro_recall double, macro_f1 double, weighted_f1 double"
# Schema of the nested report, for reading it back from JSON.
REPORT_SCHEMA = (
    f"{_HEADLINE}, classification_report map<string,{_SCORES}>, "
    f"validation struct<{_HEADLINE.replace(' double', ':double')},classification_report:map<string,{_SCORES}>>"
)


def pair_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("true_label", "predicted_label").agg(F.count("*").alias("n"))


def observed_labels(predictions: DataFrame) -> DataFrame:
    """Labels seen as true or predicted, (label)."""
    pairs = pair_counts(predictions)
    return pairs.select(F.explode(F.array("true_label", "predicted_label")).alias("label")).distinct()


def per_class(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """(label, precision, recall, f1, support) over a given label list, or the observed labels."""
    true, pred, n = F.col("true_label"), F.col("predicted_label"), F.col("n")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(true.alias("label"), n.alias("support"), zero.alias("predicted"), F.when(true == pred, n).otherwise(zero).alias("hits")),
        F.struct(pred.alias("label"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")),
    )
    sums = (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    if labels is not None:
        sums = label_table(pairs.sparkSession, labels).select("label").join(sums, "label", "left").fillna(0)
    precision = ratio_or_zero(F.col("hits"), F.col("predicted"))
    recall = ratio_or_zero(F.col("hits"), F.col("support"))
    rated = sums.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    return rated.withColumn("f1", ratio_or_zero(2 * F.col("precision") * F.col("recall"), both)).select(
        "label", "precision", "recall", "f1", "support"
    )


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.avg((F.col("true_label") == F.col("predicted_label")).cast("double")).alias("accuracy"))


def summary(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """One row: accuracy, macro precision / recall / F1 and weighted F1.

    With ``labels`` the macro averages run over that list; without, over the labels observed.
    """
    hits = F.sum(F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0))
    overall = pairs.agg((hits / F.sum("n")).alias("accuracy"))
    averages = per_class(pairs, labels).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )
    return side_by_side(overall, averages)


def report_table(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """(scope, label, precision, recall, f1, support): classes, macro avg, weighted avg, accuracy."""
    classes = per_class(pairs, labels)
    avg = lambda c: F.avg(c).alias(c)
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    names = ("precision", "recall", "f1")
    support = F.sum("support").alias("support")
    blank = F.lit(None).cast("string").alias("label")
    none = F.lit(None).cast("double")
    hits = F.sum(F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0))
    rows = [
        classes.select(F.lit("class").alias("scope"), "label", *names, "support"),
        classes.agg(*[avg(c) for c in names], support).select(F.lit("macro avg").alias("scope"), blank, *names, "support"),
        classes.agg(*[weighted(c) for c in names], support).select(
            F.lit("weighted avg").alias("scope"), blank, *names, "support"
        ),
        pairs.agg((hits / F.sum("n")).alias("f1"), F.sum("n").alias("support")).select(
            F.lit("accuracy").alias("scope"), blank, none.alias("precision"), none.alias("recall"), "f1", "support"
        ),
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table


def nested_report(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """The same as one nested row for the JSON sink; both averages stand among the classes, under their scope."""
    entry = F.struct("precision", "recall", F.col("f1").alias("f1-score"), "support").alias("scores")
    rows = report_table(pairs, labels).where("scope <> 'accuracy'").select(F.coalesce("label", "scope").alias("name"), entry)
    classes = rows.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "scores")))).alias("classification_report")
    )
    return side_by_side(summary(pairs, labels), classes)


def per_source(predictions: DataFrame, source: str, labels: Sequence[str]) -> DataFrame:
    """(source, label, precision, recall, f1, support, accuracy) for every data source, and with a null source in total.

    The rows are read once: the total is summed up from the counts of the sources. Labels that a source lacks have
    zeros, a source without a value is listed as ``(none)``.
    """
    named = F.coalesce(F.col(source).cast("string"), F.lit("(none)"))
    counts = predictions.groupBy(named.alias("source"), "true_label", "predicted_label").agg(F.count("*").alias("n"))
    true, pred, n = F.col("true_label"), F.col("predicted_label"), F.col("n")
    zero = F.lit(0).cast("long")
    hits = F.when(true == pred, n).otherwise(zero)
    sides = F.array(
        F.struct(true.alias("label"), n.alias("support"), zero.alias("predicted"), hits.alias("hits")),
        F.struct(pred.alias("label"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")),
        # Every source has all labels.
        *[F.struct(F.lit(v).alias("label"), zero.alias("support"), zero.alias("predicted"), zero.alias("hits")) for v in labels],
    )
    names = ["support", "predicted", "hits"]
    tall = counts.select("source", F.inline(sides)).groupBy("source", "label").agg(*[F.sum(c).alias(c) for c in names])
    both = tall.groupingSets([["source", "label"], ["label"]], "source", "label").agg(*[F.sum(c).alias(c) for c in names])
    by_source = Window.partitionBy("source")
    both = both.withColumn("accuracy", ratio_or_zero(F.sum("hits").over(by_source), F.sum("support").over(by_source)))
    precision, recall = ratio_or_zero(F.col("hits"), F.col("predicted")), ratio_or_zero(F.col("hits"), F.col("support"))
    rated = both.where(F.col("label").isin(*labels)).withColumns({"precision": precision, "recall": recall})
    f1 = ratio_or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.select("source", "label", "precision", "recall", f1.alias("f1"), "support", "accuracy")


def confusion_grid(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """(true_label, predicted_label, n) for every pair of labels, zeros kept."""
    spark = pairs.sparkSession
    if labels is not None:
        cells = [(t, p) for t in labels for p in labels]
        grid = small_table(spark, {"true_label": [c[0] for c in cells], "predicted_label": [c[1] for c in cells]})
    else:
        seen = pairs.select(F.explode(F.array("true_label", "predicted_label")).alias("label"))
        grid = (
            seen.agg(F.collect_set("label").alias("labels"))
            .select("labels", F.explode("labels").alias("true_label"))
            .select("true_label", F.explode("labels").alias("predicted_label"))
        )
    return grid.join(pairs, ["true_label", "predicted_label"], "left").select(
        "true_label", "predicted_label", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def confusion_matrix(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Wide form: one row per true label, one column per predicted label."""
    grid = confusion_grid(pairs, labels)
    return grid.groupBy("true_label").pivot("predicted_label", list(labels)).agg(F.sum("n"))


def top_confusions(predictions: DataFrame, n: int | None = None) -> DataFrame:
    """(rank, true_label, predicted_label, count, average_confidence) of the wrong rows.

    The mean is over confidences that were already rounded to four places, so they are summed as
    whole ten-thousandths and the result does not depend on the order of the rows.
    """
    grouped = (
        predictions.where(F.col("true_label") != F.col("predicted_label"))
        .groupBy("true_label", "predicted_label")
        .agg(F.count("*").alias("count"), F.sum(F.round(F.col("confidence") * 10000).cast("long")).alias("_sum"))
        .withColumn("_mean", F.col("_sum") / F.col("count"))
    )
    order = [F.desc("count"), F.desc("_mean"), F.col("true_label"), F.col("predicted_label")]
    ranked = grouped.withColumn("rank", F.row_number().over(small_window().orderBy(*order)))
    if n is not None:
        ranked = ranked.where(F.col("rank") <= n)
    return ranked.select(
        "rank", "true_label", "predicted_label", "count", (round_even(F.col("_mean"), 0) / 10000).alias("average_confidence")
    )


def log_loss(scored: DataFrame, weight: Column | None = None, probability: str = "p_true") -> DataFrame:
    """Weighted mean of -ln p(true label); the weights are those of the true label's class."""
    w = weight if weight is not None else F.lit(1.0)
    return scored.agg((F.sum(-F.log(F.col(probability)) * w) / F.sum(w)).alias("log_loss"))


def compare_runs(before: DataFrame | None, after: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(label, before_f1, after_f1, delta) on per-class tables; a missing side counts as 0.0.

    Without a "before" there is nothing to compare and the table is empty.
    """
    dim = label_table(after.sparkSession, labels).select("label")
    new = after.select("label", F.col("f1").alias("after_f1"))
    if before is None:
        return (
            dim.join(new, "label", "left")
            .select("label", F.lit(None).cast("double").alias("before_f1"), "after_f1", F.lit(None).cast("double").alias("delta"))
            .where(F.lit(False))
        )
    old = before.select("label", F.col("f1").alias("before_f1"))
    either = old.join(new, "label", "full_outer")
    return (
        dim.join(either, "label", "left")
        .fillna(0.0, ["before_f1", "after_f1"])
        .withColumn("delta", round_even(F.col("after_f1") - F.col("before_f1"), 4))
        .select("label", "before_f1", "after_f1", "delta")
    )


def compare_headlines(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after) of accuracy, macro F1 and weighted F1 from two summary rows."""
    names = ["accuracy", "macro_f1", "weighted_f1"]
    def long(df: DataFrame, value: str) -> DataFrame:
        return df.select(names).unpivot([], names, "metric", value)

    return long(before, "before").join(long(after, "after"), "metric", "full_outer")
