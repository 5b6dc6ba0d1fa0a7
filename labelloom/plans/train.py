"""Training, evaluation and before/after comparison of the text classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from labelloom.config import LABELS, FeatureSpec, RunConfig, SplitSpec
from labelloom.functions.numeric import probe_lines
from labelloom.operators import metrics
from labelloom.operators.classifier import TextClassifier, fit_text_classifier
from labelloom.operators.split import assign_split, check_split
from labelloom.plans.analysis import write_error_analysis
from labelloom.plans.merge import merge_datasets
from labelloom.plans.prepare import load_labelled
from labelloom.session import side_by_side
from labelloom.sources.readers import read_report
from labelloom.sources.writers import write_report, write_table

HEADLINES = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


@dataclass
class TrainingResult:
    """A fitted model with its prediction table over the held-out rows (column ``split``)."""

    classifier: TextClassifier
    predictions: DataFrame

    def part(self, name: str) -> DataFrame:
        return self.predictions.where(F.col("split") == name)

    def metrics(self, name: str = "test") -> DataFrame:
        """Per-class rows over the model's own label list (alphabetical)."""
        return metrics.per_class(metrics.pair_counts(self.part(name)), self.classifier.labels)

    def summary(self, name: str = "test") -> DataFrame:
        return metrics.summary(metrics.pair_counts(self.part(name)), self.classifier.labels)

    def report(self) -> DataFrame:
        """One nested row: test metrics, with the validation metrics in ``validation``."""
        def nested(name: str) -> DataFrame:
            return metrics.nested_report(metrics.pair_counts(self.part(name)), self.classifier.labels)

        return side_by_side(nested("test"), nested("validation").select(F.struct("*").alias("validation")))


def train_and_evaluate(
    table: DataFrame,
    key: str | Sequence[str] = ("text", "label"),
    split: SplitSpec = SplitSpec(),
    features: FeatureSpec = FeatureSpec(),
    text: str = "text",
    label: str = "label",
    keep: Sequence[str] = (),
) -> TrainingResult:
    """Split, fit on the train part only, predict the held-out parts in one map-side pass."""
    check_split(table, split, label)
    tagged = assign_split(table, split, key, label)
    classifier = fit_text_classifier(tagged.where("split = 'train'"), features, text, label)
    held = tagged.where("split <> 'train'")
    return TrainingResult(classifier, classifier.predict(held, text, label, keep=["split", *keep]))


def run_training(spark: SparkSession, config: RunConfig, root: str) -> TrainingResult:
    """The configured job: CSV in; model, label list, metrics report and confusion grid out."""
    path = lambda relative: f"{root.rstrip('/')}/{relative}"
    text, label = config.text_column, config.label_column
    table = load_labelled(
        spark, path(config.dataset_path), text, label, config.labels, config.remove_duplicates
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Rows that repeat text and label are interchangeable, so no file position is needed to tell them apart.
        result = train_and_evaluate(table, [text, label], config.split, config.features, text, label)
        result.classifier.save(path(config.model_output_path))
        result.predictions = result.predictions.persist(StorageLevel.MEMORY_AND_DISK)
        write_report(result.report(), path(config.metrics_output_path))
        grid = metrics.confusion_matrix(metrics.pair_counts(result.part("test")), result.classifier.labels)
        write_table(grid.coalesce(1), path(config.confusion_matrix_output_path), "csv")
    finally:
        table.unpersist()
    return result


def run_error_analysis(spark: SparkSession, config: RunConfig, root: str, output: str, top_n: int = 20) -> None:
    """Rebuild the test part from key and seed, score it with the saved model, write the analysis."""
    path = lambda relative: f"{root.rstrip('/')}/{relative}"
    text, label = config.text_column, config.label_column
    table = load_labelled(spark, path(config.dataset_path), text, label, config.labels, config.remove_duplicates)
    test = assign_split(table, config.split, [text, label], label).where("split = 'test'")
    model = TextClassifier.load(spark, path(config.model_output_path))
    write_error_analysis(model.predict(test, text, label), output, ["text", "true_label"], top_n)


def headline_metrics(spark: SparkSession, report_path: str) -> DataFrame:
    """(metric, value) of a saved report; a metric it lacks reads 0."""
    report = read_report(spark, report_path, metrics.REPORT_SCHEMA)
    wide = report.select(*HEADLINES, F.col("validation.macro_f1").alias("validation_macro_f1")).fillna(0.0)
    return wide.unpivot([], wide.columns, "metric", "value")


def comparison_report(before: DataFrame | None, after: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Nested before/after report from two nested reports; marks a missing "before"."""
    names = ("accuracy", "macro_f1", "weighted_f1")
    after_part = after.select(F.struct(*names).alias("after"), F.col("classification_report").alias("_new"))
    if before is None:
        return after_part.select("after", F.lit(True).alias("before_metrics_missing"))
    before_part = before.select(F.struct(*names).alias("before"), F.col("classification_report").alias("_old"))
    both = side_by_side(before_part, after_part)
    f1 = lambda side, label: F.coalesce(F.try_element_at(side, F.lit(label))["f1-score"], F.lit(0.0))
    deltas = [v for label in labels for v in (F.lit(label), F.bround(f1(F.col("_new"), label) - f1(F.col("_old"), label), 4))]
    return both.select("before", "after", F.create_map(*deltas).alias("per_class_f1_delta"))


def merge_retrain_compare(
    main: DataFrame,
    additional: DataFrame,
    output: str,
    reports: str,
    before: DataFrame | None = None,
    split: SplitSpec = SplitSpec(0.25, 0.25),
    features: FeatureSpec = FeatureSpec(),
) -> tuple[TrainingResult, DataFrame]:
    """Merge two tables, train on the result and compare with an earlier nested report."""
    merged = merge_datasets(main, additional, output, reports)
    result = train_and_evaluate(merged, ("text", "label"), split, features, keep=["data_source"])
    result.predictions = result.predictions.persist(StorageLevel.MEMORY_AND_DISK)
    comparison = comparison_report(before, result.report())
    write_report(comparison, f"{reports}/before_after_comparison")
    return result, comparison


def score_probes(classifier: TextClassifier, probes: DataFrame, top_n: int = 3) -> DataFrame:
    """(group, pos, text, predicted_label, top): the best labels of every probe sentence as lines."""
    return classifier.score(probes).select(
        "group", "pos", "text", "predicted_label", probe_lines(F.col("scored"), top_n).alias("top")
    )
