"""TF-IDF + multinomial logistic regression on Spark ML, and scoring with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pyarrow as pa

from labelloom.config import FeatureSpec
from labelloom.functions.numeric import argmax_label, ranked_labels, round_even
from labelloom.functions.text import clean, word_array
from labelloom.operators.distribution import attach_weights, balanced_weights
from labelloom.operators.features import ngrams, term_statistics, tokens, vocabulary, with_idf, with_terms
from labelloom.session import ensure_checkpoint_dir, label_table, small_table


class TermBuilder(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text -> array of n-gram terms, so that a saved model carries its own text cleaning."""

    low = Param(Params._dummy(), "low", "shortest n-gram", TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "longest n-gram", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "terms", low: int = 1, high: int = 2):
        super().__init__()
        self._setDefault(low=1, high=2)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        span = (self.getOrDefault(self.low), self.getOrDefault(self.high))
        return with_terms(dataset, self.getInputCol(), self.getOutputCol(), span)


ROWS_PER_TASK = 5_000
_SCRATCH = ("terms", "_counts", "_scaled", "features", "rawPrediction", "prediction")


@dataclass
class TextClassifier:
    """A fitted model and its label order (alphabetical)."""

    model: PipelineModel
    labels: list[str]

    def probabilities(self, df: DataFrame) -> DataFrame:
        """Adds ``probabilities`` (label order). One map-side pass, no shuffle; works on streams."""
        scored = self.model.transform(df)
        return scored.withColumn("probabilities", vector_to_array("probability")).drop(*_SCRATCH, "probability")

    def score(self, df: DataFrame) -> DataFrame:
        """Adds predicted_label and ``scored`` (labels with probabilities, best first)."""
        p = F.col("probabilities")
        return (
            self.probabilities(df)
            .withColumn("predicted_label", argmax_label(p, self.labels))
            .withColumn("scored", ranked_labels(p, self.labels))
        )

    def predict(self, df: DataFrame, text: str = "text", label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
        """(text, true_label, predicted_label, confidence, is_correct, *keep)."""
        p = F.col("probabilities")
        renamed = df if text == "text" else df.withColumnRenamed(text, "text")
        return self.probabilities(renamed).select(
            *keep, "text",
            F.col(label).alias("true_label"),
            argmax_label(p, self.labels).alias("predicted_label"),
            round_even(F.array_max(p), 4).alias("confidence"),
        ).withColumn("is_correct", F.col("true_label") == F.col("predicted_label"))

    def weight_table(self, spark: SparkSession) -> tuple[DataFrame, list[float]]:
        """The model as a table (term, idf, coefs) plus intercepts; at most ``max_features`` rows."""
        _, counter, scaler, _, regression = self.model.stages
        matrix = regression.coefficientMatrix.toArray().T
        idf = scaler.getScalingVec().toArray()
        table = small_table(
            spark,
            {"term": counter.vocabulary, "idf": idf, "coefs": [row.tolist() for row in matrix]},
            {"idf": pa.float64(), "coefs": pa.list_(pa.float64())},
        )
        return table, [float(v) for v in regression.interceptVector.toArray()]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        label_table(spark, self.labels).coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        names = spark.read.parquet(f"{path}/labels").orderBy("label_id").collect()
        return cls(PipelineModel.load(f"{path}/model"), [r["label"] for r in names])


def fit_text_classifier(
    train: DataFrame, spec: FeatureSpec = FeatureSpec(), text: str = "text", label: str = "label"
) -> TextClassifier:
    """Vocabulary and idf from the training rows, then a weighted multinomial regression.

    Only the vocabulary (at most ``max_features`` rows) and the label list come to the driver. The
    gradient is a tree aggregate over blocks of the feature vectors, which the regression keeps itself.
    """
    renamed = train.select(F.col(text).alias("text"), F.col(label).alias("label"))
    builder = TermBuilder(inputCol="text", outputCol="terms", low=spec.ngram_range[0], high=spec.ngram_range[1])
    # Cleaning is done once, but only words are kept, in a checkpoint: the n-grams of a text take many times its size, and
    # writing a cached partition of them holds it in the heap as a whole. The rows keep their order, and so the sums theirs.
    ensure_checkpoint_dir(train.sparkSession)
    words = renamed.select("label", F.array_join(tokens(clean(F.col("text"))), " ").alias("words")).checkpoint()
    prepared = words.select("label", ngrams(word_array(F.col("words")), *spec.ngram_range).alias("terms"))
    vocab = with_idf(vocabulary(term_statistics(prepared), spec.min_df, spec.max_features), prepared)
    rows = vocab.orderBy("term_id").select("term", "idf").collect()
    if not rows:
        raise ValueError("no term occurs in enough training rows")
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], "terms", "_counts")
    scaler = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_counts", outputCol="_scaled"
    )
    norm = Normalizer(p=2.0, inputCol="_scaled", outputCol="features")
    weights = balanced_weights(prepared).orderBy("label").collect()
    labels = [r["label"] for r in weights]
    if len(labels) < 2:
        raise ValueError("at least two labels are needed to train")
    n_rows = sum(r["count"] for r in weights)
    ids = label_table(train.sparkSession, labels)
    vectors = norm.transform(scaler.transform(counter.transform(prepared)))
    table = small_table(
        train.sparkSession,
        {"label": labels, "weight": [r["weight"] if spec.balanced else 1.0 for r in weights]},
        {"weight": pa.float64()},
    )
    features = (
        attach_weights(vectors.join(ids, "label"), table, len(labels))
        .select(F.col("label_id").cast("double").alias("label"), "weight", "features")
        # Every iteration is one job: a small table is not worth many tasks. Never more than now.
        .coalesce(-(-n_rows // ROWS_PER_TASK))
    )
    # Balanced weights sum to the row count, so both weightings share the same penalty.
    regression = LogisticRegression(
        family="multinomial", weightCol="weight", standardization=False, elasticNetParam=0.0,
        regParam=1.0 / (spec.c * n_rows), maxIter=spec.max_iter, tol=1e-5,
    ).fit(features)
    return TextClassifier(PipelineModel([builder, counter, scaler, norm, regression]), labels)
