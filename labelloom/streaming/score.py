"""Scoring an unbounded stream of comments. Rows are independent, so there is no stream state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from labelloom.functions.numeric import all_probabilities_line, top_lines
from labelloom.functions.text import has_text, strip
from labelloom.operators.classifier import TextClassifier
from labelloom.operators.features import with_terms
from labelloom.operators.linear import contribution_lines, judged

COUNTERS = "comments"
COMMENT = T.StructType([T.StructField("comment_id", T.LongType()), T.StructField("text", T.StringType())])


def score_comments(classifier: TextClassifier, df: DataFrame, top_n: int = 3) -> DataFrame:
    """Label, top-n block and full probability line per non-blank comment. Batch or stream."""
    usable = df.where(has_text(F.col("text"))).withColumn("text", strip(F.col("text")))
    scored = F.col("scored")
    return (
        classifier.score(usable)
        .withColumn("top", top_lines(scored, top_n))
        .withColumn("all_probabilities", all_probabilities_line(scored))
        .drop("probabilities")
    )


def judge_comments(
    df: DataFrame, model: DataFrame, labels: Sequence[str], intercepts: Sequence[float], max_features: int,
    top_n: int = 3, features: int = 5,
) -> DataFrame:
    """Label, lines of probabilities and largest contributions of every comment, and its ``status``.

    Batch or stream, one projection without a shuffle. Blank and missing texts have the status ``rejected`` and
    nulls in all added columns, other rows ``scored``. ``model`` is a table (term, idf, coefs).
    """
    scored = has_text(F.col("text"))
    named = df.withColumn("status", F.when(scored, F.lit("scored")).otherwise(F.lit("rejected")))
    terms = with_terms(named.withColumn("text", F.when(scored, strip(F.col("text"))).otherwise(F.col("text"))))
    judged_rows = judged(terms, model, labels, intercepts, max_features, features)
    added = {
        "predicted_label": F.col("predicted_label"),
        "top": top_lines(F.col("scored"), top_n),
        "all_probabilities": all_probabilities_line(F.col("scored")),
        "contributions": F.col("contributions"),
        "contribution_lines": contribution_lines(F.col("contributions")),
    }
    kept = [F.when(F.col("status") == "scored", c).alias(name) for name, c in added.items()]
    return judged_rows.select(*df.columns, "status", *kept)


def counted(judged_comments: DataFrame) -> DataFrame:
    """Lets the job count its own rows: input, scored, rejected. Map-side, so no row is counted twice by a retry."""
    of = lambda status: F.count(F.when(F.col("status") == status, F.lit(1))).alias(status)
    return judged_comments.observe(COUNTERS, F.count(F.lit(1)).alias("input"), of("scored"), of("rejected"))


def counts_of(query: StreamingQuery) -> dict[str, int]:
    """Input, scored and rejected rows of a query over the batches that it still remembers
    (``spark.sql.streaming.numRecentProgressUpdates``); a query that runs for long is better watched by a listener."""
    total = dict.fromkeys(("input", "scored", "rejected"), 0)
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(COUNTERS)
        for name in total if row is not None else ():
            total[name] += row[name]
    return total


def _judged_by(classifier: TextClassifier, df: DataFrame, top_n: int = 3, features: int = 5) -> DataFrame:
    model, intercepts = classifier.weight_table(df.sparkSession)
    size = len(classifier.model.stages[1].vocabulary)
    return judge_comments(df, model, classifier.labels, intercepts, size, top_n, features)


def explain_comments(classifier: TextClassifier, df: DataFrame, key: str = "comment_id", top_n: int = 5) -> DataFrame:
    """(key, contributions, contribution_lines) of the comments with a text."""
    explained = _judged_by(classifier, df, features=top_n).where("status = 'scored'")
    return explained.select(key, "contributions", "contribution_lines")


def scored_batch(classifier: TextClassifier, df: DataFrame) -> DataFrame:
    """Scored and explained comments, those without a text left out. Batch or stream."""
    return _judged_by(classifier, df).where("status = 'scored'").drop("status")


def comment_stream(spark: SparkSession, folder: str, schema: T.StructType = COMMENT, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(folder)


def start_scoring(
    classifier: TextClassifier, comments: DataFrame, output: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append scored comments; exactly once through the file sink's log and the checkpoint."""
    return _started(score_comments(classifier, comments), output, checkpoint, available_now)


def _started(
    df: DataFrame, output: str, checkpoint: str, available_now: bool, partition: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(partition) if partition else writer
    return (writer.trigger(availableNow=True) if available_now else writer).start(output)


def start_explained_scoring(
    classifier: TextClassifier, comments: DataFrame, output: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """As above with explanations."""
    return _started(scored_batch(classifier, comments), output, checkpoint, available_now)


def start_judging(
    comments: DataFrame, model: DataFrame, labels: Sequence[str], intercepts: Sequence[float], max_features: int,
    output: str, checkpoint: str, available_now: bool = False,
) -> StreamingQuery:
    """Judged comments in ``output/status=scored`` and rejected ones in ``output/status=rejected``, by one pass over
    the source; exactly once through the file sink's log. ``counts_of`` the query tells how many went where."""
    rows = counted(judge_comments(comments, model, labels, intercepts, max_features))
    return _started(rows, output, checkpoint, available_now, "status")
