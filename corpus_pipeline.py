"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing; each stage by one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import decontaminate, jaccard, linededup, mixing, quality
from labelloom.llm.batches import lower_batches
from labelloom.llm.queries import remainder, table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier predicts as 0 go."""
    lower_batches(spark)
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id") != 1)
    return quality.score_quality(docs, labels).where(F.col("predicted") == 1).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go from every text; n_chars is counted anew."""
    lower_batches(spark)
    kept = linededup.dedup_lines(docs, min_docs=10, min_chars=1, keep="none")
    return kept.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones stays."""
    return jaccard.without_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mix of sources."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix),
]

# A trained model decides the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
