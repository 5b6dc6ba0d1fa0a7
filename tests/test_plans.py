"""Physical plans: no cross products, pruned scans, wide rows left in place."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from labelloom.catalog import bindings as b
from labelloom.catalog import curation, modelling  # noqa: F401
from labelloom.catalog.registry import ORACLES, QUERIES
from labelloom.config import SplitSpec
from labelloom.operators.split import assign_split

LAZY = [
    "prepare_dataset", "mapping_audit", "class_distribution_full", "merge_summary", "metrics_report", "confusion_grid",
    "error_analysis_confusion", "text_diversity", "vocabulary", "linear_scores", "explain_predictions", "curated_candidates",
    "headline_comparison", "stratified_split", "seeded_positions",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_split_moves_only_keys(spark):
    """The tagged rows reach the output through a broadcast join; text is in no exchange."""
    table = b.read(spark, DATA, "documents").select("doc_id", "text", F.col("source").alias("label"))
    text = plan(assign_split(table, SplitSpec(), "doc_id"))
    top = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top and "SortMergeJoin" not in top


@pytest.mark.parametrize("name", ["tfidf_weights", "linear_scores", "explain_predictions", "contribution_lines"])
def test_term_weights_stay_in_their_row(spark, name):
    assert "hashpartitioning(doc_id" not in plan(QUERIES[name](spark, DATA))


def test_scans_are_pruned(spark):
    text = plan(QUERIES["class_distribution"](spark, DATA))
    assert "ReadSchema: struct<event_type:string>" in text


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(ORACLES) >= 95
