"""Sinks that publish whole folders, and the phrase product over all tasks."""

import os

import pytest
from pyspark.sql import functions as F

from labelloom.config import MappingSpec
from labelloom.operators.candidates import combinations
from labelloom.plans.prepare import prepare_dataset
from labelloom.sources import writers


def content(spark, path):
    return sorted(r.v for r in spark.read.parquet(path).collect())


def test_failing_writes_and_checks_leave_the_earlier_table(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_table(spark.range(3).selectExpr("id AS v"), path)
    with pytest.raises(Exception, match="boom"):
        writers.write_table(spark.range(9).selectExpr("if(id = 8, raise_error('boom'), id) AS v"), path)

    def refuse(folder):
        assert content(spark, folder) == [5]
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        writers.write_table(spark.range(5, 6).selectExpr("id AS v"), path, check=refuse)
    assert content(spark, path) == [0, 1, 2] and os.listdir(tmp_path) == ["table"]


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_table(spark.range(3).selectExpr("id AS v"), path)
    writers.write_table(spark.read.parquet(path).select((F.col("v") + 10).alias("v")), path)
    assert content(spark, path) == [10, 11, 12]


def test_a_crash_between_the_renames_is_taken_back(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_table(spark.range(3).selectExpr("id AS v"), path)
    os.rename(path, tmp_path / "_earlier.table")
    writers.settle(spark, path)
    assert content(spark, path) == [0, 1, 2] and os.listdir(tmp_path) == ["table"]
    writers.write_table(spark.range(1).selectExpr("id AS v"), str(tmp_path / "_earlier.table"))
    writers.settle(spark, path)  # both there: the publication was complete
    assert content(spark, path) == [0, 1, 2] and os.listdir(tmp_path) == ["table"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_bad_run_leaves_the_prepared_table(spark, tmp_path, fmt):
    path = str(tmp_path / "prepared")
    spec = MappingSpec.build({"a": "joy", "b": "fear"})
    good = spark.createDataFrame([(1, "one, \"two\"", "a"), (2, "three\nfour", "b")], "ord long, text string, label string")
    first = prepare_dataset(good, spec, "ord", path, fmt=fmt)
    assert sorted(r.text for r in first.collect()) == ["one, \"two\"", "three\nfour"]
    with pytest.raises(ValueError, match="no rows remain"):
        prepare_dataset(good.limit(0), spec, "ord", path, fmt=fmt)
    assert first.count() == 2 and os.listdir(tmp_path) == ["prepared"]


def pool_rows(n_openers):
    phrases = [(label, slot, k, f"{slot}{k}") for label in ("joy", "fear") for slot, n in (("opener", n_openers), ("middle", 3), ("ending", 2)) for k in range(n)]
    phrases += [("joy", "middle", 2, "again"), ("anger", "opener", 0, "alone"), (None, "opener", 0, "null")]
    return phrases, [(label, k, f"t{k}") for label in ("joy", "fear", "anger") for k in range(4)]


@pytest.mark.parametrize("block", [1, 5, 7, 1 << 14])
def test_combinations_match_a_nested_loop(spark, block):
    phrases, templates = pool_rows(3)
    got = combinations(
        spark.createDataFrame(phrases, "label string, slot string, pos int, phrase string"),
        spark.createDataFrame(templates, "label string, pos int, template string"), block,
    )
    of = lambda slot, label: [(p, v) for x, s, p, v in phrases if s == slot and x == label]
    want = [
        (label, t, o, m, e, template, opener, middle, ending)
        for label, t, template in templates
        for o, opener in of("opener", label) for m, middle in of("middle", label) for e, ending in of("ending", label)
    ]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_the_product_of_two_labels_is_spread_over_all_tasks(spark):
    phrases, templates = pool_rows(40)
    made = combinations(
        spark.createDataFrame(phrases, "label string, slot string, pos int, phrase string"),
        spark.createDataFrame(templates, "label string, pos int, template string"), 8,
    )
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)
    empty = spark.createDataFrame([], "label string, slot string, pos int, phrase string")
    assert combinations(empty, spark.createDataFrame([], "label string, pos int, template string")).count() == 0
