import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelloom.config import LABELS, MappingSpec, SplitSpec
from labelloom.operators import annotations, checks, dedup, distribution, mapping, ranking, split
from labelloom.operators.rows import drop_invalid_rows, standardize_columns
from labelloom.plans import merge, prepare
from labelloom.sources import readers

SPEC = MappingSpec.build({" Glad ": "JOY", "mad": "anger"}, ["meh"], ["mad"])


def test_mapping_spec_rules():
    assert SPEC.accepted == {"glad": "joy"} and SPEC.dropped == ("mad", "meh") and SPEC.excluded == ("mad",)
    with pytest.raises(ValueError, match="both mapped and dropped: a"):
        MappingSpec.build({"a": "joy"}, ["A "])
    with pytest.raises(ValueError, match="unsupported target labels in mapping: happy"):
        MappingSpec.build({"a": "happy"})
    with pytest.raises(ValueError, match="strings"):
        MappingSpec.build({"a": 1})


def test_mapping_audit_counts_before_cleanup(spark):
    df = spark.createDataFrame(
        [(1, "a", "GLAD"), (2, "a", "glad "), (3, " ", "glad"), (4, "b", "mad"), (5, "c", "odd"), (6, "d", None)],
        "ord int, text string, label string",
    )
    annotated = mapping.annotate_labels(df, SPEC)
    audit = mapping.mapping_audit(mapping.label_counts(annotated), SPEC).first()
    assert (audit.input_rows, audit.mapped_rows, audit.dropped_rows, audit.dropped_percentage) == (6, 3, 3, 50.0)
    assert audit.unknown_labels == ["nan", "odd"] and audit.dropped_label_counts == {"mad": 1, "nan": 1, "odd": 1}
    assert audit.mapped_label_counts == {"joy": 3} and audit.runtime_excluded_labels == ["mad"]
    prepared = prepare.prepared_table(annotated, "ord")
    assert rows(prepared, "ord", "text", "label", "source_label") == [(1, "a", "joy", "glad")]


def test_checks(spark):
    df = spark.createDataFrame([("joy",), ("foo",), ("bar",)], "label string")
    with pytest.raises(ValueError, match="bar, foo"):
        checks.require_labels(df, "label")
    with pytest.raises(ValueError, match="missing required columns: text"):
        standardize_columns(df, "text", "label")
    with pytest.raises(ValueError, match="two distinct"):
        checks.require_two_labels(df.where("label = 'joy'"), "label")
    left = spark.createDataFrame([("Joy", 0), ("fear", 1)], "label string, label_id int")
    right = spark.createDataFrame([("joy", 0), ("fear", 2)], "label string, label_id int")
    checks.require_label_contract(left, left)
    with pytest.raises(ValueError, match="fear: 1 vs 2"):
        checks.require_label_contract(left, right)


def test_invalid_rows(spark):
    df = spark.createDataFrame([(" x ", " JOY "), (None, "joy"), ("y", None), (" ", "joy"), ("z", " ")], "text string, label string")
    assert rows(drop_invalid_rows(df)) == [("x", "joy")]


def test_wide_annotations(spark):
    df = spark.createDataFrame(
        [("none", 0.0, 0.0), ("two", 1.0, 1.0), ("one", None, 1.0), ("half", 0.5, 1.0), (None, 1.0, 0.0), ("one", 0.0, 1.0)],
        "text string, a double, b double",
    )
    assert rows(annotations.single_label_rows(df, ["a", "b"])) == [("half", "b"), ("nan", "a"), ("one", "b")]
    assert rows(annotations.label_rows(df, ["a", "b"])) == [
        ("half", "b"), ("nan", "a"), ("one", "b"), ("one", "b"), ("two", "a"), ("two", "b")
    ]


@pytest.mark.parametrize("parts", [1, 13])
def test_keep_first_ignores_partitioning(spark, parts):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), (2000 - F.col("id")).alias("ord"), F.col("id").alias("v"))
    first = dedup.keep_first(df.repartition(parts), ["k"], "ord")
    assert rows(first, "ord") == [(o,) for o in range(1, 8)]
    assert first.select((F.col("v") + F.col("ord")).alias("s")).distinct().collect()[0][0] == 2000
    assert dedup.duplicate_stats(df, ["k"]).first().removed == 1993


def test_distributions(spark):
    df = spark.createDataFrame([("joy",)] * 5 + [("fear",)] * 3, "label string")
    assert rows(distribution.class_distribution(df)) == [("fear", 3, 37.5), ("joy", 5, 62.5)]
    full = {r.label: (r["count"], r.percentage) for r in distribution.class_distribution_full(df).collect()}
    assert set(full) == set(LABELS) and full["anger"] == (0, 0.0)
    assert {r.label: r.weight for r in distribution.class_weights(df).collect()}["joy"] == round(8 / 30, 6)
    empty = distribution.class_distribution_full(df.where("false")).collect()
    assert all(r["count"] == 0 and r.percentage == 0.0 for r in empty) and len(empty) == 6
    with pytest.raises(Exception, match="no training rows for label"):
        distribution.strict_class_weights(df).collect()
    block = distribution.distribution_block(df, "T:").first()[0]
    assert block == "T:\n  - fear: 3 (37.50%)\n  - joy: 5 (62.50%)"


def test_warnings(spark):
    df = spark.createDataFrame([("joy",)] * 5 + [("fear",)] * 3, "label string")
    found = distribution.distribution_warnings(distribution.class_distribution_full(df), {"joy": list("abcde"), "fear": ["z"]})
    assert [r.warning for r in found.orderBy("pos").collect()] == [
        "Class imbalance warning: 'joy' represents 62.50% of the final dataset.",
        "Mapping breadth warning: 'joy' contains 5 source labels (a, b, c, d, e).",
    ]


def test_examples_list_empty_labels(spark):
    df = spark.createDataFrame([(i, f"t{i}", "joy") for i in range(5)], "ord int, text string, label string")
    got = ranking.examples_per_class(df, 3, "ord").collect()
    assert sorted((r.pos, r.text) for r in got if r.label == "joy") == [(1, "t0"), (2, "t1"), (3, "t2")]
    assert sum(r.pos is None for r in got) == 5


def test_main_row_wins_a_merge(spark):
    main = spark.createDataFrame([(7, "same", "joy"), (8, "same", "fear")], "ord long, text string, label string")
    extra = spark.createDataFrame([(1, "same", "joy"), (2, "new", "joy")], "ord long, text string, label string")
    both = merge.concatenated(main, extra)
    merged = merge.merged_table(both)
    assert rows(merged, "text", "label", "data_source") == [
        ("new", "joy", "curated_additional"), ("same", "fear", "goemotions_cleaned"), ("same", "joy", "goemotions_cleaned")
    ]
    summary = merge.merge_summary(both, merged).first()
    assert (summary.total_rows, summary.duplicate_rows_removed) == (3, 1)
    assert summary.label_counts["anger"] == 0 and summary.data_source_counts == {"curated_additional": 1, "goemotions_cleaned": 2}


def plain_quota(counts, keep):
    total = sum(counts.values())
    floor = {k: c * keep // total for k, c in counts.items()}
    order = sorted(counts, key=lambda k: (-(counts[k] * keep % total), k))
    for k in order[: keep - sum(floor.values())]:
        floor[k] += 1
    return floor


@pytest.mark.parametrize("sizes,spec", [
    ({"a": 500, "b": 33, "c": 7}, SplitSpec(0.15, 0.15, 42)),
    ({"a": 3, "b": 3}, SplitSpec(0.3, 0.3, 1)),
    ({"a": 1000, "b": 10}, SplitSpec(0.2, 0.0, 9)),
])
def test_split_is_an_exact_partition(spark, sizes, spec):
    data = [(f"{label}-{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "k string, label string")
    one = split.assign_split(df.repartition(1), spec, "k")
    many = split.assign_split(df.repartition(11), spec, "k")
    assert rows(one) == rows(many) and one.count() == len(data)
    got = {(r.label, r.split): r["count"] for r in one.groupBy("label", "split").count().collect()}
    n = len(data)
    rest = plain_quota(sizes, n - math.ceil(spec.test_size * n))
    left = sum(rest.values())
    train = plain_quota(rest, left - math.ceil(spec.validation_ratio * left)) if spec.validation_size else rest
    for label in sizes:
        assert got.get((label, "train"), 0) == train[label]
        assert got.get((label, "test"), 0) == sizes[label] - rest[label]


@pytest.mark.parametrize("n_keys", [1, 20])
def test_split_of_repeated_keys(spark, n_keys):
    """Quotas stay exact and the number of rows per key and part does not depend on the partitioning."""
    data = [(f"k{i % n_keys}" if i % n_keys else None, "a") for i in range(1000)]
    df = spark.createDataFrame(data, "k string, label string")
    one, many = (split.assign_split(df.repartition(n), SplitSpec(0.15, 0.15), "k") for n in (1, 7))
    assert rows(one) == rows(many)
    assert rows(one.groupBy("split").count()) == [("test", 150), ("train", 700), ("validation", 150)]


def test_split_refusals(spark):
    df = spark.createDataFrame([(str(i), label) for label in "abcdef" for i in range(4)], "k string, label string")
    with pytest.raises(ValueError, match="fewer than the 6 classes"):
        split.check_split(df, SplitSpec(0.15, 0.15))
    split.check_split(df, SplitSpec(0.25, 0.25))
    with pytest.raises(ValueError, match=r"z \(2\)"):
        split.check_split(df.union(spark.createDataFrame([("1", "z"), ("2", "z")], df.schema)), SplitSpec())
    for bad in ((0, 0.1), (0.5, 0.5), (0.2, 1.0)):
        with pytest.raises(ValueError):
            SplitSpec(*bad)


def test_flat_and_structured_mapping():
    assert readers.parse_label_mapping({"sad": "sadness"}).accepted == {"sad": "sadness"}
    spec = readers.parse_label_mapping({"accepted_mappings": {"x": "joy"}, "dropped_labels": ["y"]}, ["x"])
    assert spec.accepted == {} and spec.dropped == ("x", "y")
    for bad in ([], {}, {"accepted_mappings": []}, {"accepted_mappings": {}, "dropped_labels": {}}):
        with pytest.raises(ValueError):
            readers.parse_label_mapping(bad)


def test_raising_checks_tell_how_many_there_are(spark):
    from labelloom.operators import checks

    df = spark.range(250).selectExpr("concat('x', id) as label")
    with pytest.raises(ValueError, match=r"\(250 in all\)"):
        checks.require_labels(df, "label")
    with pytest.raises(ValueError, match=r"\(250 in all\)"):
        checks.require_class_sizes(df, "label", 2)


def test_run_configuration_names_all_missing_keys(spark, tmp_path):
    from labelloom.config import RunConfig

    with pytest.raises(ValueError, match="lacks: .*dataset_path, .*labels, .*random_state, .*test_size"):
        RunConfig.parse({"min_df": 2})
