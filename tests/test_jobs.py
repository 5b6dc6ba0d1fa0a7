import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelloom.config import MappingSpec, QualitySpec, RunConfig
from labelloom.plans import curate, merge, prepare, train
from labelloom.sources import readers, writers

CSV = 'text,label\n"Wow, I did ""not"" see that",Surprise\n"two\nlines",joy\nNone,joy\nplain,joy\nplain,joy\nodd,foo\n,joy\n'


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_csv_quotes_line_breaks_and_missing_tokens(spark, tmp_path):
    got = readers.read_labelled_csv(spark, write(tmp_path / "a.csv", CSV))
    assert rows(got, "text")[0] == ('Wow, I did "not" see that',)
    assert got.where("text is null").count() == 2 and got.count() == 7
    with pytest.raises(FileNotFoundError):
        readers.read_labelled_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="expected a .csv"):
        readers.read_labelled_csv(spark, write(tmp_path / "a.txt", "x"))
    with pytest.raises(ValueError, match="no rows"):
        readers.read_labelled_csv(spark, write(tmp_path / "e.csv", "text,label\n"))


def test_load_labelled_checks(spark, tmp_path):
    good = write(tmp_path / "g.csv", "comment,mood,x\n a , JOY ,1\na,joy,2\nb,fear,3\n")
    table = prepare.load_labelled(spark, good, "comment", "mood", remove_duplicates=True, rename=True)
    assert rows(table, "text", "label", "x") == [("a", "joy", "1"), ("b", "fear", "3")]
    with pytest.raises(ValueError, match="unsupported labels: foo"):
        prepare.load_labelled(spark, write(tmp_path / "a.csv", CSV))
    with pytest.raises(ValueError, match="two distinct"):
        prepare.load_labelled(spark, write(tmp_path / "o.csv", "text,label\na,joy\n"))


def test_annotations_to_prepared_table(spark, tmp_path):
    first = write(tmp_path / "p1.csv", "text,id,a,b\nhi,1,1,0\nboth,2,1,1\n")
    second = write(tmp_path / "p2.csv", "text,id,a,b\nyo,3,0,1.0\nhi,4,1,\n")
    mapping = write(tmp_path / "m.json", json.dumps({"accepted_mappings": {"a": "joy"}, "dropped_labels": ["b"]}))
    out = prepare.prepare_from_annotations(
        spark, [first, second], mapping, str(tmp_path / "out"), str(tmp_path / "rep"), columns=["a", "b"]
    )
    assert rows(out, "text", "label", "source_label") == [("hi", "joy", "a")]
    audit = readers.read_report(spark, str(tmp_path / "rep/mapping_audit")).first()
    assert (audit.input_rows, audit.mapped_rows, audit.dropped_rows) == (2, 1, 1)
    groups = readers.read_report(spark, str(tmp_path / "rep/source_label_groups")).first()[0]
    assert groups["joy"]["a"]["count"] == 1 and groups["joy"]["a"]["examples"] == ["hi"]
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "rep/sample_examples_per_class")).collect())
    assert "[joy]\n  1. hi" in text and "[anger]\n  (no examples available)" in text
    weights = spark.read.csv(str(tmp_path / "rep/class_weights"), header=True).collect()
    assert [r.label for r in weights][0] == "joy" and weights[1].weight == "0.0"
    with pytest.raises(ValueError, match="no rows remain"):
        prepare.prepare_dataset(
            readers.read_csv(spark, first, order="ord").withColumn("label", F.lit("zzz")),
            MappingSpec.build({"a": "joy"}), "ord", str(tmp_path / "none"),
        )


def test_sentences_and_guidelines(spark, tmp_path):
    got = readers.read_sentences(spark, write(tmp_path / "s.txt", " one \n\n two\n   \n"))
    assert rows(got, "text") == [("one",), ("two",)]
    with pytest.raises(ValueError):
        readers.read_sentences(spark, write(tmp_path / "b.txt", "\n \n"))
    rules = readers.guideline_table(spark, {"joy": {"include": ["x", "y"], "exclude": ["z"]}})
    report = writers.guideline_report(rules).first()
    assert (report.include, report.exclude) == (["x", "y"], ["z"])


def pools(n_openers=12):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9)))
    phrase = lambda n: " ".join(word() for _ in range(n))
    shapes = [
        "{opener_cap} {middle} {ending}", "{middle_cap} {ending}", "{opener_cap} {middle}.",
        "{opener_cap} {middle}, {ending}", "{middle_cap}, honestly.", "{opener_cap}? {middle_cap}.",
    ]
    return {
        label: {
            "openers": [phrase(2) for _ in range(n_openers)], "middles": [phrase(3) for _ in range(12)],
            "endings": [phrase(2) + "." for _ in range(10)], "templates": shapes, "extras": [phrase(5) for _ in range(10)],
        }
        for label in ("joy", "fear")
    }


def test_candidate_counts_and_curated_job(spark, tmp_path):
    from labelloom.operators.candidates import build_candidates, build_sentences

    tables = readers.read_phrase_pools(spark, write(tmp_path / "pools.json", json.dumps(pools())))
    built = build_sentences(tables[0], tables[1])
    # 12 openers, 12 middles, 10 endings: 1440 + 120 + 144 + 1440 + 12 + 144 distinct sentences.
    assert {r.label: r["count"] for r in built.groupBy("label").count().collect()} == {"joy": 3300, "fear": 3300}
    made = build_candidates(*tables, per_class=20, labels=("joy", "fear"))
    assert made.count() == 200 and made.select("ord").distinct().count() == 200
    rules = readers.guideline_table(spark, {"joy": {"include": ["x"], "exclude": []}})
    kept = curate.curate_dataset(*tables, rules, str(tmp_path / "c"), str(tmp_path / "r"), QualitySpec(per_class=20), labels=("joy", "fear"))
    counts = {r.label: r["count"] for r in kept.groupBy("label").count().collect()}
    assert all(n <= 20 for n in counts.values()) and set(counts) == {"joy", "fear"}
    summary = readers.read_report(spark, str(tmp_path / "r/summary")).first()
    assert summary.input_rows == 200 and summary.final_rows == sum(counts.values()) and summary.vocabulary_size > 50
    assert spark.read.parquet(str(tmp_path / "c")).columns == ["text", "label", "source", "quality_tag"]


def labelled(n, seed):
    rng = random.Random(seed)
    words = {"joy": ["happy", "smile", "glad"], "fear": ["scared", "dark", "worried"], "anger": ["mad", "rude", "furious"]}
    return [(f"{rng.choice(words[k])} {rng.choice(words[k])} {i} thing", k) for i in range(n) for k in words]


def test_training_job_from_csv(spark, tmp_path):
    (tmp_path / "data").mkdir()
    lines = "text,label\n" + "\n".join(f"{t},{k}" for t, k in labelled(20, 1))
    write(tmp_path / "data/d.csv", lines)
    config = RunConfig.load(write(tmp_path / "c.json", json.dumps({
        "dataset_path": "data/d.csv", "text_column": "text", "label_column": "label", "labels": ["joy", "fear", "anger"],
        "validation_size": 0.2, "test_size": 0.2, "random_state": 42, "max_features": 100, "ngram_range": [1, 1], "min_df": 2,
        "max_iter": 50, "remove_duplicates": True, "model_output_path": "m", "labels_output_path": "l",
        "metrics_output_path": "metrics", "confusion_matrix_output_path": "cm",
    })))
    result = train.run_training(spark, config, str(tmp_path))
    assert result.summary().first().accuracy == 1.0
    headlines = {r.metric: r.value for r in train.headline_metrics(spark, str(tmp_path / "metrics")).collect()}
    assert headlines["accuracy"] == 1.0 and headlines["validation_macro_f1"] == 1.0
    train.run_error_analysis(spark, config, str(tmp_path), str(tmp_path / "analysis"))
    test_rows = spark.read.parquet(str(tmp_path / "analysis/test_predictions"))
    assert rows(test_rows, "text") == rows(result.part("test"), "text")


def test_merge_retrain_compare(spark, tmp_path):
    make = lambda seed, n: spark.createDataFrame(
        [(i, t, k) for i, (t, k) in enumerate(labelled(n, seed))], "ord long, text string, label string"
    )
    from labelloom.config import FeatureSpec
    result, comparison = train.merge_retrain_compare(
        make(1, 12), make(2, 6), str(tmp_path / "m"), str(tmp_path / "r"), features=FeatureSpec(max_iter=30)
    )
    assert comparison.first().before_metrics_missing
    merged = spark.read.parquet(str(tmp_path / "m"))
    assert merged.columns == ["text", "label", "data_source"]
    summary = readers.read_report(spark, str(tmp_path / "r/merge_summary")).first()
    assert summary.total_rows == merged.count() and summary.label_counts.sadness == 0
    again, compared = train.merge_retrain_compare(
        make(1, 12), make(2, 6), str(tmp_path / "m2"), str(tmp_path / "r2"), before=result.report(), features=FeatureSpec(max_iter=30)
    )
    assert set(compared.first().per_class_f1_delta.values()) == {0.0}
