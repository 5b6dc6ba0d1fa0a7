import math

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from labelloom.catalog import bindings as b
from labelloom.config import LABELS, FeatureSpec
from labelloom.functions.numeric import ranked_labels, softmax
from labelloom.operators import features, linear, metrics
from labelloom.operators.classifier import TextClassifier, fit_text_classifier
from labelloom.plans import analysis, train
from labelloom.streaming import score

MOODS = {
    "joy": ["so happy and smiling today", "happy happy news made me smile", "smiling all day so glad"],
    "fear": ["scared of the dark street", "so scared and worried tonight", "worried about the dark noise"],
    "anger": ["furious about the rude reply", "so angry and furious now", "rude people make me angry"],
}


@pytest.fixture(scope="module")
def training(spark):
    data = [(i * 10 + j, t, label) for i, (label, texts) in enumerate(MOODS.items()) for j, t in enumerate(texts)]
    return spark.createDataFrame(data, "comment_id long, text string, label string").repartition(3)


@pytest.fixture(scope="module")
def classifier(training):
    return fit_text_classifier(training, FeatureSpec(min_df=1, max_features=50))


def pairs_of(spark, true, pred):
    return metrics.pair_counts(spark.createDataFrame(list(zip(true, pred, strict=True)), "true_label string, predicted_label string"))


def test_metric_traps(spark):
    pairs = pairs_of(spark, ["a", "a", "b", "c"], ["a", "b", "b", "b"])
    per = {r.label: r for r in metrics.per_class(pairs, ["a", "b", "c", "d"]).collect()}
    assert (per["c"].precision, per["c"].recall, per["c"].f1, per["d"].support) == (0.0, 0.0, 0.0, 0)
    assert per["a"].f1 == pytest.approx(2 / 3) and per["b"].precision == pytest.approx(1 / 3)
    given, seen = metrics.summary(pairs, ["a", "b", "c", "d"]).first(), metrics.summary(pairs).first()
    assert given.macro_f1 == pytest.approx(seen.macro_f1 * 3 / 4) and given.weighted_f1 == pytest.approx(seen.weighted_f1)
    grid = metrics.confusion_grid(pairs, ["a", "b", "c", "d"])
    assert grid.count() == 16 and grid.agg(F.sum("n")).first()[0] == 4
    trace = grid.where("true_label = predicted_label").agg(F.sum("n")).first()[0]
    assert seen.accuracy == trace / 4 == 0.5


def test_comparison(spark):
    after = metrics.per_class(pairs_of(spark, ["joy", "fear"], ["joy", "joy"]))
    before = metrics.per_class(pairs_of(spark, ["joy", "joy"], ["joy", "anger"]))
    got = {r.label: r.delta for r in metrics.compare_runs(before, after, LABELS).collect()}
    assert len(got) == 6 and got["fear"] == 0.0
    assert metrics.compare_runs(None, after, LABELS).count() == 0
    report = metrics.nested_report(pairs_of(spark, ["joy"], ["joy"]))
    assert train.comparison_report(None, report).first().before_metrics_missing
    assert train.comparison_report(report, report).first().per_class_f1_delta["joy"] == 0.0


def test_softmax_is_stable_and_ranked(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 999.0],)], "z array<double>")
    p, ranked = df.select(softmax(F.col("z")), ranked_labels(softmax(F.col("z")), ["x", "y", "w"])).first()
    assert sum(p) == pytest.approx(1.0) and [e.label for e in ranked] == ["x", "y", "w"]


def test_tfidf_matches_the_formula(spark):
    df = spark.createDataFrame([(0, "aa bb aa"), (1, "aa cc"), (2, "zz")], "id int, text string")
    terms = features.with_terms(df, ngram_range=(1, 2))
    stats = {r.term: (r.tf, r.df) for r in features.term_statistics(terms).collect()}
    assert stats["aa"] == (3, 2) and stats["aa bb"] == (1, 1) and stats["zz"] == (1, 1) and len(stats) == 7
    vocab = features.with_idf(features.vocabulary(features.term_statistics(terms), 2, 10), df)
    assert rows(vocab, "term", "term_id") == [("aa", 0)]
    assert vocab.first().idf == pytest.approx(math.log(4 / 3) + 1)
    assert rows(features.tfidf(terms, vocab, "id", 10)) == [(0, "aa", 1.0), (1, "aa", 1.0)]


def test_ngram_lengths(spark):
    df = spark.createDataFrame([("one two three four",), ("one",), ("",)], "text string")
    got = [r[0] for r in features.with_terms(df, ngram_range=(2, 3)).select("terms").collect()]
    assert got == [["one two", "two three", "three four", "one two three", "two three four"], [], []]


def test_classifier_learns_and_survives_saving(spark, training, classifier, tmp_path):
    assert classifier.labels == ["anger", "fear", "joy"]
    predictions = classifier.predict(training, keep=["comment_id"])
    assert predictions.where("not is_correct").count() == 0
    classifier.save(str(tmp_path / "m"))
    again = TextClassifier.load(spark, str(tmp_path / "m"))
    assert rows(again.predict(training)) == rows(classifier.predict(training))
    total = classifier.probabilities(training).select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)).collect()
    assert all(r[0] == pytest.approx(1.0) for r in total)


def test_optimum_has_a_vanishing_gradient(training, classifier):
    """The penalised objective sum(w * loss) + |W|^2 / 2 has gradient zero at the fitted weights."""
    import numpy as np

    scored = classifier.model.transform(training).select("features", "probability", "label").collect()
    x = np.array([r.features.toArray() for r in scored])
    p = np.array([r.probability.toArray() for r in scored])
    y = np.array([[float(r.label == v) for v in classifier.labels] for r in scored])
    gradient = (p - y).T @ x + classifier.model.stages[-1].coefficientMatrix.toArray()
    assert np.abs(gradient).max() < 5e-2


def test_linear_table_agrees_with_the_model(spark, training, classifier):
    model, intercepts = classifier.weight_table(spark)
    terms = features.with_terms(training)
    table = linear.linear_scores(terms, model, classifier.labels, intercepts, "comment_id", 50)
    by_table = {r.comment_id: r.probabilities for r in table.collect()}
    for r in classifier.probabilities(training).collect():
        assert by_table[r.comment_id] == pytest.approx(r.probabilities)


def test_explanations(spark, classifier):
    df = spark.createDataFrame([(1, "happy smiling"), (2, "qq ww"), (3, "furious")], "comment_id long, text string")
    got = {r.comment_id: r for r in score.explain_comments(classifier, df).collect()}
    assert {e.feature for e in got[1].contributions} >= {"happy", "smiling"}
    scores = [e.score for e in got[1].contributions]
    assert scores == sorted(scores, reverse=True) and min(scores) > 0
    assert got[2].contributions == [] and got[2].contribution_lines == linear.NO_FEATURES
    assert got[3].contribution_lines.startswith("  - furious (")
    with pytest.raises(ValueError):
        linear.explain(df, df, ["a"], [0.0], "comment_id", 5, top_n=0)


@pytest.mark.parametrize("explained", [False, True])
def test_stream_equals_batch(spark, classifier, tmp_path, explained):
    data = [(1, "so happy today"), (2, "  "), (3, None), (4, "dark and scared"), (5, "unknownword")]
    df = spark.createDataFrame(data, "comment_id long, text string")
    for part in (df.where("comment_id < 3"), df.where("comment_id >= 3")):
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = score.comment_stream(spark, str(tmp_path / "in"))
    start = score.start_explained_scoring if explained else score.start_scoring
    start(classifier, stream, str(tmp_path / "out"), str(tmp_path / "log"), available_now=True).awaitTermination()
    batch = score.scored_batch(classifier, df) if explained else score.score_comments(classifier, df)
    columns = ["comment_id", "predicted_label", "top", "all_probabilities"] + (["contribution_lines"] if explained else [])
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert rows(streamed, *columns) == rows(batch, *columns)
    assert streamed.count() == 3


def test_metrics_by_source(spark):
    data = [("a", "joy", "joy"), ("a", "fear", "joy"), (None, "fear", "fear"), ("b", "anger", "fear")]
    df = spark.createDataFrame(data, "data_source string, true_label string, predicted_label string")
    got = {(r.source, r.label): r for r in metrics.per_source(df, "data_source", ["joy", "fear", "anger"]).collect()}
    assert len(got) == 4 * 3
    assert (got["a", "joy"].precision, got["a", "joy"].recall, got["a", "joy"].accuracy) == (0.5, 1.0, 0.5)
    assert (got["(none)", "fear"].f1, got["(none)", "joy"].support) == (1.0, 0)
    assert (got[None, "fear"].support, got[None, "fear"].precision, got[None, "anger"].accuracy) == (2, 0.5, 0.5)


def test_nested_report_holds_the_averages(spark):
    report = metrics.nested_report(pairs_of(spark, ["joy", "joy", "fear"], ["joy", "fear", "fear"])).first().classification_report
    assert set(report) == {"joy", "fear", "macro avg", "weighted avg"}
    assert report["macro avg"]["precision"] == 0.75 and report["weighted avg"]["support"] == 3


def test_judged_stream_holds_rejects_and_counts(spark, classifier, tmp_path):
    data = [(1, "so happy today"), (2, "  "), (3, None), (4, "dark and scared"), (5, "unknownword"), (6, "")]
    df = spark.createDataFrame(data, "comment_id long, text string")
    for part in (df.where("comment_id < 3"), df.where("comment_id >= 3")):
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    model, intercepts = classifier.weight_table(spark)
    given = (model, classifier.labels, intercepts, 50)
    stream = score.comment_stream(spark, str(tmp_path / "in"))
    query = score.start_judging(stream, *given, str(tmp_path / "out"), str(tmp_path / "log"), available_now=True)
    query.awaitTermination()
    batch = score.judge_comments(df, *given)
    columns = ["comment_id", "status", "predicted_label", "top", "all_probabilities", "contributions", "contribution_lines"]
    assert rows(spark.read.parquet(str(tmp_path / "out")), *columns) == rows(batch, *columns)
    assert spark.read.parquet(str(tmp_path / "out" / "status=rejected")).count() == 3
    assert score.counts_of(query) == {"input": 6, "scored": 3, "rejected": 3}
    assert "Exchange" not in batch._jdf.queryExecution().executedPlan().toString()
    by_model = {r.comment_id: r for r in score.score_comments(classifier, df).collect()}
    for r in batch.where("status = 'scored'").collect():
        assert (r.predicted_label, r.all_probabilities) == (by_model[r.comment_id].predicted_label, by_model[r.comment_id].all_probabilities)


def test_probes(spark, classifier):
    from labelloom.sources.readers import probe_table

    got = train.score_probes(classifier, probe_table(spark, {"Easy": ["so happy", "so scared"]})).orderBy("pos").collect()
    assert [r.predicted_label for r in got] == ["joy", "fear"] and len(got[0].top) == 3 and got[0].top[0].startswith("joy: ")


def test_error_analysis_bundle(spark, tmp_path):
    predictions = b.predictions(spark, DATA)
    analysis.write_error_analysis(predictions, str(tmp_path / "a"), "ord", 5)
    wrong = spark.read.csv(str(tmp_path / "a" / "wrong_examples"), header=True, multiLine=True, escape='"')
    twin = spark.read.csv(str(tmp_path / "a" / "misclassified_examples"), header=True, multiLine=True, escape='"')
    assert wrong.count() == 5 and rows(wrong) == rows(twin)
    assert spark.read.json(str(tmp_path / "a" / "top_confusions")).count() <= 5
    everything = analysis.error_analysis(predictions, "ord", None)
    assert everything.wrong.count() == predictions.where("not is_correct").count()


def test_ranks_follow_the_logits_where_probabilities_round_together(spark):
    from labelloom.operators import linear

    model = spark.createDataFrame([("good", 1.0, [0.3, 0.1])], "term string, idf double, coefs array<double>")
    table = spark.createDataFrame([(1, ["good"])], "id long, terms array<string>")
    row = linear.linear_scores(table, model, ["a", "b"], [0.0, 0.2], "id", 5).first()
    assert 0.1 + 0.2 > 0.3 and row.probabilities[0] == row.probabilities[1]
    assert row.predicted_label == "b" and [e.label for e in row.scored] == ["b", "a"]
    assert linear.explain(table, model, ["a", "b"], [0.0, 0.2], "id", 5).first().predicted_label == "b"


def test_training_caches_no_terms(spark, training, monkeypatch):
    """The n-grams of long texts, cached, ran executors out of memory; the regression keeps the only copy of its vectors."""
    monkeypatch.setattr(type(training), "persist", lambda *_: pytest.fail("a table is cached"))
    odd = spark.createDataFrame([(90, None, "joy"), (91, "  ", "fear"), (92, "!!", "anger")], training.schema)
    model = fit_text_classifier(training.unionByName(odd), FeatureSpec(min_df=1, max_features=50))
    assert model.labels == ["anger", "fear", "joy"] and "happy" in model.model.stages[1].vocabulary
