"""Queries: metrics, error analysis, features, scoring, training, near-duplicates and streaming."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.catalog import bindings as b
from labelloom.catalog.curation import SPLIT_SQL, pools, REGIONS
from labelloom.catalog.registry import query
from labelloom.config import LABELS, QualitySpec
from labelloom.functions.numeric import all_probabilities_line, argmax_label, ranked_labels, softmax, top_lines
from labelloom.functions.similarity import long_from, long_gram, short_gram
from labelloom.operators import candidates, features, linear, metrics, neardup, ranking, split
from labelloom.plans import analysis, curate, train
from labelloom.session import small_table, small_window, stored
from labelloom.sources import writers
from labelloom.streaming import score

PRED = f"WITH {b.SQL_PREDICTIONS}"
_GIVEN = ("anger", "fear", "joy", "neutral", "sadness", "surprise", "boredom")
_SQL_GIVEN = "given(label) AS (VALUES " + ", ".join(f"('{v}')" for v in _GIVEN) + ")"
_PER_CLASS = """
sides AS (
  SELECT true_label AS label, 1 AS support, 0 AS predicted, (true_label = predicted_label)::INT AS hits FROM predictions
  UNION ALL SELECT predicted_label, 0, 1, 0 FROM predictions),
sums AS (SELECT label, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM sides GROUP BY 1),
rated AS (SELECT label, coalesce(support, 0) AS support,
                 CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / predicted END AS precision,
                 CASE WHEN coalesce(support, 0) = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / support END AS recall
          FROM {labels} LEFT JOIN sums USING (label)),
classes AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1
            FROM rated)"""
GIVEN = f"{PRED}, {_SQL_GIVEN}, {_PER_CLASS.format(labels='given')}"
OBSERVED = f"""{PRED}, seen AS (SELECT DISTINCT unnest([true_label, predicted_label]) AS label FROM predictions),
{_PER_CLASS.format(labels='seen')}"""
_SUMMARY = """SELECT round_even((SELECT avg((true_label = predicted_label)::INT) FROM predictions), 9) AS accuracy,
  round_even(avg(precision), 9) AS macro_precision, round_even(avg(recall), 9) AS macro_recall,
  round_even(avg(f1), 9) AS macro_f1, round_even(sum(f1 * support) / sum(support), 9) AS weighted_f1 FROM classes"""


def _rounded(df: DataFrame, places: int = 9) -> DataFrame:
    """Float sums differ in the last bits between engines."""
    return df.select(
        *[F.bround(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.pair_counts(b.predictions(spark, sf))


# --- metrics -------------------------------------------------------------------------------------

@query("prediction_table", f"{PRED} SELECT ord, text, true_label, predicted_label, confidence, is_correct FROM predictions")
def prediction_table(spark: SparkSession, sf: str) -> DataFrame:
    return b.predictions(spark, sf)


@query("observed_labels", f"{PRED} SELECT DISTINCT unnest([true_label, predicted_label]) AS label FROM predictions")
def observed_labels(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.observed_labels(b.predictions(spark, sf))


@query("accuracy", f"{PRED} SELECT avg((true_label = predicted_label)::INT) AS accuracy FROM predictions")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.accuracy(b.predictions(spark, sf))


@query("per_class_metrics", f"""{GIVEN}
SELECT label, round_even(precision, 9) AS precision, round_even(recall, 9) AS recall, round_even(f1, 9) AS f1, support FROM classes""")
def per_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.per_class(_pairs(spark, sf), _GIVEN))


@query("metrics_by_source", f"""{PRED}, {b.SQL_LABELS},
paired AS (SELECT prep.source_label AS source, true_label, predicted_label FROM predictions JOIN prep USING (ord)
  UNION ALL SELECT NULL, true_label, predicted_label FROM predictions),
sources AS (SELECT DISTINCT source FROM paired),
counted AS (SELECT s.source, d.label,
    count(*) FILTER (p.true_label = d.label) AS support, count(*) FILTER (p.predicted_label = d.label) AS predicted,
    count(*) FILTER (p.true_label = d.label AND p.predicted_label = d.label) AS hits,
    avg((p.true_label = p.predicted_label)::INT) AS accuracy
  FROM sources s CROSS JOIN dim d JOIN paired p ON p.source IS NOT DISTINCT FROM s.source GROUP BY 1, 2),
shares AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE hits::DOUBLE / predicted END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE hits::DOUBLE / support END AS recall FROM counted)
SELECT source, label, round_even(precision, 9) AS precision, round_even(recall, 9) AS recall,
  round_even(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 9) AS f1,
  support, round_even(accuracy, 9) AS accuracy FROM shares""")
def metrics_by_source(spark: SparkSession, sf: str) -> DataFrame:
    named = b.predictions(spark, sf).join(b.prepared(spark, sf).select("ord", "source_label"), "ord")
    return _rounded(metrics.per_source(named, "source_label", LABELS))


@query("saved_headlines", f"""{GIVEN}, one AS ({_SUMMARY.strip()})
SELECT metric, value FROM (SELECT accuracy, macro_precision, macro_recall, macro_f1, weighted_f1,
  0.0::DOUBLE AS validation_macro_f1 FROM one)
UNPIVOT (value FOR metric IN (accuracy, macro_precision, macro_recall, macro_f1, weighted_f1, validation_macro_f1))""")
def saved_headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Headlines of a report that was written and read back; it has no validation part, which reads 0."""
    folder = b.scratch(spark, "metrics")
    writers.write_report(metrics.nested_report(_pairs(spark, sf), _GIVEN), folder)
    return _rounded(train.headline_metrics(spark, folder))


@query("metrics_summary_given_labels", f"{GIVEN} {_SUMMARY}")
def metrics_summary_given_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.summary(_pairs(spark, sf), _GIVEN))


@query("metrics_summary_observed_labels", f"{OBSERVED} {_SUMMARY}")
def metrics_summary_observed_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.summary(_pairs(spark, sf)))


@query("metrics_report", f"""{GIVEN},
report AS (
  SELECT 'class' AS scope, label, precision, recall, f1, support FROM classes
  UNION ALL SELECT 'macro avg', NULL, avg(precision), avg(recall), avg(f1), sum(support) FROM classes
  UNION ALL SELECT 'weighted avg', NULL, sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM classes
  UNION ALL SELECT 'accuracy', NULL, NULL, NULL, avg((true_label = predicted_label)::INT), count(*) FROM predictions)
SELECT scope, label, round_even(precision, 9) AS precision, round_even(recall, 9) AS recall, round_even(f1, 9) AS f1, support FROM report""")
def metrics_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.report_table(_pairs(spark, sf), _GIVEN))


@query("confusion_grid", f"""{PRED}, {_SQL_GIVEN}
SELECT t.label AS true_label, p.label AS predicted_label,
       (SELECT count(*) FROM predictions x WHERE x.true_label = t.label AND x.predicted_label = p.label) AS n
FROM given t, given p""")
def confusion_grid(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_grid(_pairs(spark, sf), _GIVEN)


@query("confusion_matrix", f"""{PRED}
SELECT true_label, {", ".join(f"count(*) FILTER (predicted_label = '{v}') AS {v}" for v in LABELS)} FROM predictions GROUP BY 1""")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_pairs(spark, sf), LABELS)


_CONFUSIONS = f"""{PRED},
g AS (SELECT true_label, predicted_label, count(*) AS count,
            sum(round(confidence * 10000)::BIGINT) / count(*) AS m FROM predictions WHERE NOT is_correct GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY count DESC, m DESC, true_label, predicted_label) AS rank,
       true_label, predicted_label, count, round_even(m, 0) / 10000 AS average_confidence FROM g"""


@query("top_confusions", f"{_CONFUSIONS} QUALIFY rank <= 20")
def top_confusions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.top_confusions(b.predictions(spark, sf), 20)


@query("all_confusions", _CONFUSIONS)
def all_confusions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.top_confusions(b.predictions(spark, sf))


@query("error_analysis_examples", f"""{PRED}
SELECT 'correct' AS view, ord, text, true_label, predicted_label, confidence FROM (
  SELECT * FROM predictions WHERE is_correct ORDER BY confidence DESC, ord LIMIT 20)
UNION ALL
SELECT 'wrong', ord, text, true_label, predicted_label, confidence FROM (
  SELECT * FROM predictions WHERE NOT is_correct ORDER BY confidence DESC, ord LIMIT 20)""")
def error_analysis_examples(spark: SparkSession, sf: str) -> DataFrame:
    report = analysis.error_analysis(b.predictions(spark, sf), "ord", 20)
    columns = ["ord", "text", "true_label", "predicted_label", "confidence"]
    return report.correct.select(F.lit("correct").alias("view"), *columns).union(
        report.wrong.select(F.lit("wrong"), *columns)
    )


@query("error_analysis_confusion", f"""{PRED},
seen AS (SELECT DISTINCT unnest([true_label, predicted_label]) AS label FROM predictions)
SELECT t.label AS true_label, p.label AS predicted_label, count(x.ord) AS n
FROM seen t CROSS JOIN seen p LEFT JOIN predictions x ON x.true_label = t.label AND x.predicted_label = p.label GROUP BY 1, 2""")
def error_analysis_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.error_analysis(b.predictions(spark, sf), "ord", 20).confusion


@query("misclassified_by_confidence", f"""{PRED}
SELECT ord, true_label, predicted_label, confidence FROM predictions WHERE NOT is_correct ORDER BY confidence DESC, ord""")
def misclassified_by_confidence(spark: SparkSession, sf: str) -> DataFrame:
    wrong = analysis.error_analysis(b.predictions(spark, sf), "ord", None).wrong
    return wrong.select("ord", "true_label", "predicted_label", "confidence")


@query("before_after_comparison", f"""{PRED},
sides AS (
  SELECT run, label, sum(s) AS support, sum(p) AS predicted, sum(h) AS hits FROM (
    SELECT unnest(['before', 'after']) AS run, true_label AS label, 1 AS s, 0 AS p,
           unnest([(true_label = 'joy')::INT, is_correct::INT]) AS h FROM predictions
    UNION ALL SELECT 'after', predicted_label, 0, 1, 0 FROM predictions
    UNION ALL SELECT 'before', 'joy', 0, 1, 0 FROM predictions) GROUP BY 1, 2),
f AS (SELECT run, label, CASE WHEN coalesce(hits, 0) = 0 THEN 0.0::DOUBLE
      ELSE 2 * (hits::DOUBLE / predicted) * (hits::DOUBLE / support) / (hits::DOUBLE / predicted + hits::DOUBLE / support) END AS f1 FROM sides),
{b.SQL_LABELS}
SELECT d.label, round_even(coalesce(x.f1, 0), 9) AS before_f1, round_even(coalesce(y.f1, 0), 9) AS after_f1,
       round_even(coalesce(y.f1, 0) - coalesce(x.f1, 0), 4) AS delta
FROM dim d LEFT JOIN f x ON x.label = d.label AND x.run = 'before' LEFT JOIN f y ON y.label = d.label AND y.run = 'after'""")
def before_after_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Before: everything was called joy."""
    table = b.predictions(spark, sf)
    before = metrics.per_class(metrics.pair_counts(table.withColumn("predicted_label", F.lit("joy"))))
    after = metrics.per_class(metrics.pair_counts(table))
    return _rounded(metrics.compare_runs(before, after, LABELS))


@query("headline_comparison", f"""{OBSERVED},
after AS ({_SUMMARY}),
n AS (SELECT count(*) FILTER (true_label = 'joy')::DOUBLE AS joy, count(*)::DOUBLE AS n, count(DISTINCT true_label) AS k FROM predictions)
SELECT 'accuracy' AS metric, round_even(joy / n, 9) AS before, accuracy AS after FROM n, after
UNION ALL SELECT 'macro_f1', round_even(2 * joy / (n + joy) / k, 9), macro_f1 FROM n, after
UNION ALL SELECT 'weighted_f1', round_even(2 * joy / (n + joy) * joy / n, 9), weighted_f1 FROM n, after""")
def headline_comparison(spark: SparkSession, sf: str) -> DataFrame:
    table = b.predictions(spark, sf)
    before = metrics.summary(metrics.pair_counts(table.withColumn("predicted_label", F.lit("joy"))))
    return _rounded(metrics.compare_headlines(before, metrics.summary(metrics.pair_counts(table))))


# --- logits --------------------------------------------------------------------------------------

_SOFT = f"""WITH {b.SQL_LOGITS},
shifted AS (SELECT *, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM logits),
soft AS (SELECT vec_id, label, logits, list_transform(e, lambda x: x / list_sum(e)) AS p FROM shifted),
flat AS (SELECT vec_id, label, unnest({b.SQL_LABEL_LIST}) AS class, unnest(p) AS score, generate_subscripts(p, 1) AS i FROM soft)"""


@query("softmax_probabilities", f"{_SOFT} SELECT vec_id, class, round_even(score, 9) AS score FROM flat")
def softmax_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(v) for v in LABELS])
    rows = b.logits(spark, sf).withColumn("p", softmax(F.col("logits")))
    zipped = rows.select("vec_id", F.explode(F.arrays_zip(names.alias("class"), F.col("p").alias("score"))).alias("z"))
    return _rounded(zipped.select("vec_id", F.col("z.class").alias("class"), F.col("z.score").alias("score")))


@query("argmax_labels", f"SELECT vec_id, ({b.SQL_LABEL_LIST})[list_position({b.SQL_CLASS_LOGITS}, list_max({b.SQL_CLASS_LOGITS}))] AS predicted_label FROM embeddings")
def argmax_labels(spark: SparkSession, sf: str) -> DataFrame:
    return b.logits(spark, sf).select("vec_id", argmax_label(F.col("logits"), LABELS).alias("predicted_label"))


_RANKED = f"{_SOFT}, ranked AS (SELECT vec_id, class, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, i) AS rank FROM flat)"


@query("ranked_labels", f"{_RANKED} SELECT vec_id, rank, class AS label, round_even(score, 9) AS score FROM ranked WHERE rank <= 3")
def ranked(spark: SparkSession, sf: str) -> DataFrame:
    scored = ranked_labels(softmax(F.col("logits")), LABELS)
    rows = b.logits(spark, sf).select("vec_id", F.posexplode(F.slice(scored, 1, 3)).alias("i", "e"))
    return _rounded(rows.select("vec_id", (F.col("i") + 1).alias("rank"), F.col("e.label").alias("label"), F.col("e.score").alias("score")))


@query("display_lines", f"""{_RANKED}
SELECT vec_id,
  string_agg(CASE WHEN rank = 1 THEN '->' ELSE '  ' END || ' Top ' || rank || ': ' || class || printf(' (%.2f%%)', score * 100), chr(10) ORDER BY rank)
    FILTER (rank <= 3) AS top,
  string_agg(class || printf(': %.2f%%', score * 100), ' | ' ORDER BY rank) AS all_probabilities
FROM ranked GROUP BY 1""")
def display_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.logits(spark, sf).withColumn("scored", ranked_labels(softmax(F.col("logits")), LABELS))
    return rows.select("vec_id", top_lines(F.col("scored")).alias("top"), all_probabilities_line(F.col("scored")).alias("all_probabilities"))


@query("logit_predictions", f"""{_RANKED}
SELECT vec_id, label AS true_label, class AS predicted_label, round_even(score, 4) AS confidence, label = class AS is_correct
FROM ranked JOIN logits USING (vec_id) WHERE rank = 1""")
def logit_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.predictions_from_logits(b.logits(spark, sf), LABELS, keep=["vec_id"]).drop("probabilities")


@query("logit_label_scores", f"{_SOFT} SELECT vec_id, class AS label, round_even(score, 9) AS score FROM flat")
def logit_label_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = analysis.labelled_probabilities(b.logits(spark, sf), LABELS)
    return _rounded(scored.select("vec_id", F.explode("label_scores").alias("label", "score")))


@query("logit_metrics", f"""{_RANKED},
predictions AS (SELECT label AS true_label, class AS predicted_label FROM ranked JOIN logits USING (vec_id) WHERE rank = 1),
seen AS (SELECT DISTINCT unnest([true_label, predicted_label]) AS label FROM predictions),
{_PER_CLASS.format(labels='seen')} {_SUMMARY}""")
def logit_metrics(spark: SparkSession, sf: str) -> DataFrame:
    table = analysis.predictions_from_logits(b.logits(spark, sf), LABELS)
    return _rounded(metrics.summary(metrics.pair_counts(table)))


@query("weighted_log_loss", f"""{_SOFT},
w AS (SELECT label, sum(count(*)) OVER () / (6 * count(*)) AS weight FROM logits GROUP BY 1)
SELECT round_even(sum(-ln(score) * weight) / sum(weight), 9) AS log_loss FROM flat JOIN w USING (label) WHERE class = label""")
def weighted_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    from labelloom.operators.distribution import attach_weights, count_by
    
    rows = b.logits(spark, sf)
    total = F.sum("count").over(small_window())
    weights = count_by(rows, "label").withColumn("weight", total / (F.lit(len(LABELS)) * F.col("count")))
    names = F.array(*[F.lit(v) for v in LABELS])
    p_true = F.element_at(softmax(F.col("logits")), F.array_position(names, F.col("label")).cast("int"))
    scored = attach_weights(rows.withColumn("p_true", p_true), weights, len(LABELS))
    return _rounded(metrics.log_loss(scored, F.col("weight")))


# --- features ------------------------------------------------------------------------------------

_TERMS = f"""
words AS (SELECT doc_id, regexp_extract_all({b.sql_clean('text')}, '[a-z0-9]{{2,}}') AS w FROM documents),
terms AS (SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS terms FROM words),
hits AS (SELECT doc_id, unnest(terms) AS term FROM terms),
stats AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM hits GROUP BY 1),
top AS (SELECT * FROM stats WHERE df >= 2 ORDER BY tf DESC, term LIMIT 5000),
vocab AS (SELECT term, tf, df, row_number() OVER (ORDER BY term) - 1 AS term_id,
                 ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1 AS idf FROM top),
raw AS (SELECT doc_id, term, count(*) * any_value(idf) AS raw FROM hits JOIN vocab USING (term) GROUP BY 1, 2),
tfidf AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    return features.with_terms(b.read_text(spark, sf, "documents", "doc_id", "text")).drop("text")


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _terms(spark, sf)
    return features.with_idf(features.vocabulary(features.term_statistics(rows)), b.read(spark, sf, "documents"))


@query("tokens", f"WITH {_TERMS} SELECT doc_id, array_to_string(w, ' ') AS tokens FROM words")
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    only = features.with_terms(b.read_text(spark, sf, "documents", "doc_id", "text"), ngram_range=(1, 1))
    return only.select("doc_id", F.array_join("terms", " ").alias("tokens"))


@query("ngram_terms", f"WITH {_TERMS} SELECT doc_id, len(terms) AS n_terms, md5(array_to_string(terms, '|')) AS digest FROM terms")
def ngram_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf).select("doc_id", F.size("terms").alias("n_terms"), F.md5(F.array_join("terms", "|")).alias("digest"))


@query("term_statistics", f"WITH {_TERMS} SELECT term, tf, df FROM stats")
def term_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return features.term_statistics(_terms(spark, sf))


@query("vocabulary", f"WITH {_TERMS} SELECT term, tf, df, term_id, round_even(idf, 9) AS idf FROM vocab")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_vocabulary(spark, sf))


@query("tfidf_weights", f"WITH {_TERMS} SELECT doc_id, term, round_even(weight, 9) AS weight FROM tfidf")
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(features.tfidf(_terms(spark, sf), _vocabulary(spark, sf), "doc_id", 5000))


# A made-up linear model over the vocabulary, so that SQL can repeat scoring and explaining.
_SCORES = f"""WITH {_TERMS},
coefs AS (SELECT term, i, label, (('0x' || substr(md5(i || ':' || term), 1, 4))::INT % 2001 - 1000) / 1000.0::DOUBLE AS coef
  FROM vocab, (SELECT unnest(range(6)) AS i, unnest({b.SQL_LABEL_LIST}) AS label)),
z AS (SELECT doc_id, i, label, coalesce(sum(weight * coef), 0) + i / 10.0::DOUBLE AS z
  FROM documents CROSS JOIN (SELECT unnest(range(6)) AS i, unnest({b.SQL_LABEL_LIST}) AS label)
  LEFT JOIN tfidf USING (doc_id) LEFT JOIN coefs USING (term, i, label) GROUP BY 1, 2, 3),
scored AS (SELECT doc_id, i, label, exp(z - max(z) OVER d) / sum(exp(z)) OVER d * exp(max(z) OVER d) AS score,
  row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, i) AS rank FROM z WINDOW d AS (PARTITION BY doc_id))"""


def _linear_model(spark: SparkSession, sf: str) -> DataFrame:
    def coef(i: int):
        return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{i}:"), "term")), 1, 4), 16, 10).cast("int") % 2001 - 1000) / F.lit(1000.0)

    return _vocabulary(spark, sf).select("term", "idf", F.array(*[coef(i) for i in range(6)]).alias("coefs"))


_INTERCEPTS = [i / 10.0 for i in range(6)]


@query("linear_scores", f"{_SCORES} SELECT doc_id, rank, label, round_even(score, 9) AS score FROM scored")
def linear_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = linear.linear_scores(_terms(spark, sf), _linear_model(spark, sf), LABELS, _INTERCEPTS, "doc_id", 5000)
    rows = scored.select("doc_id", F.posexplode("scored").alias("i", "e"))
    return _rounded(rows.select("doc_id", (F.col("i") + 1).alias("rank"), F.col("e.label").alias("label"), F.col("e.score").alias("score")))


_EXPLAINED = f"""{_SCORES},
best AS (SELECT doc_id, i, label FROM scored WHERE rank = 1),
parts AS (SELECT doc_id, term, weight * coef AS score, row_number() OVER (PARTITION BY doc_id ORDER BY weight * coef DESC, term) AS pos
  FROM best JOIN tfidf USING (doc_id) JOIN coefs USING (term, i) WHERE weight * coef > 0 QUALIFY pos <= 5)"""


@query("explain_predictions", f"""{_EXPLAINED}
SELECT doc_id, best.label AS predicted_label, pos, term AS feature, round_even(score, 9) AS score FROM best LEFT JOIN parts USING (doc_id)""")
def explain_predictions(spark: SparkSession, sf: str) -> DataFrame:
    explained = linear.explain(_terms(spark, sf), _linear_model(spark, sf), LABELS, _INTERCEPTS, "doc_id", 5000)
    rows = explained.select("doc_id", "predicted_label", F.posexplode_outer("contributions").alias("i", "e"))
    return _rounded(rows.select(
        "doc_id", "predicted_label", (F.col("i") + 1).alias("pos"), F.col("e.feature").alias("feature"), F.col("e.score").alias("score")
    ))


@query("contribution_lines", f"""{_EXPLAINED}
SELECT doc_id, coalesce(string_agg(printf('  - %s (%.4f)', term, score), chr(10) ORDER BY pos),
  '  No strong positive feature contributions were found.') AS lines FROM best LEFT JOIN parts USING (doc_id) GROUP BY 1""")
def contribution_lines(spark: SparkSession, sf: str) -> DataFrame:
    explained = linear.explain(_terms(spark, sf), _linear_model(spark, sf), LABELS, _INTERCEPTS, "doc_id", 5000)
    return explained.select("doc_id", linear.contribution_lines(F.col("contributions")).alias("lines"))


# --- training and scoring with Spark ML ----------------------------------------------------------

@query("train_and_evaluate")
def train_and_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    result = b.fitted(spark, sf)
    return result.metrics().withColumn("part", F.lit("test")).unionByName(
        result.metrics("validation").withColumn("part", F.lit("validation"))
    )


@query("model_predictions")
def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return b.fitted(spark, sf).predictions


@query("held_out_rows", f"{SPLIT_SQL} SELECT ord, split, label AS true_label FROM tagged WHERE split <> 'train'")
def held_out_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows a later run rebuilds from key and seed for its error analysis."""
    tagged = split.assign_split(b.prepared(spark, sf), split.SplitSpec(), "ord")
    return tagged.where("split <> 'train'").select("ord", "split", F.col("label").alias("true_label"))


@query("score_probes")
def score_probes(spark: SparkSession, sf: str) -> DataFrame:
    probes = b.read(spark, sf, "benchmark").select(F.lit("benchmark").alias("group"), F.col("item_id").alias("pos"), "text")
    return train.score_probes(b.fitted(spark, sf).classifier, probes)


@query("stream_scoring")
def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as a file stream, scored to the end of the available input."""
    model = b.fitted(spark, sf).classifier
    folder = b.scratch(spark, "stream")
    b.turns(spark, sf).select(F.col("ord").alias("comment_id"), "text").write.json(f"{folder}/in")
    comments = score.comment_stream(spark, f"{folder}/in")
    score.start_scoring(model, comments, f"{folder}/out", f"{folder}/log", available_now=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _judged_stream(spark: SparkSession, sf: str):
    """All documents as a file stream, judged by the linear model; the finished query and its output folder."""
    folder = b.scratch(spark, "judged")
    b.read(spark, sf, "documents").select(F.col("doc_id").alias("comment_id"), "text").write.json(f"{folder}/in")
    comments = score.comment_stream(spark, f"{folder}/in")
    model = _linear_model(spark, sf)
    running = score.start_judging(comments, model, LABELS, _INTERCEPTS, 5000, f"{folder}/out", f"{folder}/log", available_now=True)
    running.awaitTermination()
    return running, f"{folder}/out"


_FILLED = f"text IS NOT NULL AND {b.sql_strip('text')} <> ''"


@query("stream_explanations", f"""{_EXPLAINED}
SELECT doc_id AS comment_id, 'scored' AS status, best.label AS predicted_label, pos, term AS feature, round_even(score, 9) AS score
FROM best JOIN (SELECT doc_id FROM documents WHERE {_FILLED}) USING (doc_id) LEFT JOIN parts USING (doc_id)
UNION ALL SELECT doc_id, 'rejected', NULL, NULL, NULL, NULL FROM documents WHERE NOT coalesce({_FILLED}, FALSE)""")
def stream_explanations(spark: SparkSession, sf: str) -> DataFrame:
    """Label and contributions of every streamed document, blank ones as rejects, read back from the sink."""
    _, folder = _judged_stream(spark, sf)
    found = spark.read.parquet(folder).select("comment_id", "status", "predicted_label", F.posexplode_outer("contributions").alias("i", "e"))
    return _rounded(found.select(
        "comment_id", "status", "predicted_label", (F.col("i") + 1).alias("pos"),
        F.col("e.feature").alias("feature"), F.col("e.score").alias("score"),
    ))


@query("stream_counts", f"""
SELECT counter, n FROM (SELECT count(*) AS input, count(*) FILTER ({_FILLED}) AS scored,
  count(*) - count(*) FILTER ({_FILLED}) AS rejected FROM documents) UNPIVOT (n FOR counter IN (input, scored, rejected))""")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the streaming job counted of its own rows."""
    running, _ = _judged_stream(spark, sf)
    counts = score.counts_of(running)
    return small_table(spark, {"counter": list(counts), "n": list(counts.values())}, {"n": pa.int64()})


# --- near-duplicates -----------------------------------------------------------------------------

def _near_rows(spark: SparkSession, sf: str) -> DataFrame:
    return curate.exact_unique(curate.normalized(b.turns(spark, sf)).drop("text"), QualitySpec().min_words)


def _sql_candidates(source: str, threshold: float = 0.9) -> str:
    """Pairs within the length bound that share as many numbered q-grams as the ratio needs."""
    border, long, short = long_from(threshold), long_gram(threshold), short_gram(threshold)
    return f"""
WITH base AS (SELECT label, ord, {b.sql_normal('text')} AS t FROM ({source})),
u AS (SELECT label, t, min(ord) AS ord, length(t) AS n FROM base WHERE len(string_split(t, ' ')) >= {QualitySpec().min_words} GROUP BY label, t),
s AS (SELECT * FROM u, (VALUES ({long}), ({short})) AS v(q)
      WHERE (q = {long} AND n >= {border}) OR (q = {short} AND n * {threshold} < {border} * (2 - {threshold}))),
p AS (SELECT label, ord, n, q, substr(t, i, q) AS gram FROM (SELECT *, unnest(range(1, n - q + 2)) AS i FROM s)),
g AS (SELECT *, row_number() OVER (PARTITION BY ord, q, gram) AS k FROM p)
SELECT y.ord AS later, x.ord AS earlier
FROM g y JOIN g x ON y.label = x.label AND y.q = x.q AND y.gram = x.gram AND y.k = x.k AND x.ord < y.ord
  AND 2 * least(x.n, y.n) >= {threshold} * (x.n + y.n) - 1e-9 AND y.q = CASE WHEN least(x.n, y.n) >= {border} THEN {long} ELSE {short} END
GROUP BY y.ord, x.ord
HAVING count(*) >= any_value(((2 * y.q - 1) * {threshold} / 2 - (y.q - 1)) * (x.n + y.n) - (y.q - 1)) - 1e-9"""


def _near_documents(spark: SparkSession, sf: str, label: str) -> DataFrame:
    docs = b.read(spark, sf, "documents").select("text", F.col(label).alias("label"), F.col("doc_id").alias("ord"))
    return curate.exact_unique(curate.normalized(docs).drop("text"), QualitySpec().min_words)


@query("near_duplicate_document_candidates", _sql_candidates(b.SQL_DOCUMENTS))
def near_duplicate_document_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.candidate_pairs(stored(neardup.profile(_near_documents(spark, sf, "source"), 0.9)), 0.9)


@query("near_duplicate_documents")
def near_duplicate_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that copy an earlier one of their language. The matcher's ratio has no SQL form; tests scan in order."""
    return neardup.near_duplicates(_near_documents(spark, sf, "lang"), 0.9)


@query("near_duplicate_candidates", _sql_candidates(b.SQL_TURNS))
def near_duplicate_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """All turns: q follows from the threshold, 4 at 0.9 and 2 for short texts."""
    return neardup.candidate_pairs(stored(neardup.profile(_near_rows(spark, sf), 0.9)), 0.9)


@query("near_duplicate_rows")
def near_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(_near_rows(spark, sf), 0.9)


@query("quality_control")
def quality_control(spark: SparkSession, sf: str) -> DataFrame:
    return curate.quality_control(b.turns(spark, sf), labels=("user", "assistant", "system")).kept


@query("quality_stats")
def quality_stats(spark: SparkSession, sf: str) -> DataFrame:
    return curate.quality_control(b.turns(spark, sf), labels=("user", "assistant", "system")).stats


@query("curated_dataset")
def curated_dataset(spark: SparkSession, sf: str) -> DataFrame:
    made = candidates.build_candidates(*pools(spark, sf), 240, b.SEED, REGIONS)
    return curate.quality_control(made, labels=REGIONS).kept


@query("sorted_confident_predictions", f"{PRED} SELECT ord, confidence FROM predictions ORDER BY confidence DESC, ord LIMIT 20")
def sorted_confident_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_by_confidence(b.predictions(spark, sf).select("ord", "confidence"), 20, "ord")
