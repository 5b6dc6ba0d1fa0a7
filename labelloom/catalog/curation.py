"""Queries: reading, checking, mapping, cleaning, counting, merging and splitting labelled text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from labelloom.catalog import bindings as b
from labelloom.catalog.registry import query
from labelloom.config import FOCUS_LABELS, LABELS, NA_TOKENS, QualitySpec, SplitSpec
from labelloom.functions import text as t
from labelloom.functions.numeric import percent_text
from labelloom.operators import annotations, candidates, checks, dedup, distribution, mapping, ranking, rows, split
from labelloom.plans import curate, merge, prepare
from labelloom.session import label_table, small_window
from labelloom.sources import readers, writers

WIDE = ("quality", "toxic")
PREP = f"WITH {b.SQL_PREP}"


# --- sources and sinks ---------------------------------------------------------------------------

@query("csv_round_trip", f"""{PREP}
SELECT ord, text, label FROM prep
WHERE text NOT IN ({", ".join(f"'{v}'" for v in NA_TOKENS)})""")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = b.scratch(spark, "prepared-csv")
    writers.write_table(b.prepared(spark, sf).select("ord", "text", "label"), folder, "csv")
    back = readers.read_csv(spark, prepare.output_parts(spark, folder))
    return back.where("text is not null").withColumn("ord", F.col("ord").cast("long"))


@query("json_report_round_trip", f"""{PREP}
SELECT count(*) AS input_rows,
       count(mapped_label) AS mapped_rows,
       count(drop_reason) AS dropped_rows,
       round_even(count(drop_reason) / count(*) * 100, 2) AS dropped_percentage
FROM prep_annotated""")
def json_report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = b.scratch(spark, "audit")
    counts = mapping.label_counts(b.annotated(spark, sf))
    writers.write_report(mapping.mapping_audit(counts, b.DOCUMENT_MAPPING), folder)
    return readers.read_report(spark, folder).select("input_rows", "mapped_rows", "dropped_rows", "dropped_percentage")


@query("label_dictionary", "SELECT event_type AS label, row_number() OVER (ORDER BY event_type) - 1 AS label_id "
       "FROM (SELECT DISTINCT event_type FROM events)")
def label_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    folder = b.scratch(spark, "labels")
    names = [r[0] for r in b.read(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]
    writers.write_labels(spark, names, folder)
    return readers.read_labels(spark, folder).withColumn("label_id", F.col("label_id").cast("long"))


@query("sentence_file", f"""
SELECT "text", count(*) AS lines FROM (
  SELECT {b.sql_strip('line')} AS "text"
  FROM (SELECT unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM documents))
WHERE "text" <> '' GROUP BY 1""")
def sentence_file(spark: SparkSession, sf: str) -> DataFrame:
    folder = b.scratch(spark, "sentences")
    b.read(spark, sf, "documents").select("text").write.text(folder)
    return readers.read_sentences(spark, folder).groupBy("text").agg(F.count("*").alias("lines"))


@query("example_report_blocks", f"""{PREP}, {b.SQL_LABELS},
firsts AS (SELECT label, text, row_number() OVER (PARTITION BY label ORDER BY ord) AS pos FROM prep QUALIFY pos <= 10)
SELECT d.label_id AS pos, '[' || d.label || ']' || chr(10) ||
  coalesce(string_agg('  ' || f.pos || '. ' || f.text, chr(10) ORDER BY f.pos), '  (no examples available)') AS block
FROM dim d LEFT JOIN firsts f USING (label) GROUP BY d.label_id, d.label""")
def example_report_blocks(spark: SparkSession, sf: str) -> DataFrame:
    picked = ranking.examples_per_class(b.prepared(spark, sf), 10, "ord").where("pos is not null")
    return writers.report_lines(picked, LABELS)


# --- filters and checks --------------------------------------------------------------------------

@query("drop_invalid_rows", f"""
SELECT ord, {b.sql_strip('text')} AS text, {b.sql_fold('label')} AS label
FROM (SELECT d.doc_id AS ord, d.text, l.quality::VARCHAR AS label FROM documents d LEFT JOIN labels l USING (doc_id))
WHERE text IS NOT NULL AND label IS NOT NULL AND {b.sql_strip('text')} <> '' AND {b.sql_strip('label')} <> ''""")
def drop_invalid_rows(spark: SparkSession, sf: str) -> DataFrame:
    wide = b.wide_flags(spark, sf)
    return rows.drop_invalid_rows(
        wide.select(F.col("doc_id").alias("ord"), "text", F.col("quality").cast("string").alias("label"))
    )


@query("valid_text_predicate", f"""
SELECT page_id, html IS NOT NULL AND {b.sql_strip("coalesce(html, '')")} <> '' AS valid FROM pages""")
def valid_text_predicate(spark: SparkSession, sf: str) -> DataFrame:
    return b.read(spark, sf, "pages").select("page_id", t.has_text(F.col("html")).alias("valid"))


@query("missing_value_tokens", f"""
SELECT event_id, CASE WHEN v IN ({", ".join(f"'{v}'" for v in NA_TOKENS)}) THEN NULL ELSE v END AS value_text
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'None' ELSE event_type END AS v FROM events)""")
def missing_value_tokens(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit("None")).otherwise(F.col("event_type"))
    return b.read(spark, sf, "events").select("event_id", t.null_tokens(value, NA_TOKENS).alias("value_text"))


@query("single_label_rows", f"""
SELECT DISTINCT {b.sql_strip("coalesce(d.text, 'nan')")} AS text,
       CASE WHEN l.quality = 1 THEN 'quality' ELSE 'toxic' END AS label
FROM documents d JOIN labels l USING (doc_id)
WHERE coalesce(l.quality, 0) + coalesce(l.toxic, 0) = 1 AND {b.sql_strip("coalesce(d.text, 'nan')")} <> ''""")
def single_label_rows(spark: SparkSession, sf: str) -> DataFrame:
    return annotations.single_label_rows(b.wide_flags(spark, sf), WIDE)


@query("multi_label_rows", f"""
SELECT text, label, count(*) AS n FROM (
  SELECT {b.sql_strip("coalesce(d.text, 'nan')")} AS text, unnest(['quality', 'toxic']) AS label,
         unnest([l.quality, l.toxic]) AS flag
  FROM documents d JOIN labels l USING (doc_id))
WHERE flag = 1 AND text <> '' GROUP BY 1, 2""")
def multi_label_rows(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.count_by(annotations.label_rows(b.wide_flags(spark, sf), WIDE), "text", "label").withColumnRenamed(
        "count", "n"
    )


@query("minimum_word_filter", f"""
SELECT doc_id, len(string_split({b.sql_normal('text')}, ' ')) AS words FROM documents
WHERE {b.sql_normal('text')} <> '' AND len(string_split({b.sql_normal('text')}, ' ')) >= 5""")
def minimum_word_filter(spark: SparkSession, sf: str) -> DataFrame:
    base = curate.normalized(b.read_text(spark, sf, "documents", "doc_id", "text"))
    kept = rows.long_enough(base, QualitySpec().min_words)
    return kept.select("doc_id", t.word_count(F.col("normalized_text")).alias("words"))


@query("unsupported_labels", "SELECT DISTINCT role AS label FROM conversations WHERE role NOT IN ('user', 'assistant')")
def unsupported_labels(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unsupported_labels(b.turns(spark, sf), "label", ["user", "assistant"])


@query("label_variety", "SELECT count(DISTINCT source) AS labels, count(DISTINCT source) >= 2 AS enough FROM documents")
def label_variety(spark: SparkSession, sf: str) -> DataFrame:
    return checks.label_variety(b.documents(spark, sf), "label")


@query("small_classes", """
WITH words AS (SELECT unnest(string_split(text, ' ')) AS label FROM benchmark)
SELECT label, count(*) AS count FROM words GROUP BY 1 HAVING count(*) < 3""")
def small_classes(spark: SparkSession, sf: str) -> DataFrame:
    words = b.read(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("label"))
    return checks.small_classes(words, "label", SplitSpec().min_rows_per_label)


_RULES = """
SELECT DISTINCT source AS source_label,
       CASE WHEN lang = 'en' THEN 'joy' WHEN lang = 'fr' THEN 'amusement' END AS target_label,
       CASE WHEN lang IN ('en', 'fr') THEN 'accept' ELSE 'drop' END AS action
FROM documents"""


@query("mapping_conflicts", f"""
WITH rules AS ({_RULES})
SELECT DISTINCT 'unsupported_target' AS problem, target_label AS value FROM rules
WHERE action = 'accept' AND target_label NOT IN ({", ".join(f"'{v}'" for v in LABELS)})
UNION ALL
SELECT 'mapped_and_dropped', source_label FROM (
  SELECT source_label FROM rules WHERE action = 'accept' INTERSECT SELECT source_label FROM rules WHERE action = 'drop')""")
def mapping_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.col("lang")
    rules = b.read(spark, sf, "documents").select(
        F.col("source").alias("source_label"),
        F.when(lang == "en", "joy").when(lang == "fr", "amusement").alias("target_label"),
        F.when(lang.isin("en", "fr"), "accept").otherwise("drop").alias("action"),
    ).distinct()
    return checks.mapping_problems(rules)


@query("label_contract_breaks", """
WITH a AS (SELECT lower(event_type) AS label, row_number() OVER (ORDER BY event_type) - 1 AS left_id
           FROM (SELECT DISTINCT event_type FROM events)),
     b AS (SELECT lower(event_type) AS label, row_number() OVER (ORDER BY first_id) - 1 AS right_id
           FROM (SELECT event_type, min(event_id) AS first_id FROM events GROUP BY 1))
SELECT label, left_id, right_id FROM a FULL JOIN b USING (label) WHERE left_id IS DISTINCT FROM right_id""")
def label_contract_breaks(spark: SparkSession, sf: str) -> DataFrame:
    firsts = b.read(spark, sf, "events").groupBy(F.upper("event_type").alias("label")).agg(F.min("event_id").alias("f"))
    order = lambda c: F.row_number().over(small_window().orderBy(c)) - 1
    left = firsts.select("label", order("label").alias("label_id"))
    right = firsts.select("label", order("f").alias("label_id"))
    return checks.label_contract_breaks(left, right)


# --- mapping and preparation ---------------------------------------------------------------------

@query("annotate_labels", f"{PREP} SELECT ord, source_label, mapped_label, drop_reason FROM prep_annotated")
def annotate_labels(spark: SparkSession, sf: str) -> DataFrame:
    return b.annotated(spark, sf).select("ord", "source_label", "mapped_label", "drop_reason")


@query("missing_labels_are_unknown", """
SELECT source_label, drop_reason, count(*) AS n FROM (
  SELECT coalesce(l.toxic::VARCHAR, 'nan') AS source_label, 'unknown_label' AS drop_reason
  FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY 1, 2""")
def missing_labels_are_unknown(spark: SparkSession, sf: str) -> DataFrame:
    table = b.wide_flags(spark, sf).select("text", F.col("toxic").cast("string").alias("label"))
    counts = mapping.label_counts(mapping.annotate_labels(table, b.DOCUMENT_MAPPING))
    return counts.select("source_label", "drop_reason", "n")


@query("dropped_label_counts", f"""{PREP}
SELECT source_label, drop_reason, count(*) AS n FROM prep_annotated WHERE drop_reason IS NOT NULL GROUP BY 1, 2""")
def dropped_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.label_counts(mapping.dropped_rows(b.annotated(spark, sf))).select("source_label", "drop_reason", "n")


@query("prepare_dataset", f"{PREP} SELECT ord, text, label, source_label FROM prep")
def prepare_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return b.prepared(spark, sf)


@query("prepare_keeping_duplicates", f"{PREP} SELECT ord, text, label, source_label FROM prep_clean")
def prepare_keeping_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.prepared_table(b.annotated(spark, sf), "ord", remove_duplicates=False)


@query("prepare_from_annotations", f"""
WITH folded AS (
  SELECT {b.sql_strip('d.text')} AS text, CASE WHEN l.quality = 1 THEN 'quality' ELSE 'toxic' END AS source_label,
         min(d.doc_id) AS ord
  FROM documents d JOIN labels l USING (doc_id)
  WHERE l.quality + l.toxic = 1 AND {b.sql_strip('d.text')} <> '' GROUP BY 1, 2)
SELECT text, CASE source_label WHEN 'quality' THEN 'joy' ELSE 'anger' END AS label, source_label, ord FROM folded""")
def prepare_from_annotations(spark: SparkSession, sf: str) -> DataFrame:
    spec = readers.parse_label_mapping({"quality": "joy", "toxic": "anger"})
    folded = annotations.single_label_rows(b.wide_flags(spark, sf), WIDE, order="doc_id").withColumnRenamed("doc_id", "ord")
    return prepare.prepared_table(mapping.annotate_labels(folded, spec), "ord")


def _flat(c: str) -> Column:
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    return F.array_join(F.transform(F.sort_array(F.map_entries(c)), entry), ",").alias(c)


@query("mapping_audit_excluded", f"""WITH {b.sql_annotated("prep", b.EXCLUDING_MAPPING, b.SQL_DOCUMENTS)}
SELECT count(*) AS input_rows, count(mapped_label) AS mapped_rows, count(drop_reason) AS dropped_rows,
  (SELECT string_agg(source_label || '=' || n, ',' ORDER BY source_label)
   FROM (SELECT source_label, count(*) n FROM prep_annotated WHERE drop_reason IS NOT NULL GROUP BY 1)) AS dropped_label_counts,
  (SELECT string_agg(source_label, ',' ORDER BY source_label) FROM prep_map WHERE action = 'drop') AS configured_dropped_labels,
  'src15,src3' AS runtime_excluded_labels
FROM prep_annotated""")
def mapping_audit_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """The audit with two mapped labels excluded for this run: they count as configured drops."""
    counts = mapping.label_counts(mapping.annotate_labels(b.documents(spark, sf), b.EXCLUDING_MAPPING))
    joined = lambda c: F.array_join(F.sort_array(c), ",").alias(c)
    return mapping.mapping_audit(counts, b.EXCLUDING_MAPPING).select(
        "input_rows", "mapped_rows", "dropped_rows", _flat("dropped_label_counts"),
        joined("configured_dropped_labels"), joined("runtime_excluded_labels"),
    )


@query("mapping_audit", f"""{PREP}
SELECT count(*) AS input_rows, count(mapped_label) AS mapped_rows, count(drop_reason) AS dropped_rows,
  round_even(count(drop_reason) / count(*) * 100, 2) AS dropped_percentage,
  (SELECT string_agg(source_label || '=' || n, ',' ORDER BY source_label)
   FROM (SELECT source_label, count(*) n FROM prep_annotated GROUP BY 1)) AS original_label_counts,
  (SELECT string_agg(mapped_label || '=' || n, ',' ORDER BY mapped_label)
   FROM (SELECT mapped_label, count(*) n FROM prep_annotated WHERE mapped_label IS NOT NULL GROUP BY 1)) AS mapped_label_counts,
  (SELECT string_agg(source_label || '=' || n, ',' ORDER BY source_label)
   FROM (SELECT source_label, count(*) n FROM prep_annotated WHERE drop_reason IS NOT NULL GROUP BY 1)) AS dropped_label_counts,
  (SELECT string_agg(source_label, ',' ORDER BY source_label)
   FROM (SELECT DISTINCT source_label FROM prep_annotated WHERE drop_reason = 'unknown_label')) AS unknown_labels,
  (SELECT string_agg(source_label, ',' ORDER BY source_label) FROM prep_map WHERE action = 'drop') AS configured_dropped_labels,
  (SELECT string_agg(t || ':' || s, ';' ORDER BY t) FROM (
     SELECT mapped_label AS t, string_agg(source_label, ',' ORDER BY source_label) AS s
     FROM prep_map WHERE action = 'accept' GROUP BY 1)) AS source_labels_by_target,
  0 AS runtime_excluded
FROM prep_annotated""")
def mapping_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = mapping.mapping_audit(mapping.label_counts(b.annotated(spark, sf)), b.DOCUMENT_MAPPING)
    sources = F.array_join(
        F.transform(
            F.map_entries("source_labels_by_target"),
            lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ",")),
        ), ";",
    )
    return audit.select(
        "input_rows", "mapped_rows", "dropped_rows", "dropped_percentage",
        _flat("original_label_counts"), _flat("mapped_label_counts"), _flat("dropped_label_counts"),
        F.array_join("unknown_labels", ",").alias("unknown_labels"),
        F.array_join("configured_dropped_labels", ",").alias("configured_dropped_labels"),
        sources.alias("source_labels_by_target"),
        F.size("runtime_excluded_labels").alias("runtime_excluded"),
    )


@query("source_label_groups", f"""{PREP},
firsts AS (SELECT source_label, text, row_number() OVER (PARTITION BY source_label ORDER BY ord) AS pos
           FROM prep QUALIFY pos <= 3),
counts AS (SELECT source_label, count(*) AS n FROM prep GROUP BY 1)
SELECT m.mapped_label AS target, m.source_label AS source, coalesce(max(c.n), 0) AS count,
       coalesce(string_agg(f.text, '|' ORDER BY f.pos), '') AS examples
FROM prep_map m LEFT JOIN counts c USING (source_label) LEFT JOIN firsts f USING (source_label)
WHERE m.action = 'accept' GROUP BY 1, 2""")
def source_label_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = ranking.source_groups(b.prepared(spark, sf), b.DOCUMENT_MAPPING.sources_by_target(), 3, "ord")
    return groups.withColumn("examples", F.array_join("examples", "|"))


@query("encode_decode_labels", f"""{PREP}, {b.SQL_LABELS}
SELECT ord, label, label_id, label AS decoded FROM prep JOIN dim USING (label)""")
def encode_decode_labels(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = label_table(spark, LABELS)
    coded = mapping.encode_labels(b.prepared(spark, sf).select("ord", "label"), dictionary)
    return mapping.decode_labels(coded, dictionary, label="decoded")


# --- duplicates ----------------------------------------------------------------------------------

@query("exact_duplicates", """
SELECT text, lang, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text, lang""")
def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.read(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return dedup.keep_first(docs, ["text", "lang"], "doc_id")


@query("normalized_duplicates", f"""
SELECT lang AS label, {b.sql_normal('text')} AS normalized_text, min(doc_id) AS ord
FROM documents WHERE {b.sql_normal('text')} <> '' AND len(string_split({b.sql_normal('text')}, ' ')) >= 5 GROUP BY 1, 2""")
def normalized_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.read(spark, sf, "documents").select(F.col("doc_id").alias("ord"), F.col("lang").alias("label"), "text")
    return curate.exact_unique(curate.normalized(docs).drop("text"), QualitySpec().min_words)


@query("distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_rows(b.read(spark, sf, "documents").select("text", "lang"))


@query("duplicate_stats", f"""{PREP}
SELECT count(*) AS before, count(DISTINCT (text, label)) AS after, count(*) - count(DISTINCT (text, label)) AS removed FROM prep_clean""")
def duplicate_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_stats(prepare.prepared_table(b.annotated(spark, sf), "ord", False), ["text", "label"])


# --- counts and weights --------------------------------------------------------------------------

@query("class_distribution", """
SELECT event_type AS label, count(*) AS count, round_even(count(*) / sum(count(*)) OVER () * 100, 2) AS percentage
FROM events GROUP BY 1""")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.class_distribution(b.read(spark, sf, "events"), "event_type")


_FULL_DISTRIBUTION = f"""{PREP}, {b.SQL_LABELS},
dist AS (SELECT label, count(p.ord) AS count,
                round_even(count(p.ord) / greatest((SELECT count(*) FROM prep), 1) * 100, 2) AS percentage
         FROM dim LEFT JOIN prep p USING (label) GROUP BY 1)"""


@query("class_distribution_full", f"{_FULL_DISTRIBUTION} SELECT label, count, percentage FROM dist")
def class_distribution_full(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.class_distribution_full(b.prepared(spark, sf))


@query("class_weights", f"""{PREP}, {b.SQL_LABELS}
SELECT label, count(p.ord) AS count,
       CASE WHEN count(p.ord) = 0 THEN 0.0 ELSE round_even((SELECT count(*) FROM prep) / (6 * count(p.ord)), 6) END AS weight
FROM dim LEFT JOIN prep p USING (label) GROUP BY 1""")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.class_weights(b.prepared(spark, sf))


@query("balanced_weights", """
SELECT event_type AS label, count(*) AS count,
       sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM events GROUP BY 1""")
def balanced_weights(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.balanced_weights(b.read(spark, sf, "events"), "event_type")


@query("row_weights", """
WITH w AS (SELECT event_type, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM events GROUP BY 1)
SELECT event_id, event_type, weight FROM events JOIN w USING (event_type)""")
def row_weights(spark: SparkSession, sf: str) -> DataFrame:
    events = b.read(spark, sf, "events").select("event_id", "event_type")
    return distribution.attach_weights(events, distribution.balanced_weights(events, "event_type"), 100, "event_type")


@query("dominant_class", f"""{_FULL_DISTRIBUTION}
SELECT label, count, percentage FROM dist ORDER BY percentage DESC, label LIMIT 1""")
def dominant_class(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.dominant_class(distribution.class_distribution_full(b.prepared(spark, sf)))


@query("distribution_warnings", """
WITH dist AS (SELECT role AS label, count(*) / sum(count(*)) OVER () * 100 AS p FROM conversations GROUP BY 1),
top AS (SELECT * FROM dist ORDER BY p DESC, label LIMIT 1)
SELECT 0 AS pos, printf('Class imbalance warning: ''%s'' represents %.2f%% of the final dataset.', label, round_even(p, 2)) AS warning
FROM top WHERE round_even(p, 2) >= 40
UNION ALL
SELECT 1, 'Mapping breadth warning: ''joy'' contains 5 source labels (src10, src6, src7, src8, src9).'""")
def distribution_warnings(spark: SparkSession, sf: str) -> DataFrame:
    counts = distribution.class_distribution_full(b.turns(spark, sf), ["user", "assistant", "system"])
    return distribution.distribution_warnings(counts, b.DOCUMENT_MAPPING.sources_by_target())


@query("distribution_block", """
WITH d AS (SELECT event_type AS label, count(*) AS n, round_even(count(*) / sum(count(*)) OVER () * 100, 2) AS p FROM events GROUP BY 1)
SELECT 'Events:' || chr(10) || string_agg(printf('  - %s: %d (%.2f%%)', label, n, p), chr(10) ORDER BY label) AS block FROM d""")
def distribution_block(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.distribution_block(b.read(spark, sf, "events"), "Events:", "event_type")


@query("text_diversity", f"""
WITH w AS (SELECT list_filter(string_split({b.sql_normal('text')}, ' '), lambda x: x <> '') AS words FROM documents)
SELECT count(*) AS rows, (SELECT count(DISTINCT word) FROM (SELECT unnest(words) AS word FROM w)) AS vocabulary_size,
       round_even(sum(len(words)) / greatest(count(*), 1), 2) AS average_words_per_example FROM w""")
def text_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.text_diversity(b.read_text(spark, sf, "documents", "text"))


# --- examples, ranks, shuffles -------------------------------------------------------------------

@query("examples_per_class", f"""{PREP}, {b.SQL_LABELS},
firsts AS (SELECT label, text, row_number() OVER (PARTITION BY label ORDER BY ord) AS pos FROM prep QUALIFY pos <= 3)
SELECT label, pos, text FROM dim LEFT JOIN firsts USING (label)""")
def examples_per_class(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.examples_per_class(b.prepared(spark, sf), 3, "ord")


@query("focused_examples", f"""{PREP},
focus(label, class_pos) AS (VALUES {", ".join(f"('{v}', {i})" for i, v in enumerate(FOCUS_LABELS))}),
firsts AS (SELECT label, text, row_number() OVER (PARTITION BY label ORDER BY ord) AS pos FROM prep QUALIFY pos <= 8)
SELECT label, class_pos, pos, text FROM focus LEFT JOIN firsts USING (label)""")
def focused_examples(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.focused_examples(b.prepared(spark, sf), FOCUS_LABELS, 8, "ord")


@query("cap_per_class", """
SELECT l_returnflag AS label, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) <= 240""")
def cap_per_class(spark: SparkSession, sf: str) -> DataFrame:
    items = b.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"), "l_orderkey", "l_linenumber")
    return ranking.cap_per_class(items, 240, ["l_orderkey", "l_linenumber"])


@query("shuffled_head", """
SELECT event_type AS label, event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) AS shuffle_pos
FROM events QUALIFY shuffle_pos <= 1200""")
def shuffled_head(spark: SparkSession, sf: str) -> DataFrame:
    events = b.read(spark, sf, "events").select(F.col("event_type").alias("label"), "event_id")
    return ranking.shuffled_head(events, 1200, "event_id", b.SEED)


@query("seeded_positions", """
SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS position FROM orders""")
def seeded_positions(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.seeded_positions(b.read(spark, sf, "orders").select("o_orderkey"), "o_orderkey", b.SEED)


# --- merging -------------------------------------------------------------------------------------

MERGED = f"""{PREP}, {b.SQL_ADDITIONAL},
both_sources AS (
  SELECT text, label, ord, source_label, 'goemotions_cleaned' AS data_source, 0 AS source_rank FROM prep
  UNION ALL
  SELECT text, label, ord, NULL, 'curated_additional', 1 FROM additional
  QUALIFY row_number() OVER (PARTITION BY text, label ORDER BY ord) = 1),
merged AS (SELECT * FROM both_sources
           QUALIFY row_number() OVER (PARTITION BY text, label ORDER BY source_rank, ord) = 1)"""


def _both(spark: SparkSession, sf: str) -> DataFrame:
    return merge.concatenated(b.prepared(spark, sf), b.additional(spark, sf))


@query("merge_datasets", f"{MERGED} SELECT text, label, ord, source_label, data_source, source_rank FROM merged")
def merge_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged_table(_both(spark, sf))


@query("merge_distributions", f"""{MERGED}, {b.SQL_LABELS}
SELECT 'label' AS report, label, NULL AS data_source, count(m.text) AS count FROM dim LEFT JOIN merged m USING (label) GROUP BY 2
UNION ALL SELECT 'data_source', NULL, data_source, count(*) FROM merged GROUP BY 3
UNION ALL SELECT 'source_label', label, data_source, count(*) FROM merged GROUP BY 2, 3""")
def merge_distributions(spark: SparkSession, sf: str) -> DataFrame:
    return distribution.merge_distributions(merge.merged_table(_both(spark, sf)))


@query("merge_summary", f"""{MERGED}, {b.SQL_LABELS}
SELECT (SELECT count(*) FROM merged) AS total_rows,
       (SELECT count(*) FROM both_sources) - (SELECT count(*) FROM merged) AS duplicate_rows_removed,
       (SELECT string_agg(label || '=' || n, ',' ORDER BY label)
        FROM (SELECT label, count(m.text) AS n FROM dim LEFT JOIN merged m USING (label) GROUP BY 1)) AS label_counts,
       (SELECT string_agg(data_source || '=' || n, ',' ORDER BY data_source)
        FROM (SELECT data_source, count(*) AS n FROM merged GROUP BY 1)) AS data_source_counts""")
def merge_summary(spark: SparkSession, sf: str) -> DataFrame:
    both = _both(spark, sf)
    summary = merge.merge_summary(both, merge.merged_table(both))
    return summary.select("total_rows", "duplicate_rows_removed", _flat("label_counts"), _flat("data_source_counts"))


@query("merge_shuffle", f"""{MERGED}
SELECT ord, source_rank, row_number() OVER (ORDER BY md5('42:' || source_rank || ':' || ord), source_rank, ord) AS position FROM merged""")
def merge_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge.merged_table(_both(spark, sf)).select("ord", "source_rank")
    return ranking.seeded_positions(merged, ["source_rank", "ord"], b.SEED)


# --- splitting -----------------------------------------------------------------------------------

def sql_split(source: str, key: str, order: str, spec: SplitSpec) -> str:
    """CTEs up to ``tagged`` for a table ``source`` with a column label."""
    def stage(name: str, rows: str, frm: str, ratio: float) -> str:
        return f"""
{name}_n AS (SELECT sum({rows}) AS n, sum({rows}) - ceil(sum({rows}) * {ratio!r}::DOUBLE)::BIGINT AS keep FROM {frm}),
{name}_f AS (SELECT label, ({rows} * keep) // n AS fl, ({rows} * keep) % n AS rest, keep FROM {frm}, {name}_n),
{name} AS (SELECT label, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= keep - sum(fl) OVER () THEN 1 ELSE 0 END AS kept
           FROM {name}_f)"""

    return f"""counts AS (SELECT label, count(*)::BIGINT AS c FROM {source} GROUP BY 1),
{stage('outer_cut', 'c', 'counts', spec.test_size)},
{stage('inner_cut', 'kept', 'outer_cut', spec.validation_ratio)},
quota AS (SELECT label, c - o.kept AS n_test, o.kept - i.kept AS n_validation, i.kept AS n_train
          FROM counts JOIN outer_cut o USING (label) JOIN inner_cut i USING (label)),
tagged AS (
  SELECT s.*, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_validation THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{spec.seed}:' || {key}), {order}) AS r FROM {source}) s
  JOIN quota USING (label))"""


SPLIT = SplitSpec()
SPLIT_SQL = f"{PREP}, {sql_split('prep', 'ord', 'ord', SPLIT)}"


@query("stratified_split", f"{SPLIT_SQL} SELECT ord, label, split FROM tagged")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.assign_split(b.prepared(spark, sf).select("ord", "label"), SPLIT, "ord")


@query("stratified_split_orders", f"""
WITH src AS (SELECT o_orderstatus AS label, o_orderkey FROM orders), {sql_split('src', 'o_orderkey', 'o_orderkey', SPLIT)}
SELECT label, o_orderkey, split FROM tagged""")
def stratified_split_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.read(spark, sf, "orders").select(F.col("o_orderstatus").alias("label"), "o_orderkey")
    return split.assign_split(orders, SPLIT, "o_orderkey")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("stratified_split_lineitem", f"""
WITH src AS (SELECT l_returnflag AS label, {", ".join(LINE_KEY)} FROM lineitem),
{sql_split('src', " || ':' || ".join(LINE_KEY), ", ".join(LINE_KEY), SplitSpec(0.25, 0.25, 7))}
SELECT label, {", ".join(LINE_KEY)}, split FROM tagged""")
def stratified_split_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    items = b.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"), *LINE_KEY)
    return split.assign_split(items, SplitSpec(0.25, 0.25, 7), LINE_KEY)


@query("split_repeated_keys", f"""
WITH src AS (SELECT l_linestatus AS label, l_suppkey FROM lineitem), {sql_split('src', 'l_suppkey', 'l_suppkey', SPLIT)}
SELECT label, l_suppkey, split, count(*) AS n FROM tagged GROUP BY 1, 2, 3""")
def split_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    items = b.read(spark, sf, "lineitem").select(F.col("l_linestatus").alias("label"), "l_suppkey")
    return split.assign_split(items, SPLIT, "l_suppkey").groupBy("label", "l_suppkey", "split").agg(F.count("*").alias("n"))


@query("two_way_split", f"""
WITH src AS (SELECT event_type AS label, event_id FROM events), {sql_split('src', 'event_id', 'event_id', SplitSpec(0.2, 0.0))}
SELECT label, split, count(*) AS n FROM tagged GROUP BY 1, 2""")
def two_way_split(spark: SparkSession, sf: str) -> DataFrame:
    events = b.read(spark, sf, "events").select(F.col("event_type").alias("label"), "event_id")
    train, validation, test = split.split_frames(split.assign_split(events, SplitSpec(0.2, 0.0), "event_id"))
    tall = train.withColumn("split", F.lit("train"))
    tall = tall.unionByName(validation.withColumn("split", F.lit("validation")))
    tall = tall.unionByName(test.withColumn("split", F.lit("test")))
    return tall.groupBy("label", "split").agg(F.count("*").alias("n"))


@query("split_quotas", f"{SPLIT_SQL} SELECT label, c AS count, n_test, n_validation, n_train FROM quota JOIN counts USING (label)")
def split_quotas(spark: SparkSession, sf: str) -> DataFrame:
    return split.quotas(distribution.count_by(b.prepared(spark, sf), "label"), SPLIT)


@query("train_class_weights", f"""{SPLIT_SQL}, {b.SQL_LABELS},
n AS (SELECT label, count(*) AS count FROM tagged WHERE split = 'train' GROUP BY 1)
SELECT label, count, round_even(sum(count) OVER () / (6 * count), 6) AS weight FROM dim JOIN n USING (label)""")
def train_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    tagged = split.assign_split(b.prepared(spark, sf).select("ord", "label"), SPLIT, "ord")
    return distribution.strict_class_weights(tagged.where("split = 'train'"))


@query("split_leakage", f"""{SPLIT_SQL}
SELECT text, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM tagged GROUP BY 1 HAVING count(DISTINCT split) > 1""")
def split_leakage(spark: SparkSession, sf: str) -> DataFrame:
    tagged = split.assign_split(b.prepared(spark, sf).select("ord", "text", "label"), SPLIT, "ord")
    return split.leakage(tagged).withColumn("splits", F.array_join("splits", ","))


# --- cleaning ------------------------------------------------------------------------------------

@query("unescape_entities", f"SELECT page_id, {b.sql_unescape('html')} AS text FROM pages")
def unescape_entities(spark: SparkSession, sf: str) -> DataFrame:
    return b.read(spark, sf, "pages").select("page_id", t.unescape_entities(F.col("html")).alias("text"))


@query("clean_pages", f"SELECT page_id, {b.sql_clean('html')} AS html FROM pages")
def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    return rows.clean_table(b.read_text(spark, sf, "pages", "page_id", "html"), "html")


@query("clean_documents", f"SELECT doc_id, text, {b.sql_clean('text')} AS cleaned FROM documents WHERE {b.sql_clean('text')} <> ''")
def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return rows.clean_table(b.read_text(spark, sf, "documents", "doc_id", "text"), "text", "cleaned", drop_empty=True)


@query("clean_options", f"SELECT page_id, {b.sql_clean('html', False, False, False, False)} AS html FROM pages")
def clean_options(spark: SparkSession, sf: str) -> DataFrame:
    pages = b.read_text(spark, sf, "pages", "page_id", "html")
    return rows.clean_table(pages, "html", lowercase=False, drop_urls=False, drop_mentions=False, keep_hashtag_word=False)


@query("normal_form", f"SELECT doc_id, {b.sql_normal('text')} AS normalized_text FROM documents")
def normal_form(spark: SparkSession, sf: str) -> DataFrame:
    return b.read(spark, sf, "documents").select("doc_id", t.normal_form(F.col("text")).alias("normalized_text"))


@query("sentence_case", f"""
SELECT conv_id, turn, upper(substr({b.sql_strip('text')}, 1, 1)) || substr({b.sql_strip('text')}, 2) AS text,
       trim(regexp_replace(text, '[{b._S}]+', ' ', 'g')) AS squeezed, {b.sql_strip('text')} AS model_input FROM conversations""")
def sentence_case(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("text")
    return b.read(spark, sf, "conversations").select(
        "conv_id", "turn", t.sentence_case(c).alias("text"), t.squeeze(c).alias("squeezed"), t.model_input(c).alias("model_input")
    )


@query("percentage_text", "SELECT event_id, printf('%.2f%%', (event_id / 9973.0::DOUBLE) * 100) AS share FROM events")
def percentage_text(spark: SparkSession, sf: str) -> DataFrame:
    return b.read(spark, sf, "events").select("event_id", percent_text(F.col("event_id") / F.lit(9973.0)).alias("share"))


@query("output_label", "SELECT event_id, lower(trim(upper(event_type))) AS predicted_label FROM events")
def output_label(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.upper("event_type"), F.lit("\t"))
    return b.read(spark, sf, "events").select("event_id", t.output_label(padded).alias("o")).select("event_id", "o.predicted_label")


# --- candidates ----------------------------------------------------------------------------------
# Phrase pools come from the tables: one label per region, suppliers open, market segments go in the
# middle, order priorities end, nations make the templates, customers the extras.

POOLS = """
openers AS (SELECT r_name AS label, s_name AS opener, row_number() OVER (PARTITION BY r_name ORDER BY s_suppkey) - 1 AS opener_pos
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
middles AS (SELECT label, 'serves the  ' || lower(seg) || ' market' AS middle, row_number() OVER (PARTITION BY label ORDER BY seg) - 1 AS middle_pos
  FROM (SELECT DISTINCT r_name AS label, c_mktsegment AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)),
endings AS (SELECT label, 'at priority ' || p || '.' AS ending, row_number() OVER (PARTITION BY label ORDER BY p) - 1 AS ending_pos
  FROM (SELECT DISTINCT r_name AS label, o_orderpriority AS p FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)),
templates AS (SELECT label, pos AS template_pos, n_name FROM (
  SELECT r_name AS label, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1 AS pos
  FROM nation JOIN region ON n_regionkey = r_regionkey)),
filled AS (SELECT label, template_pos, opener_pos, middle_pos, ending_pos,
  trim(regexp_replace(CASE template_pos
    WHEN 0 THEN upper(middle[1]) || middle[2:] || ' ' || ending
    WHEN 1 THEN upper(opener[1]) || opener[2:] || ' ' || middle || '.'
    ELSE upper(opener[1]) || opener[2:] || ' ' || middle || ' in ' || n_name || ' ' || ending END, '\\s+', ' ', 'g')) AS text
  FROM templates JOIN openers USING (label) JOIN middles USING (label) JOIN endings USING (label)),
built AS (SELECT * FROM filled
  QUALIFY row_number() OVER (PARTITION BY label, text ORDER BY template_pos, opener_pos, middle_pos, ending_pos) = 1)"""


def pools(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    regions = b.read(spark, sf, "nation").join(
        b.read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("r_name").alias("label"), "n_nationkey", "n_name")
    at = lambda *order: (F.row_number().over(W.Window.partitionBy("label").orderBy(*order)) - 1).alias("pos")
    customers = b.read(spark, sf, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    openers = b.read(spark, sf, "supplier").join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "label", F.lit("opener").alias("slot"), at("s_suppkey"), F.col("s_name").alias("phrase")
    )
    segments = customers.select("label", "c_mktsegment").distinct()
    middles = segments.select(
        "label", F.lit("middle").alias("slot"), at("c_mktsegment"),
        F.concat(F.lit("serves the  "), F.lower("c_mktsegment"), F.lit(" market")).alias("phrase"),
    )
    priorities = b.read(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "label", "o_orderpriority"
    ).distinct()
    endings = priorities.select(
        "label", F.lit("ending").alias("slot"), at("o_orderpriority"),
        F.concat(F.lit("at priority "), "o_orderpriority", F.lit(".")).alias("phrase"),
    )
    numbered = regions.select("label", at("n_nationkey"), "n_name")
    templates = numbered.select(
        "label", "pos",
        F.when(F.col("pos") == 0, F.lit("{middle_cap} {ending}"))
        .when(F.col("pos") == 1, F.lit("{opener_cap} {middle}."))
        .otherwise(F.concat(F.lit("{opener_cap} {middle} in "), "n_name", F.lit(" {ending}"))).alias("template"),
    )
    extras = customers.select("label", F.col("c_custkey").alias("pos"), F.concat("c_name", F.lit(" is calm.")).alias("text"))
    return openers.unionByName(middles).unionByName(endings), templates, extras


@query("phrase_combinations", f"WITH {POOLS} SELECT label, template_pos, opener_pos, middle_pos, ending_pos FROM filled")
def phrase_combinations(spark: SparkSession, sf: str) -> DataFrame:
    phrases, templates, _ = pools(spark, sf)
    return candidates.combinations(phrases, templates).select("label", *candidates.ORDER)


@query("built_sentences", f"WITH {POOLS} SELECT label, text, template_pos, opener_pos, middle_pos, ending_pos FROM built")
def built_sentences(spark: SparkSession, sf: str) -> DataFrame:
    phrases, templates, _ = pools(spark, sf)
    return candidates.build_sentences(phrases, templates)


REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_RANK = "CASE label " + " ".join(f"WHEN '{v}' THEN {i + 1}" for i, v in enumerate(REGIONS)) + " END"


@query("curated_candidates", f"""WITH {POOLS},
everything AS (
  SELECT label, text, concat_ws('-', 'b', template_pos, opener_pos, middle_pos, ending_pos) AS candidate FROM built
  UNION ALL
  SELECT r_name, c_name || ' is calm.', 'x-' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
SELECT text, label, 'curated_additional' AS source, 'high_precision' AS quality_tag, {_RANK} * 1201 + pos AS ord
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || label || ':' || candidate), label, candidate) AS pos
      FROM everything) WHERE pos <= 1200 AND label IN ({", ".join(f"'{v}'" for v in REGIONS)})""")
def curated_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return candidates.build_candidates(*pools(spark, sf), 240, b.SEED, REGIONS)


@query("guideline_table", """
SELECT r_name AS label, CASE WHEN n_nationkey < 13 THEN 'include' ELSE 'exclude' END AS kind,
       string_agg(n_name || ' ' || n, '|' ORDER BY n_nationkey) AS rules
FROM (SELECT r_name, n_name, n_nationkey, count(c_custkey) AS n FROM nation JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def guideline_table(spark: SparkSession, sf: str) -> DataFrame:
    counts = b.read(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    rules = (
        b.read(spark, sf, "nation").join(b.read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(counts, "n_nationkey", "left")
        .select(
            F.col("r_name").alias("label"), F.when(F.col("n_nationkey") < 13, "include").otherwise("exclude").alias("kind"),
            F.col("n_nationkey").alias("pos"), F.concat_ws(" ", "n_name", F.coalesce("n", F.lit(0))).alias("rule"),
        )
    )
    report = writers.guideline_report(rules)
    long = report.unpivot("label", ["include", "exclude"], "kind", "rules").where(F.size("rules") > 0)
    return long.withColumn("rules", F.array_join("rules", "|"))
