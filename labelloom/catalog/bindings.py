"""How the operators are bound to the test tables, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.config import LABELS, MappingSpec
from labelloom.functions.text import WHITESPACE
from labelloom.operators.mapping import annotate_labels
from labelloom.plans.prepare import prepared_table
from labelloom.session import ensure_checkpoint_dir, widened

# Source labels src0..src19 of the documents stand in for the annotators' labels.
_ACCEPTED = {
    "src0": "anger", "src1": "anger", "src2": "anger", "src3": "anger",
    "src4": "fear", "src5": "fear",
    "src6": "joy", "src7": "joy", "src8": "joy", "src9": "joy", "src10": "joy",
    "src11": "sadness", "src12": "sadness", "src13": "sadness", "src14": "sadness",
    "src15": "surprise",
    "src16": "neutral",
}
DOCUMENT_MAPPING = MappingSpec.build(_ACCEPTED, ["src17", "src18"])
EXCLUDING_MAPPING = MappingSpec.build(_ACCEPTED, ["src17", "src18"], ["src3", "src15"])
TURN_MAPPING = MappingSpec.build({"user": "joy", "assistant": "neutral"}, ["system"])
SEED = 42


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def read_text(spark: SparkSession, sf: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a text table, spread over the cores for CPU-heavy steps."""
    return widened(read(spark, sf, table).select(*columns))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(text, label = source, ord = doc_id)."""
    return read(spark, sf, "documents").select("text", F.col("source").alias("label"), F.col("doc_id").alias("ord"))


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    return annotate_labels(documents(spark, sf), DOCUMENT_MAPPING)


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return prepared_table(annotated(spark, sf), "ord")


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """(text, label = role, ord): conversation turns in order."""
    return read(spark, sf, "conversations").select(
        "text", F.col("role").alias("label"), (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("ord")
    )


def additional(spark: SparkSession, sf: str) -> DataFrame:
    """Second merge source: mapped turns plus the prepared documents that were also hand-labelled,
    so that both sources share rows."""
    spoken = prepared_table(annotate_labels(turns(spark, sf), TURN_MAPPING), "ord")
    again = prepared(spark, sf).join(read(spark, sf, "labels").select(F.col("doc_id").alias("ord")), "ord", "left_semi")
    shift = F.lit(10**12)
    return spoken.select("text", "label", "ord").unionByName(
        again.select("text", "label", (F.col("ord") + shift).alias("ord"))
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A made-up predictor over the prepared documents that SQL can repeat: half the rows keep their
    label, the others get one by hash; the confidence comes from the hash as well."""
    h = F.md5(F.concat(F.lit("p:"), F.col("ord").cast("string")))
    digits = lambda start, n: F.conv(F.substring(h, start, n), 16, 10).cast("int")
    names = F.array(*[F.lit(v) for v in LABELS])
    predicted = F.when(digits(9, 2) < 128, F.col("label")).otherwise(F.element_at(names, digits(1, 4) % 6 + 1))
    return prepared(spark, sf).select(
        "ord", "text", F.col("label").alias("true_label"), predicted.alias("predicted_label"),
        F.bround(F.lit(0.2) + (digits(5, 4) % 8000) / F.lit(10000.0), 4).alias("confidence"),
    ).withColumn("is_correct", F.col("true_label") == F.col("predicted_label"))


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, label, logits): the largest of every sixth embedding value as the logit of each class."""
    largest = lambda i: F.array_max(F.filter("embedding", lambda _, j: j % 6 == i))
    names = F.array(*[F.lit(v) for v in LABELS])
    return read(spark, sf, "embeddings").select(
        "vec_id",
        F.element_at(names, (F.col("label") % 6 + 1).cast("int")).alias("label"),
        F.transform(F.sequence(F.lit(0), F.lit(5)), largest).cast("array<double>").alias("logits"),
    )


def wide_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their two 0/1 columns; null where a document was not labelled."""
    flags = read(spark, sf, "labels")
    return read(spark, sf, "documents").select("doc_id", "text").join(flags, "doc_id", "left")


# --- the same in SQL -----------------------------------------------------------------------------

SQL_CLASS_LOGITS = "list_transform(range(6), lambda i: list_max(list_filter(embedding, lambda x, j: (j - 1) % 6 = i))::DOUBLE)"
_SQL_SPACES = WHITESPACE.replace("'", "''")
_W = r"\p{L}\p{N}_"
_S = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def sql_strip(c: str) -> str:
    return f"trim({c}, '{_SQL_SPACES}')"


def sql_fold(c: str) -> str:
    return f"lower({sql_strip(c)})"


def _sub(c: str, pattern: str, to: str = " ") -> str:
    pattern = pattern.replace("'", "''")
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


def sql_unescape(c: str) -> str:
    """Only the entities that occur in the tables, ampersand last."""
    for entity, value in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        c = f"replace({c}, '{entity}', '{value}')"
    return _sub(c, "&amp;?", "&")


def sql_clean(c: str, lowercase: bool = True, urls: bool = True, mentions: bool = True, words: bool = True) -> str:
    c = sql_strip(sql_unescape(f"coalesce({c}, '')"))
    if lowercase:
        c = f"lower({c})"
    c = _sub(c, r"<[^>]+>")
    c = _sub(c, rf"\b[{_W}.+-]+@[{_W}-]+\.[{_W}.-]+\b")
    if urls:
        c = _sub(c, rf"https?://[^{_S}]+|www\.[^{_S}]+")
    if mentions:
        c = _sub(c, rf"@[{_W}]+")
    c = _sub(c, rf"#([{_W}]+)", r" \1 " if words else " ")
    c = _sub(c, rf"[^a-z0-9{_S}!?']")
    return sql_strip(_sub(c, rf"[{_S}]+"))


def sql_normal(c: str) -> str:
    return f"array_to_string(regexp_extract_all(lower({c}), '[a-zA-Z'']+'), ' ')"


def _values(spec: MappingSpec) -> str:
    rows = [f"('{s}', '{t}', 'accept')" for s, t in spec.accepted.items()]
    rows += [f"('{s}', NULL, 'drop')" for s in spec.dropped]
    return ", ".join(rows)


def sql_annotated(name: str, spec: MappingSpec, source: str) -> str:
    """CTEs for annotated rows and the prepared table ``name`` of (text, label, ord) in ``source``."""
    return f"""
{name}_map(source_label, mapped_label, action) AS (VALUES {_values(spec)}),
{name}_annotated AS (
  SELECT r.text, r.label, r.ord, r.source_label, m.mapped_label,
         CASE WHEN m.action = 'drop' THEN 'configured_drop'
              WHEN m.mapped_label IS NULL THEN 'unknown_label' END AS drop_reason
  FROM (SELECT text, label, ord, {sql_fold("coalesce(label, 'nan')")} AS source_label FROM ({source})) r
  LEFT JOIN {name}_map m USING (source_label)),
{name}_clean AS (
  SELECT {sql_strip('text')} AS text, mapped_label AS label, ord, source_label
  FROM {name}_annotated WHERE mapped_label IS NOT NULL AND text IS NOT NULL AND {sql_strip('text')} <> ''),
{name} AS (
  SELECT text, label, ord, source_label FROM {name}_clean
  QUALIFY row_number() OVER (PARTITION BY text, label ORDER BY ord) = 1)"""


SQL_DOCUMENTS = "SELECT text, source AS label, doc_id AS ord FROM documents"
SQL_TURNS = "SELECT text, role AS label, conv_id * 1000000 + turn AS ord FROM conversations"
SQL_PREP = sql_annotated("prep", DOCUMENT_MAPPING, SQL_DOCUMENTS)
SQL_ADDITIONAL = f"""{sql_annotated('spoken', TURN_MAPPING, SQL_TURNS)},
additional AS (
  SELECT text, label, ord FROM spoken
  UNION ALL
  SELECT text, label, ord + 1000000000000 FROM prep WHERE ord IN (SELECT doc_id FROM labels))"""
SQL_LABELS = "dim(label, label_id) AS (VALUES " + ", ".join(f"('{v}', {i})" for i, v in enumerate(LABELS)) + ")"
_LIST = "[" + ", ".join(f"'{v}'" for v in LABELS) + "]"
SQL_LABEL_LIST = _LIST
SQL_PREDICTIONS = f"""{SQL_PREP},
predictions AS (
  SELECT *, true_label = predicted_label AS is_correct FROM (
    SELECT ord, text, label AS true_label,
           CASE WHEN ('0x' || substr(h, 9, 2))::INT < 128 THEN label
                ELSE ({_LIST})[('0x' || substr(h, 1, 4))::INT % 6 + 1] END AS predicted_label,
           round_even(0.2::DOUBLE + (('0x' || substr(h, 5, 4))::INT % 8000) / 10000.0::DOUBLE, 4) AS confidence
    FROM (SELECT *, md5('p:' || ord) AS h FROM prep)))"""
SQL_LOGITS = f"""
logits AS (
  SELECT vec_id, ({_LIST})[label % 6 + 1] AS label, {SQL_CLASS_LOGITS} AS logits
  FROM embeddings)"""


def fitted(spark: SparkSession, sf: str):
    """Classifier trained on the prepared documents. Every query trains its own, so none depends on another."""
    from labelloom.plans.train import train_and_evaluate

    return train_and_evaluate(prepared(spark, sf), "ord", keep=["ord"])
