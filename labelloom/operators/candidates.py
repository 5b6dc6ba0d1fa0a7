"""Candidate sentences from phrase pools: template x opener x middle x ending, per label.

The pools are tables, so they can come from a file or from another query:
phrases (label, slot, pos, phrase), templates (label, pos, template), extras (label, pos, text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.config import ADDITIONAL_SOURCE, LABELS, QUALITY_TAG
from labelloom.functions.text import fill_template, squeeze
from labelloom.operators.dedup import keep_first
from labelloom.operators.ranking import shuffled_head

ORDER = ("template_pos", "opener_pos", "middle_pos", "ending_pos")


# Combinations of one opener that one task makes in one go.
BLOCK = 1 << 14


def combinations(phrases: DataFrame, templates: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every combination within a label, with the four positions.

    Templates, middles and endings of a label fold to arrays (they are configured pools); openers stay rows. A
    combination of an opener is a number in mixed radix: the digits are found by division and looked up in the arrays.
    Ranges of ``block`` numbers are dealt to all tasks by hash, so the product is spread whatever the number of labels,
    and only pools are shuffled. A label without one of the slots has no combination; repeated positions all count.
    """
    def items(slot: str):
        return F.sort_array(F.collect_list(F.when(F.col("slot") == slot, F.struct("pos", "phrase"))))

    folded = phrases.groupBy("label").agg(items("middle").alias("_m"), items("ending").alias("_e")).where("size(_m) > 0 AND size(_e) > 0")
    shapes = templates.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "template"))).alias("_t"))
    openers = phrases.where("slot = 'opener'").select(
        "label", F.col("pos").alias("opener_pos"), F.col("phrase").alias("opener")
    )
    ranges = (
        openers.join(folded.join(shapes, "label"), "label")
        .withColumn("_n", F.expr("bigint(size(_t)) * size(_m) * size(_e)"))
        .withColumn("_lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(block).cast("long"))))
    )
    # A given number, as adaptive execution would join these few rows into one task again.
    tasks = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = ranges.repartition(tasks, "label", "opener_pos", "opener", "_lo").withColumn(
        "_k", F.explode(F.sequence("_lo", F.least(F.col("_lo") + (block - 1), F.col("_n") - 1)))
    )
    return numbered.select(
        "label", "opener_pos", "opener",
        F.expr("_t[int(_k div (size(_m) * size(_e)))]").alias("_t"),
        F.expr("_m[int((_k div size(_e)) % size(_m))]").alias("_m"),
        F.expr("_e[int(_k % size(_e))]").alias("_e"),
    ).select(
        "label",
        F.col("_t.pos").alias("template_pos"), "opener_pos",
        F.col("_m.pos").alias("middle_pos"), F.col("_e.pos").alias("ending_pos"),
        F.col("_t.template").alias("template"), "opener",
        F.col("_m.phrase").alias("middle"), F.col("_e.phrase").alias("ending"),
    )


def build_sentences(phrases: DataFrame, templates: DataFrame) -> DataFrame:
    """Distinct sentences per label; a repeated sentence keeps its first combination."""
    filled = combinations(phrases, templates).select(
        "label",
        squeeze(fill_template(F.col("template"), F.col("opener"), F.col("middle"), F.col("ending"))).alias("text"),
        *ORDER,
    )
    return keep_first(filled, ["label", "text"], ORDER)


def build_candidates(
    phrases: DataFrame,
    templates: DataFrame,
    extras: DataFrame,
    per_class: int = 240,
    seed: int = 42,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Curated candidates: built sentences plus extras, shuffled, ``5 * per_class`` kept per label.

    Extras are not compared with the built sentences. ``ord`` is the order in the shuffled table.
    """
    built = build_sentences(phrases, templates).select(
        "label", "text", F.concat_ws("-", F.lit("b"), *ORDER).alias("candidate")
    )
    added = extras.select("label", "text", F.concat_ws("-", F.lit("x"), F.col("pos")).alias("candidate"))
    picked = shuffled_head(built.unionByName(added), per_class * 5, ["label", "candidate"], seed)
    rank = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")).cast("long")
    return picked.where(F.col("label").isin(*labels)).select(
        "text", "label",
        F.lit(ADDITIONAL_SOURCE).alias("source"),
        F.lit(QUALITY_TAG).alias("quality_tag"),
        (rank * F.lit(per_class * 5 + 1) + F.col("shuffle_pos")).alias("ord"),
    )
