"""Sinks. Tables are written by the executors; text and JSON reports are label-sized.

Every sink writes beside its folder and publishes by rename, so a failed job leaves the earlier output as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import label_table


def _folders(spark: SparkSession, path: str):
    """File system, the folder itself, and where its earlier content stays while a new one is published."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = kind(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Names with a leading underscore are no data to Spark, should somebody read the parent folder.
    return fs, target, kind(target.getParent(), f"_earlier.{target.getName()}")


def settle(spark: SparkSession, path: str) -> None:
    """Finish or take back a publication that was cut short. Every write begins with it."""
    fs, target, earlier = _folders(spark, path)
    if fs.exists(earlier):
        if fs.exists(target):
            fs.delete(earlier, True)
        else:
            fs.rename(earlier, target)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[str], object] | None = None) -> None:
    """Run ``write(folder)`` on a folder beside ``path``, then ``check(folder)``, then put it in the place of ``path``.

    If writing or checking raises, the new folder goes and ``path`` stays as it was. The earlier content is moved aside
    first and deleted last; after a crash between the two renames ``settle`` brings it back. ``write`` may read ``path``.
    """
    settle(spark, path)
    fs, target, earlier = _folders(spark, path)
    aside = earlier.suffix(f".{uuid.uuid4().hex}")
    try:
        write(aside.toString())
        if check is not None:
            check(aside.toString())
        replaced = fs.exists(target)
        if replaced and not fs.rename(target, earlier):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(aside, target):
            if replaced:
                fs.rename(earlier, target)
            raise OSError(f"cannot publish {path}")
    except BaseException:
        fs.delete(aside, True)
        raise
    fs.delete(earlier, True)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", check: Callable[[str], object] | None = None) -> None:
    """Parquet by default; CSV keeps quotes and line breaks inside cells readable. ``check`` sees the written folder first."""
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("quote", '"')
    publish(df.sparkSession, path, writer.save, check)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row nested report as JSON."""
    publish(report.sparkSession, path, report.coalesce(1).write.option("ignoreNullFields", False).json)


# Fixed value: stands under a label without rows.
NO_EXAMPLES = "  (no examples available)"


def report_lines(examples: DataFrame, labels: Sequence[str], empty_note: str | None = NO_EXAMPLES) -> DataFrame:
    """Readable block per label from (label, pos, text); one row (pos, block) per label in order."""
    dim = label_table(examples.sparkSession, labels)
    numbered = examples.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("items")
    )
    line = lambda e: F.concat(F.lit("  "), e["pos"].cast("string"), F.lit(". "), e["text"])
    body = F.array_join(F.transform("items", line), "\n")
    note = F.lit(empty_note) if empty_note else F.lit(None).cast("string")
    return (
        dim.join(numbered, "label", "left")
        .select(
            F.col("label_id").alias("pos"),
            F.concat_ws(
                "\n",
                F.concat(F.lit("["), F.col("label"), F.lit("]")),
                F.when(F.col("items").isNull(), note).otherwise(body),
            ).alias("block"),
        )
    )


def write_text_blocks(blocks: DataFrame, path: str, separator: str = "\n") -> None:
    """Blocks (pos, block) as one text file in order. Blocks are label-sized summaries."""
    ordered = blocks.agg(F.sort_array(F.collect_list(F.struct("pos", "block"))).alias("all"))
    text = ordered.select(F.array_join(F.transform("all", lambda b: b["block"]), separator + "\n").alias("value"))
    publish(blocks.sparkSession, path, text.coalesce(1).write.text)


def write_labels(spark: SparkSession, labels: Sequence[str], path: str) -> None:
    """Label list with both directions of the id mapping: (label, label_id)."""
    publish(spark, path, label_table(spark, labels).coalesce(1).write.parquet)


def guideline_report(rules: DataFrame) -> DataFrame:
    """(label, kind, pos, rule) folded to one row per label: include / exclude lists."""
    def rules_of(kind: str):
        picked = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "rule"))))
        return F.transform(picked, lambda r: r["rule"]).alias(kind)

    return rules.groupBy("label").agg(rules_of("include"), rules_of("exclude"))
