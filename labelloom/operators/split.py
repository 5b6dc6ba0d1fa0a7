"""Exact stratified train / validation / test split.

Quotas are exact per label. Rows are chosen by the seeded hash of their key, so the same split can
be rebuilt later from the key and the seed alone. The wide rows never move: two small aggregates
over (label, key) find, per label, the hash at which each part ends, and the rows are then tagged
in place against that label-sized table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from labelloom.config import SplitSpec
from labelloom.functions.hashing import as_list, seeded_hash
from labelloom.operators.checks import require_class_sizes
from labelloom.operators.ranking import bucket_of
from labelloom.session import bounded, ensure_checkpoint_dir, small_window

MAX_LABELS = 10_000


def _apportion(counts: DataFrame, rows: str, draws: Column, out: str) -> DataFrame:
    """Largest-remainder shares of ``draws`` over the label counts; equal remainders by label name.

    Whole-number arithmetic, so shares do not depend on rounding.
    """
    total = F.sum(rows).over(small_window())
    exact = F.col(rows) * draws
    shared = (
        counts.withColumn("_total", total)
        .withColumn("_floor", F.expr("0L") + F.floor((exact - exact % F.col("_total")) / F.col("_total")))
        .withColumn("_rest", exact % F.col("_total"))
    )
    rank = F.row_number().over(small_window().orderBy(F.desc("_rest"), "label"))
    missing = draws - F.sum("_floor").over(small_window())
    return (
        shared.withColumn("_rank", rank)
        .withColumn("_missing", missing)
        .withColumn(out, F.col("_floor") + F.when(F.col("_rank") <= F.col("_missing"), 1).otherwise(0))
        .drop("_total", "_floor", "_rest", "_rank", "_missing")
    )


def quotas(counts: DataFrame, spec: SplitSpec) -> DataFrame:
    """(label, count, n_test, n_validation, n_train) from (label, count); label-sized throughout."""
    n = F.sum("count").over(small_window())
    stage = counts.select("label", "count").withColumn("_keep", n - F.ceil(n * F.lit(spec.test_size)))
    stage = _apportion(stage, "count", F.col("_keep"), "_left")
    if spec.validation_size == 0:
        return stage.select(
            "label", "count", (F.col("count") - F.col("_left")).alias("n_test"),
            F.lit(0).cast("long").alias("n_validation"), F.col("_left").alias("n_train"),
        )
    left = F.sum("_left").over(small_window())
    stage = stage.withColumn("_keep", left - F.ceil(left * F.lit(spec.validation_ratio)))
    stage = _apportion(stage, "_left", F.col("_keep"), "n_train")
    return stage.select(
        "label", "count", (F.col("count") - F.col("_left")).alias("n_test"),
        (F.col("_left") - F.col("n_train")).alias("n_validation"), "n_train",
    )


def cut_points(keyed: DataFrame, spec: SplitSpec) -> DataFrame:
    """(label, test_end, test_share, validation_end, validation_share): where the test and validation parts end.

    An end is the last (hash, key) of the part; its share is (taken, n): how many of the n rows with that key are
    still inside. ``keyed`` has label, _h and _k. Hash buckets that lie wholly inside a part need no ranking; only
    in the one bucket per label and boundary in which a part ends are keys counted and ordered, so a key that
    repeats often is one row there.
    """
    bucketed = keyed.withColumn("_b", bucket_of(F.col("_h")))
    by_bucket = bucketed.groupBy("label", "_b").agg(F.count("*").alias("n"))
    by_label = by_bucket.groupBy("label").agg(F.sum("n").alias("count"))
    through = F.sum("n").over(W.Window.partitionBy("label").orderBy("_b"))
    limits = quotas(by_label, spec).select(
        "label", F.col("n_test").alias("_t"), (F.col("n_test") + F.col("n_validation")).alias("_v")
    )
    def inside(mark: str) -> Column:
        return (F.col("_before") < F.col(mark)) & (F.col(mark) <= F.col("_before") + F.col("n"))

    boundary = (
        by_bucket.withColumn("_before", through - F.col("n"))
        .join(limits, "label")
        .where(inside("_t") | inside("_v"))
    )
    counted = (
        bucketed.join(bounded(boundary.select("label", "_b", "_before", "_t", "_v"), 2 * MAX_LABELS), ["label", "_b"])
        .groupBy("label", "_b", "_before", "_t", "_v", "_h", "_k")
        .agg(F.count("*").alias("n"))
    )
    key_order = W.Window.partitionBy("label", "_b").orderBy("_h", "_k")
    ranked = counted.withColumn("_first", F.col("_before") + F.sum("n").over(key_order) - F.col("n"))

    def at(mark: str) -> Column:
        taken = F.col(mark) - F.col("_first")
        end = F.struct(F.struct("_h", "_k").alias("end"), F.struct(taken.alias("taken"), "n").alias("share"))
        return F.max(F.when((taken > 0) & (taken <= F.col("n")), end))

    ends = ranked.groupBy("label").agg(at("_t").alias("t"), at("_v").alias("v"))
    return ends.select(
        "label", F.col("t.end").alias("test_end"), F.col("t.share").alias("test_share"),
        F.col("v.end").alias("validation_end"), F.col("v.share").alias("validation_share"),
    )


def _numbered(rows: DataFrame, group: list[str]) -> DataFrame:
    """Adds ``_i``, the 1-based number of a row in its group, by task of the input plus the rows in the tasks before.

    The task numbers are written down first, so a lost executor cannot change them between the two uses.
    """
    held = rows.withColumn("_p", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id()).checkpoint()
    counts = held.groupBy(*group, "_p").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(W.Window.partitionBy(*group).orderBy("_p")) - F.col("_c")
    inside = F.row_number().over(W.Window.partitionBy(*group, "_p").orderBy("_n"))
    return held.join(counts.withColumn("_before", before), [*group, "_p"]).withColumn("_i", F.col("_before") + inside)


def assign_split(
    df: DataFrame, spec: SplitSpec, key: str | Sequence[str], label: str = "label", n_labels: int = MAX_LABELS
) -> DataFrame:
    """Adds ``split`` (train / validation / test).

    Quotas are exact, also where keys repeat. Rows that share key and label count as interchangeable: how many of
    them go to each part is fixed by key and seed, which of them is not. Finding the ends runs a job; only rows
    whose key lies across an end are moved.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = as_list(key)
    hashed = seeded_hash(spec.seed, *keys)
    ident = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    keyed = df.select(F.col(label).alias("label"), hashed.alias("_h"), ident.alias("_k"))
    cuts = cut_points(keyed, spec).withColumnRenamed("label", label).checkpoint()
    mark = F.struct(hashed.alias("_h"), ident.alias("_k"))

    def within(part: str, number: Column) -> Column:
        end, taken = F.col(f"{part}_end"), F.col(f"{part}_share.taken")
        return F.coalesce((mark < end) | ((mark == end) & (number <= taken)), F.lit(False))

    def tagged(rows: DataFrame, number: Column) -> DataFrame:
        part = F.when(within("test", number), "test").when(within("validation", number), "validation").otherwise("train")
        return rows.withColumn("split", part).select(*df.columns, "split")

    def across(part: str) -> Column:
        share = F.col(f"{part}_share")
        return F.coalesce((mark == F.col(f"{part}_end")) & (share["taken"] < share["n"]), F.lit(False))

    # Left, so that a label all of whose rows train (no cut point) is kept.
    ended = df.join(bounded(cuts, n_labels), label, "left")
    if cuts.where("test_share.taken < test_share.n or validation_share.taken < validation_share.n").isEmpty():
        return tagged(ended, F.lit(1))
    divided = across("test") | across("validation")
    shared = ended.where(divided).withColumn("_at", F.when(mark == F.col("test_end"), "test").otherwise("validation"))
    return tagged(ended.where(~divided), F.lit(1)).unionByName(tagged(_numbered(shared, [label, "_at"]), F.col("_i")))


def check_split(df: DataFrame, spec: SplitSpec, label: str = "label") -> None:
    """Refuse a split that cannot keep every class on both sides of each stage."""
    require_class_sizes(df, label, spec.min_rows_per_label)
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("count"))
    row = quotas(counts, spec).agg(
        F.count("*").alias("k"), F.sum("n_test").alias("test"),
        F.sum("n_validation").alias("validation"), F.sum("n_train").alias("train"),
    ).first()
    sides = {"test": row["test"], "the rest": row["validation"] + row["train"]}
    if spec.validation_size > 0:
        sides |= {"validation": row["validation"], "train": row["train"]}
    for name, rows in sides.items():
        if rows < row["k"]:
            raise ValueError(f"{name} would get {rows} rows, fewer than the {row['k']} classes")


def split_frames(tagged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test tables; validation is empty in two-way mode."""
    return tuple(tagged.where(F.col("split") == part).drop("split") for part in ("train", "validation", "test"))


def leakage(tagged: DataFrame, text: str = "text") -> DataFrame:
    """Texts that sit in more than one part (they may carry two labels): (text, splits)."""
    return (
        tagged.groupBy(text)
        .agg(F.sort_array(F.collect_set("split")).alias("splits"))
        .where(F.size("splits") > 1)
    )
