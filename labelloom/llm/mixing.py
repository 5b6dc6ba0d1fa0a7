"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Blocks of a source with share w get windows: block j (from 1) is released at slot floor((j - 1) / w) and due by slot
ceil(j / w). The released block with the earliest deadline takes each slot, so that every source is less than one
block away from its share at any time. Shares are whole numbers of slots of a round, after which all sources are
exactly even and the pattern repeats; only one round, whose length is bounded by a parameter, is ever scheduled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

BLOCK_ROWS = 16
ROUND_SLOTS = 240
POWER = 0.5  # target weights are row counts to this power
MAX_SOURCES = 2000
BUCKET_ROWS = 2_000


def target_slots(counts: DataFrame, slots: int = ROUND_SLOTS, power: float = POWER, weights: DataFrame | None = None) -> DataFrame:
    """(source, rows, share): slots of a round per source in proportion to its weight, one at least.

    Without ``weights`` the weight is rows ** power. A table (source, weight) gives target weights of any scale; rows
    of one source add up, and a source that it lacks, or whose weight is null, not finite or negative, has weight 0.
    """
    weight = F.pow(F.col("rows").cast("double"), F.lit(power))
    if weights is not None:
        given = F.col("weight").cast("double")
        usable = F.when((given > 0) & (given < float("inf")), given).otherwise(0.0)
        named = weights.groupBy(F.col("source").alias("__named")).agg(F.sum(usable).alias("__weight"))
        counts = counts.join(named, F.col("source").eqNullSafe(F.col("__named")), "left").drop("__named")
        weight = F.coalesce("__weight", F.lit(0.0))
    total = F.sum(weight).over(Window.partitionBy())
    part = F.lit(slots) * weight / total
    part = part if weights is None else F.when(total > 0, part).otherwise(0.0)
    share = F.greatest(F.lit(1), F.round(part, 0).cast("int"))
    return counts.withColumn("share", share).drop("__weight")


def pattern(shares: DataFrame) -> DataFrame:
    """(slot, k, nth): which source k takes each slot of a round, as its nth block (from 0), by earliest deadline.

    ``shares`` has one row with an array of whole shares; ties of deadlines go to the smaller k.
    """
    shares = shares.select("shares", F.aggregate("shares", F.lit(0), lambda a, x: a + x).alias("round"))

    def take(state: Column, slot: Column) -> Column:
        def candidate(done: Column, k: Column) -> Column:
            share = F.element_at("shares", k + 1)
            released = F.floor(done * F.col("round") / share) <= slot
            due = F.ceil((done + 1) * F.col("round") / share).cast("int")
            return F.when(released & (done < share), F.struct(due.alias("due"), k.alias("k"), done.alias("nth")))

        pick = F.array_min(F.transform(state["done"], candidate))
        done = F.transform(state["done"], lambda n, k: F.when(k == pick["k"], n + 1).otherwise(n))
        return F.struct(done.alias("done"), F.array_append(state["taken"], pick).alias("taken"))

    start = F.struct(F.transform("shares", lambda _: F.lit(0)).alias("done"), F.expr("cast(array() as array<struct<due:int,k:int,nth:int>>)").alias("taken"))
    run = F.aggregate(F.sequence(F.lit(0), F.col("round") - 1), start, take, lambda s: s["taken"])
    return shares.select(F.posexplode(run).alias("slot", "pick")).select("slot", "pick.k", "pick.nth")


def mix_sources(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", seed: int = 0, block_rows: int = BLOCK_ROWS, slots: int = ROUND_SLOTS, power: float = POWER, weights: DataFrame | None = None) -> DataFrame:
    """Add block (long, of the source), slot (long, of the schedule) and position (long, of the mix) to every row.

    Rows of a source come in the order of the md5 of seed and id, then id; rows with equal ids are interchangeable.
    ``weights`` (source, weight) gives the target weights, else they are row counts to ``power``; see target_slots.
    A null source is a source of its own, null ids come first. All rows are placed: once a source has run out, the
    others keep their order and close the gaps. Columns named block, slot or position are replaced, others pass
    unchanged. An empty table stays empty. More than MAX_SOURCES sources raise an error, as a round cannot hold them.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.drop("block", "slot", "position")
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("__mark")
    keyed = docs.withColumn("__mark", mark)
    counts = keyed.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows")).checkpoint()
    n_sources = counts.count()
    if n_sources > MAX_SOURCES:
        raise ValueError(f"{n_sources} sources: a round of the schedule holds {MAX_SOURCES} at most")
    if not n_sources:
        return docs.select("*", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("position"))
    # Tables of at most MAX_SOURCES rows, or MAX_SOURCES + slots for the round.
    k = (F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_first())) - 1).alias("k")
    sources = target_slots(counts, slots, power, weights).select("source", "rows", "share", k).checkpoint()
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "share", "rows"))), lambda x: x)
    one = sources.agg(ordered.alias("all")).select(F.col("all.share").alias("shares"), F.col("all.rows").alias("sizes"))
    taken = pattern(one.select("shares"))
    # before[k]: slots of source k that come earlier in the round; counts all sources' blocks before a slot.
    before = [F.count(F.when(F.col("k") == F.lit(i), 1)).over(Window.partitionBy().orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)) for i in range(n_sources)]
    taken = taken.withColumn("before", F.array(*before)).checkpoint()

    # Ranks inside a source by even buckets of the md5, so that no task sorts a whole source.
    rows = counts.agg(F.max("rows")).first()[0]
    buckets = max(1, -(-rows // BUCKET_ROWS))
    value = F.conv(F.substring("__mark", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("__bucket", F.floor(value * F.lit(buckets) / F.lit(1 << 32)).cast("int"))
    # Keys without nulls, the same for window and join, so that whole rows are dealt once.
    keyed = keyed.withColumns({"__none": F.col(source_col).isNull(), "__name": F.coalesce(F.col(source_col).cast("string"), F.lit(""))})
    keys = ["__none", "__name", "__bucket"]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("__none", "__name").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("ahead", ahead).drop("n")
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("__mark", F.col(id_col).asc_nulls_first())) - 1
    placed = keyed.withColumn("__r", within).join(offsets, keys)
    placed = placed.withColumn("__i", F.col("ahead") + F.col("__r")).drop(*keys, "ahead", "__r", "__mark")
    slots_of = sources.select(F.col("source").alias("__s"), F.col("k").alias("__k"), F.col("share").alias("__share"))
    placed = placed.join(F.broadcast(slots_of), F.col(source_col).eqNullSafe(F.col("__s")))
    placed = placed.withColumn("block", F.floor(F.col("__i") / F.lit(block_rows)).cast("long"))
    placed = placed.withColumn("__round", F.floor(F.col("block") / F.col("__share"))).withColumn("__nth", (F.col("block") % F.col("__share")).cast("int"))
    shares, totals = one.first()
    length = sum(shares)
    at = taken.select(F.col("k").alias("__k"), F.col("nth").alias("__nth"), F.col("slot").alias("__slot"), "before")
    placed = placed.join(F.broadcast(at), ["__k", "__nth"])
    # Rows of every source before this slot: whole rounds and the part of this one, no more than the source has.
    earlier = sum(
        (F.least(F.lit(int(total)).cast("long"), (F.col("__round") * F.lit(share) + F.col("before")[i]) * F.lit(block_rows)) for i, (share, total) in enumerate(zip(shares, totals, strict=True))),
        F.lit(0).cast("long"),
    )
    placed = placed.withColumn("slot", (F.col("__round") * F.lit(length) + F.col("__slot")).cast("long"))
    return placed.withColumn("position", (earlier + F.col("__i") % F.lit(block_rows)).cast("long")).select(*docs.columns, "block", "slot", "position")
