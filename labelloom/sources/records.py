"""Records of quoted CSV files, cut in parallel.

A line break may stand inside a quoted cell, so a split of a file does not know whether it begins inside one. Every
split is therefore walked under both assumptions at once; a window over the splits of a file then tells which one
holds, and each line learns the record it belongs to. Records of one line, nearly all, are never moved; only the
lines of records that span several are shuffled and put together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.session import bounded, ensure_checkpoint_dir, small_table

LINE = "file long, start long, no long, value string, o_rec long, i_rec long, o_open boolean, i_open boolean"
OPEN_BEFORE = -1  # the record of a line began in an earlier split


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line that begins inside or outside of one.

    A quote opens a cell only as its first character, and a doubled quote inside a cell is a character of it.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(",", at) + 1
                if at == 0:
                    return False
                continue
            at += 1
        quote = line.find('"', at)
        while quote >= 0 and line.startswith('"', quote + 1):
            quote = line.find('"', quote + 2)
        if quote < 0:
            return True
        at = line.find(",", quote + 1) + 1
        if at == 0:
            return False
        inside = False


class _Walk:
    """One pass over the lines of a split from an assumed state."""

    def __init__(self, inside: bool):
        self.inside, self.record = inside, OPEN_BEFORE

    def lines(self, first: int, n: int, quoted: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
        """Record and open state of ``n`` lines numbered from ``first``, of which ``quoted`` hold a quote."""
        record, still = np.arange(first, first + n), np.zeros(n, bool)
        at = 0
        for i, line in [*quoted, (n, None)]:
            if self.inside:
                record[at:i], still[at:i] = self.record, True
            if line is None:
                break
            if not self.inside:
                self.record = first + i
            record[i] = self.record
            self.inside = still[i] = ends_inside(line, self.inside)
            at = i + 1
        return record, still


def _first_filled(value: pa.Array) -> int:
    return pc.index(pc.invert(pc.is_in(value, pa.array(["", "\r"], value.type))), True).as_py()


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, seen, walks, header = None, 0, (), False
    for batch in batches:
        file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
        changes = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for lo, hi in zip([0, *changes], [*changes, batch.num_rows], strict=True):
            if lo == hi:
                continue
            if (file[lo], start[lo]) != key:
                key, seen, walks, header = (file[lo], start[lo]), 0, (_Walk(False), _Walk(True)), start[lo] == 0
            part = batch.slice(lo, hi - lo)
            value = part.column("value")
            if header and (at := _first_filled(value)) >= 0:
                # Blanked here, so that no later filter can be put ahead of leaving it out.
                value, header = pa.concat_arrays([value[:at], pa.array([""], value.type), value[at + 1 :]]), False
            at = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
            quoted = list(zip(at.tolist(), value.take(pa.array(at)).to_pylist(), strict=True))
            (o_rec, o_open), (i_rec, i_open) = (walk.lines(seen, hi - lo, quoted) for walk in walks)
            numbers = np.arange(seen, seen + hi - lo)
            columns = [part.column("file"), part.column("start"), pa.array(numbers), value]
            columns += [pa.array(c) for c in (o_rec, i_rec, o_open, i_open)]
            yield pa.record_batch(columns, names=["file", "start", "no", "value", "o_rec", "i_rec", "o_open", "i_open"])
            seen += hi - lo


def _raw_path(spark: SparkSession, path: str) -> list[str]:
    """The files or folders that a listed path names, without scheme and host."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toUri().getRawPath() for s in fs.globStatus(hadoop_path) or []]


def _places(spark: SparkSession, paths: Sequence[str], file_path: Column) -> Column:
    """The places of a file in the list; a file listed twice has two."""
    named = [(place, raw) for place, path in enumerate(paths) for raw in _raw_path(spark, path)]
    listed = F.array(*[F.struct(F.lit(place).alias("place"), F.lit(raw).alias("raw")) for place, raw in named])
    bare = F.regexp_replace(file_path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    mine = F.filter(listed, lambda e: (bare == e["raw"]) | F.startswith(bare, F.concat(e["raw"], F.lit("/"))))
    return F.array_distinct(F.transform(mine, lambda e: e["place"]))


def _splits(lines: DataFrame, files: DataFrame) -> DataFrame:
    """One row per split and place in the list: whether it begins inside a cell, and where that record began."""
    last = F.max(F.struct("no", "o_rec", "i_rec", "o_open", "i_open")).alias("last")
    ends = lines.groupBy("file", "start").agg(last).select("file", "start", "last.*")
    here = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A split either settles the state, whatever it was, or keeps it, or swaps it.
    settles = F.col("o_open") == F.col("i_open")
    ends = ends.withColumn("swaps", F.sum((F.col("o_open") & ~F.col("i_open")).cast("int")).over(here))
    known = F.last(F.when(settles, F.struct(F.col("o_open").cast("int").alias("state"), "swaps")), True).over(before)
    so_far = F.coalesce(F.last("swaps").over(before), F.lit(0))
    ends = ends.select("*", known.alias("known"), so_far.alias("so_far"))
    state = F.coalesce("known.state", F.lit(0)) + F.col("so_far") - F.coalesce("known.swaps", F.lit(0))
    ends = ends.withColumn("inside", state % 2 == 1)
    opens = _mine("open") & (_mine("rec") != OPEN_BEFORE)
    begun = F.last(F.when(opens, F.struct("start", _mine("rec").alias("no"))), True).over(before)
    return ends.select("file", "start", "inside", begun.alias("begun")).join(files, "file")


def _mine(name: str) -> Column:
    """What holds of the two assumptions."""
    return F.when(F.col("inside"), F.col(f"i_{name}")).otherwise(F.col(f"o_{name}"))


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(place, start, no, record) of every record of the listed files, without headers and empty lines.

    The header is the first line that is not empty, and has no line break in its names.
    ``place`` is the place of the file in the list; (place, start, no) sorts records as they stand. Lines end with \\n
    or \\r\\n; a break inside a cell stays as it is. A cell that is never closed runs to the end of its file, as it
    does for a sequential reader. Paths are told apart by 64-bit hashes. The text is read twice, at first for the
    state of every split, when this function is called.
    """
    ensure_checkpoint_dir(spark)
    text = spark.read.option("lineSep", "\n").text(list(dict.fromkeys(paths)))
    # Spark writes a local path as file:/x or file:///x.
    named = lambda path: F.xxhash64(F.replace(F.col(path), F.lit(":///"), F.lit(":/"))).alias("file")
    lines = text.select(named("_metadata.file_path"), F.col("_metadata.file_block_start").alias("start"), "value")
    lines = lines.mapInArrow(_walked, LINE)
    # The driver has planned the scan of these files, so it holds their names in any case.
    files = small_table(spark, {"path": text.inputFiles()})
    files = files.select(named("path"), F.explode(_places(spark, paths, F.col("path"))).alias("place"))
    splits = _splits(lines, files).checkpoint()
    known = lines.join(bounded(splits, splits.count()), ["file", "start"])
    known = known.withColumns({"rec": _mine("rec"), "open": _mine("open")})
    single = (F.col("rec") == F.col("no")) & ~F.col("open")
    earlier = F.col("rec") == OPEN_BEFORE
    first = F.when(earlier, F.col("begun")).otherwise(F.struct("start", F.col("rec").alias("no")))
    pieces = known.where(~single).select("place", "file", first.alias("at"), F.struct("start", "no", "value").alias("piece"))
    lines_of = F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["value"])
    torn = pieces.groupBy("place", "file", "at").agg(F.array_join(lines_of, "\n").alias("record"))
    whole = known.where(single).select("place", "file", F.struct("start", "no").alias("at"), F.col("value").alias("record"))
    records = whole.unionByName(torn).withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")
    return records.select("place", "at.start", "at.no", "record")
