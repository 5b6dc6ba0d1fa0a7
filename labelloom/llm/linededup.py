"""Line dedup: lines that many documents share lose their copies.

Two Bloom filters (once-seen, twice-seen) over line hashes tell which lines may be repeats. Only those are
shuffled, counted exactly and given a first occurrence. A line that is not suspected never leaves its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import bloom
from labelloom.session import ensure_checkpoint_dir

# Bits of each Bloom filter, as a power of two: 8 MB to broadcast, at any input size.
FILTER_BITS = 26
# A confirmed list of at most so many keys (16 bytes each) is broadcast; a longer one is joined.
BROADCAST_KEYS = 1 << 20


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line: A-Z lower-cased, white space [\\x20\\x09-\\x0D] stripped at both ends."""
    return [line.strip() for line in text.lower().split(b"\n")]


def _texts(batch: pa.RecordBatch, text_col: str) -> list[bytes]:
    return [t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def dedup_lines(docs: DataFrame, text_col: str = "text", order_col: str = "doc_id", min_docs: int = 2, min_chars: int = 1, keep: str = "first", filter_bits: int = FILTER_BITS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Drop lines whose key occurs in at least ``min_docs`` documents; add long columns n_lines and n_dropped.

    keep="first" leaves the first occurrence (smallest ``order_col``, null first, then line number) in place,
    keep="none" drops all of them. Every row is one document, also if it repeats another row. A null or empty
    text is one empty line and becomes the empty text. Keys under ``min_chars`` code points always stay.
    Rows that tie for the first occurrence (same ``order_col``, same text) all keep it. Columns named n_lines
    or n_dropped are replaced; other columns pass unchanged. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    docs = docs.drop("n_lines", "n_dropped")
    narrow = docs.select(F.col(order_col).cast("string").alias("o"), F.col(text_col).alias("t"))

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in _texts(batch, "t"):
            yield np.fromiter((xxhash.xxh3_64_intdigest(k) for k in set(line_keys(text)) if _long_enough(k, min_chars)), np.uint64)

    def batched(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        found = list(hashes(batch))
        yield np.concatenate(found) if found else np.zeros(0, np.uint64)

    suspected = bloom.twice_seen(narrow.select("t"), batched, filter_bits)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, orders, lines, digests = [], [], [], []
            for order, text in zip(batch.column("o").to_pylist(), _texts(batch, "t"), strict=True):
                first = {}
                for number, key in enumerate(line_keys(text)):
                    if _long_enough(key, min_chars):
                        first.setdefault(key, number)
                own = list(first)
                seen = bloom.contains(suspected.value, np.fromiter((xxhash.xxh3_64_intdigest(k) for k in own), np.uint64, len(own)))
                hit = [k for k, s in zip(own, seen, strict=True) if s]
                keys += [xxhash.xxh3_128_digest(k) for k in hit]
                lines += [first[k] for k in hit]
                orders += [order] * len(hit)
                digests += [hashlib.md5(text).digest()] * len(hit)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(orders, pa.string()), pa.array(digests, pa.binary()), pa.array(lines, pa.int32())], names=["key", "o", "digest", "line"])

    occurrences = narrow.mapInArrow(suspects, "key binary, o string, digest binary, line int")
    # The order column travels as text through Arrow and is cast back, so that numbers order as numbers.
    place = F.struct(F.col("o").cast(docs.schema[order_col].dataType).alias("o"), "digest", "line")
    confirmed = occurrences.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where(F.col("n") >= min_docs)
    if keep == "first":
        confirmed = confirmed.select("key", F.col("first.digest").alias("digest"), F.col("first.line").alias("line"), F.col("first.o").cast("string").alias("o"))
    else:
        confirmed = confirmed.select("key", F.lit(None).cast("binary").alias("digest"), F.lit(-1).alias("line"), F.lit(None).cast("string").alias("o"))
    confirmed = confirmed.checkpoint()

    if confirmed.count() <= broadcast_keys:
        table = {bytes(r.key): (r.digest and bytes(r.digest), r.line, r.o) for r in confirmed.collect()}
        shared = spark.sparkContext.broadcast(table)
        return _applied(docs, text_col, order_col, shared)
    # Too many keys to broadcast: each text fetches its own. Texts are told apart by digest, so exact copies share the answer.
    per_text = occurrences.join(confirmed.withColumnsRenamed({"digest": "fd", "o": "fo", "line": "fl"}), "key")
    per_text = per_text.groupBy("digest").agg(F.collect_set(F.struct("key", F.col("fd").alias("digest"), F.col("fl").alias("line"), F.col("fo").alias("o"))).alias("__drops"))
    with_key = docs.withColumn("__digest", F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    joined = with_key.join(per_text.withColumnRenamed("digest", "__digest"), "__digest", "left").drop("__digest")
    return _applied(joined, text_col, order_col, None)


def _applied(docs: DataFrame, text_col: str, order_col: str, shared) -> DataFrame:
    """The map-side end: rebuild every text without its dropped lines."""
    names = [c for c in docs.columns if c != "__drops"]
    schema = docs.select(*names, F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema
    docs = docs.withColumn("__order", F.col(order_col).cast("string"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_texts, n_lines, n_dropped = [], [], []
            own = batch.column("__drops").to_pylist() if shared is None else [None] * batch.num_rows
            for text, order, drops in zip(_texts(batch, text_col), batch.column("__order").to_pylist(), own, strict=True):
                table = shared.value if shared is not None else {d["key"]: (d["digest"], d["line"], d["o"]) for d in drops or []}
                lines = text.split(b"\n")
                keys = line_keys(text) if table else []
                digest = None
                kept = []
                for number, line in enumerate(lines):
                    found = table.get(xxhash.xxh3_128_digest(keys[number])) if table and keys[number] else None
                    if found is None:
                        kept.append(line)
                    elif found[1] == number and found[2] == order:
                        digest = digest or hashlib.md5(text).digest()
                        if digest == found[0]:
                            kept.append(line)
                kept_texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = {name: batch.column(name) for name in names}
            columns[text_col] = pa.array(kept_texts, pa.binary()).cast(pa.string())
            yield pa.record_batch([*columns.values(), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, "n_lines", "n_dropped"])

    return docs.mapInArrow(rebuild, schema)
