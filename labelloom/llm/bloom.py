"""A pair of Bloom filters, for keys seen at least once and at least twice, built by all tasks and merged by shard.

The filters have a fixed size, so what is broadcast does not grow with the data. Beyond their capacity more
keys look repeated and take the exact way that follows; no repeated key is ever missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 2
SHARD_BYTES = 1 << 17
_SCHEMA = pa.schema([("shard", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
_DDL = "shard int, once binary, twice binary"


def _positions(keys: np.ndarray, log2_bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << log2_bits) - 1)
    return [(keys >> np.uint64(shift)) & mask for shift in (0, 64 - log2_bits)][:PROBES]


def _set(bits: np.ndarray, keys: np.ndarray, log2_bits: int) -> None:
    for at in _positions(keys, log2_bits):
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7))).astype(np.uint8))


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key, whether all its bits are set."""
    log2_bits = int(len(bits)).bit_length() + 2
    found = np.ones(len(keys), bool)
    for at in _positions(keys, log2_bits):
        found &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


class Pair:
    """Both filters of one task. ``add`` takes well mixed 64-bit keys; a key counts once for each time it occurs."""

    def __init__(self, log2_bits: int):
        self.log2_bits = log2_bits
        self.once = np.zeros(1 << (log2_bits - 3), np.uint8)
        self.twice = np.zeros(1 << (log2_bits - 3), np.uint8)

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        again = (counts > 1) | contains(self.once, keys)
        _set(self.twice, keys[again], self.log2_bits)
        _set(self.once, keys[~again], self.log2_bits)
        _set(self.once, keys[again & (counts > 1)], self.log2_bits)

    def shards(self) -> Iterator[pa.RecordBatch]:
        for k, at in enumerate(range(0, len(self.once), SHARD_BYTES)):
            once = self.once[at : at + SHARD_BYTES]
            if once.any():
                packed = [pa.compress(x[at : at + SHARD_BYTES].tobytes(), "zstd", asbytes=True) for x in (self.once, self.twice)]
                yield pa.record_batch([pa.array([k], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]], schema=_SCHEMA)


def _merge(size: int) -> Callable:
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for shard, *packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                once, twice = (np.frombuffer(pa.decompress(p, size, "zstd", asbytes=True), np.uint8) for p in packed)
                if shard in kept:
                    have = kept[shard]
                    have[1][:] |= twice | (have[0] & once)
                    have[0][:] |= once
                else:
                    kept[shard] = (once.copy(), twice.copy())
        for shard, (_, twice) in kept.items():
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([pa.compress(twice.tobytes(), "zstd", asbytes=True)], pa.binary())], names=["shard", "twice"])

    return merge


def twice_seen(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2_bits: int) -> Broadcast:
    """The broadcast twice-seen filter over all keys that ``keys_of`` finds in the batches of ``df``.

    Tasks send compressed shards of their filters; a merge task streams over the rows of its shards. The
    driver sees the merged twice-seen bits only: 2 ** log2_bits / 8 bytes, however large the input is.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(log2_bits)
        for batch in batches:
            for keys in keys_of(batch):
                pair.add(keys)
        yield from pair.shards()

    size = min(SHARD_BYTES, 1 << (log2_bits - 3))
    n_shards = max(1, (1 << (log2_bits - 3)) // SHARD_BYTES)
    merged = df.mapInArrow(build, _DDL).repartition(min(n_shards, 64), "shard").mapInArrow(_merge(size), "shard int, twice binary")
    bits = np.zeros(1 << (log2_bits - 3), np.uint8)
    for shard, packed in merged.collect():
        at = shard * SHARD_BYTES
        bits[at : at + size] = np.frombuffer(pa.decompress(bytes(packed), size, "zstd", asbytes=True), np.uint8)
    return df.sparkSession.sparkContext.broadcast(bits)


MEMBER_BITS = 29  # of a filter over listed keys: 64 MB at most; beyond some 50 million keys it lets more pass


def members(keys: DataFrame, n_keys: int) -> Broadcast:
    """A broadcast filter of the values of a one-column table of well mixed long keys, sized by their counted number.

    What it lets pass by mistake has to be told apart by the caller; it never refuses a listed key.
    """
    log2_bits = min(max(int(16 * max(n_keys, 1) - 1).bit_length(), 12), MEMBER_BITS)
    size = min(SHARD_BYTES, 1 << (log2_bits - 3))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (log2_bits - 3), np.uint8)
        for batch in batches:
            _set(bits, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), log2_bits)
        for k, at in enumerate(range(0, len(bits), size)):
            if bits[at : at + size].any():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([pa.compress(bits[at : at + size].tobytes(), "zstd", asbytes=True)], pa.binary())], names=["shard", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                part = np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), np.uint8)
                kept[shard] = kept[shard] | part if shard in kept else part
        for shard, part in kept.items():
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([pa.compress(part.tobytes(), "zstd", asbytes=True)], pa.binary())], names=["shard", "bits"])

    ddl = "shard int, bits binary"
    n_shards = (1 << (log2_bits - 3)) // size
    merged = keys.mapInArrow(build, ddl).repartition(min(n_shards, 32), "shard").mapInArrow(merge, ddl)
    bits = np.zeros(1 << (log2_bits - 3), np.uint8)
    for shard, packed in merged.collect():
        bits[shard * size : (shard + 1) * size] = np.frombuffer(pa.decompress(bytes(packed), size, "zstd", asbytes=True), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def may_hold(shared: Broadcast) -> Callable:
    """A boolean function of a long column: may its value be listed in the filter?"""

    @F.pandas_udf("boolean")
    def held(keys: pd.Series) -> pd.Series:
        return pd.Series(contains(shared.value, keys.to_numpy(np.int64).view(np.uint64)))

    return held


def summed(df: DataFrame, accumulate: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """The sum over all tasks of an int64 array of fixed ``length``, built by ``accumulate`` and merged by shard.

    The driver sees one array of that length, however large the input is.
    """
    shard = min(length, 1 << 15)

    def packed(k: int, part: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([k], pa.int32()), pa.array([pa.compress(part.tobytes(), "zstd", asbytes=True)], pa.binary()), pa.array([len(part)], pa.int32())], names=["shard", "part", "size"])

    def unpacked(data: bytes, size: int) -> np.ndarray:
        return np.frombuffer(pa.decompress(bytes(data), size * 8, "zstd", asbytes=True), np.int64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = accumulate(batches)
        for k, at in enumerate(range(0, length, shard)):
            if total[at : at + shard].any():
                yield packed(k, total[at : at + shard])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                part = unpacked(data, size)
                kept[k] = kept[k] + part if k in kept else part
        for k, part in kept.items():
            yield packed(k, part)

    ddl = "shard int, part binary, size int"
    total = np.zeros(length, np.int64)
    for k, data, size in df.mapInArrow(build, ddl).repartition(min(-(-length // shard), 32), "shard").mapInArrow(merge, ddl).collect():
        total[k * shard : k * shard + size] = unpacked(data, size)
    return total


def frequencies(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2_slots: int) -> Broadcast:
    """A broadcast table of 2 ** log2_slots counters: an upper estimate of how often each key occurs.

    Keys share counters, so it never says too little.
    """

    def accumulate(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros(1 << log2_slots, np.int64)
        for batch in batches:
            for keys in keys_of(batch):
                np.add.at(counts, (keys >> np.uint64(64 - log2_slots)).astype(np.int64), 1)
        return counts

    total = summed(df, accumulate, 1 << log2_slots)
    return df.sparkSession.sparkContext.broadcast(np.minimum(total, 2**31 - 1).astype(np.int32))


def estimated(counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    log2_slots = int(len(counts)).bit_length() - 1
    return counts[(keys >> np.uint64(64 - log2_slots)).astype(np.int64)]
