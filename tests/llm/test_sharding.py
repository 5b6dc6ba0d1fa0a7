"""Sharding by jump hash against a plain version, and gapless slots under repeats, nulls and empty tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import sharding
from labelloom.llm.queries import op11_sharding


def plain_jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def plain_shard(doc_id, shards: int) -> int:
    return plain_jump(int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:16], 16), shards)


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 1000])
def test_jump_equals_the_plain_walk(shards):
    rng = random.Random(shards)
    keys = [0, 1, 2**64 - 1, *[rng.getrandbits(64) for _ in range(500)]]
    assert sharding.jump(np.array(keys, np.uint64), shards).tolist() == [plain_jump(k, shards) for k in keys]


def test_shards_are_even_and_one_more_takes_only_into_itself():
    keys = np.random.default_rng(1).integers(0, 2**64, 48_000, np.uint64)
    before, after = sharding.jump(keys, 24), sharding.jump(keys, 25)
    assert np.bincount(before).min() > 1_700 and np.bincount(before).max() < 2_300
    moved = before != after
    assert (after[moved] == 24).all() and 0.03 < moved.mean() < 0.05


def test_no_shards():
    with pytest.raises(ValueError):
        sharding.jump(np.zeros(1, np.uint64), 0)


def test_query_on_nulls_repeats_and_empty_texts(spark, tmp_path):
    rows = [(i, f"text é {i}") for i in range(300)] + [(None, "a"), (None, None), (7, ""), (7, None), (8, "x" * 300_000)] + [(9, "same")] * 50
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(-1)).withColumn("slot", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    found = op11_sharding(spark, str(tmp_path)).collect()
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), plain_shard(i, 24), plain_shard(i, 25)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found) == want
    assert {r.law for r in found} == {"key"}
    for shard in {r.shard for r in found}:
        own = [r for r in found if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        in_order = [(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id},{r.size},{r.text_crc32}".encode()).hexdigest()) for r in sorted(own, key=lambda r: r.slot)]
        assert in_order == sorted(in_order)


def test_slots_do_not_depend_on_buckets_chunks_or_partitions(spark):
    rows = [(i % 90, i % 3) for i in range(400)] + [(1, 1)] * 100 + [(None, None)] * 30
    table = spark.createDataFrame(rows, "a long, shard int")
    ways = [
        sorted(map(tuple, sharding.numbered(table.repartition(n), ["a"], bucket_rows=b, chunk_rows=c).collect()), key=repr)
        for n, b, c in [(1, 4000, 4096), (5, 7, 16), (3, 1, 1)]
    ]
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) == len(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.numbered(sharding.with_shards(empty, "doc_id", 24), ["doc_id"]).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)] + [(None, None), (3, "t3")], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=5, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select("doc_id", "text").collect())) == sorted(map(repr, docs.collect()))
    assert all(r.shard == plain_shard(r.doc_id, 5) for r in back.collect())
    assert all(len(list(d.glob("*.parquet"))) <= 2 for d in (tmp_path / "out").glob("shard=*"))
