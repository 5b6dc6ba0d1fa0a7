"""Ranked lexical search over a length-stratified index.

Documents whose length normaliser m is equal form a stratum; a large stratum is cut into blocks of bounded size, so
that a common length fills many tasks. Inside a block the postings of a term are ordered by how often the term
occurs (tf, highest first). All documents of a block share m, so a posting's impact depends on tf alone and is
computed once for each tf. A query's bound in a block is the sum of its terms' highest impacts; the blocks with the
highest bounds are read first and give every query a score that k documents reach. After that a block is skipped
where its bound is lower, and inside a block only the tf runs that can lift a document over that score open documents.
All scores are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm import bloom, textops
from labelloom.session import bounded, ensure_checkpoint_dir

# Characters between terms, and the scale of weights, impacts and lengths: fixed values of the ranking.
TERM_BREAKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WEIGHT_SCALE = 1_000
IMPACT_SCALE = 1_000_000_000
TF_SCALE, LENGTH_SCALE = 1_000, 20
BASE, SLOPE = 100, 50

BLOCK_DOCS = 2_048
FIRST_BLOCKS = 3  # blocks with the highest bounds that are read before there is a cutoff
ITEM_BLOCK = 4_096  # items searched for at a time; their terms and weights are broadcast
LAST = np.iinfo(np.int64).max

_INDEX = "m long, block int, ids array<long>, terms binary, starts binary, tfs binary, docs binary"


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, row within the piece, term hash) for each piece of a text column."""
    table = textops.byte_table(TERM_BREAKS)
    data, offsets = textops.text_bytes(column)
    for lo, hi in textops.pieces(offsets):
        row, _, _, hashes = textops.words(data, offsets, lo, hi, table)
        yield lo, hi, row, hashes


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term): the different terms of every item. Rows that share an id are one item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, row, hashes in _terms(batch.column("t")):
                yield pa.record_batch([batch.column("item").take(pa.array(lo + row)), pa.array(hashes.view(np.int64))], names=["item", "term"])

    source = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("t"))
    schema = source.selectExpr("item", "0L as term").schema
    return source.mapInArrow(split, schema).distinct()


class Queries:
    """The items of one block: their terms as places in a sorted vocabulary, end to end."""

    def __init__(self, rows: list):
        known = {}
        for item, _ in rows:
            known.setdefault(item, len(known))
        self.items = list(known)
        self.vocabulary, code = np.unique(np.array([t for _, t in rows], np.int64), return_inverse=True)
        owner = np.array([known[i] for i, _ in rows], np.int64)
        order = np.lexsort((code, owner))
        self.codes = code[order].astype(np.int64)
        self.starts = np.searchsorted(owner[order], np.arange(len(known) + 1))


def _counts(docs: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """(id, place, n, terms, tfs) of every document with a term: all its terms counted in n, those asked for in the arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, place = shared.value, 0
        for batch in batches:
            for lo, hi, row, hashes in _terms(batch.column("t")):
                size = hi - lo
                n = np.bincount(row, minlength=size)
                signed = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(vocabulary, signed), len(vocabulary) - 1)
                asked = vocabulary[at] == signed
                pairs, tf = np.unique(row[asked] * len(vocabulary) + at[asked], return_counts=True)
                codes, tf = (pairs % len(vocabulary)).astype(np.int32), np.minimum(tf, 2**31 - 1).astype(np.int32)
                ends = np.searchsorted(pairs, np.arange(size + 1) * len(vocabulary))
                rows = np.flatnonzero(n)
                spans = [(ends[r], ends[r + 1]) for r in rows]
                yield pa.record_batch(
                    [
                        batch.column("id").slice(lo, size).take(pa.array(rows)),
                        pa.array(place + rows),
                        pa.array(n[rows]),
                        pa.array([codes[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([tf[a:b].tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["id", "place", "n", "terms", "tfs"],
                )
                place += size

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return source.mapInArrow(count, "id long, place long, n long, terms binary, tfs binary")


def _totals(counts: DataFrame, width: int) -> np.ndarray:
    """[documents with a term, terms of all documents, documents that hold term 0, 1, ...]"""

    def accumulate(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            total[0] += batch.num_rows
            total[1] += batch.column("n").to_numpy().sum()
            held = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            total[2:] += np.bincount(held, minlength=width)
        return total

    return bloom.summed(counts.select("n", "terms"), accumulate, width + 2)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of every term."""
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _index(counts: DataFrame, n_docs: int, n_terms: int, block_docs: int) -> DataFrame:
    """One row for each block of a stratum: m, its documents, and postings by term and falling tf."""
    length = F.expr(f"cast(n as decimal(38, 0)) * {SLOPE} * {n_docs} div {max(n_terms, 1)}").cast("long")
    held = counts.where(F.length("terms") > 0).withColumn("m", F.lit(BASE - SLOPE) + length).drop("n")
    strata = held.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_docs)).cast("int").alias("parts")).checkpoint()
    # Places count rows of a task, so copies of one row spread over the blocks as other rows do.
    held = held.join(bounded(strata, strata.count()), "m").withColumn("block", F.pmod(F.xxhash64("place", "id"), F.col("parts")).cast("int"))

    def build(key: tuple, group: pa.Table) -> pa.Table:
        terms, tfs = group.column("terms").to_pylist(), group.column("tfs").to_pylist()
        code = np.frombuffer(b"".join(terms), np.int32)
        tf = np.frombuffer(b"".join(tfs), np.int32)
        doc = np.repeat(np.arange(len(terms), dtype=np.int32), [len(t) // 4 for t in terms])
        order = np.lexsort((doc, -tf, code))
        own, starts = np.unique(code[order], return_index=True)
        arrays = [own.astype(np.int32), np.r_[starts, len(code)].astype(np.int32), tf[order], doc[order]]
        ids = pa.array([group.column("id").to_pylist()], pa.list_(pa.int64()))
        return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), ids, *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], names=["m", "block", "ids", "terms", "starts", "tfs", "docs"])

    # Dealt by block: the exchange of a join on m would put a common length into one task.
    return held.select("m", "block", "id", "terms", "tfs").repartition("m", "block").groupBy("m", "block").applyInArrow(build, _INDEX)


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return IMPACT_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m)


class Block:
    """A block of one stratum, ready to be searched."""

    def __init__(self, m: int, terms: bytes, starts: bytes, tfs: bytes, docs: bytes, width: int):
        self.terms, self.starts = np.frombuffer(terms, np.int32), np.frombuffer(starts, np.int32)
        self.docs = np.frombuffer(docs, np.int32)
        levels, level = np.unique(np.frombuffer(tfs, np.int32).astype(np.int64), return_inverse=True)
        self.impacts = impact(levels, m)[level]  # once for each tf of the stratum
        self.highest = np.zeros(width, np.int64)
        self.highest[self.terms] = self.impacts[self.starts[:-1]]
        self.at = np.full(width, -1, np.int64)
        self.at[self.terms] = np.arange(len(self.terms))
        self._dense: dict[int, np.ndarray] = {}
        self.opened = 0

    def bounds(self, queries: Queries, weight: np.ndarray) -> np.ndarray:
        """The most that any document of the block can score, for every query."""
        return np.add.reduceat((weight * self.highest)[queries.codes], queries.starts[:-1])

    def _row(self, term: int, n: int) -> np.ndarray:
        if term not in self._dense:
            i = self.at[term]
            row = np.zeros(n, np.int64)
            own = slice(self.starts[i], self.starts[i + 1])
            row[self.docs[own]] = self.impacts[own]
            self._dense[term] = row
        return self._dense[term]

    def search(self, codes: np.ndarray, weight: np.ndarray, least: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents of the block that score ``least`` or more; ``least`` is 1 at least."""
        codes = codes[(self.at[codes] >= 0) & (weight[codes] > 0)]
        most = weight[codes] * self.highest[codes]
        order = np.argsort(-most, kind="stable")
        codes, most = codes[order], most[order]
        rest = np.r_[np.cumsum(most[::-1])[::-1], 0]  # what the terms from here on can add
        opened = np.zeros(n, bool)
        for i, term in enumerate(codes):
            if rest[i] < least:
                break  # a document that holds only these terms stays below
            own = slice(self.starts[self.at[term]], self.starts[self.at[term] + 1])
            need = max(-(-(least - int(rest[i + 1])) // int(weight[term])), 0)
            runs = np.searchsorted(-self.impacts[own], -need, side="right")
            opened[self.docs[own][:runs]] = True
        found = np.flatnonzero(opened)
        self.opened += len(found)
        score = np.zeros(len(found), np.int64)
        for i, term in enumerate(codes):
            score += weight[term] * self._row(int(term), n)[found]
            stays = score + rest[i + 1] >= least
            if not stays.all():
                found, score = found[stays], score[stays]
        return found, score


def _best(score: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, null, -score))[:k]


class _Top:
    """The k best documents of every query among the blocks of one task."""

    def __init__(self, k: int, cutoffs: np.ndarray):
        self.k, self.cutoffs, self.kept = k, cutoffs.copy(), {}

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if q in self.kept:
            score, ids, null = (np.r_[a, b] for a, b in zip(self.kept[q], (score, ids, null), strict=True))
        best = _best(score, ids, null, self.k)
        self.kept[q] = score[best], ids[best], null[best]
        if len(best) == self.k:
            self.cutoffs[q] = max(self.cutoffs[q], score[best[-1]])

    def rows(self) -> pa.RecordBatch:
        q = np.repeat(np.array(list(self.kept), np.int32), [len(s[0]) for s in self.kept.values()])
        score, ids, null = (np.concatenate([s[i] for s in self.kept.values()]) if self.kept else np.zeros(0, np.int64) for i in range(3))
        return pa.record_batch([pa.array(q, pa.int32()), pa.array(score, pa.int64()), pa.array(ids.astype(np.int64), pa.int64(), mask=null.astype(bool))], names=["q", "score", "doc_id"])


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[Block, np.ndarray, np.ndarray, int]]:
    """(block, ids, whether an id is null, row) of an Arrow batch of the index."""
    for i in range(batch.num_rows):
        arrays = [batch.column(c)[i].as_py() for c in ("terms", "starts", "tfs", "docs")]
        ids = batch.column("ids")[i].values
        null = ids.is_null().to_numpy(zero_copy_only=False)
        yield Block(batch.column("m")[i].as_py(), *arrays, width), ids.fill_null(LAST).to_numpy(), null, i


def _searched(index: DataFrame, queries: Queries, weight: np.ndarray, k: int, block_docs: int, first_blocks: int) -> DataFrame:
    """(q, score, doc_id): the k best documents of every query, some more where tasks did not know of each other."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((queries, weight))
    width = len(queries.vocabulary)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        for batch in batches:
            for block, _, _, i in _blocks(batch, width):
                bound = block.bounds(queries, weight)
                q = np.flatnonzero(bound > 0)
                place = [pa.array([batch.column(c)[i].as_py()] * len(q), t) for c, t in (("m", pa.int64()), ("block", pa.int32()))]
                yield pa.record_batch([pa.array(q.astype(np.int32)), pa.array(bound[q]), *place], names=["q", "bound", "m", "block"])

    every = index.mapInArrow(bounds, "q int, bound long, m long, block int")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "m", "block")
    first = every.withColumn("r", F.row_number().over(order)).where(F.col("r") <= first_blocks)
    # At most ITEM_BLOCK * first_blocks rows.
    first = F.broadcast(first.groupBy("m", "block").agg(F.collect_list("q").alias("qs")))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        top = _Top(k, np.ones(len(queries.items), np.int64))
        for batch in batches:
            for block, ids, null, i in _blocks(batch, width):
                for q in batch.column("qs")[i].as_py():
                    found, score = block.search(queries.codes[queries.starts[q] : queries.starts[q + 1]], weight, top.cutoffs[q], len(ids))
                    top.add(q, score, ids[found], null[found])
        yield top.rows()

    seeds = index.join(first, ["m", "block"]).mapInArrow(seed, "q int, score long, doc_id long")
    reached = seeds.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("r") == k)
    cutoffs = np.ones(len(queries.items), np.int64)
    for row in reached.select("q", "score").collect():  # one row for each item of the block at most
        cutoffs[row.q] = row.score
    known = spark.sparkContext.broadcast(cutoffs)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        top = _Top(k, known.value)
        for batch in batches:
            for block, ids, null, _ in _blocks(batch, width):
                bound = block.bounds(queries, weight)
                # Equal scores go by id, so a block whose bound equals the cutoff is read.
                for q in np.flatnonzero(bound >= top.cutoffs):
                    found, score = block.search(queries.codes[queries.starts[q] : queries.starts[q + 1]], weight, top.cutoffs[q], len(ids))
                    if len(found):
                        top.add(int(q), score, ids[found], null[found])
        yield top.rows()

    return index.mapInArrow(visit, "q int, score long, doc_id long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_docs: int = BLOCK_DOCS, first_blocks: int = FIRST_BLOCKS, item_block: int = ITEM_BLOCK) -> DataFrame:
    """The ``k`` best documents of every item: (item_col, rank from 1, doc_id, score), equal scores by ascending id.

    Terms are the longest runs of ASCII letters, digits and characters beyond ASCII; A-Z is lower-cased. Null and empty
    texts hold none; documents and items without terms appear nowhere. Every row is one document, also if it repeats
    another; null ids come last among equal scores. Items that share an id are one item with all their terms (each
    counts once); a null item id is an id like others. Extra columns are not read, ids must be whole numbers. Empty
    tables give no rows. Items are searched for in blocks of ``item_block``, each with one pass over the documents that
    indexes the terms of its items. Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    asked = _item_terms(items, item_col, item_text_col).checkpoint()
    blocks = max(1, -(-asked.select("item").distinct().count() // item_block))
    numbered = asked.withColumn("__block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    results = []
    for b in range(blocks):
        rows = [(r.item, r.term) for r in numbered.where(F.col("__block") == b).select("item", "term").collect()]
        if not rows:
            continue
        queries = Queries(rows)
        counts = _counts(docs, id_col, text_col, queries.vocabulary).checkpoint()
        totals = _totals(counts, len(queries.vocabulary))
        weight = weights(int(totals[0]), totals[2:])
        index = _index(counts, int(totals[0]), int(totals[1]), block_docs).checkpoint()
        found = _searched(index, queries, weight, k, block_docs, first_blocks)
        names = pa.table({"q": pa.array(range(len(queries.items)), pa.int32()), "item": pa.array(queries.items, pa.int64())})
        results.append(found.join(F.broadcast(spark.createDataFrame(names)), "q").select("item", "doc_id", "score"))
    if not results:
        return asked.select(F.col("item").cast("long").alias(item_col), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    everything = results[0]
    for more in results[1:]:
        everything = everything.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = everything.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", "doc_id", "score")
