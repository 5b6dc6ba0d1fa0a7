"""Exact top-k inner products by the three-phase uniform threshold.

The components of a vector, ordered by their energy, are cut into a few stretches; each gives a local list of partial
scores, ordered by the stretch's norm. Phase 1 reads the entries of largest norm in every list, resolves the totals of
the best and keeps, per query, a total that k candidates reach: a safe cutoff. In phase 2 the lists are read one after
the other: an entry that holds its even share of the cutoff is sufficient, any other needs a later list whose norms
allow such a share, and both need what is known plus the norms of the unread lists to reach the cutoff; what fails
leaves. Phase 3 resolves the totals of those left, exactly. Equal vectors are one candidate that carries its smallest ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

LISTS = 4
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
TILE = 1024  # candidates whose scores are in memory at a time
HEAD = 8  # phase 1 reads one of so many entries of every list
SPARSE = 16  # under one of so many entries left, single products are cheaper than a block


def quantised(vector: str = "embedding", levels: int = 256):
    """floor(levels * x) of every component as long; null where a component is null or not finite, or the vector is."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(levels) * x.cast("double")).cast("long")))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros; float64 while sums stay exact, else Python integers."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    high = max((int(np.abs(x.astype(object)).max()) for x in (a, b) if x.size), default=0) if max(a.size, b.size) < 4096 else max(int(np.abs(a).max()), int(np.abs(b).max()))
    kind = np.float64 if high * high * max(a.shape[1], 1) < 2**53 else object
    return a.astype(kind), b.astype(kind)


def _long(x) -> int:
    return int(min(max(x, -(2**63)), 2**63 - 1))


def _stretches(qs: np.ndarray, cs: np.ndarray, lists: int) -> list[np.ndarray]:
    """Components by falling energy, in ``lists`` parts of even width."""
    energy = np.sqrt((qs.astype(float) ** 2).sum(0)) * np.sqrt((cs.astype(float) ** 2).sum(0))
    return [s for s in np.array_split(np.argsort(-energy, kind="stable"), lists) if len(s)]


def local_best(qs: np.ndarray, cs: np.ndarray, lists: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (query, total) of the best entries of every list, looked for among the largest norms of its stretch."""
    head = min(len(cs), max(more, -(-len(cs) // HEAD)))
    picked = []
    for stretch in _stretches(qs, cs, lists):
        rows = np.argsort(-(cs[:, stretch].astype(float) ** 2).sum(1), kind="stable")[:head]
        part = qs[:, stretch] @ cs[np.ix_(rows, stretch)].T
        n = min(more, head)
        picked.append(rows[np.argsort(-part, axis=1)[:, :n] if part.dtype == object else np.argpartition(-part, n - 1, axis=1)[:, :n]])
    at = np.repeat(np.arange(len(qs)), sum(p.shape[1] for p in picked))
    pairs = np.unique(np.stack([at, np.concatenate(picked, axis=1).ravel()]), axis=1)
    return pairs[0], (qs[pairs[0]] * cs[pairs[1]]).sum(1)


def reaching(qs: np.ndarray, cs: np.ndarray, least: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3: (query, candidate, total) of all totals that reach the query's cutoff, and the entries read.

    A cutoff of minus infinity keeps every candidate. Sums beyond 53 bits (object arrays) are resolved without bounds.
    """
    stretches = _stretches(qs, cs, lists)
    if qs.dtype == object:
        total = qs @ cs.T
        at, near = np.nonzero(total >= least.astype(object)[:, None])
        return at, near, total[at, near], total.size * len(stretches)
    norms = [np.stack([np.sqrt((x[:, s] ** 2).sum(1)) for s in stretches]) * (1 + 1e-9) for x in (qs, cs)]
    share = (least / len(stretches))[:, None]
    found, read = [], 0
    for lo in range(0, len(cs), TILE):
        tile = cs[lo : lo + TILE]
        nq, nc = norms[0], norms[1][:, lo : lo + TILE]
        total = np.zeros((len(qs), len(tile)))
        alive = nq.T @ nc >= least[:, None]
        sufficient = np.zeros_like(alive)
        for k, stretch in enumerate(stretches):
            at, near = np.nonzero(alive) if alive.mean() < 1 / SPARSE else (None, None)
            if at is None:
                some = np.flatnonzero(alive.any(0))
                part = np.zeros_like(total)
                part[:, some] = qs[:, stretch] @ tile[np.ix_(some, stretch)].T
                read += len(qs) * len(some)
                total += part
                sufficient |= part >= share
                rest = nq[k + 1 :].T @ nc[k + 1 :]
                alive &= total + rest >= least[:, None]
                if k + 1 < len(stretches):
                    late = np.full_like(total, -np.inf)
                    for m in range(k + 1, len(stretches)):
                        np.maximum(late, np.multiply.outer(nq[m], nc[m]), out=late)
                    alive &= sufficient | (late >= share)
                else:
                    alive &= sufficient
            else:
                part = np.einsum("ij,ij->i", qs[np.ix_(at, stretch)], tile[np.ix_(near, stretch)])
                read += len(at)
                total[at, near] += part
                sufficient[at, near] |= part >= share[at, 0]
                rest = np.einsum("ij,ij->j", nq[k + 1 :, at], nc[k + 1 :, near])
                late = (nq[k + 1 :, at] * nc[k + 1 :, near]).max(0, initial=-np.inf)
                alive[at, near] = (total[at, near] + rest >= least[at]) & (sufficient[at, near] | (late >= share[at, 0]))
        at, near = np.nonzero(alive)
        found.append((at, near + lo, total[at, near]))
    return *(np.concatenate([f[k] for f in found]) for k in range(3)), read


def _groups(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch of equal values."""
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    return starts, np.r_[starts[1:], len(at)] if len(at) else starts


def _best(at: np.ndarray, total: np.ndarray, near: np.ndarray, more: int, ties: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries sorted by query and falling total, cut to the ``more`` best of each query, with their ties on request."""
    order = np.argsort(-total, kind="stable")
    order = order[np.argsort(at[order], kind="stable")]
    at, total, near = at[order], total[order], near[order]
    starts, ends = _groups(at)
    size = ends - starts
    place = np.arange(len(at)) - np.repeat(starts, size)
    keep = place < more
    if ties:
        edge = total[np.minimum(starts + more, ends) - 1] if len(starts) else total
        keep |= (total == np.repeat(edge, size)).astype(bool)
    return at[keep], total[keep], near[keep]


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = LISTS) -> DataFrame:
    """The k best candidates of every query: (query_id, rank from 1, vec_id, score), ties to the smaller vec_id.

    Both tables have vec_id (long) and v (array of long). The score is the inner product, a shorter vector filled with
    zeros; scores beyond 64 bits are held at its ends. A candidate with the query's own id is left out. Rows with a null id or
    vector take no part; rows that repeat both id and vector are one. Fewer than k candidates give fewer rows.
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    more = k + 1  # the query's own row may be among the best
    whole = lambda df: df.select("vec_id", "v").where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    ranked = whole(vectors).distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
    # Only the k + 1 smallest ids of a vector can appear in any result.
    classes = ranked.where(F.col("r") <= more).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).checkpoint()
    asked = whole(queries).distinct()
    n_blocks = max(1, -(-classes.count() // CANDIDATE_BLOCK))
    distinct = asked.select("v").distinct().checkpoint()
    q_blocks = max(1, -(-distinct.count() // QUERY_BLOCK))
    # Blocks of about fixed size by the hash of distinct vectors, so no block can grow hot.
    blocks = classes.groupBy(F.pmod(F.xxhash64("v"), F.lit(n_blocks)).alias("block")).agg(F.collect_list("v").alias("v"), F.collect_list("ids").alias("ids")).checkpoint()
    asking = distinct.groupBy(F.pmod(F.xxhash64("v"), F.lit(q_blocks)).cast("int").alias("q")).agg(F.collect_list("v").alias("qv")).checkpoint()
    spread = blocks.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def matrices(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Per pair of blocks: row number, query block, queries and candidates as matrices."""
        for i in range(batch.num_rows):
            c, q = batch.column("v")[i].values, batch.column("qv")[i].values
            width = max([1, *[int(np.diff(x.offsets.to_numpy()).max()) for x in (c, q) if len(x)]])
            yield i, batch.column("q")[i].as_py(), *_exact(_matrix(q, width), _matrix(c, width))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, q, qs, cs in matrices(batch):
                at, total = local_best(qs, cs, lists, more)
                at, total, _ = _best(at, total, np.zeros(len(at), int), more, ties=False)
                yield pa.record_batch([pa.array([q] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([_long(x) for x in total], pa.int64())], names=["q", "at", "score"])

    first = spread.join(asking, "q").select("q", "v", "qv").mapInArrow(gather, "q int, at int, score long")
    order = Window.partitionBy("q", "at").orderBy(F.desc("score"))
    reached = first.withColumn("r", F.row_number().over(order)).where(F.col("r") <= more).groupBy("q", "at").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n"))
    cutoffs = reached.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("at", F.when(F.col("n") >= more, F.col("cutoff"))))).alias("cutoffs"))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, q, qs, cs in matrices(batch):
                ids = batch.column("ids")[i].as_py()
                cutoff = dict(batch.column("cutoffs")[i].as_py())
                least = np.array([-np.inf if cutoff.get(k) is None else cutoff[k] for k in range(len(qs))], float if qs.dtype != object else object)
                at, near, total, _ = reaching(qs, cs, least, lists)
                # Ties at the last place stay until their ids are known.
                at, total, near = _best(at, total, near, more, ties=True)
                out = []
                for lo, hi in zip(*_groups(at), strict=True):
                    best = heapq.nsmallest(more, ((-_long(s), x) for s, c in zip(total[lo:hi], near[lo:hi], strict=True) for x in ids[c]))
                    out += [(int(at[lo]), -s, x) for s, x in best]
                yield pa.record_batch(
                    [pa.array([q] * len(out), pa.int32()), pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())],
                    names=["q", "at", "score", "vec_id"],
                )

    known = asking.join(cutoffs, "q")
    found = spread.join(known, "q").select("q", "v", "ids", "qv", "cutoffs").mapInArrow(resolve, "q int, at int, score long, vec_id long")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("q", "at").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= more)
    best = best.groupBy("q", "at").agg(F.collect_list(F.struct("score", "vec_id")).alias("best"))
    places = asking.select("q", F.posexplode("qv").alias("at", "v"))
    # One row per distinct vector, so that many queries of one vector are a skew the join can split.
    answers = places.join(best, ["q", "at"]).select("v", "best")
    named = asked.withColumnRenamed("vec_id", "query_id").join(answers, "v").select("query_id", F.inline("best"))
    named = named.where(F.col("vec_id") != F.col("query_id"))
    # A query id with several vectors keeps its best k over all of them.
    named = named.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
