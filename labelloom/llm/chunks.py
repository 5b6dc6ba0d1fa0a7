"""Substring dedup by content-defined chunking.

A gear hash rolls over the words of a text, h = (h << 16) + G(word) in 64 bits, so it remembers four words. A chunk ends
behind a word whose hash has STRONG leading zero bits, unless the word before had WEAK ones (the minimum of two words),
and behind one with WEAK leading zero bits if none of the REACH words before had them. Where no word out of MOST in a
row ends a chunk that way, the largest hash of the MOST ends one, ties included (the maximum, also in text that repeats).
Cuts depend on nearby words only, so an insertion shifts text without changing the chunks after it. Chunks are compared
by digest: a twice-seen Bloom filter names the suspects, only runs of suspects that could make up a whole passage are
shuffled, counted exactly, and joined into spans.

Bound: let two texts share a passage of n words, byte for byte. From word 3 on (the first is 0) both have the same
hashes, from word 3 + REACH on the same cuts by mask. In the next MOST words let c be the last cut by mask, or without
one the last largest hash: both texts cut there, and cuts by maximum behind c come from windows that begin behind c, so
both have the same until the first cut by mask, or else the first largest hash, of the last MOST words, where both cut
again. At the start 3 + REACH + MOST words are lost at most, at the end MOST - 1: 21 together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm import bloom, textops

GEAR_WORDS = 4  # words that the gear hash remembers
GEAR_SHIFT = np.uint64(64 // GEAR_WORDS)
STRONG, WEAK = 3, 2  # leading zero bits of a hash
REACH = 3  # words that must pass before a weak cut; under GEAR_WORDS, so they never lie in another text
MOST = 8  # chunks have at most so many words from one text's second cut on
FILTER_BITS = 28
MIN_WORDS = 28  # at most 21 words of a passage are lost at its ends, so this finds all of over 48 words


def gear_hashes(hashes: np.ndarray) -> np.ndarray:
    """h = (h << GEAR_SHIFT) + G(word) behind each word; older words have left the 64 bits."""
    h = np.zeros(len(hashes), np.uint64)
    for k in range(min(GEAR_WORDS, len(hashes))):
        h[k:] += hashes[: len(hashes) - k] << (GEAR_SHIFT * np.uint64(k))
    return h


def _lately(marked: np.ndarray, reach: int) -> np.ndarray:
    """Whether one of the ``reach`` words before is marked."""
    out = np.zeros(len(marked), bool)
    for k in range(1, reach + 1):
        out[k:] |= marked[:-k]
    return out


def cuts(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a chunk ends behind each word; the last word of a text always ends one."""
    n = len(hashes)
    ends = np.zeros(n, bool)
    if n == 0:
        return ends
    h = gear_hashes(hashes)
    whole = np.arange(n) - np.searchsorted(row, row) >= GEAR_WORDS - 1  # else the hash reaches over the start of the text
    weak = whole & (h >> np.uint64(64 - WEAK) == 0)
    strong = whole & (h >> np.uint64(64 - STRONG) == 0)
    masked = (strong & ~_lately(weak, 1)) | (weak & ~_lately(weak, REACH))
    ends |= masked
    ends[-1] = True
    ends[:-1] |= row[1:] != row[:-1]
    windows = n - MOST + 1
    if windows < 1:
        return ends
    total = np.r_[0, np.cumsum(masked)]
    bare = (row[:windows] == row[MOST - 1 :]) & (total[MOST:] == total[:windows])
    h = np.where(whole, h | np.uint64(1), np.uint64(0))
    best = h[:windows].copy()  # best[i] = max of h[i : i + MOST]
    for k in range(1, MOST):
        np.maximum(best, h[k : k + windows], out=best)
    for k in range(MOST):
        ends[k : k + windows] |= bare & (h[k : k + windows] == best)
    return ends


def text_chunks(column: pa.Array) -> Iterator[tuple]:
    """Per piece: (lo, hi, row, start, end, words, first key, second key) of all chunks; positions in code points.

    Blanks before a chunk's first word belong to it. Keys cover the bytes of a chunk and the GEAR_WORDS words before it,
    by which its first cut was chosen. Neighbours with equal keys are one chunk, so a word repeated is one row.
    """
    data, offsets = textops.text_bytes(column)
    table = textops.byte_table(r"\x20\x09-\x0D", lower=False)
    for lo, hi in textops.pieces(offsets):
        part, rel = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        of, begin, end, hashes = textops.words(data, offsets, lo, hi, table)
        last = np.flatnonzero(cuts(of, hashes))
        first = np.r_[0, last[:-1] + 1] if len(last) else last
        row = of[first]
        head = np.searchsorted(of, row)
        start, stop = np.where(first == head, rel[row], end[first - 1]), end[last]
        before = begin[np.maximum(first - GEAR_WORDS, head)]
        key, other = (textops.span_hashes(part, before, stop, base) for base in (textops._BASE, textops.OTHER_BASE))
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (other[1:] != other[:-1])
        heads = np.flatnonzero(fresh)
        tails = np.r_[heads[1:], len(row)] - 1 if len(heads) else heads
        points = np.r_[0, np.cumsum((part & 0xC0) != 0x80)]
        base, row = points[rel[row[heads]]], row[heads]
        yield lo, hi, row, points[start[heads]] - base, points[stop[tails]] - base, last[tails] + 1 - first[heads], key[heads], other[heads]


def _long_runs(row: np.ndarray, words: np.ndarray, seen: np.ndarray, min_words: int) -> np.ndarray:
    """Chunks in unbroken runs of seen chunks of one text with at least ``min_words`` words."""
    _, start, end = textops.runs(seen.view(np.uint8), np.searchsorted(row, np.r_[np.unique(row), row[-1] + 1]))
    total = np.r_[0, np.cumsum(words)]
    kept = np.zeros(len(row) + 1, np.int64)
    good = total[end] - total[start] >= min_words
    kept[start[good]] += 1
    kept[end[good]] -= 1
    return np.cumsum(kept)[:-1] > 0


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per span that other documents hold too: (id_col, start, end, n_words, first_<id_col>).

    A span is an unbroken run of chunks that each occur in two documents or more (behind the same words), with ``min_words`` words at least;
    start and end count code points, from 0. A document is a distinct pair of id and text: rows that repeat both are
    one, equal texts under different ids (or a null id) are two. first_<id_col> is the smallest id that holds one of
    the span's chunks (nulls aside). Null, empty and short texts have no spans. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, row, _, _, _, key, _ in text_chunks(batch.column("t")):
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            yield key[np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])]] if len(key) else key

    twice = bloom.twice_seen(source.select("t"), keys, filter_bits)
    hashed = source.withColumn("h", F.xxhash64("t"))
    schema = hashed.selectExpr("id", "h", "0 as k", "0 as s", "0 as e", "0 as w", "0L as key", "0L as other").schema

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, row, start, end, words, key, other in text_chunks(batch.column("t")):
                if len(row) == 0:
                    continue
                kept = _long_runs(row, words, bloom.contains(twice.value, key), min_words)
                place = np.arange(len(row)) - np.searchsorted(row, row)
                at = pa.array(lo + row[kept])
                ints = [pa.array(x[kept].astype(np.int32)) for x in (place, start, end, words)]
                yield pa.record_batch(
                    [batch.column("id").take(at), batch.column("h").take(at), *ints, pa.array(key[kept].view(np.int64)), pa.array(other[kept].view(np.int64))],
                    names=["id", "h", "k", "s", "e", "w", "key", "other"],
                )

    found = hashed.mapInArrow(suspects, schema)
    holder = F.struct("id", "h")
    repeated = found.groupBy("key", "other").agg(F.min(holder).alias("low"), F.max(holder).alias("high"), F.min("id").alias("first"))
    repeated = repeated.where(~F.col("low").eqNullSafe(F.col("high"))).select("key", "other", "first")
    chunks = found.join(repeated, ["key", "other"]).select("id", "h", "k", "s", "e", "w", "first").distinct()
    place = F.row_number().over(Window.partitionBy("id", "h").orderBy("k"))
    runs = chunks.withColumn("run", F.col("k") - place).groupBy("id", "h", "run")
    spans = runs.agg(F.min("s").alias("start"), F.max("e").alias("end"), F.sum("w").alias("n_words"), F.min("first").alias("first")).where(F.col("n_words") >= min_words)
    return spans.select(F.col("id").alias(id_col), "start", "end", "n_words", F.col("first").alias(f"first_{id_col}"))
