"""Vectorised work on the bytes of Arrow text columns: words, hashes and shingles without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at a time inside a batch; a longer text is one piece of its own.
PIECE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
OTHER_BASE = 0xC2B2AE3D27D4EB4F | 1
_powers: dict[str, np.ndarray] = {}


def byte_table(separators: str, lower: bool = True) -> np.ndarray:
    """Maps a UTF-8 byte to itself (A-Z lower-cased on request), or to 0 when it separates words.

    ``separators`` is a character class over ASCII; bytes of longer characters never separate.
    """
    import re

    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    for code in range(128):
        if re.match(f"[{separators}]", chr(code)):
            table[code] = 0
    table[0] = 0
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column end to end, and n + 1 offsets. A null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = filled.buffers()
    if offsets is None or len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``limit`` bytes each; never splits a text."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        factors = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        have = _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, by prefix sums of a polynomial in an odd ``base``."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    terms = (values.astype(np.uint64) + np.uint64(1)) * _power(f"up{base}", base, len(values))
    total = np.cumsum(terms, dtype=np.uint64)
    raw = total[ends - 1] - total[starts] + terms[starts]
    down = _power(f"down{base}", pow(base, -1, 1 << 64), len(values))
    return mixed(raw * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, table: np.ndarray):
    """Words of the rows lo..hi: (row from 0, start, end, hash), in text order. Start and end count bytes of the piece."""
    base = offsets[lo]
    mapped = table[data[base : offsets[hi]]]
    row, starts, ends = runs((mapped != 0).view(np.uint8), offsets[lo : hi + 1] - base)
    return row, starts, ends, span_hashes(mapped, starts, ends)


def runs(kinds: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the longest stretches of one kind, kind 0 left out; ``rel`` holds the rows' offsets."""
    inside = kinds != 0
    first, last = inside.copy(), inside.copy()
    if len(inside):
        change = kinds[1:] != kinds[:-1]
        first[1:] &= change
        last[:-1] &= change
        edges = rel[1:-1]
        begin = edges[edges < len(inside)]
        first[begin] |= inside[begin]
        before = edges[edges > 0] - 1
        last[before] |= inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(rel, starts, side="right") - 1, starts, ends


def shingles(row: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (row, hash), sorted by row and hash: ``size`` consecutive words, or all words of a shorter text."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    factors = [np.uint64(x) for x in _power("shingle", 0xA0761D6478BD642F | 1, size + 1)[1:]]
    out_row, out_hash = [], []
    if n >= size:
        value = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            value += hashes[k : n - size + 1 + k] * factors[k]
        whole = row[: n - size + 1] == row[size - 1 :]
        out_row.append(row[: n - size + 1][whole])
        out_hash.append(mixed(value[whole] + np.uint64(size)))
    heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    counts = np.diff(np.r_[heads, n])
    for head, count in zip(heads[counts < size], counts[counts < size], strict=True):
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for k in range(count):
                value += hashes[head + k] * factors[k]
            out_hash.append(mixed(np.array([value + np.uint64(count)], np.uint64)))
        out_row.append(row[head : head + 1])
    rows, keys = np.concatenate(out_row), np.concatenate(out_hash)
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    fresh = np.r_[True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]
    return rows[fresh], keys[fresh]
