"""Gear hashes and cuts against a plain loop, null ids, and the bound on what a passage loses."""

from __future__ import annotations

import random

import numpy as np

from labelloom.llm import chunks


def plain_cuts(words: list[int]) -> list[bool]:
    """The rule word by word: a rolling hash, masks, and the maximum of bare windows."""
    h, hashes = 0, []
    for w in words:
        h = ((h << 16) + w) % 2**64
        hashes.append(h)
    whole = [i >= chunks.GEAR_WORDS - 1 for i in range(len(words))]
    zeros = lambda i, bits: 0 <= i and whole[i] and hashes[i] < 2 ** (64 - bits)
    masked = [
        (zeros(i, chunks.STRONG) and not zeros(i - 1, chunks.WEAK)) or (zeros(i, chunks.WEAK) and not any(zeros(i - k, chunks.WEAK) for k in range(1, chunks.REACH + 1)))
        for i in range(len(words))
    ]
    ends = masked[:]
    value = [hashes[i] | 1 if whole[i] else 0 for i in range(len(words))]
    for s in range(len(words) - chunks.MOST + 1):
        window = range(s, s + chunks.MOST)
        if not any(masked[i] for i in window):
            for i in window:
                ends[i] |= value[i] == max(value[j] for j in window)
    if ends:
        ends[-1] = True
    return ends


def test_cuts_equal_a_rolling_loop():
    rng = random.Random(3)
    vocabulary = [rng.getrandbits(64) for _ in range(300)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 7, 8, 9, 200]))] for _ in range(60)]
    texts += [[v] * 40 for v in vocabulary[:30]] + [[*vocabulary[k : k + 3]] * 20 for k in range(30)]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = chunks.cuts(row, np.array([w for t in texts for w in t], np.uint64))
    assert got.tolist() == [e for t in texts for e in plain_cuts(t)]


def test_shared_passages_lose_at_most_21_words():
    rng = random.Random(4)
    for _ in range(400):
        vocabulary = [rng.getrandbits(64) for _ in range(rng.choice([1, 2, 3, 10, 1000]))]
        passage = [rng.choice(vocabulary) for _ in range(51)]
        sides = []
        for _ in range(2):
            before, after = ([rng.getrandbits(64) for _ in range(rng.randint(0, 20))] for _ in range(2))
            ends = np.flatnonzero(plain_cuts(before + passage + after)) - len(before)
            sides.append([int(e) for e in ends])
        first = max(min(e for e in s if e >= 3 + chunks.REACH and set(x for x in s if e <= x < 51 - chunks.MOST) == set(x for x in o if e <= x < 51 - chunks.MOST) and e in o) for s, o in (sides, sides[::-1]))
        last = max(set(sides[0]) & set(sides[1]) & set(range(51)))
        assert first + 1 <= 3 + chunks.REACH + chunks.MOST and 50 - last <= chunks.MOST - 1


def test_null_ids_and_other_columns(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(None, passage), (None, passage), (1, "so " + passage), (2, None), (3, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as start", "1 as id", "2 as h")
    spans = chunks.repeated_spans(docs).collect()
    assert sorted(str(r.doc_id) for r in spans) == ["1", "None"] and {r.first_doc_id for r in spans} == {1}
