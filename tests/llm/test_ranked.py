"""Ranked search against a scan of all documents, with ties, repeats, nulls, long and empty texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import ranked, textops


def terms(text) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def scan(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        found = []
        for i, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // total
            w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own if t in bag}
            score = sum(w[t] * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in w)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed: int, n: int):
    rng = random.Random(seed)
    words = ["the", "of", "Été", "x9"] * 6 + [f"w{i}" for i in range(60)] + ["Ab", "aB", "naïve", "日本"]
    docs = [(i, " ,\n".join(rng.choices(words, k=rng.choice([1, 3, 8, 8, 8, 40])))) for i in range(n)]
    docs += [(500, "w1 w2"), (500, "w1 w2"), (None, "w1 w2"), (None, "w1 w2 w2"), (501, None), (502, ""), (503, " .,- "), (504, "w5 " * 60_000)]
    docs += [(600 + i, "the w7 w7 w8") for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(9)] + [(1, "w1 w2"), (20, None), (21, "!"), (22, "nowhere"), (None, "w1"), (23, "the")]
    return docs, items


@pytest.mark.parametrize("k,block,first,item_block", [(50, 2048, 3, 4096), (5, 4, 1, 4096), (7, 16, 2, 4), (1, 1, 1, 1)])
def test_equals_a_scan(spark, k, block, first, item_block):
    docs, items = corpus(k, 120)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as m", "'x' as score").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as rank", "3 as doc_id")
    got = ranked.ranked_search(d, q, k, block_docs=block, first_blocks=first, item_block=item_block).collect()
    assert sorted(map(tuple, got), key=repr) == scan(docs, items, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.ranked_search(docs.where("false"), items).count() == 0
    assert ranked.ranked_search(docs, items.where("false")).count() == 0
    assert ranked.ranked_search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def block_of(m, bags, width):
    rows = sorted((t, -tf, d) for d, bag in enumerate(bags) for t, tf in bag.items())
    code = np.array([r[0] for r in rows], np.int32)
    own, starts = np.unique(code, return_index=True)
    arrays = [own.astype(np.int32), np.r_[starts, len(rows)].astype(np.int32), np.array([-r[1] for r in rows], np.int32), np.array([r[2] for r in rows], np.int32)]
    return ranked.Block(m, *[a.tobytes() for a in arrays], width)


def test_bounds_hold_and_runs_below_the_cutoff_open_no_document():
    rng = random.Random(5)
    width, n = 30, 400
    bags = [Counter(rng.choices(range(width), weights=[60, 40, 30] + [1] * 27, k=12)) for _ in range(n)]
    block = block_of(97, bags, width)
    weight = np.array([3, 5, 9] + [900] * 27, np.int64)
    codes = np.array([0, 1, 2, 7, 11, 19], np.int64)
    real = np.array([sum(int(weight[t]) * int(ranked.impact(np.int64(bag[t]), 97)) for t in codes.tolist() if t in bag) for bag in bags])
    queries = ranked.Queries([(0, int(t)) for t in range(width)])
    assert block.bounds(queries, weight)[0] >= max(sum(int(weight[t]) * int(ranked.impact(np.int64(b[t]), 97)) for t in b) for b in bags)
    least = int(np.sort(real)[-20])
    found, score = block.search(codes, weight, least, n)
    assert sorted(zip(found.tolist(), score.tolist())) == [(d, s) for d, s in enumerate(real.tolist()) if s >= least]
    # Nearly every document holds one of the common terms, which cannot lift a document to the cutoff alone.
    assert (real > 0).sum() > 390 and block.opened < 200


def test_weights_are_those_of_the_formula():
    assert ranked.weights(10, np.array([0, 1, 10])).tolist() == [math.floor(1000 * math.log(22)), math.floor(1000 * math.log(22 / 3)), math.floor(1000 * math.log(22 / 21))]


def test_terms_break_where_the_class_says():
    table = textops.byte_table(ranked.TERM_BREAKS)
    keeps = {chr(c) for c in range(128) if table[c]}
    assert keeps == set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
