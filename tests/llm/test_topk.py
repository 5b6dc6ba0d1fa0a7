"""The three phases on matrices: nothing that reaches a cutoff is lost, and skewed vectors are mostly left unread."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import topk


def vectors(rng: np.random.Generator, n: int, width: int, skewed: bool) -> np.ndarray:
    x = rng.normal(size=(n, width))
    if skewed:  # energy falls along a hidden order of components, norms differ by vector
        x *= (0.8 ** np.arange(width))[rng.permutation(width)] * rng.lognormal(0, 0.7, (n, 1))
    return np.floor(256 * x)


@pytest.mark.parametrize("skewed", [False, True])
@pytest.mark.parametrize("lists", [1, 2, 3, 4, 7])
def test_all_totals_that_reach_the_cutoff_are_found(skewed, lists):
    rng = np.random.default_rng(lists)
    both = vectors(rng, 2550, 24, skewed)
    qs, cs = both[:50], both[50:]
    total = qs @ cs.T
    at, score = topk.local_best(qs, cs, lists, 6)
    least = np.array([np.sort(score[at == q])[-6] for q in range(50)])
    least[:3] = -np.inf, -1e6, 0
    want = total >= least[:, None]
    at, near, score, _ = topk.reaching(qs, cs, least, lists)
    assert want.sum() == len(at) and want[at, near].all() and (score == total[at, near]).all()


def test_under_half_of_the_entries_of_skewed_vectors_are_read():
    rng = np.random.default_rng(9)
    both = vectors(rng, 20_100, 64, skewed=True)
    qs, cs = both[:100], both[100:]
    at, score = topk.local_best(qs, cs, topk.LISTS, 6)
    least = np.array([np.sort(score[at == q])[-6] for q in range(100)])
    *_, read = topk.reaching(qs, cs, least, topk.LISTS)
    assert read < 0.5 * len(qs) * len(cs) * topk.LISTS


def test_sums_beyond_doubles_are_exact():
    big = 3_000_000_019
    qs, cs = topk._exact(np.array([[big, -1]]), np.array([[big, 1], [big, 2], [1, big]]))
    at, near, score, _ = topk.reaching(qs, cs, np.array([big * big - 1], object), 2)
    assert list(zip(at.tolist(), near.tolist(), score.tolist(), strict=True)) == [(0, 0, big * big - 1)]


def test_columns_of_clashing_names_and_one_vector_for_all(spark):
    rows = [(k, [1, 2]) for k in range(50)] + [(100, [3, 3])]
    table = spark.createDataFrame(rows, "vec_id long, v array<long>").withColumn("score", F.lit("x")).withColumn("block", F.lit(1)).withColumn("q", F.lit(2))
    got = topk.exact_top_k(table, table, 2).collect()
    assert len(got) == 2 * len(rows)
    assert {(r.vec_id, r.score) for r in got if r.query_id == 7} == {(100, 9), (0, 5)} and {r.vec_id for r in got if r.query_id == 100} == {0, 1}
