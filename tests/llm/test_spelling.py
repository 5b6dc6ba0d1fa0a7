"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labelloom.llm import spelling


LONG = "xyz" * 700


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def scan(docs, min_length=7, one_in=31):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % one_in == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            if len(run) >= min_length:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(((-words[v], v) for v in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def variants(rng: random.Random, word: str, n: int) -> list[str]:
    letters = "abÀÿ×ðe"
    out = []
    for _ in range(n):
        at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        out.append(word[:at] + (rng.choice(letters) if kind < 2 else "") + word[at + (kind > 0) :])
    return out


def corpus(seed: int):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdé", k=rng.choice([7, 7, 8, 9, 12]))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "ababababab", "ÀÀÀÀÀÀÀ", "straßeÿÿ"]
    words = [v for s in stems for v in [s, *variants(rng, s, 14)]]
    words += [v for w in words[:40] for v in variants(rng, w, 3)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(20)]
    docs += [(100, ("aaaaaaa " * 600) + "AAAAAAAB aaaaaab " * 30), (101, "Aaaaabb aaaaabb aaaaacb aaaaacb")]
    docs += [(None, "aaaaaaa aaaaaac aaaaaac"), (102, None), (103, ""), *[(104 + i, w) for i, w in enumerate([LONG, LONG, LONG[:-1] + "y", LONG[:-1] + "y", LONG[3:], LONG[3:]])]]
    docs += [(20, docs[3][1]), (3, docs[3][1])]
    return docs


@pytest.mark.parametrize("cells", [1, 40, spelling.GROUP_CELLS])
def test_equals_all_pairs(spark, cells):
    docs = corpus(cells)
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "'n' as n").repartition(3)
    got = sorted(map(tuple, spelling.spelling_groups(table, group_cells=cells).collect()), key=repr)
    want = scan(docs)
    assert got == want
    assert any(r[1] and r[1] != r[2] for r in want) and any(r[4] > 5 for r in want)


def test_counts_pass_on_in_parts(spark, monkeypatch):
    docs = corpus(7)
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 3)
    whole = {r.word: r.n for r in spelling._occurrences(table, "doc_id", "text", 7, 2).groupBy("word").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert {w: n for w, n in whole.items() if n >= 2} == {r[0]: r[3] for r in scan(docs, one_in=2)}


def test_empty_table_and_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(empty).count() == 0
    assert spelling.spelling_groups(spark.createDataFrame([(1, "short words only")], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_rows_shared_through_prefixes_give_the_pairs_of_a_plain_matrix(seed):
    rng = random.Random(seed)
    rows = sorted({(rng.randrange(3), "".join(rng.choices("abc", k=rng.choice([0, 1, 3, 4, 4, 5])))) for _ in range(120)})
    width = max(len(w) for _, w in rows)
    window = np.array([list(w.encode().ljust(width, b"\0")) for _, w in rows], np.uint8).reshape(len(rows), width)
    q, w = spelling.near_pairs(window, np.array([len(x) for _, x in rows]), np.array([g for g, _ in rows]))
    want = sorted((i, j) for i, (g, u) in enumerate(rows) for j, (h, v) in enumerate(rows) if g == h and u != v and one_edit(u, v))
    assert sorted(zip(q.tolist(), w.tolist(), strict=True)) == want


def test_codes_of_words():
    flat, offsets = spelling.latin_codes(pa.array(["skipped", "aÀÿ", "", "×z"])[1:])
    assert [flat[a:b].tobytes().decode("latin-1") for a, b in zip(offsets, offsets[1:], strict=False)] == ["aÀÿ", "", "×z"]
