"""Word vectors and vocabulary of the quality classifier against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from labelloom.llm import quality

TEXTS = ["the cat sat on the mat", None, "", "the dog -- the dog 12 12 !", "The cat", "x" * 5000 + " the"] * 3


def plain_words(text):
    return re.findall(r"[A-Za-z]+|[0-9]+|([^\sA-Za-z0-9])\1*", text or "") and [
        m.group(0) for m in re.finditer(r"[A-Za-z]+|[0-9]+|([^\sA-Za-z0-9])\1*", text or "")
    ]


def keys(text):
    return [k for _, _, _, key in quality.words(pa.array([text])) for k in key.tolist()]


def test_vocabulary_holds_the_most_frequent_words(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(4)
    n = Counter(w for t in TEXTS for w in plain_words(t))
    ranked = sorted(n, key=lambda w: (-n[w], np.uint64(keys(w)[0]).view(np.int64)))
    for size in (1, 3, 5):
        got = quality.vocabulary(docs, "text", size)
        assert got.tolist() == sorted(keys(w)[0] for w in ranked[:size])
    assert len(quality.vocabulary(docs, "text")) == len(n)
    assert quality.vocabulary(docs.limit(0), "text").tolist() == []


def test_slots_are_own_for_known_words_and_shared_for_the_tail():
    vocab = np.sort(np.array(keys("the cat"), np.uint64))
    (_, _, row, slot), = quality.word_slots(pa.array(["the cat the", "dog"]), vocab)
    assert row.tolist() == [0, 0, 0, 1]
    assert slot[0] == slot[2] != slot[1] and max(slot[:3]) < 2 and slot[3] >= quality.VOCABULARY
    (_, _, _, bare), = quality.word_slots(pa.array(["the"]), np.zeros(0, np.uint64))
    assert bare[0] >= quality.VOCABULARY


def test_vectors_are_context_sums_and_pooling_is_their_mean(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    vocab = quality.vocabulary(docs, "text")
    vectors = quality.word_vectors(docs, "text", vocab)
    position, sign = quality.index_vectors()
    index = np.zeros((quality.SLOTS, quality.DIMS))
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.SLOTS), position[:, k]), sign[:, k])
    place = {key: i for i, key in enumerate(vocab.tolist())}
    sums = np.zeros((quality.SLOTS, quality.DIMS))
    slots = [[place[k] for k in keys(t)] for t in TEXTS]
    for text in slots:
        for i, word in enumerate(text):
            for j in range(max(0, i - quality.WINDOW), min(len(text), i + quality.WINDOW + 1)):
                if j != i:
                    sums[word] += index[text[j]]
    length = np.maximum(np.sqrt((sums**2).sum(1, keepdims=True)), 1)
    want = sums / length + index / np.sqrt(quality.NONZERO)
    np.testing.assert_allclose(vectors, want, atol=1e-5)
    got = quality.pooled(pa.array(TEXTS), vectors, vocab)
    for row, text in zip(got, slots, strict=True):
        np.testing.assert_allclose(row, want[text].mean(0) if text else np.zeros(quality.DIMS), atol=1e-4)


def test_repeated_null_and_very_long_rows_and_clashing_names(spark):
    long = "good plain words about things " * 20_000
    texts = [(1, "a", long), (1, "a", long), (2, None, None), (3, "c", ""), (None, "d", "words"), (4, "e", "junk junk junk")]
    docs = spark.createDataFrame([(i, s, t, 9.0, "p") for i, s, t in texts], "doc_id long, source string, text string, score double, predicted string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (9, 1), (2, 5)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == 6 and rows[0].__fields__ == ["doc_id", "source", "text", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.text or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by.values())
