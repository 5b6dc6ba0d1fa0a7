"""Quality classifier: random-indexing word vectors, pooled per document, and a small numpy network.

Word vectors come from the whole corpus: every word adds the sparse random index vectors of its neighbours. Words are
counted over all texts; the most frequent ones have a vector each, the others share a fixed number of hashed ones, so
the table of vectors has a fixed size. The network is fitted on a bounded sample of labelled rows; its probabilities
are calibrated by a temperature on rows it was not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import bloom, textops

VOCABULARY = 8192  # words with a vector of their own
TAIL = 2048  # vectors that all other words share by their hash
SLOTS = VOCABULARY + TAIL
DIMS = 48
NONZERO = 2
WINDOW = 2
HIDDEN = 24
PIECE_BYTES = 1 << 19  # the table of context sums is passed once for each piece, so pieces are not too small
FIT_ROWS = 20_000  # most labelled rows that the network is fitted on


def _kinds() -> np.ndarray:
    """Byte kinds: 0 white space, 1 letter, 2 digit, and one kind for each other ASCII character."""
    kinds = np.ones(256, np.uint8)
    for code in range(128):
        c = chr(code)
        kinds[code] = 0 if code <= 32 or code == 127 else 1 if c.isalpha() else 2 if c.isdigit() else code + 3
    return kinds


_KINDS = _kinds()


def words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, row, key) of the words of each piece: runs of letters, of digits, or of one sign, by their hashes."""
    data, offsets = textops.text_bytes(column)
    for lo, hi in textops.pieces(offsets, PIECE_BYTES):
        part = data[offsets[lo] : offsets[hi]]
        row, start, end = textops.runs(_KINDS[part], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, row, textops.span_hashes(part, start, end)


def vocabulary(docs: DataFrame, text_col: str, size: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words of all texts, ties by the hash."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, key in words(batch.column(0)):
                found, n = np.unique(key, return_counts=True)
                yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    counts = docs.select(text_col).mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))


def word_slots(column: pa.Array, vocab: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, row, slot) of the words of each piece: the place in the vocabulary, or a shared slot behind it."""
    for lo, hi, row, key in words(column):
        slot = VOCABULARY + (key % np.uint64(TAIL)).astype(np.int64)
        if len(vocab):
            at = np.minimum(np.searchsorted(vocab, key), len(vocab) - 1)
            slot = np.where(vocab[at] == key, at, slot)
        yield lo, hi, row, slot


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For every slot the positions and signs of its few nonzero components, from a fixed rule."""
    h = textops.mixed(np.arange(1, SLOTS * NONZERO + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)).reshape(SLOTS, NONZERO)
    return (h % np.uint64(DIMS)).astype(np.int64), np.where(h >> np.uint64(63), 1, -1)


def word_vectors(docs: DataFrame, text_col: str, vocab: np.ndarray) -> np.ndarray:
    """SLOTS x DIMS vectors: context sums over all texts, squashed and of length 1."""
    position, sign = index_vectors()

    def accumulate(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(SLOTS * DIMS)
        for batch in batches:
            for _, _, row, slot in word_slots(batch.column(0), vocab):
                for gap in range(1, WINDOW + 1):
                    near = row[gap:] == row[:-gap]
                    a, b = slot[gap:][near], slot[:-gap][near]
                    for k in range(NONZERO):
                        for word, context in ((a, b), (b, a)):
                            total += np.bincount(word * DIMS + position[context, k], sign[context, k], SLOTS * DIMS)
        return total.astype(np.int64)

    sums = bloom.summed(docs.select(text_col), accumulate, SLOTS * DIMS).reshape(SLOTS, DIMS).astype(np.float64)
    length = np.sqrt((sums**2).sum(1, keepdims=True))
    # A slot's own index vector keeps slots apart that share their contexts.
    own = np.zeros((SLOTS, DIMS))
    for k in range(NONZERO):
        np.add.at(own, (np.arange(SLOTS), position[:, k]), sign[:, k])
    return (sums / np.maximum(length, 1) + own / np.sqrt(NONZERO)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    """One row per text: the mean vector of its words, zero without words."""
    out = np.zeros((len(column), DIMS), np.float32)
    for lo, hi, row, slot in word_slots(column, vocab):
        n = np.bincount(row, minlength=hi - lo)
        full = np.flatnonzero(n)
        if len(full):
            heads = np.cumsum(n)[full] - n[full]
            for at in range(0, len(full), 64):  # bounded memory: the vectors of some texts at a time
                some = full[at : at + 64]
                first, last = heads[at], heads[at + len(some) - 1] + n[some[-1]]
                out[lo + some] = np.add.reduceat(vectors[slot[first:last]], heads[at : at + len(some)] - first, axis=0) / n[some, None]
    return out


@dataclass(frozen=True)
class Network:
    """Two layers: tanh, then a logistic output with a temperature. Without weights, a constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple | None
    constant: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.02, decay: float = 1e-3) -> Network:
    """Full-batch Adam on four fifths of the rows, all weighted alike, the temperature on the others."""
    mean, scale = (x.mean(0), x.std(0) + 1e-4) if len(x) else (0.0, 1.0)
    if len(x) < 10 or y.min() == y.max():
        return Network(mean, scale, None, float(y.mean()) if len(y) else 0.5)
    held = np.arange(len(x)) % 5 == 4
    z, t = ((x - mean) / scale)[~held], y[~held].astype(np.float64)
    rng = np.random.default_rng(7)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        hidden = np.tanh(z @ params[0] + params[1])
        out = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -50, 50)))
        d = (out - t) / len(t)
        back = d[:, None] * params[2] * (1 - hidden**2)
        grads = [z.T @ back + decay * params[0], back.sum(0), hidden.T @ d + decay * params[2], d.sum(keepdims=True)]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, tuple(params), float(y.mean()))
    raw, truth = net.logits(x[held]), y[held]
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(truth == 1, -raw, raw) / t).mean() for t in grid]
    return Network(mean, scale, tuple(params), float(y.mean()), float(grid[int(np.argmin(loss))]))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add score (double, 0 to 1: likelier label 1) and predicted (int, score >= 0.5) to every row of ``docs``.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1; other values and nulls are left out); of its rows, the
    ``fit_rows`` with the smallest id hashes are fitted on. Only the text makes the score: a null text counts as
    empty, equal texts score alike. Without labels of both kinds every row gets their mean, or 0.5 without any.
    Columns named score or predicted are replaced, the others pass unchanged. Empty tables work.
    """
    spark = docs.sparkSession
    docs = docs.drop("score", "predicted")
    vocab = vocabulary(docs, text_col)
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text_col, vocab))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    sample = marked.orderBy(F.xxhash64("id"), "id", "y").limit(fit_rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("t"), vectors.value, vocab)
            yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y"), batch.column("o")], names=["x", "y", "o"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    # The sample has fit_rows rows at most, so it may be broadcast.
    labelled = texts.join(F.broadcast(sample), "id").select("t", "y", F.xxhash64("id", "t").alias("o"))
    rows = labelled.mapInArrow(features, "x binary, y int, o long").orderBy("o", "x", "y").limit(fit_rows).collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(-1, DIMS).astype(np.float64)
    network = spark.sparkContext.broadcast(fit(x, np.array([r.y for r in rows], np.int64)))
    names = docs.columns
    schema = docs.select(*names, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = network.value.probabilities(pooled(batch.column(text_col), vectors.value, vocab))
            yield pa.record_batch([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(scored, schema)
