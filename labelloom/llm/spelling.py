"""Spelling variants: words one edit apart, by dynamic programming over sorted word lists.

Two words with one edit agree before and behind it. A word is dealt, for each window of places, into the group of
words that agree outside the window; the edit then lies inside. Windows start as halves of the word, and a group
that is too large is dealt again by half windows, down to one place, where the alphabet bounds it.

In a group, what lies in the window is compared through the sorted list of it. The edit matrix of a query against a
listed word has one row for each character; listed words share the rows of their common prefix (the adjacent LCPs
tell how long that is), so each row is computed once for the whole range of words with that prefix, as a band of
three cells. A range whose row exceeds one edit is skipped. The rows of all queries advance together, level by level.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

MIN_LENGTH = 7
MIN_COUNT = 2
DELETE_ONE_IN = 31  # of the occurrences, told by a checksum, one in so many loses a character
RATIO = 10  # a form is so many times as frequent as its variant
GROUP_CELLS = 8_192  # words times places of the window in a group; a larger one is dealt again
SHORT_WINDOW = 64  # groups of windows up to so many places are compared together
FLUSH_WORDS = 200_000  # words that a task counts before it hands them on
FAR = 9  # more edits than are looked for


def _occurrences(docs: DataFrame, id_col: str, text_col: str, min_length: int, one_in: int) -> DataFrame:
    """(word, n): words with partial counts, after the deletions."""
    run = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, data in zip(batch.column("id").to_pylist(), batch.column("t"), strict=True):
                if not data.is_valid:
                    continue
                start = zlib.crc32(f"{doc_id}:".encode())
                # Bytes lower-case A-Z only.
                for word, n in Counter(run.findall(data.as_buffer().to_pybytes().lower().decode())).items():
                    mark = zlib.crc32(word.encode(), start)
                    if mark % one_in == 0:
                        at = mark % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) >= FLUSH_WORDS:
                    yield handed(total)
                    total.clear()
        yield handed(total)

    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("t"))
    return source.mapInArrow(count, "word string, n long")


def latin_codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words end to end, one byte for each character up to U+00FF, and n + 1 offsets."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = words.buffers()
    offs = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    lead = raw >= 0xC0  # C2 or C3, followed by the low bits
    low = raw.copy()
    low[1:][raw[:-1] == 0xC3] += 0x40
    before = np.r_[0, np.cumsum(lead)]
    rel = offs - offs[0]
    return low[~lead], rel - before[rel]


def near_pairs(window: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word): all ordered pairs of rows of one group whose windows are one edit apart.

    ``window`` holds a row of characters for each word, filled with zeros beyond its ``length``; rows are sorted by
    group, then by window, and differ inside a group.
    """
    n, width = window.shape
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = group[1:] == group[:-1]
    lcp = np.full(n, -1, np.int64)
    if width:
        differs = window[1:] != window[:-1]
        lcp[1:] = np.where(same, np.where(differs.any(axis=1), differs.argmax(axis=1), width), -1)
    else:
        lcp[1:] = np.where(same, 0, -1)
    # Queries with a margin, so that places before and behind a word read as 0, which no listed character equals.
    query = np.zeros((n, width + 4), np.uint8)
    query[:, 1 : width + 1] = window
    heads = np.flatnonzero(lcp < 0)
    own = np.searchsorted(heads, np.arange(n), side="right") - 1
    lo, hi, q = heads[own], np.r_[heads, n][own + 1], np.arange(n)
    one = np.ones(n, np.int8)
    # The band of row d: the cells of d - 1, d and d + 1 characters of the query.
    band = [one * FAR, one * 0, np.where(length > 0, 1, FAR).astype(np.int8)]
    found_q, found_w = [], []
    for depth in range(width + 1):
        gap = length[q] - depth + 1
        at_end = (length[lo] == depth) & (gap >= 0) & (gap <= 2)
        edits = np.choose(np.clip(gap, 0, 2), band)
        near = at_end & (edits == 1)
        found_q.append(q[near])
        found_w.append(lo[near])
        if depth == width:
            break
        edges = np.flatnonzero(lcp <= depth)
        starts = edges[length[edges] > depth]
        first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
        many = last - first
        parent = np.repeat(np.arange(len(q)), many)
        child = starts[np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many) + first[parent]]
        end = np.r_[edges, n][np.searchsorted(edges, child, side="right")]
        q, listed, size = q[parent], window[child, depth], length[q[parent]]
        b0, b1, b2 = (b[parent] for b in band)
        n0 = np.where(depth <= size, np.minimum(b1 + 1, b0 + (query[q, depth] != listed)), FAR)
        n1 = np.where(depth + 1 <= size, np.minimum(np.minimum(b2, n0) + 1, b1 + (query[q, depth + 1] != listed)), FAR)
        n2 = np.where(depth + 2 <= size, np.minimum(n1 + 1, b2 + (query[q, depth + 2] != listed)), FAR)
        lives = np.minimum(np.minimum(n0, n1), n2) <= 1
        lo, hi, q = child[lives], end[lives], q[lives]
        band = [x[lives].astype(np.int8) for x in (n0, n1, n2)]
        if not len(q):
            break
    return np.concatenate(found_q), np.concatenate(found_w)


def _shared_groups(table: pa.Table) -> Iterator[pa.Table]:
    """The rows whose group holds several: all groups of short windows together, each group of a long window by itself."""
    columns = [table.column(c).to_numpy() for c in ("key", "short", "a", "b")]
    head = np.ones(table.num_rows + 1, bool)
    head[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    several = ~(head[:-1] & head[1:])
    wide = columns[3] - columns[2] > SHORT_WINDOW
    if (several & ~wide).any():
        yield table.filter(pa.array(several & ~wide))
    edges = np.flatnonzero(head)
    for at, end in zip(edges, edges[1:], strict=False):
        if wide[at] and end - at > 1:
            yield table.slice(at, end - at)


def _compared(table: pa.Table, ratio: int) -> pa.RecordBatch:
    """(word, near, form_n, form): near words that the groups of a table give each word, and the best form among them."""
    words = table.column("word").combine_chunks()
    n, short, a, b = (table.column(c).to_numpy() for c in ("n", "short", "a", "b"))
    key = table.column("key").to_numpy()
    flat, offsets = latin_codes(words)
    size = np.diff(offsets)
    length = size - a - (short - b)
    width = int(length.max()) if len(length) else 0
    window = np.zeros((len(size), width), np.uint8)
    inside = np.arange(width) < length[:, None]
    window[inside] = flat[((offsets[:-1] + a)[:, None] + np.arange(width))[inside]]
    group = np.cumsum(np.r_[True, (key[1:] != key[:-1]) | (short[1:] != short[:-1]) | (a[1:] != a[:-1])]) - 1 if len(key) else key
    q, w = near_pairs(window, length, group)
    # Two words of the longer length meet among words as short as themselves.
    meets = (size[q] == short[q]) | (size[w] == short[q])
    q, w = q[meets], w[meets]
    # An edit belongs to the window that holds the first place where the words differ.
    differs = window[q] != window[w]
    place = differs.argmax(axis=1) if width else np.zeros(len(q), np.int64)
    here = (place < b[q] - a[q]) | (b[q] == short[q])
    q, w = q[here], w[here]
    if len(q):
        # Groups are told apart by 64-bit hashes; what lies outside the window is compared here.
        texts = words.to_pylist()
        agree = [
            texts[x][:i] == texts[y][:i] and texts[x][len(texts[x]) - tail :] == texts[y][len(texts[y]) - tail :]
            for x, y, i, tail in zip(q.tolist(), w.tolist(), a[q].tolist(), (short - b)[q].tolist(), strict=True)
        ]
        q, w = q[agree], w[agree]
    rows, near = np.unique(q, return_counts=True)
    best: dict[int, tuple[int, str]] = {}
    fits = n[w] >= ratio * n[q]
    for x, y in zip(q[fits].tolist(), w[fits].tolist(), strict=True):
        this = (-int(n[y]), texts[y])
        if x not in best or this < best[x]:
            best[x] = this
    forms = [best.get(x) for x in rows.tolist()]
    return pa.record_batch(
        [
            words.take(pa.array(rows)),
            pa.array(near, pa.int64()),
            pa.array([-f[0] if f else None for f in forms], pa.int64()),
            pa.array([f[1] if f else None for f in forms], pa.string()),
        ],
        names=["word", "near", "form_n", "form"],
    )


def _keyed(parts: DataFrame) -> DataFrame:
    """Adds key: the group of words that agree outside the window [a, b) of a word of ``short`` characters."""
    head = F.expr("substring(word, 1, a)")
    tail = F.expr("right(word, short - b)")
    return parts.withColumn("key", F.xxhash64("short", "a", "b", head, tail))


def _windows(parts: DataFrame, middle) -> DataFrame:
    """Each window [a, b) as [a, middle) and [middle, b)."""
    halves = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
    return parts.select("word", "n", "short", F.explode(halves).alias("w")).select("word", "n", "short", "w.a", "w.b")


def _near(words: DataFrame, ratio: int, group_cells: int) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have a near word."""
    # As the shorter (or equal) of two words, and as the longer one.
    size = F.char_length("word")
    parts = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).withColumns({"a": F.lit(0), "b": F.col("short")})
    parts = _windows(parts, F.floor(F.col("short") / 2).cast("int"))
    groups = []
    while True:
        keyed = _keyed(parts)
        span = (F.col("b") - F.col("a")).alias("span")
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(span).alias("span"))
        large = sizes.where((F.col("rows") * F.col("span") > group_cells) & (F.col("span") > 1)).select("key").checkpoint()
        if large.isEmpty():
            groups.append(keyed)
            break
        groups.append(keyed.join(large, "key", "left_anti"))
        again = keyed.join(large, "key", "left_semi").drop("key")
        parts = _windows(again, F.floor((F.col("a") + F.col("b")) / 2).cast("int")).checkpoint()
    everything = groups[0].select("key", "short", "a", "b", "word", "n")
    for more in groups[1:]:
        everything = everything.unionByName(more.select("key", "short", "a", "b", "word", "n"))
    window = F.expr("substring(word, a + 1, char_length(word) - a - (short - b))")
    dealt = everything.repartition("key").sortWithinPartitions("key", "short", "a", window)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole = pa.concat_tables([rest, whole]) if rest is not None else whole
            keys = whole.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            for part in _shared_groups(whole.slice(0, cut)) if cut else ():
                yield _compared(part, ratio)
            rest = whole.slice(cut)
        for part in _shared_groups(rest) if rest is not None and rest.num_rows else ():
            yield _compared(part, ratio)

    pairs = dealt.mapInArrow(compare, "word string, near long, form_n long, form string")
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("order"), "form")))
    found = pairs.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that is reached from form to form. Each step is far more frequent, so there is no ring."""
    reached = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, one_in: int = DELETE_ONE_IN, group_cells: int = GROUP_CELLS) -> DataFrame:
    """One row for each word of the corpus: (word, form, root, n, n_near, form_n).

    Words are runs of [A-Za-z\\u00C0-\\u00FF] with A-Z lower-cased. Where ``one_in`` divides the crc32 of "id:run", the run
    loses the character at crc32 % length. Results of ``min_length`` (2 at least) characters or more that occur
    ``min_count`` times count as words, n times each. Near words are one inserted, deleted or replaced character apart; n_near counts
    them. The form is the most frequent near word (ties: smallest in code-point order) if it occurs ``ratio`` times as
    often or more, else null, and form_n its n; root is where the forms lead, the word itself if it has none. Null texts
    hold no words, a null id counts as the empty text. Repeated rows count again. Extra columns are not read; an empty
    table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    counted = _occurrences(docs, id_col, text_col, min_length, one_in).groupBy("word").agg(F.sum("n").alias("n"))
    words = counted.where(F.col("n") >= min_count).checkpoint()
    near = _near(words, ratio, group_cells).checkpoint()
    roots = _roots(near.where(F.col("form").isNotNull()))
    result = words.join(near, "word", "left").join(roots, "word", "left")
    n_near = F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", n_near, "form_n")
