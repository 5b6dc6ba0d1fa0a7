"""Exact Jaccard join of word shingle sets by adaptive multi-match prefixes, as connected classes.

1. A set can only have a partner if enough of its smallest tokens by hash occur elsewhere; a twice-seen Bloom filter
   leaves the tokens for which that may hold, and these are counted exactly. Only sets with enough of them go on.
2. Equal sets become one node. Tokens of a node are ordered from rare to frequent by a counting sketch. Each
   node lengthens its prefix from the sketch's estimate of its candidates: with l - 1 more tokens, a partner has
   to share l tokens of the prefix before it is verified.
3. Each token first links its holders to one hub (pairs linear in the postings). Holders that are in one class by
   then need no comparison. What is left is compared across classes: short lists send pairs, long lists are cut
   into blocks and verified inside the tasks, which send a spanning set of links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from labelloom.llm import bloom, textops
from labelloom.llm.batches import small_batches
from labelloom.llm.components import components
from labelloom.session import ensure_checkpoint_dir

FILTER_BITS = 27  # of the sieve: 16 MB to broadcast, at any input size
COMMON_BITS = 26  # of the filter over the sets that passed it
SKETCH_SLOTS = 20
EXTRA = 10  # a twentieth let sets of chance matches pass on 0.5 GB: 16 % of the tokens counted were enough, now 27 %
EXTENSIONS = (1, 2, 4, 8, 16, 32)
SHORT_LIST = 24  # posting lists up to this length send pairs; longer ones are verified in blocks
BLOCK_ROWS = 512
CARRIED = 512  # sets up to this size travel with their postings in long lists
VERIFY_COST = 4.0  # cost of a verification, in posting reads
CHUNK_TOKENS = 1 << 20  # suspected tokens, and
CHUNK_ROWS = 1 << 16  # rows that a task counts among themselves before it hands them on
BATCH_ROWS = 1000  # rows with one or two sets each that Python gets at a time

_SEPARATORS = r"\x20\x09-\x0D"


def _need(n, num: int, den: int):
    """Least overlap of a set of n with any partner."""
    return -(-num * n // den)


def _need_larger(n, num: int, den: int):
    """Least overlap of a set of n with a partner that is not smaller."""
    return -(-2 * num * n // (num + den))


def text_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, row within the piece, sorted distinct shingle hashes) for each piece of a text column."""
    table = textops.byte_table(_SEPARATORS)
    data, offsets = textops.text_bytes(column)
    for lo, hi in textops.pieces(offsets):
        row, _, _, hashes = textops.words(data, offsets, lo, hi, table)
        yield lo, hi, *textops.shingles(row, hashes, size)


def _extra(n, num: int, den: int):
    """Tokens that two sets must share among their smallest ones, beyond the one that is certain: a share of them."""
    return np.maximum(1, np.minimum(n // EXTRA, _need(n, num, den)))


def _shared(n, num, den):
    """Least number of its smallest tokens that a set of n shares with any partner, which may be smaller."""
    return _extra(_need(n, num, den), num, den)


def _digests(keys: np.ndarray, heads: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    return [xxhash.xxh3_128_digest(keys[h : h + m].tobytes()) if m else None for h, m in zip(heads, n, strict=True)]


class _Chunk:
    """Rows of a task with their suspected tokens, until they are handed on."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.names, self.types = names, types
        self.ids, self.hashes, self.n, self.digests, self.tokens, self.owners = [], [], [], [], [], []
        self.rows = self.size = 0

    def add(self, ids: pa.Array, hashes: pa.Array, n: np.ndarray, digests: list, tokens: np.ndarray, owners: np.ndarray) -> None:
        self.ids.append(ids), self.hashes.append(hashes), self.n.append(n), self.digests.extend(digests)
        self.tokens.append(tokens), self.owners.append(owners + self.rows)
        self.rows += len(n)
        self.size += len(tokens)

    def _batch(self, size: int, **columns) -> pa.RecordBatch:
        arrays = [columns[c] if c in columns else pa.nulls(size, t) for c, t in zip(self.names, self.types, strict=True)]
        return pa.record_batch([a.cast(t) for a, t in zip(arrays, self.types, strict=True)], names=self.names)

    def handed(self) -> Iterator[pa.RecordBatch]:
        """The rows; for each set how many suspected tokens another set of the chunk holds; and each token once."""
        n = np.concatenate(self.n)
        own = np.array([int.from_bytes(d[:8], "little", signed=True) if d else 0 for d in self.digests], np.int64)
        yield self._batch(self.rows, id=pa.concat_arrays(self.ids), h=pa.concat_arrays(self.hashes), n=pa.array(n), d=pa.array(self.digests, pa.binary()), k=pa.array(own))
        sets, first, code = np.unique(own, return_index=True, return_inverse=True)
        token, owner = np.concatenate(self.tokens), code[np.concatenate(self.owners)]
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        fresh = np.ones(len(token), bool)  # a copy of the set adds nothing
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner = token[fresh], owner[fresh]
        head = np.ones(len(token), bool)
        head[1:] = token[1:] != token[:-1]
        group = np.cumsum(head) - 1
        several = (np.bincount(group) > 1) if len(group) else np.zeros(0, bool)
        counted = np.bincount(owner[several[group]], minlength=len(sets)) if len(group) else np.zeros(len(sets), np.int64)
        held = n[first] > 0
        yield self._batch(int(held.sum()), k=pa.array(sets[held]), n=pa.array(n[first][held]), c=pa.array(counted[held]))
        at = np.flatnonzero(head)
        yield self._batch(len(at), t=pa.array(token[at].view(np.int64)), k=pa.array(sets[owner[at]]), several=pa.array(several))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, c): how many tokens of each set, sent to be confirmed, another set holds. Rows come sorted by token."""
    rest: pa.Table | None = None

    def counted(part: pa.Table) -> pa.RecordBatch:
        t, k, several = (part.column(c).to_numpy(zero_copy_only=False) for c in ("t", "k", "several"))
        heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        low, high = np.minimum.reduceat(k, heads), np.maximum.reduceat(k, heads)
        shared = (low != high) | np.logical_or.reduceat(several, heads)
        own = k[np.repeat(shared, np.diff(np.r_[heads, len(t)])) & ~several]
        sets, c = np.unique(own, return_counts=True)
        return pa.record_batch([pa.array(sets, pa.int64()), pa.array(c, pa.int64())], names=["k", "c"])

    for batch in batches:
        whole = pa.Table.from_batches([batch])
        whole = pa.concat_tables([rest, whole]) if rest is not None else whole
        tokens = whole.column("t").to_numpy()
        cut = int(np.searchsorted(tokens, tokens[-1])) if len(tokens) else 0
        if cut:
            yield counted(whole.slice(0, cut))
        rest = whole.slice(cut)
    if rest is not None and rest.num_rows:
        yield counted(rest)


def _profiles(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h, n, d, k) of all documents, and k of the sets that may have a partner.

    Partners share a set number of their smallest tokens by hash. Two Bloom filters over those tell which of them may
    occur in two sets; these are counted exactly, inside a chunk of rows first, and once for each chunk between chunks,
    so that a token that very many documents hold sends one row a chunk. A set with fewer suspected tokens than a
    partner needs sends none: neither it nor any set that it could be counted for loses a link.
    """

    def smallest(column: pa.Array):
        for lo, hi, rows, keys in text_sets(column, size):
            n = np.bincount(rows, minlength=hi - lo)
            heads = np.cumsum(n) - n
            prefix = n - _need(n, num, den) + _extra(n, num, den)
            yield lo, hi, rows, keys, n, heads, np.arange(len(keys)) - heads[rows] < prefix[rows]

    def prefix_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, _, keys, _, _, small in smallest(batch.column("t")):
            yield keys[small]

    twice = bloom.twice_seen(docs.select(F.col(text_col).alias("t")), prefix_keys, filter_bits)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    schema = source.selectExpr("id", "h", "0L as n", "cast(null as binary) as d", "0L as k", "0L as c", "0L as t", "true as several").schema
    schema = StructType([StructField(f.name, f.dataType) for f in schema])  # each kind of row leaves some columns null
    names, types = schema.names, list(to_arrow_schema(schema).types)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(names, types)
        for batch in batches:
            for lo, hi, rows, keys, n, heads, small in smallest(batch.column("t")):
                at = np.flatnonzero(small)
                at = at[bloom.contains(twice.value, keys[at])]
                enough = np.bincount(rows[at], minlength=hi - lo) >= _shared(n, num, den)
                at = at[enough[rows[at]]]
                chunk.add(batch.column("id").slice(lo, hi - lo), batch.column("h").slice(lo, hi - lo), n, _digests(keys, heads, n), keys[at], rows[at])
                if chunk.size >= CHUNK_TOKENS or chunk.rows >= CHUNK_ROWS:
                    yield from chunk.handed()
                    chunk = _Chunk(names, types)
        if chunk.rows:
            yield from chunk.handed()

    everything = source.select("id", "t", "h").mapInArrow(profile, schema).checkpoint()
    rows = everything.where(F.col("h").isNotNull()).select("id", "h", "n", "d", "k")
    sent = everything.where(F.col("t").isNotNull()).select("t", "k", "several")
    replies = sent.repartition("t").sortWithinPartitions("t").mapInArrow(_confirmed, "k long, c long")
    local = everything.where(F.col("c").isNotNull()).select("k", "c", "n", F.lit(1).alias("chunks"))
    counts = local.unionByName(replies.select("k", "c", F.lit(None).cast("long").alias("n"), F.lit(0).alias("chunks")))
    counts = counts.groupBy("k").agg(F.sum("c").alias("c"), F.max("n").alias("n"), F.sum("chunks").alias("chunks"))
    least = lambda n: F.floor((F.lit(num) * n + F.lit(den - 1)) / F.lit(den))
    partner = least(F.col("n"))
    shared = F.greatest(F.lit(1), F.least(F.floor(partner / EXTRA), least(partner)))
    return rows, counts.where(F.col("c") >= shared * F.col("chunks")).select("k").checkpoint()


def _nodes(docs: DataFrame, rows: DataFrame, passing: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(d, n, tokens) of the passing sets, read again from one document each, so that no set is shuffled.

    A filter picks the documents; the few others that it lets pass are nodes without partners or repeat a node.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "h"))
    chosen = rows.join(passing, "k", "left_semi").groupBy("d").agg(first.alias("one")).select(F.xxhash64("one.id", "one.h").alias("key")).checkpoint()
    wanted = bloom.may_hold(bloom.members(chosen, chosen.count()))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    source = source.where(wanted(F.xxhash64("id", F.xxhash64("t")))).select("t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            for lo, hi, rows, keys in text_sets(batch.column("t"), size):
                n = np.bincount(rows, minlength=hi - lo)
                heads = np.cumsum(n) - n
                digests = _digests(keys, heads, n)
                fresh = [i for i, d in enumerate(digests) if d and d not in known and not known.add(d)]
                own = [keys[heads[i] : heads[i] + n[i]].tobytes() for i in fresh]
                yield pa.record_batch([pa.array([digests[i] for i in fresh], pa.binary()), pa.array(n[fresh], pa.int64()), pa.array(own, pa.binary())], names=["d", "n", "tokens"])

    return source.mapInArrow(sets, "d binary, n long, tokens binary").checkpoint()


def _postings(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(token, d, n, place, matches, score) for the prefix tokens that other nodes hold; tokens go from rare to frequent."""

    def all_tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for tokens in batch.column("tokens").to_pylist():
            yield textops.mixed(np.frombuffer(tokens, np.uint64))

    counts = bloom.frequencies(nodes.select("tokens"), all_tokens, SKETCH_SLOTS)
    # Tokens that only one node holds come first in the order and need no posting.
    common = bloom.twice_seen(nodes.select("tokens"), all_tokens, COMMON_BITS)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, tokens in zip(batch.column("d").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                keys = np.frombuffer(tokens, np.uint64)
                n, need, code = len(keys), _need(len(keys), num, den), textops.mixed(keys)
                held = bloom.contains(common.value, code)
                if held.sum() < need:
                    continue  # too few tokens that another node holds
                often = np.where(held, bloom.estimated(counts.value, code).astype(np.int64), 1)
                order = np.lexsort((keys, often, held))
                keys, often, alone = keys[order], often[order], n - int(held.sum())
                work = np.cumsum(often - 1)
                choices = [m for m in EXTENSIONS if m <= need]
                # At most work / m sets can share m tokens of the prefix: reading its lists plus verifying those.
                cost = [work[n - need + m - 1] * (1 + VERIFY_COST / m) for m in choices]
                m = choices[int(np.argmin(cost))]
                place = np.arange(alone, n - need + m, dtype=np.int32)
                size, score = len(place), int(work[n - need])
                if size:
                    yield pa.record_batch(
                        [
                            pa.array(keys[place].view(np.int64)),
                            pa.array([d] * size, pa.binary()),
                            pa.array(np.full(size, n, np.int32)),
                            pa.array(place),
                            pa.array(np.full(size, m, np.int32)),
                            pa.array(np.full(size, score, np.int64)),
                        ],
                        names=["token", "d", "n", "place", "matches", "score"],
                    )

    return nodes.select("d", "tokens").mapInArrow(postings, "token long, d binary, n int, place int, matches int, score long")


def _overlap(x: bytes, y: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))


def _verified(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Only sets of such pairs are moved."""
    pairs = pairs.checkpoint()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct().select(F.xxhash64("d").alias("key")).checkpoint()
    asked = bloom.may_hold(bloom.members(ends, ends.count()))
    sets = nodes.where(asked(F.xxhash64("d"))).select("d", "tokens")
    wide = pairs.join(sets.withColumnsRenamed({"d": "a", "tokens": "x"}), "a").join(sets.withColumnsRenamed({"d": "b", "tokens": "y"}), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                both = _overlap(x, y)
                good.append(den * both >= num * ((len(x) + len(y)) // 8 - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return wide.select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary")


class _List:
    """One block pair of a token's posting list, compared across classes."""

    def __init__(self, rows: dict[str, np.ndarray], num: int, den: int):
        self.rows, self.num, self.den = rows, num, den

    def pairs(self) -> tuple[list, list, list, list]:
        r, num, den = self.rows, self.num, self.den
        count, n, m, place = len(r["d"]), r["n"].astype(np.int64), r["matches"].astype(np.int64), r["place"].astype(np.int64)
        if count < 2:
            return [], [], [], []
        as_small, as_large = n - _need_larger(n, num, den), n - _need(n, num, den)
        i, j = np.triu_indices(count, 1)
        across = r["class"][i] != r["class"][j]
        if r["lo"] != r["hi"]:
            across &= r["block"][i] != r["block"][j]
        i, j = i[across], j[across]
        swap = n[i] > n[j]
        s, t = np.where(swap, j, i), np.where(swap, i, j)
        close = den * n[s] >= num * n[t]
        match = np.minimum(m[s], m[t])
        # Equal sizes: either may be the smaller one, and the overlap that both need is the larger set's too.
        base_t = np.where(n[s] == n[t], as_small[t], as_large[t])
        close &= (place[s] < as_small[s] + match) & (place[t] < base_t + match)
        s, t, match = s[close], t[close], match[close]
        tokens = r["tokens"]
        carried = np.array([x is not None for x in tokens])
        inside = carried[s] & carried[t]
        a, b, need, sure = list(s[~inside]), list(t[~inside]), list(match[~inside]), [False] * int((~inside).sum())
        if inside.any():
            s, t = s[inside], t[inside]
            both = self._overlaps(tokens, s, t)
            good = den * both >= num * (n[s] + n[t] - both)
            for x, y in self._spanning(s[good], t[good]):
                a.append(x), b.append(y), need.append(0), sure.append(True)
        return [r["d"][k] for k in a], [r["d"][k] for k in b], [int(x) for x in need], sure

    @staticmethod
    def _overlaps(tokens: list, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        used = np.unique(np.r_[s, t])
        at = {k: i for i, k in enumerate(used)}
        flat = [np.frombuffer(tokens[k], np.uint64) for k in used]
        owner = np.repeat(np.arange(len(used)), [len(x) for x in flat])
        _, code, often = np.unique(np.concatenate(flat), return_inverse=True, return_counts=True)
        shared = often[code] > 1
        code, owner = np.unique(code[shared], return_inverse=True)[1], owner[shared]
        if len(s) < 4 * len(used):
            return np.array([_overlap(tokens[x], tokens[y]) for x, y in zip(s, t, strict=True)], np.int64)
        total = np.zeros((len(used), len(used)), np.float32)
        width = int(code.max()) + 1 if len(code) else 0
        for at_code in range(0, width, 4096):
            part = (code >= at_code) & (code < at_code + 4096)
            grid = np.zeros((len(used), min(4096, width - at_code)), np.float32)
            grid[owner[part], code[part] - at_code] = 1
            total += grid @ grid.T
        return total[[at[x] for x in s], [at[x] for x in t]].astype(np.int64)

    @staticmethod
    def _spanning(s: np.ndarray, t: np.ndarray) -> Iterator[tuple[int, int]]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(s.tolist(), t.tolist(), strict=True):
            if (p := root(x)) != (q := root(y)):
                parent[p] = q
                yield x, y


def _across(postings: DataFrame, nodes: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, need, sure) from posting lists that hold several classes."""
    marked = postings.join(classes.withColumnsRenamed({"node": "d"}), "d", "left").withColumn("class", F.coalesce("root", "d")).drop("root", "score")
    # A window shuffles the postings once; totals joined to them would shuffle them twice.
    holders = Window.partitionBy("token")
    lists = marked.select("*", F.count(F.lit(1)).over(holders).alias("df"), F.min("class").over(holders).alias("low"), F.max("class").over(holders).alias("high"))
    rows = lists.where(F.col("low") != F.col("high")).drop("low", "high").withColumn("parts", F.ceil(F.col("df") / F.lit(BLOCK_ROWS)).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("d"), F.col("parts")).cast("int"))
    # A row of block b goes to the pairs (b, c) of all blocks c of its list; short lists have one block.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    small = nodes.where(F.col("n") <= CARRIED).select("d", "tokens")
    long_lists = rows.where(F.col("df") > SHORT_LIST).join(small, "d", "left")
    rows = long_lists.unionByName(rows.where(F.col("df") <= SHORT_LIST).withColumn("tokens", F.lit(None).cast("binary")))
    columns = ["token", "lo", "hi", "block", "d", "n", "place", "matches", "class", "tokens"]
    spread = rows.select(*columns).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def flush(group: pa.Table):
            one = {c: group.column(c).to_pylist() for c in ("d", "class", "tokens")}
            codes = {c: i for i, c in enumerate(dict.fromkeys(one["class"]))}
            rows = {c: group.column(c).to_numpy() for c in ("n", "place", "matches", "block")}
            rows |= {"d": one["d"], "tokens": one["tokens"], "class": np.array([codes[c] for c in one["class"]])}
            rows |= {"lo": group.column("lo")[0].as_py(), "hi": group.column("hi")[0].as_py()}
            return _List(rows, num, den).pairs()

        def emit(found: list) -> pa.RecordBatch:
            a, b, need, sure = (sum(x, []) for x in zip(*found, strict=True)) if found else ([], [], [], [])
            low, high = [min(p) for p in zip(a, b, strict=True)], [max(p) for p in zip(a, b, strict=True)]
            return pa.record_batch([pa.array(low, pa.binary()), pa.array(high, pa.binary()), pa.array(need, pa.int32()), pa.array(sure, pa.bool_())], names=["a", "b", "need", "sure"])

        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole = pa.concat_tables([rest, whole]).combine_chunks() if rest is not None else whole
            keys = [whole.column(c).to_numpy() for c in ("token", "lo", "hi")]
            cut = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1])) + 1
            edges = [0, *cut.tolist()]
            yield emit([flush(whole.slice(x, y - x)) for x, y in zip(edges, edges[1:], strict=False)])
            rest = whole.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield emit([flush(rest)])

    return spread.mapInArrow(compare, "a binary, b binary, need int, sure boolean")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: tuple[int, int] = (80, 100), filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per input row: (id_col, n_shingles, component_id, set_digest, text_hash).

    Texts are lower-cased (A-Z) and split at [\\x20\\x09-\\x0D]; the set holds distinct ``size``-word shingles, or all
    words as one shingle of a shorter text. Rows link when den * |x & y| >= num * |x | y| for threshold (num, den).
    component_id is the smallest id reachable by links, null ids aside. A null, empty or blank text has an empty
    set (n_shingles 0, null digest) and links with nothing. Repeated rows link as equal sets. Other columns,
    also clashing names, are not read. Shingles are told apart by 64-bit hashes. An empty table stays empty.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # All work on sets is done when this returns, so the setting covers it.
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return _classes(docs, id_col, text_col, size, *threshold, filter_bits)


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int, filter_bits: int) -> DataFrame:
    rows, passing = _profiles(docs, id_col, text_col, size, num, den, filter_bits)
    nodes = _nodes(docs, rows, passing, id_col, text_col, size)
    postings = _postings(nodes, num, den).checkpoint()

    hub = F.max(F.struct("score", "d", "n")).over(Window.partitionBy("token"))
    to_hub = postings.select("token", "d", "n", hub.alias("hub")).where(F.col("d") != F.col("hub.d"))
    to_hub = to_hub.where(den * F.least("n", "hub.n") >= num * F.greatest("n", "hub.n"))
    to_hub = to_hub.select(F.least("d", "hub.d").alias("a"), F.greatest("d", "hub.d").alias("b")).distinct()
    links = _verified(to_hub, nodes, num, den).checkpoint()
    classes = components(links)

    found = _across(postings, nodes, classes, num, den).checkpoint()
    counted = found.where(~F.col("sure")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("need").alias("need"))
    more = _verified(counted.where(F.col("shared") >= F.col("need")).select("a", "b"), nodes, num, den)
    links = links.unionByName(found.where("sure").select("a", "b")).unionByName(more)
    classes = components(links)

    lows = rows.where(F.col("d").isNotNull()).groupBy("d").agg(F.min("id").alias("low"))
    lowest = classes.join(lows.withColumnRenamed("d", "node"), "node").groupBy("root").agg(F.min("low").alias("component_id"))
    linked = classes.join(lowest, "root").select(F.col("node").alias("d"), "component_id")
    named = lows.join(linked, "d", "left").select("d", F.coalesce("component_id", "low").alias("component_id"))
    result = rows.select("id", "h", "n", "d").join(named, "d", "left")
    component = F.coalesce("component_id", "id").alias("component_id")
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component, F.col("d").alias("set_digest"), F.col("h").alias("text_hash"))


def without_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of linked rows stays: the one with the smallest id, then text hash; null ids come last.

    Rows with an empty set all stay. Of rows that repeat id and text one stays. Columns pass unchanged.
    """
    rows = similar_classes(docs, id_col, text_col).where(F.col("n_shingles") > 0).withColumnRenamed(id_col, "__id").checkpoint()
    # Rows without a component id have neither an id nor a partner that has one; their equal sets are one class.
    of = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("set_digest"))]
    best = rows.groupBy(*[c.alias(f"c{i}") for i, c in enumerate(of)]).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("text_hash").alias("h"))).alias("one"))
    best = best.where(F.col("n") > 1).select("c0", "c1", F.col("one.id").alias("id"), F.col("one.h").alias("h")).checkpoint()
    member = rows.select("__id", F.col("text_hash").alias("__h"), *[c.alias(f"m{i}") for i, c in enumerate(of)])
    grouped = member.join(best, F.col("m0").eqNullSafe(F.col("c0")) & F.col("m1").eqNullSafe(F.col("c1")))
    copies = grouped.select("__id", "__h").distinct()
    losers = copies.join(best.select("id", "h"), F.col("__id").eqNullSafe(F.col("id")) & (F.col("__h") == F.col("h")), "left_anti")
    repeated = rows.groupBy("__id", F.col("text_hash").alias("__h")).count().where(F.col("count") > 1).select("__id", "__h").checkpoint()
    losers = losers.select("__id", "__h").checkpoint()
    # Texts are many times larger than these lists: only rows that a list may name take part in the joins.
    listed = losers.unionByName(repeated).select(F.xxhash64("__id", "__h").alias("key")).checkpoint()
    named = bloom.may_hold(bloom.members(listed, listed.count()))(F.xxhash64(id_col, F.xxhash64(text_col)))
    marked = docs.withColumn("__named", named)
    own = marked.where("__named").withColumn("__own", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__h"))
    kept = own.join(losers, same, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, "__own"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return marked.where(~F.col("__named")).select(*docs.columns).unionByName(kept.select(*docs.columns))
