"""One query per operator, over its whole table with production parameters, and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import chunks, decontaminate, html, jaccard, licenses, linededup, mixing, quality, ranked, sharding, spelling, topk, urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT r, unnest(a) AS line, generate_subscripts(a, 1) AS i FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
g AS (SELECT r, count(*) AS n_lines, count(f.key) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '') AS kept
      FROM k LEFT JOIN f USING (key) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM g JOIN d USING (r)
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.dedup_lines(docs, min_docs=10, min_chars=1, keep="none")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: a join on shared shingles in SQL emits all pairs inside the groups of copies."""
    docs = table(spark, sf_dir, "documents")
    return jaccard.similar_classes(docs).select("doc_id", "n_shingles", "component_id")


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: chunk cuts come from a rolling hash over bytes."""
    return chunks.repeated_spans(table(spark, sf_dir, "documents"))


def remainder(key: str) -> Column:
    """crc32 of the id as text, modulo 3: remainder 1 is held out of training."""
    return F.crc32(F.col(key).cast("string")) % 3


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: a trained model; tests hold it against held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id") != 1)
    held_out = F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out")
    return quality.score_quality(docs, labels).select("doc_id", held_out, "score", "predicted")


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: labels and scores come from the automaton's chains."""
    return licenses.digest(table(spark, sf_dir, "documents"))


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: pages are parsed."""
    return html.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised().alias("v"))
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("""
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, greatest(1, round_even(240 * pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM c), 0))::INTEGER AS share,
             (row_number() OVER (ORDER BY source NULLS FIRST) - 1)::INTEGER AS k FROM c),
z AS (SELECT list(share ORDER BY k) AS shares, list(n ORDER BY k) AS sizes, sum(share)::INTEGER AS len FROM w),
p AS (
  SELECT -1 AS slot, -1 AS k, list_transform(shares, lambda x: 0) AS done, list_transform(shares, lambda x: 0) AS prior FROM z
  UNION ALL
  SELECT slot + 1, pick, list_transform(done, lambda x, i: CASE WHEN i = pick + 1 THEN x + 1 ELSE x END), done
  FROM (SELECT p.slot, p.done, z.len,
               list_min(list_filter(list_transform(p.done, lambda x, i:
                 CASE WHEN x < z.shares[i] AND (x * z.len) // z.shares[i] <= p.slot + 1
                      THEN (((x + 1) * z.len + z.shares[i] - 1) // z.shares[i]) * 100000 + i - 1 END), lambda y: y IS NOT NULL)) % 100000 AS pick
        FROM p, z) WHERE slot + 1 < len),
t AS (SELECT slot, k, prior[k + 1] AS nth, prior FROM p WHERE slot >= 0),
i AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source
             ORDER BY md5('0:' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS i FROM documents),
b AS (SELECT i.doc_id, i.source, i.i, i.i // 16 AS block, w.k, (i.i // 16) // w.share AS r, (i.i // 16) % w.share AS nth
      FROM i JOIN w ON i.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, source, block::BIGINT AS block, (r * z.len + t.slot)::BIGINT AS slot,
       (list_sum(list_transform(t.prior, lambda x, j: least(z.sizes[j], (r * z.shares[j] + x) * 16))) + b.i % 16)::BIGINT AS position
FROM b JOIN t ON b.k = t.k AND b.nth = t.nth, z
""")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query()
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: urls without a rule are judged by trained trees."""
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are the hits: a document and a benchmark item that it holds. Tests compare with a brute-force scan."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs.select("doc_id", "text"), items)


# crc32 of a text in SQL: the table of the 256 remainders, then one step for each UTF-8 byte.
_CRC_TABLE = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps)"""


def _sql_crc32(text: str) -> str:
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {data}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


@query(f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, {_sql_crc32("coalesce(text, '')")} AS text_crc32 FROM documents, crc),
j AS (
  SELECT r, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS k, 0::BIGINT AS b, 0::BIGINT AS ahead FROM d
  UNION ALL
  SELECT r, nk, ahead, floor((ahead + 1) * (2147483648::DOUBLE / (nk // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM (SELECT r, ahead, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS nk FROM j WHERE ahead < 25)),
s AS (SELECT r, max(b) FILTER (WHERE b < 24) AS shard, max(b) AS grown_shard FROM j GROUP BY r)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ',' || size || ',' || text_crc32), doc_id, size, text_crc32) - 1 AS slot
FROM d JOIN s USING (r)
""")
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 8).cast("long").alias("size")
    rows = table(spark, sf_dir, "documents").select("doc_id", size, F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    sharded = sharding.with_shards(rows, "doc_id", 24, grown=True)
    return sharding.numbered(sharded, ["doc_id", "size", "text_crc32"])


def _sql_terms(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[^{ranked.TERM_BREAKS}]+')"


@query(f"""
WITH q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_sql_terms("text")}) AS term FROM benchmark)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_terms("text")} AS a FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(a))::BIGINT AS n_terms FROM d WHERE len(a) > 0),
p AS (SELECT r, doc_id, len(a) AS n, unnest(a) AS term FROM d),
t AS (SELECT r, term, any_value(doc_id) AS doc_id, any_value(n) AS n, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, s GROUP BY term),
i AS (SELECT r, term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part FROM t JOIN w USING (term), s),
f AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(part)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM f WHERE score > 0 QUALIFY rank <= 50
""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query(f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY doc_id, run),
h AS (SELECT run, n, {_sql_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM c, crc),
v AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT DISTINCT word, near FROM (
  SELECT a.word, b.word AS near FROM x a JOIN x b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT x.word, w.word FROM x JOIN w ON x.cut = w.word
  UNION ALL SELECT w.word, x.word FROM x JOIN w ON x.cut = w.word)),
g AS (SELECT p.word, a.n, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near
      FROM p JOIN w a ON a.word = p.word JOIN w b ON b.word = p.near
      QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, p.near) = 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
      FROM w LEFT JOIN g USING (word)),
t AS (SELECT word, word AS root, 0 AS d FROM f
      UNION ALL SELECT t.word, f.form, d + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(root, d) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM f JOIN t USING (word) GROUP BY word, form
""")
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))
