"""Tokens, n-grams, vocabulary and TF-IDF as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from labelloom.functions.text import clean
from labelloom.session import small_window

# Fixed value: a token is a run of two or more word characters of cleaned text.
TOKEN = "([a-z0-9]{2,})"


def tokens(cleaned: Column) -> Column:
    return F.regexp_extract_all(cleaned, F.lit(TOKEN), F.lit(1))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All word n-grams with low <= n <= high. Each length extends the one before by a shifted zip."""
    current, parts = words, [words] if low <= 1 else []
    for n in range(2, high + 1):
        # The zip pads its end with null, and joining with null drops that entry.
        shifted = F.slice(words, n, F.size(words))
        current = F.array_compact(F.zip_with(current, shifted, lambda a, b: F.concat(a, F.lit(" "), b)))
        if n >= low:
            parts.append(current)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def with_terms(
    df: DataFrame, text: str = "text", output: str = "terms", ngram_range: tuple[int, int] = (1, 2), cleaned: bool = False
) -> DataFrame:
    """Adds the array of terms; ``cleaned`` says the text needs no cleaning any more."""
    source = F.col(text) if cleaned else clean(F.col(text))
    return (
        df.withColumn("_words", tokens(source))
        .withColumn(output, ngrams(F.col("_words"), *ngram_range))
        .drop("_words")
    )


def term_statistics(df: DataFrame, terms: str = "terms") -> DataFrame:
    """(term, tf, df): corpus and document frequency in one aggregate.

    Every row sends its terms once, in order, each beside the one before it, so that the first of equal
    terms counts for df. No row id is shuffled and counts combine in the tasks first.
    """
    ordered = F.sort_array(terms)
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), ordered), F.lit(1), F.size(ordered))
    paired = F.arrays_zip(ordered.alias("term"), before.alias("before"))
    first = ~F.col("term").eqNullSafe(F.col("before"))
    return (
        df.select(F.inline(paired).alias("term", "before"))
        .groupBy("term")
        .agg(F.count("*").alias("tf"), F.sum(first.cast("long")).alias("df"))
    )


def vocabulary(statistics: DataFrame, min_df: int = 2, max_features: int = 5000) -> DataFrame:
    """(term, tf, df, term_id): the most frequent terms, ties by name; ids follow the names."""
    kept = statistics.where(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(max_features)
    by_name = small_window().orderBy("term")
    return kept.withColumn("term_id", F.row_number().over(by_name) - 1)


def with_idf(vocab: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds the smooth idf ln((1 + n) / (1 + df)) + 1; n is the row count of the training table."""
    n = rows.agg(F.count("*")).scalar()
    return vocab.withColumn("idf", F.log((n + 1) / (F.col("df") + 1)) + 1)


def known_terms(vocab: DataFrame, max_features: int, *columns: str) -> list[Row]:
    """The rows of a vocabulary by term, held by the driver; more than ``max_features`` of them are refused."""
    found = vocab.select("term", *columns).orderBy("term").limit(max_features + 1).collect()
    if len(found) > max_features:
        raise ValueError(f"the vocabulary has more than {max_features} terms")
    return found


def constants(values: Sequence[float] | Sequence[str]) -> Column:
    """A long array as one constant, which the optimizer folds; numbers keep every digit."""
    if values and isinstance(values[0], str):
        return F.split(F.lit("\n".join(values)), "\n")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that the optimizer does not work them out again at every use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def with_weights(df: DataFrame, known: list[Row], terms: str = "terms", output: str = "weights") -> DataFrame:
    """Adds the L2-normalised tf-idf of every row as array<struct<i, weight>>, i being the place in ``known``.

    Terms are counted inside the row against the vocabulary, so nothing is shuffled. A row without any known term,
    or without terms, gets an empty array.
    """
    # No text has this term; the model needs one.
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in known] or ["\n"], "_terms", "_counts")
    counted = counter.transform(df.withColumn("_terms", F.coalesce(terms, F.array().cast("array<string>"))))
    idf = constants([r["idf"] for r in known] or [0.0])
    vector = F.unwrap_udt("_counts")
    raw = F.zip_with(
        vector["indices"], vector["values"], lambda i, tf: F.struct(i.alias("i"), (tf * F.get(idf, i)).alias("raw"))
    )
    raws = held(counted, _raw=raw)
    total = F.aggregate("_raw", F.lit(0.0), lambda acc, e: acc + e["raw"] * e["raw"])
    normed = held(raws, _norm=F.sqrt(total))
    weights = F.transform("_raw", lambda e: F.struct(e["i"].alias("i"), (e["raw"] / F.col("_norm")).alias("weight")))
    return held(normed, **{output: weights}).drop("_terms", "_counts", "_raw", "_norm")


def tfidf(df: DataFrame, vocab: DataFrame, key: str, max_features: int, terms: str = "terms") -> DataFrame:
    """Non-zero entries (key, term, weight)."""
    known = known_terms(vocab, max_features, "idf")
    names = constants([r["term"] for r in known] or [""])
    weighted = with_weights(df.select(key, terms), known, terms).select(key, F.inline("weights"))
    return weighted.select(key, F.get(names, F.col("i")).alias("term"), "weight")
