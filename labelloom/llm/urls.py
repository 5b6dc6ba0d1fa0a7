"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for the urls no rule fits.

The trees learn from the urls that the rules label. Features are column expressions: lengths, depth, digit ratio,
entropy, parameter counts, signs of the host, and how often its suffix was blocked among the labelled urls.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

# Rules (verdict, host, path): a rule fits its host and all hosts below it, if the path starts with the rule's.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
FIT_ROWS = 20_000  # most labelled urls that the trees are fitted on
PRIOR_ROWS = 20.0  # weight of the overall share in the share of a suffix
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "dots", "hyphens", "ends_html", "suffix_share"]


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty for a null url or one without "://"."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.expr(f"substring(coalesce({url}, ''), instr(coalesce({url}, ''), '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; equal lengths go to the earlier rule."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _lexical(df: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("__url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    times = lambda x, of: F.length(of) - F.length(F.replace(of, x))
    signs = F.array_distinct(F.split(url, ""))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c))) / n
    entropy = F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(F.greatest(share(c), F.lit(1e-9))))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.select(
        "*",
        n.alias("length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        times(F.lit("/"), F.col("path")).cast("double").alias("depth"),
        (F.length(F.regexp_replace(url, r"[^0-9]", "")) / n).alias("digit_ratio"),
        entropy.alias("entropy"),
        F.when(query == "", F.lit(0.0)).otherwise((times(F.lit("&"), query) + 1).cast("double")).alias("parameters"),
        times(F.lit("."), F.col("host")).cast("double").alias("dots"),
        times(F.lit("-"), F.col("host")).cast("double").alias("hyphens"),
        F.col("path").endswith(".html").cast("double").alias("ends_html"),
        F.substring_index("host", ".", -1).alias("suffix"),
    )


def filter_urls(pages: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add host, path, rule, verdict (allow or block) and block_score (of the trees) to every row of ``pages``.

    The longest rule that fits decides, else the trees: block from 0.5. They are fitted on the ``fit_rows`` labelled urls
    of the smallest hashes. If the rules label urls of one kind only, the rest gets that verdict; without any, allow.
    Null and odd urls have empty parts and are judged by the trees. Repeated urls get equal verdicts. Columns of these
    names are replaced, others pass unchanged; an empty table stays empty.
    """
    rules = RULES if rules is None else rules
    ensure_checkpoint_dir(pages.sparkSession)
    new = ["host", "path", "rule", "verdict", "block_score"]
    pages = pages.drop(*new)
    names = pages.columns
    host, path = url_parts(f"`{url_col}`")
    parts = pages.withColumn("__url", F.col(url_col)).withColumn("host", host).withColumn("path", path)
    parts = parts.withColumn("__r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("rule", F.col("__r.rule")).withColumn("__label", F.col("__r.verdict")).drop("__r")
    blocked = (F.col("__label") == "block").cast("double")
    labelled = parts.where(F.col("__label").isNotNull())
    bySuffix = labelled.groupBy(F.substring_index("host", ".", -1).alias("suffix")).agg(F.count(F.lit(1)).alias("n"), F.sum(blocked).alias("bad")).checkpoint()
    total, bad = bySuffix.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    if not total or bad in (0, total):
        verdict = "block" if total and bad else "allow"
        score = F.lit(float(verdict == "block"))
        return parts.select(*names, "host", "path", "rule", F.coalesce("__label", F.lit(verdict)).alias("verdict"), score.alias("block_score"))
    share = (F.coalesce("bad", F.lit(0.0)) + PRIOR_ROWS * bad / total) / (F.coalesce("n", F.lit(0)) + PRIOR_ROWS)
    with_share = lambda df: _lexical(df).join(bySuffix, "suffix", "left").withColumn("suffix_share", share)
    sample = labelled.select("__url", "host", "path", "__label").orderBy(F.xxhash64("__url"), "__url").limit(fit_rows)
    table = with_share(sample).select(blocked.alias("label"), F.xxhash64("__url").alias("o"), *FEATURES)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__x")
    # A bounded sample in a fixed order: the same trees every time.
    fitted = assembler.transform(table.coalesce(1).sortWithinPartitions("o", *FEATURES)).select("label", F.col("__x").alias("features")).checkpoint()
    model = GBTClassifier(maxIter=8, maxDepth=4, stepSize=0.3, seed=1).fit(fitted)
    model.setFeaturesCol("__x")
    judged = model.transform(assembler.transform(with_share(parts)))
    block_score = vector_to_array("probability")[1]
    method = F.when(block_score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(*names, "host", "path", "rule", F.coalesce("__label", method).alias("verdict"), block_score.alias("block_score"))
