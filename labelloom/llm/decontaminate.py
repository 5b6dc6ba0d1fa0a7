"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units behind numbers and capitalised words become typed placeholders; what remains is a template that a
re-parameterised question shares with its original. Windows of templates are joined by hash, at every position of a text:
first only to find the texts that hold any window of any item, then to compare these. An item's windows have WINDOW
words, or all of a shorter item, whatever other items there are. A window counts when its slots are consistent: along one alignment, a value of the item always
stands for the same value of the text. Windows of the plain lower-cased words are joined too, so that a change of case
hides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir

WINDOW = 6
MIN_WORDS = 5  # shorter items cannot be told from chance and are left out
COVER = 0.6  # share of an item's windows that a text has to hold
HINTED_ROWS = 1_000_000  # tables up to this many narrow rows are broadcast; larger ones are joined by shuffle

# Unit words that a number may have.
UNITS = "km|m|cm|mm|mi|miles?|ft|feet|foot|inch|inches|yards?|kg|g|mg|lbs?|pounds?|ounces?|oz|tons?|l|ml|liters?|litres?|gallons?|s|ms|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|usd|eur|mph|kmh|kw|kwh|w|v|hz|khz|mhz|ghz|kb|mb|gb|tb"
_NUMBER = r"\p{N}+(?:_\p{N}+)*"
_AFTER = r"(?![\p{L}\p{M}])"  # a number may follow: 5h30, 5 m²


def _words(text: Column, inside: str) -> Column:
    return F.filter(F.split(text, rf"[^\p{{L}}\p{{M}}{inside}]+"), lambda w: w != "")


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that the optimizer does not work them out again at every use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def formed(df: DataFrame, text: str, values: bool = False) -> DataFrame:
    """Replace ``text`` by word arrays of equal length: a, the template; b, lower-cased words with typed numbers; on request v, the values.

    All are cut from one marked text: inside numbers [.,:] become _, units behind numbers are set apart with a ~ in
    front. Marks replace characters of words by characters of words, so the arrays cannot differ in length.
    """
    clean = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[#@~_]", " ")
    marked = F.regexp_replace(F.regexp_replace(clean, r"(?<=\p{N})[.,:](?=\p{N})", "_"), rf"(?i)(\p{{N}})\s*({UNITS}){_AFTER}", "$1 ~$2 ")
    df = _held(df, __marked=marked).drop(text)
    df = _held(df, __typed=F.regexp_replace(F.regexp_replace("__marked", _NUMBER, "#"), r"~\p{L}+", "~"))
    columns = {"a": _words(F.regexp_replace("__typed", r"\p{Lu}[\p{L}\p{M}]*", "@"), "#@~"), "b": _words(F.lower("__typed"), "#~")}
    if values:
        columns["v"] = F.transform(_words(F.lower("__marked"), r"\p{N}_~"), lambda w: F.ltrim(w, F.lit("~")))
    return _held(df, **columns).drop("__marked", "__typed")


def _hashed(df: DataFrame, *words: str) -> DataFrame:
    """Add ``h`` + name, the hashes of the words of an array column."""
    return _held(df, **{f"h{w}": F.transform(w, lambda x: F.xxhash64(x)) for w in words})


def _windows(df: DataFrame, words: tuple[str, ...], widths: list[int], own: str | None = None) -> DataFrame:
    """Replace ``words``, arrays of hashed words of equal length, by (at, h): start and hash of every window of every width.

    With ``own``, a row has windows of the width in that column only. Positions are rows and every word is read by its
    place, so that windows are hashed in generated code; slices would copy the words of each one.
    """
    last = F.size(words[0]) - min(widths)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    placed = df.select("*", F.explode(starts).alias("at"))
    fits = lambda n: (F.size(words[0]) - F.col("at") >= n) & (F.col(own) == n if own else F.lit(True))
    hashes = [F.when(fits(n), F.xxhash64(*[F.get(F.col(w), F.col("at") + k) for k in range(n)])) for n in widths for w in words]
    return placed.select(*[c for c in df.columns if c not in words], "at", F.explode(F.array(*hashes)).alias("h")).where(F.col("h").isNotNull())


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(HINTED_ROWS + 1).count() <= HINTED_ROWS else df


def text_key(text: str) -> list[Column]:
    """Two 64-bit hashes that stand for a whole text."""
    return [F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k1"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(1)).alias("k2")]


def leaked_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """(k1, k2, item_id, cover, exact): the distinct texts, by ``text_key``, that hold an item's template.

    cover is the share of the item's windows found with consistent slots; exact says that all of them carry the item's
    own values. Items of equal words are searched once and all named. Null and short texts or items give nothing.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    items = formed(benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")), "t", values=True)
    items = items.where(F.size("a") >= MIN_WORDS).checkpoint()
    width = F.least(F.lit(window), F.size("a"))
    widths = sorted(r[0] for r in items.select(width).distinct().collect())  # at most window - MIN_WORDS + 1
    if not widths:
        return docs.sparkSession.createDataFrame([], "k1 long, k2 long, item_id long, cover double, exact boolean")
    groups = items.groupBy("a", "b", "v").agg(F.collect_set("item_id").alias("ids")).withColumn("g", F.xxhash64("v", "a")).withColumn("width", width).checkpoint()
    spots = _windows(_hashed(groups, "a", "b").select("g", "width", "ha", "hb"), ("ha", "hb"), widths, "width").select("g", "at", "h").distinct().checkpoint()
    wanted_hashes = _hinted(spots.select("h").distinct())

    probes = _hashed(formed(docs.select(*text_key(text_col), F.col(text_col).alias("t")), "t"), "a", "b")
    probes = _windows(probes.select("k1", "k2", "ha", "hb"), ("ha", "hb"), widths).drop("at")
    found = probes.join(wanted_hashes, "h", "left_semi").select("k1", "k2").distinct().checkpoint()
    texts = docs.select(*text_key(text_col), F.col(text_col).alias("t")).join(_hinted(found), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("t").alias("t"))
    texts = formed(texts, "t", values=True).withColumnsRenamed({"a": "ta", "b": "tb", "v": "tv"}).checkpoint()

    places = _windows(_hashed(texts, "ta", "tb").select("k1", "k2", "hta", "htb"), ("hta", "htb"), widths).withColumnRenamed("at", "pos")
    hits = places.join(spots, "h").select("k1", "k2", "g", "pos", "at").distinct()
    wide = hits.join(texts, ["k1", "k2"]).join(groups.select("g", "a", "v", "width"), "g")
    part = lambda c, at: F.slice(c, F.col(at) + 1, F.col("width"))
    slots = F.filter(F.arrays_zip(part("a", "at").alias("kind"), part("v", "at").alias("item"), part("tv", "pos").alias("text")), lambda s: s["kind"].rlike("[#@~]"))
    pairs = F.transform(slots, lambda s: F.struct(s["item"].alias("item"), s["text"].alias("text")))
    slotted = wide.select("k1", "k2", "g", "at", (F.col("pos") - F.col("at")).alias("line"), pairs.alias("pairs"))
    # Along a line the pairs of an item's slots are bounded by the item's length.
    lines = slotted.groupBy("k1", "k2", "g", "line").agg(F.collect_set("at").alias("ats"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    even = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    same = F.forall("pairs", lambda p: p["item"].eqNullSafe(p["text"]))
    good = lines.where(even).select("k1", "k2", "g", same.alias("same"), F.explode("ats").alias("at"))
    score = good.groupBy("k1", "k2", "g").agg(F.count_distinct("at").alias("n"), F.every("same").alias("exact"))
    sized = groups.select("g", "ids", (F.size("a") - F.col("width") + 1).alias("all"))
    kept = score.join(sized, "g").withColumn("cover", F.col("n") / F.col("all")).where(F.col("cover") >= cover)
    return kept.select("k1", "k2", F.explode("ids").alias("item_id"), "cover", "exact")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, item_id, cover, exact) for every row of ``docs`` whose text holds an item; repeated rows repeat."""
    leaks = leaked_texts(docs.select(text_col), benchmark, text_col).checkpoint()
    return docs.select(id_col, *text_key(text_col)).join(leaks, ["k1", "k2"]).drop("k1", "k2")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with their columns unchanged."""
    leaks = leaked_texts(docs.select(text_col), benchmark, text_col).select("k1", "k2").distinct().checkpoint()
    k1, k2 = text_key(text_col)
    keyed = docs.withColumn("__k1", k1).withColumn("__k2", k2)
    return keyed.join(_hinted(leaks.toDF("__k1", "__k2")), ["__k1", "__k2"], "left_anti").select(*docs.columns)
