import html
import re

import pytest
from pyspark.sql import functions as F

from labelloom.functions import text as t
from labelloom.operators.rows import clean_table

CLEANED = [
    ("hi @joséluis ok", "hi ok"),
    ("#café time", "caf time"),
    ("mail josé.p@ex.com now", "mail now"),
    ("AT&amp;T &lt;b&gt; &nbsp; ok", "at t ok"),
    ("www.foo.com/é bar", "bar"),
    ("don't! what?", "don't! what?"),
    ("<p>hi</p> a<b", "hi a b"),
    ("@user_name, #tag-two", "tag two"),
    ("see https://x.org/a?b=1&c=2 end", "see end"),
    ("a\u00a0b\u2003c\x1cd", "a b c d"),
    (None, ""),
    ("   ", ""),
]


def apply(spark, values, function, *args, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"), *args, **kw)).collect()]


def test_cleaning_traps(spark):
    assert apply(spark, [c[0] for c in CLEANED], t.clean) == [c[1] for c in CLEANED]


def test_cleaning_options(spark):
    out = apply(spark, ["Hi @me at www.x.io #Tag"], t.clean, lowercase=False, drop_urls=False, drop_mentions=False, keep_hashtag_word=False)
    assert out == ["i me at www x io"]


def test_clean_table_keeps_source_column_and_drops_empty(spark):
    df = spark.createDataFrame([("a",), ("@x",), (None,)], "text string")
    out = clean_table(df, "text", "cleaned", drop_empty=True)
    assert [tuple(r) for r in out.collect()] == [("a", "a")]


def test_entities_match_the_standard_library(spark):
    values = ["&eacute;&#233;&#xe9;", "&amp;lt;", "&copy2", "no entity", "&bogus; &", None]
    assert apply(spark, values, t.unescape_entities) == [None if v is None else html.unescape(v) for v in values]


def test_normal_form_and_word_count(spark):
    assert apply(spark, ["It's 3 O'Clock, OK?", "123", ""], t.normal_form) == ["it's o'clock ok", "", ""]
    assert apply(spark, ["a b", "", "a"], t.word_count) == [2, 0, 1]


def test_strip_takes_every_unicode_space(spark):
    assert apply(spark, ["\u3000\x85 x \u2028\x1f"], t.strip) == ["x"]


def test_sentence_case_changes_one_character(spark):
    assert apply(spark, ["  wow, That", "", "I am"], t.sentence_case) == ["Wow, That", "", "I am"]


def test_fill_template(spark):
    df = spark.createDataFrame([("{opener_cap}? {middle_cap} {ending}", "wait", "it came", "at all.")], "t string, o string, m string, e string")
    filled = df.select(t.squeeze(t.fill_template(F.col("t"), F.col("o"), F.col("m"), F.col("e")))).first()[0]
    assert filled == "Wait? It came at all."


def test_valid_text(spark):
    assert apply(spark, ["a", " \t", None, ""], t.has_text) == [True, False, False, False]


@pytest.mark.parametrize("text", ["plain words", "MiXed CASE 12 it's", "tab\tand\nline"])
def test_normal_form_matches_a_plain_scan(spark, text):
    assert apply(spark, [text], t.normal_form) == [" ".join(re.findall("[a-zA-Z']+", text.lower()))]


def test_cleaning_looks_for_what_is_kept(spark):
    """Replacing all that is not kept took six times as long; the results are the same."""
    texts = ["", " ", "!", "a", " Ab c!!  d?'", "é\U0001f600x퟿ y", "--", "\n1\n\n2\t", "q" * 300 + "…" * 300 + "r"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    cleaned = frame.select("text", t.clean(F.col("text")).alias("cleaned"))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "[^a-z0-9!?']" not in plan
    assert all(r.cleaned == re.sub(r"[^a-z0-9!?']+", " ", r.text.lower()).strip() for r in cleaned.collect())


def test_entities_are_decoded_in_small_batches(spark):
    """An Arrow batch holds 10,000 pages, however long they are."""
    frame = spark.createDataFrame([(None,), ("a &amp; b",), ("c",)], "text string")
    decoded = frame.select(t.unescape_entities(F.col("text")).alias("text"))
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [r.text for r in decoded.collect()] == [None, "a & b", "c"]
