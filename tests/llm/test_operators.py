"""The training-data operators against plain Python on small tables, with nulls, empty tables, ties and repeats."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from labelloom.llm import chunks, decontaminate, html, jaccard, licenses, linededup, mixing, quality, topk, urls

DOCS = "doc_id long, text string, source string"


def text_of(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefg", k=4)) for _ in range(n))


def near_copy(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for at in rng.sample(range(len(words)), edits):
        words[at] = "".join(rng.choices("hijkl", k=5))
    return " ".join(words)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# 1 top-k ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_top_k_matches_brute_force_with_ties_and_ragged_vectors(spark, lists):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 3) for _ in range(rng.choice([3, 4, 4]))]) for i in range(60)]
    rows += [(100 + i, [1, 1, 1, 1]) for i in range(30)] + [(200, [0, 0, 0, 0]), (201, []), (202, None), (None, [9, 9, 9, 9]), (0, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.exact_top_k(table, table.where("vec_id % 10 = 0"), 5, lists).collect()}
    real = {(i, tuple(v)) for i, v in rows if i is not None and v is not None}
    want = {}
    for q, v in real:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in real if i != q)[:5]
            want |= {(q, r): (i, -s) for r, (s, i) in enumerate(scored, 1)}
    assert got == want


def test_top_k_of_empty_tables_and_bad_components(spark):
    empty = spark.createDataFrame([], "vec_id long, v array<long>")
    assert topk.exact_top_k(empty, empty).count() == 0
    vectors = spark.createDataFrame([(1, [0.5, float("nan")]), (2, [0.5, None]), (3, [-0.001]), (4, None), (5, [float("inf")])], "vec_id long, embedding array<float>")
    assert [r.v for r in vectors.select(topk.quantised().alias("v")).collect()] == [None, None, [-1], None, None]


# 2 line dedup -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_keys", [0, 1000])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup_matches_brute_force(spark, keep, broadcast_keys):
    rows = [(2, "a\n X \nb", "s"), (1, "x\n\nc\nx", "s"), (3, None, None), (4, "", "s"), (10, "\tx", "s"), (None, "a", "s"), (2, "a\n X \nb", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_lines", F.lit("clash"))
    got = sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in linededup.dedup_lines(docs, min_docs=2, keep=keep, broadcast_keys=broadcast_keys).collect()))
    keys = [[k.strip(" \t\n\v\f\r") for k in lower(t or "").split("\n")] for _, t, _ in rows]
    often = {k for ks in keys for k in ks if k and sum(k in other for other in keys) >= 2}
    first = {k: min(((i is not None, i or 0), ks.index(k), t) for (i, t, _), ks in zip(rows, keys, strict=True) if k in ks) for k in often}
    want = []
    for (i, t, _), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [line for n, (line, k) in enumerate(zip(lines, ks, strict=True)) if k not in often or (keep == "first" and first[k] == ((i is not None, i or 0), n, t))]
        want.append((i or 0, "\n".join(kept), len(lines), len(lines) - len(kept)))
    assert got == sorted(want)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


# 3 mixing -----------------------------------------------------------------------------------------------------------


def test_mix_places_every_row_within_one_block_of_its_share(spark):
    rows = [(i, None, s) for s, n in (("a", 700), ("b", 300), (None, 90), ("c", 3)) for i in range(n)] + [(None, None, "a")] * 2
    docs = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix_sources(docs, block_rows=4, slots=30).collect()
    assert sorted(r.position for r in mixed) == list(range(len(rows)))
    ordered = sorted(mixed, key=lambda r: r.position)
    assert [r.slot for r in ordered] == sorted(r.slot for r in mixed)
    share = {s: max(1, round(30 * n**0.5 / sum(m**0.5 for m in (702, 300, 90, 3)))) for s, n in (("a", 702), ("b", 300), (None, 90), ("c", 3))}
    length = sum(share.values())
    last = {s: max(r.slot for r in mixed if r.source == s) for s in share}
    for s in share:  # while the source lasts, its blocks are less than one away from its share
        slots = {r.slot for r in mixed if r.source == s}
        done = 0
        for t in range(last[s]):
            done += t in slots
            assert abs(done - (t + 1) * share[s] / length) < 1
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# 4 licenses ---------------------------------------------------------------------------------------------------------


def test_license_scan_finds_phrases_and_notices(spark):
    notice = licenses.TEMPLATES[3][1]
    rows = [
        (1, "Used under the MIT License, under the mit license; Apache License, Version 2.0", "s"),
        (2, "blah " + notice.replace("binary", "object").upper() + " blah", "s"),
        (3, None, "s"), (4, "", "s"), (5, "Licensed under the Apache License, Version 2.0. CC-BY-NC é the the", "s"),
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x"))).collect()}
    for i, text, _ in rows:
        words = licenses.template_words(text or "")
        starts = [(k, p) for p in licenses.BASE_PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in starts]
        base = ",".join(sorted({licenses.BASE_PHRASES[p] for _, p in starts}))
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == (len(words), len(at), min(at, default=None), max(at, default=None), base)
    assert got[2].labels == "bsd" and 0.8 <= got[2].score < 1 and got[2].spans[0].start == 1
    assert got[3].labels == "" and got[3].score == 0 and got[1].score == 1
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


# 5 urls -------------------------------------------------------------------------------------------------------------


def test_url_rules_and_trees(spark):
    rows = [(i, f"http://{'x-' * (i % 2)}h{i}.example.{'net/es' if i % 2 else 'com'}/{i}") for i in range(60)]
    odd = [(100, None), (101, "no scheme"), (102, "http://WWW.Example.com/en/x?y#z"), (103, "http://example.com/EN/"), (104, "http://notexample.com/en/"), (105, "https://com"), (106, "http://shop.org/a")]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string")
    got = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert len(got) == 67 and {r.verdict for r in got.values()} <= {"allow", "block"}
    assert (got[100].host, got[100].path, got[100].rule) == ("", "", None) and (got[101].host, got[101].rule) == ("", None)
    assert (got[102].host, got[102].path, got[102].rule, got[102].verdict) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (got[103].rule, got[104].rule, got[105].rule, got[106].rule) == ("com/", "com/", None, None)
    assert got[1].rule == "net/es/" and got[1].verdict == "block"
    assert urls.filter_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages.where("page_id = 106")).collect()} == {"allow"}


# 6 decontamination --------------------------------------------------------------------------------------------------


def test_decontamination_catches_copies_and_new_parameters(spark):
    rng = random.Random(5)
    item = "If Anna buys 3.5 kg of apples for 12 dollars, how many kg does Anna get for 24 dollars at that same price today"
    other = text_of(rng, 40)
    items = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, "too short"), (6, item)], "item_id long, text string")
    changed = item.replace("Anna", "Omar").replace("3.5", "7").replace("12", "50").replace("24", "100")
    broken = item.replace("Anna", "Omar", 1)
    docs = [(1, text_of(rng, 30) + " " + item + " " + text_of(rng, 30), ""), (2, changed, ""), (3, broken, ""), (4, text_of(rng, 500), ""), (5, None, ""), (6, "", ""), (7, other.upper(), ""), (2, changed, "")]
    table = spark.createDataFrame(docs, DOCS)
    got = sorted((r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(table, items).collect())
    assert got == [(1, 1, True), (1, 6, True), (2, 1, False), (2, 1, False), (2, 6, False), (2, 6, False), (7, 2, True)]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(table, items).collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(table, items.limit(0)).count() == 0
    assert decontaminate.contaminated(table.limit(0), items).count() == 0


def test_items_behind_units_between_numbers(spark):
    item = "The first of The rivers has 12 locks and The second has 12 bridges over 3.5 km in The old town"
    heads = ["It took 5h30 for Tom", "A room of 5 m² and 120 km²", "Some 10m2 of land", "B2B 3cm³, 5h30m10s", "1.5,2:3kg4.5 _#@~ e-mail5h"]
    docs = spark.createDataFrame([(i, f"{head} {item}", "s") for i, head in enumerate(heads)], DOCS)
    sizes = decontaminate.formed(docs.select("doc_id", "text"), "text", values=True).select(F.size("a"), F.size("b"), F.size("v")).collect()
    assert all(a == b == v for a, b, v in sizes)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.contaminated(docs, items).collect()) == [(i, 1, 1.0, True) for i in range(len(heads))]


def test_decontamination_matches_a_scan_of_all_windows(spark):
    rng = random.Random(19)
    item = text_of(rng, 60)
    docs = [(k, f"{text_of(rng, k % 37)} {near_copy(rng, item, 1)} {text_of(rng, 5)}", "s") for k in range(80)]
    docs += [(k, f"{text_of(rng, k % 7)} {near_copy(rng, item, rng.randint(2, 7))}", "s") for k in range(80, 160)]
    words = item.split(" ")
    docs += [(k, " ".join([*text_of(rng, 35).split(" ")[: k % 35], *words[: k - 160], "zzzz", *words[k - 160 :]]), "s") for k in range(160, 220)]
    windows = lambda text: [tuple(text.split(" ")[k : k + 6]) for k in range(len(text.split(" ")) - 5)]
    share = {i: sum(w in set(windows(t)) for w in windows(item)) / 55 for i, t, _ in docs}
    want = sorted((i, 1, c, True) for i, c in share.items() if c >= 0.6)
    assert 140 < len(want) < 220
    table = spark.createDataFrame(docs, DOCS)
    for others in ([], [(2, "five words make one item")]):
        items = spark.createDataFrame([(1, item), *others], "item_id long, text string")
        assert sorted(tuple(r) for r in decontaminate.contaminated(table, items).collect()) == want


def test_windows_are_hashed_without_copying_their_words(spark):
    rng = random.Random(29)
    rows = [(i, 5 + i % 2, words := [rng.randint(0, 9) for _ in range(i % 13)], [w // 2 for w in words]) for i in range(40)]
    table = spark.createDataFrame(rows, "id long, width int, x array<long>, y array<long>")
    one = spark.createDataFrame([(i, n, at, part) for i, _, *both in rows for n in (5, 6) for w in both for at in range(len(w) - n + 1) if (part := w[at : at + n])], "id long, n int, at int, part array<long>")
    want = one.select("id", "at", F.xxhash64("part").alias("h"), "n")
    got = decontaminate._windows(table, ("x", "y"), [5, 6])
    assert sorted(tuple(r) for r in got.select("id", "at", "h").collect()) == sorted(tuple(r)[:3] for r in want.collect())
    own = decontaminate._windows(table, ("x", "y"), [5, 6], "width").select("id", "at", "h")
    assert sorted(tuple(r) for r in own.collect()) == sorted(tuple(r)[:3] for r in want.where(F.col("n") == 5 + F.col("id") % 2).collect())
    plan = got._jdf.queryExecution().toString()
    assert "slice(" not in plan and "lambda" not in plan


# 7 substring dedup --------------------------------------------------------------------------------------------------


def test_repeated_passages_of_over_fifty_words_are_found(spark):
    rng = random.Random(7)
    passages = [text_of(rng, 55) for _ in range(20)]
    rows = [(2 * k + side, f"{text_of(rng, 20 + k)} {p} {text_of(rng, 30)}", "s") for k, p in enumerate(passages) for side in (0, 1)]
    rows += [(100 + k, text_of(rng, 80), "s") for k in range(40)] + [(200, None, "s"), (201, "", "s"), (202, "é" * 40, "s"), (300, text_of(rng, 90), "s")]
    rows.append(rows[-1])  # the same document again
    spans = chunks.repeated_spans(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in spans} == set(range(40))
    texts = {i: t for i, t, _ in rows}
    for r in spans:
        assert texts[r.doc_id][r.start : r.end] in texts[r.doc_id ^ 1] and r.first_doc_id == min(r.doc_id, r.doc_id ^ 1)
    assert chunks.repeated_spans(spark.createDataFrame([], DOCS)).count() == 0


def test_short_texts_alone_in_a_partition(spark):
    rows = [(n, ("ab " * 20)[:n], "s") for n in range(1, 41)]
    assert chunks.repeated_spans(spark.createDataFrame(rows, DOCS).repartitionByRange(40, "doc_id")).count() == 0


def test_every_window_of_51_shared_words_meets_a_span(spark):
    rng = random.Random(17)
    short = [" ".join(rng.choices("abcdefgh", k=51)) for _ in range(12)]
    unit = [text_of(rng, n).split(" ") for n in (1, 1, 2, 3, 5, 7, 12, 30)] + [["Of"], ["a", "b"]]
    periodic = [" ".join((u * 60)[: rng.randint(51, 140)]) for u in unit]
    rows = [(2 * k + side, f"{text_of(rng, rng.randint(0, 30))} {p} {text_of(rng, rng.randint(0, 30))}", "s") for k, p in enumerate(short + periodic) for side in (0, 1)]
    rows += [(100 + k, f"{text_of(rng, 9 * k)} {'Of ' * n}{text_of(rng, 25)}", "s") for k, n in enumerate((51, 60, 131, 308))] + [(200, text_of(rng, 300), "s")]
    spans = chunks.repeated_spans(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    covered = {i: set() for i, _, _ in rows}
    for r in spans:
        covered[r.doc_id] |= set(range(r.start, r.end))
    holders = {}
    for i, text, _ in rows:
        at = [m.span() for m in re.finditer(r"\S+", text)]
        for k in range(len(at) - 50):
            a, b = at[k][0], at[k + 50][1]
            holders.setdefault(text[a:b], []).append((i, a, b, at[k : k + 51]))
    shared = [h for hs in holders.values() if len({i for i, *_ in hs}) > 1 for h in hs]
    assert {i for i, *_ in shared} >= set(range(2 * len(short + periodic))) | {100, 101, 102, 103} and 200 not in {r.doc_id for r in spans}
    for i, _, _, at in shared:
        assert sum(covered[i].issuperset(range(*x)) for x in at) >= 51 - 22


# 8 Jaccard join -----------------------------------------------------------------------------------------------------


def brute_classes(rows):
    def shingles(text):
        words = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
        return frozenset(zip(*[words[k:] for k in range(5)], strict=False)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])

    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    for x, y in itertools.combinations(range(len(rows)), 2):
        a, b = sets[x], sets[y]
        if a and 100 * len(a & b) >= 80 * len(a | b) and label[x] != label[y]:
            old, new = label[y], label[x]
            label = [new if v == old else v for v in label]
    low = {v: min((rows[k][0] for k in range(len(rows)) if label[k] == v and rows[k][0] is not None), default=None) for v in set(label)}
    return sorted(((rows[k][0], len(sets[k]), low[label[k]]) for k in range(len(rows))), key=str)


@pytest.mark.parametrize("limits", [(24, 1024, 512), (2, 16, 512), (2, 8, 40)])
def test_similar_classes_match_brute_force(spark, monkeypatch, limits):
    for name, value in zip(("SHORT_LIST", "BLOCK_ROWS", "CARRIED"), limits, strict=True):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(11)
    base = text_of(rng, 60)
    texts = [near_copy(rng, base, rng.choice([0, 1, 1, 2, 3, 4])) for _ in range(60)]
    texts += [near_copy(rng, t, 1) for t in [text_of(rng, rng.choice([3, 4, 5, 6, 50, 300])) for _ in range(8)] for _ in range(3)]
    texts += [None, "", " \t", "One two", "one TWO", "a b c d", "a b c d"] + [text_of(rng, 40) for _ in range(10)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, base, "s"), (None, "lonely words here", "s"), (3, texts[3], "s")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1)).withColumn("component_id", F.lit("x"))
    classes = jaccard.similar_classes(docs, filter_bits=20).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in classes.collect()), key=str) == brute_classes(rows)


def test_one_row_of_each_class_stays(spark):
    rows = [(1, "a b c d e f", "s"), (2, "a b c d e f", "t"), (None, "A b c d e f", "s"), (3, "", "s"), (3, "", "s"), (4, "q", "s"), (4, "q", "s"), (None, "z z", "s"), (None, "z z", "t")]
    kept = jaccard.without_similar(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(str(x) for x in [(1, "a b c d e f"), (3, ""), (3, ""), (4, "q"), (None, "z z")])
    assert jaccard.similar_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_sets_with_chance_matches_are_not_compared(spark):
    rng = random.Random(31)
    passages = [text_of(rng, 100) for _ in range(20)]
    texts = [f"{passages[i // 2]} {text_of(rng, 400)}" for i in range(40)]  # a fifth of the shingles occur twice
    texts += [near_copy(rng, texts[0], 3)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    _, passing = jaccard._profiles(docs, "doc_id", "text", 5, 80, 100, 24)
    assert 2 <= passing.count() < 10


# 9 HTML -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p>", ""), ("just words", "just words"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p><b>One<br>two<p>Three\n four<script>x</p></script></article><footer>f</footer>", "T & U\n\nOne two\n\nThree four"),
        ('<div class="sidebar">menu</div><div><p>Hello there</p><p>Second <b>bold</b></p></div><div id="comments"><p>A long comment of some reader</p></div>', "Hello there\n\nSecond bold"),
        ("<article><header><h1>Head</h1><p>by x</p></header><section><p>a b c</p></section><section><p>d</p><form>go</form></section></article>", "Head\n\na b c\n\nd"),
        ('<a "<a "' * 3, '<a "<a "<a "<a "<a "<a "'),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "tag",
    ["article class='post category-social tag-search'", "article class='hentry has-comments'", "div class='content with-sidebar'", "div id='layout-nav-left'", "div class='widget'", "div class='search' id='site-overlay'"],
)
def test_marks_do_not_hide_the_article(tag):
    page = f"<body><div class='site-footer'>foot</div><{tag}><p>The first of some words</p><p>And a second line</p><div class='comments'><p>{'reader ' * 50}</p></div></{tag.split()[0]}></body>"
    assert html.main_text(page) == "The first of some words\n\nAnd a second line"


@pytest.mark.parametrize("tag", ["<svg width='1'/>", "<math/>", "<object data='x'>", "<svg><path d=''/>", "<svg><svg>x</svg>y</svg>"])
def test_foreign_elements_do_not_swallow_the_page(tag):
    assert html.main_text(f"<body><article><p>One {tag}two</p><p>Three</p></article></body>") == "One two\n\nThree"


def test_extract_text_keeps_rows(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (2, "<p>é</p>")], "page_id long, html string").withColumn("text", F.lit(0))
    assert sorted((r.page_id, r.text, r.n_chars) for r in html.extract_text(pages).collect()) == [(1, "", 0), (1, "", 0), (2, "é", 1)]
    assert html.extract_text(pages.limit(0)).count() == 0


# 10 quality ---------------------------------------------------------------------------------------------------------


def test_quality_learns_junk_and_scores_every_row(spark):
    rng = random.Random(13)
    good = [(i, text_of(rng, rng.randint(5, 80)).capitalize() + ".", "s") for i in range(200)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in text_of(rng, 30).split(" ")), "s") for i in range(60)]
    docs = spark.createDataFrame(good + bad + [(5000, None, "s"), (5001, "", "s"), (None, "abcd efgh", "s")], DOCS).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _, _ in good[::2] + bad[::2]] + [(7, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert len(got) == 263 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    right = [got[i].predicted == int(i < 1000) for i, _, _ in good[1::2] + bad[1::2]]
    assert sum(right) / len(right) >= 0.97 and got[5000].score == got[5001].score
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
