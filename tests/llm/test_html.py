"""Main text by composite text density: the densities, what they decide, and pages made to be slow."""

from __future__ import annotations

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from labelloom.llm import html


def sentence(rng: random.Random, low: int = 6, high: int = 25) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(low, high)))


def page_of(rng: random.Random, wrap: str) -> tuple[str, str]:
    """A page without telling names but for its comments, and its article."""
    paragraphs = [sentence(rng) for _ in range(rng.randint(3, 12))]
    links = lambda n: "".join(f"<li><a href=/{i}>{sentence(rng, 1, 4)}</a></li>" for i in range(n))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    related = f"<ul>{links(rng.randint(5, 15))}</ul>"
    thread = "".join(f"<div class='comment'><p>{sentence(rng, 20, 60)}</p></div>" for _ in range(rng.randint(0, 20)))
    page = f"<body><div><ul>{links(rng.randint(10, 60))}</ul></div><{wrap}><h1>{paragraphs[0]}</h1>{body}{related}</{wrap}><div class='comments'>{thread}</div><div>{links(20)}</div></body>"
    return page, "\n\n".join([paragraphs[0], *paragraphs])


def test_densities_pick_the_article_among_menus_lists_and_comments(monkeypatch):
    rng = random.Random(5)
    cases = [page_of(rng, wrap) for wrap in ("article", "main", "div", "section") for _ in range(50)]
    assert sum(html.main_text(page) == text for page, text in cases) >= 0.99 * len(cases)
    monkeypatch.setattr(html, "composite_density", lambda node, root: node.most if node.chars else 0.0)
    assert sum(html.main_text(page) != text for page, text in cases) >= 0.5 * len(cases)


def brute(node: html.Node, root: html.Node) -> tuple[int, int, int, int]:
    """Characters, tags, link characters and link tags below a node, by recursion."""
    chars = sum(len(c.strip()) for c in node.children if isinstance(c, str))
    tags = link_chars = link_tags = 0
    for child in node.children:
        if isinstance(child, html.Node) and not child.noise:
            c, t, lc, lt = brute(child, root)
            chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (child.name == "a")
    return chars, tags, chars if node.name == "a" else link_chars, link_tags


def test_densities_equal_a_recursive_count():
    rng = random.Random(6)
    for _ in range(30):
        page, _ = page_of(rng, "div")
        root = html.parse(page.replace("class=", "title="))
        order = html.measure(root)
        whole = brute(root, root)
        for node in order:
            chars, tags, link_chars, link_tags = brute(node, root)
            assert (node.chars, node.tags, node.link_chars, node.link_tags) == (chars, tags, link_chars, link_tags)
            density = 0.0
            if chars:
                base = chars / max(chars - link_chars, 1) * link_chars + whole[2] / whole[0] * chars + math.e
                ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
                density = chars / max(tags, 1) * math.log(max(ratio, 1.0)) / math.log(math.log(base) + math.e - 1)
            assert node.density == pytest.approx(density)
        for node in order:
            assert node.total == pytest.approx(sum(c.density for c in node.children if isinstance(c, html.Node) and not c.noise))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class=comment><p>Only readers</p></div>", "Only readers"),
        ("<div class=ad>Buy this now and pay later</div><article><h1>Title</h1><p>body words</p></article>", "Title\n\nbody words"),
        ("<div class=ad>Buy this now and pay later</div><div><h1>Some title</h1><p>Short one</p></div>", "Some title\n\nShort one"),
        ("<div><p>A text with <a href=x>one link</a> inside</p><p>so</p><p><a href=y>More</a></p></div>", "A text with one link inside\n\nso"),
        ("<article><header><div><h1>Head</h1><p>by x</p></div></header><p>words of it</p></article>", "Head\n\nwords of it"),
        ("<p hidden>no</p><p aria-hidden=true>no</p><p>yes it is</p>", "yes it is"),
        ("\n\t ", ""), ("<!-- only -->", ""), ("<a href=x>link</a>", "link"),
    ],
)
def test_small_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("part", ["<svg>", "<div class='nav'>", "<b>", "<p><b>x", "<ul><li>", "<td><b>x", "<a \"", "<!--", "<header>", "</i>", "<script>"])
def test_time_is_linear_in_the_page(part):
    def took(n: int) -> float:
        began = time.perf_counter()
        html.main_text(part * n + "word")
        return time.perf_counter() - began

    took(1000)
    assert took(40_000) < 20 * took(4000) + 1.0


def test_null_empty_repeated_long_and_deep_pages(spark):
    long = "<article>" + "<p>" + "word " * 200_000 + "</p></article>"
    deep = "<div>" * 50_000 + "deep words"
    rows = [(1, None), (1, None), (2, ""), (3, long), (3, long), (None, deep)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("n_chars", F.lit("x"))
    got = sorted((str(r.page_id), r.n_chars, r.text[:10]) for r in html.extract_text(pages).collect())
    assert got == sorted([("1", 0, "")] * 2 + [("2", 0, "")] + [("3", 999_999, "word word ")] * 2 + [("None", 10, "deep words")])
