"""Page text on templates that training never saw, and message passing against enumeration."""

import itertools
import math
from collections import Counter

import pytest
from test_vectors_pages_urls import PAGE

from eventlake.llm import html


@pytest.fixture(scope="module")
def model():
    return html.Model({k: 300 * n for k, n in html.page_counts(PAGE).items()})


BODY = [
    "A headline of some length",
    "The river rose in the night, and by the morning the lower fields were under water. Nobody had slept.",
    "Farmers brought their animals to the school on the hill, where the fire service kept watch. It rained on.",
    "By noon the bridge was closed. A second wave was expected in the evening, the office said.",
]
JUNK = ["Home", "News", "Contact us", "Great text, thanks a lot! I was there, too.", "I do not agree at all. Sorry.", "Read this next", "All rights reserved"]
H, P = f"<h1>{BODY[0]}</h1>", "".join(f"<p>{t}</p>" for t in BODY[1:])
LINKS = "".join(f'<li><a href="/{t}">{t}</a></li>' for t in JUNK[:3])
READERS = f"<div><p>{JUNK[3]}</p></div><div><p>{JUNK[4]}</p></div>"
NEXT, END = f'<a href="/n">{JUNK[5]}</a>', f"<p>{JUNK[6]}</p>"
TEMPLATES = [
    f'<div class="main-menu"><ul>{LINKS}</ul></div><div class="entry-content">{H}{P}</div><div class="post-comments">{READERS}</div>',
    f'<div id="topNav"><ul>{LINKS}</ul></div><div id="content">{H}{P}</div><ol class="commentlist">{READERS}</ol>',
    f'<nav><ul>{LINKS}</ul></nav><div class="post type-post category-share">{H}{P}</div><div class="usercomments">{READERS}</div>',
    f'<div class="hd has-sidebar"><div class="story">{H}{P}<div class="story-comments">{READERS}</div></div></div><div class="site-footer">{END}</div>',
    f"<main>{H}{P}</main><section class='kommentare'>{READERS}</section><footer>{END}</footer>",
    f'<div class="blog-sidebar">{NEXT}</div><div class="text">{H}{P}</div><div class="article-share">{NEXT}</div>',
    f'<div class="post-header">{H}</div><div class="post-body">{P}</div><div class="post-footer">{END}</div>',
    f'<table><tr><td class="leftMenu"><ul>{LINKS}</ul></td><td class="mainText">{H}{P}</td></tr></table><div class="cmnt">{READERS}</div>',
    f'<div id="wrap"><div id="main">{H}{P}</div><div id="content-sidebar">{NEXT}</div></div><div id="footer">{END}</div>',
    f'<div role="navigation"><ul>{LINKS}</ul></div><div role="main">{H}{P}</div><div role="contentinfo">{END}</div>',
    f'<div class="content">{H}<div class="contentAd">{NEXT}</div>{P}<div class="entry-comments">{READERS}</div></div>',
    f'<div class="prose">{H}{P}</div><div class="disqus-thread">{READERS}</div><ul class="breadcrumbs">{LINKS}</ul>',
]


@pytest.mark.parametrize("body", TEMPLATES)
def test_templates_without_an_article_element(model, body):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"
    got, want = (Counter(t.split()) for t in (model.extract(page), " ".join(BODY)))
    common = sum((got & want).values())
    assert common and 2 * common / (sum(got.values()) + sum(want.values())) >= 0.95, model.extract(page)


NAMES = (
    "commentlist post-comments article-comments entry-comments story-comments usercomments cmnt kommentare"
    " main-menu main-nav content-sidebar blog-sidebar post-footer article-share contentAd"
).split()


@pytest.mark.parametrize("name", NAMES)
def test_what_a_class_says_is_no_content_goes(model, name):
    page = f'<body><div class="content">{H}{P}</div><div class="{name}"><p>{JUNK[3]} {JUNK[4]}</p></div></body>'
    assert model.extract(page) == "\n\n".join(BODY)


def test_classes_of_content_stay():
    for said in ("post-header", "entry-content", "post type-post category-share tag-ad", "main has-sidebar", "mainText"):
        assert html.hint_of(f' class="{said}"') == "main", said
    for said in ("", "row", "has-sidebar", "x" * 100_000, "advertising", "commentary", "headline"):
        assert html.hint_of(f' class="{said}"') == "none", said


def test_message_passing_equals_enumeration(model):
    page = f'<div class="menu"><p>{JUNK[0]}</p></div><div id="content"><h1>T</h1><p>{BODY[1]}</p></div><p>x</p>'
    elements, _ = html.parse(page)
    n = len(elements)
    assert 5 <= n <= 12
    total, content = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        weight = (0.8, 0.2)[labels[0]]
        for i, e in enumerate(elements):
            odds = sum(model.ratio.get(o, 0.0) for o in html.observations(e))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            weight *= p if labels[i] else 1 - p
            if e.parent >= 0:
                weight *= model.edges[html.kind(e)][labels[e.parent]][labels[i]]
        total += weight
        content = [c + weight * y for c, y in zip(content, labels, strict=True)]
    for fast, slow in zip(model.marginals(elements), content, strict=True):
        assert fast == pytest.approx(slow / total, abs=1e-9)
