"""Blocks of web pages: which elements are skipped, broken and deeply nested markup."""

import time

import pytest

from quireflow.llm import html_main
from quireflow.llm.html_main import blocks


@pytest.mark.parametrize("page,want", [
    ('<p>one <svg class="icon"/> two</p><p>three</p>', ["one two", "three"]),
    ("<p>one <svg><text>no</text></svg> two</p>", ["one two"]),
    ("<p>one <SVG><g/></svg> two <svg /> three</p>", ["one two three"]),
    ("<title-card>one</title-card><p>two</p>", ["one", "two"]),
    ("<object-view>one</object-view><p>two</p>", ["one", "two"]),
    ("<p>one</p><noscript>two<p>three</p></noscript>", ["one", "two", "three"]),
    ("<p>one</p><object data='x'>two</object><p>three</p>", ["one", "two", "three"]),
    ("<p>one</p><select><option>no</select><p>two</p>", ["one", "two"]),
    ("<p>one</p><script>no", ["one"]),
])
def test_html_skips_only_closed_elements(page, want):
    assert [b.text for b in blocks(page)] == want


def test_html_many_unclosed_elements_take_linear_time():
    assert len(blocks("<select>a " * 50_000)) == 50_000


@pytest.mark.parametrize("page,n", [
    ("<div>" * 200_000 + "deep", 1),
    ("<div>a" * 100_000, 100_000),
    ("".join(f"<div class='c{k}'>t" for k in range(20_000)), 20_000),
    ("<ul><li>x" * 50_000, 50_000),
    ("<li>" * 200_000 + "x", 1),
    ("</div>" * 200_000 + "x", 1),
    ("<p>" + "long text " * 200_000, 1),
])
def test_deep_and_long_pages(page, n):
    """As a worker reads them: features known to the model only, so that a deep path has no more than it knows."""
    model, began = html_main.default_model(), time.time()
    assert len(blocks(page, model.index)) == n
    html_main.main_text(page, model)
    assert time.time() - began < 60


def test_noscript_of_an_article_stays():
    page = "<nav><a href='/'>Home</a></nav><article><p>One sentence of the article.</p><noscript>Keep this sentence, too.</noscript></article><footer>&copy; x</footer>"
    assert html_main.main_text(page, html_main.default_model()) == "One sentence of the article.\nKeep this sentence, too."
