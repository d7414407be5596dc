"""Pages with broken markup, and classes inside articles."""

from __future__ import annotations

import time

import pytest

from loomwright.llm.html_text import CUT, MAIN, blocks, main_text


def kept(page: str) -> list[str]:
    return [text for text, kind in blocks(page) if kind != CUT]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p title=don't>Hello", ["Hello"]),
        ("<p title='a>b'>one</p><p title=\"c>d\">two</p>", ["one", "two"]),
        ('<p title="open>three</p>', ["three"]),
        ('<p "quoted>four</p>', ["four"]),
        ("<p a = 'x' b= y>five<br/>six</p>", ["five six"]),
        ("a<!-->b<!--->c<!-- no --!>d", ["abcd"]),
        ("x</span></b>y", ["xy"]),
        ("x</div>y", ["x", "y"]),
        ("1 < 2 and 3 <4", ["1 < 2 and 3 <4"]),
        ("text<a href='", ["text"]),
        ("", []),
    ],
)
def test_odd_markup(page, want):
    assert kept(page) == want


@pytest.mark.parametrize("name", ["related-work", "login-tutorial", "shared-memory", "cookie-recipes", "has-sidebar", "comment-free-prose"])
def test_classes_that_only_hold_such_a_word_stay(name):
    assert kept(f'<article><p>one</p><div class="{name}">two</div></article>') == ["one", "two"]


@pytest.mark.parametrize("name", ["related", "relatedPosts", "ad-slot-3", "comments section", "newsletter-signup-form", "share_buttons", "x1 sidebar", "adBox"])
def test_classes_of_boilerplate_are_cut_in_articles(name):
    assert kept(f'<article><p>one</p><div class="{name}">two</div><p>three</p></article>') == ["one", "three"]


def test_values_without_quotation_marks():
    assert kept("<article><p>one</p><div id=x class=sidebar>two</div><p hidden>three</p><p>four</p></article>") == ["one", "four"]


@pytest.mark.parametrize("depth", [0, 3, 9, 200])
def test_an_inline_element_ends_whatever_was_left_open_in_it(depth):
    page = '<article><p>one</p><span class="ad">' + "<div>" * depth + "no</span><p>two</p></article>"
    assert kept(page) == ["one", "two"]
    assert [kind for _, kind in blocks(page)] == [MAIN, CUT, MAIN]


@pytest.mark.parametrize(
    "piece", ["<a ", "<a b='", '<a b="', "<", "</a", "<a b   ", "<!--", "<script>", "<div>", "</x>", "<div></x>", "<span class=ad>", '<p title="', "<![CDATA[", "<b><p>", "&"]
)
def test_long_broken_pages_take_linear_time(piece):
    """A megabyte of each, with a stray mark at the end (a quadratic scan would take hours)."""
    start = time.process_time()
    blocks(piece * ((1 << 20) // len(piece)) + "\"'")
    assert time.process_time() - start < 20


def test_every_page_is_differenced_and_markup_puts_back_lines_of_articles(spark):
    """Pages that markup decides wholly had no partner at all."""
    page = "<nav>menu</nav><article><p>quoted by both</p><p>own %d</p></article><footer>foot %d</footer>"
    rows = [(k, f"http://h.x/a/{k}", page % (k, k)) for k in (1, 2)]
    found = {r["page_id"]: r for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in (1, 2):
        assert (found[k]["text"], found[k]["n_cut"], found[k]["n_shared"], found[k]["n_restored"]) == (f"quoted by both own {k}", 2, 2, 1)
