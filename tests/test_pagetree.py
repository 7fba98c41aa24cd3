"""The page tree against pages of known structure, and its cost."""

import time

import pytest

from folioscope.functions import markup
from folioscope.functions.pagetree import PageTree

PAGES = [
    ("unclosed paragraphs", "<p>one<p>two<p>three", "p", ["one", "two", "three"]),
    ("a list ends a paragraph", "<p>before<ul><li>a<li>b</ul>after", "p", ["before"]),
    ("nested lists", "<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "li", ["a b c", "b", "c", "d"]),
    ("definitions", "<dl><dt>t<dd>d1<dd>d2<dt>u</dl>", "dd", ["d1", "d2"]),
    ("table cells", "<table><tr><td>1<td>2<tr><td>3</table>", "td", ["1", "2", "3"]),
    ("rows of a nested table stay inside", "<table><tr><td>x<table><tr><td>y</table>z<td>w</table>", "td", ["x y z", "y", "w"]),
    ("options", "<select><option>a<option>b</select>", "option", ["a", "b"]),
    ("inline elements go through a paragraph", "<p>An <i>odd</i> <b>word</p>rest", "p", ["An odd word"]),
    ("scripts aren't text", "<p>a<script>var p = '<p>no</p>';</script>b</p>", "p", ["ab"]),
    ("stray end tags", "</p></div><p>a</b></i> b</p></p>", "p", ["a b"]),
    ("a paragraph in a cell isn't ended by the outer one's end tag", "<p>o<table><tr><td><p>i</table>", "p", ["o", "i"]),
    ("character references", "<p>R&amp;D &lt;b&gt; &#233;</p>", "p", ["R&D <b> é"]),
    ("words at edges of blocks stay apart", "<div><h2>T</h2><p>a</p><p>b</p></div>", "div", ["T a b"]),
    ("JATS", "<jats:sec><jats:title>A</jats:title><jats:p>x<jats:break/>y</jats:p></jats:sec>", "jats:p", ["xy"]),
]


@pytest.mark.parametrize("name, page, tag, expected", PAGES, ids=[p[0] for p in PAGES])
def test_structure(name, page, tag, expected):
    assert PageTree(page).texts(tag) == expected


def test_empty_pages():
    assert PageTree(None).elements == [] and PageTree("").text() == "" and PageTree("no tags").text() == "no tags"


def test_candidates_hold_their_own_text():
    page = "<p>Abstract one<p>nothing<p>abstract two<div class='Abstract x'>div<p>inner</div><span>s</span>"
    assert markup.candidates(page) == ["Abstract one", "abstract two", "div inner", "s"]
    assert markup.markdown(page) == "Abstract one\nnothing\nabstract two\ninner"
    assert markup.candidates("<span>a" * 3) == ["aaa"]


@pytest.mark.parametrize("piece", ["<p>Abstract of a page, with words.", "<div>x", "<span>y", "<li>z", "<b></p>", "<table><tr><td>q"])
def test_cost_is_in_proportion(piece):
    def cost(n):
        began = time.process_time()
        found = markup.candidates(piece * n)
        return time.process_time() - began, sum(map(len, found))

    cost(500)
    small, large = cost(4_000), cost(16_000)
    assert large[1] <= 4.1 * max(1, small[1]) and large[0] < 12 * small[0] + 0.1
