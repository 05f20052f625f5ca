from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest

from sluicework.llm import htmltext
from sluicework.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

CASES = {
    "": "",
    "plain  text\nhere": "plain text here",
    "a < b & c &amp; &lt;d&gt;": "a < b & c & <d>",
    "x&nbsp;y": "x y",
    "<p>a<p>b<div>c</div>d": "a\n\nb\n\nc\nd",
    "<div>a<div>b</div></div>c": "a\nb\nc",
    "one<br>two<br><br>four": "one\ntwo\n\nfour",
    "<ul><li>x<li>y<ol start=3><li>p<li>q</ol></ul>z": "- x\n- y\n  3. p\n  4. q\n\nz",
    "<ol><li value=7>g<li>h</ol>": "7. g\n8. h",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<table><tr><th>Name<th>n<tr><td>alpha beta<td>1</table>": "Name        n\nalpha beta  1",
    "<table><tr><td>a<td>b<td>c<tr><td colspan=2>wide cell<td>z</table>": "a  b  c\nwide cell  z",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<td>no table": "no table",
    "<table>stray<tr><td>in</table>out": "stray\n\nin\n\nout",
    "<table><tr><td><table><tr><td>x<td>y</table><td>z</table>": "x  y  z",
    "<table><caption>C</caption><tbody><tr><td>1</table>": "C\n1",
    "a<b>c<p>d</b>e": "ac\n\nde",
    "<pre>x\n  y</pre>t": "x\n  y\n\nt",
    "<div hidden>no</div><span style='color:red; DISPLAY : none'>no</span>yes": "yes",
    "<details><summary>S</summary>no<p>no</details><details open>yes</details>": "S\nyes",
    "<title>no</title><style>no</style><script>if (a<b) '</p>'</script><noscript>no</noscript>yes": "yes",
    "<head><meta charset=x><title>no</title></head><body>yes": "yes",
    "</p>x</br>y</nothing>z": "x\nyz",
    "<!-- <p>no</p> -->yes<!-->also<!--no": "yesalso",
    "<textarea>a <b> c</textarea>": "a <b> c",
    "<select><option>a<option>b</select>": "a\nb",
    "<input type=submit value='Go on'><input value=no>": "Go on",
    "<script>never closed <p>no": "",
    "<a title='>'>x</a": "x",
    "<blockquote><p>q</blockquote>r": "  q\n\nr",
    "<h1>T</h1>x<h2>U</h3>y": "T\n\nx\n\nU\n\ny",
    "<p>é&eacute;&#233;&#xe9;": "éééé",
    "<table><tr><td rowspan=2>aaaa<td>b<tr><td>c<tr><td>d<td>e</table>": "aaaa  b\n      c\nd     e",
    "<table><tr><td>a<td rowspan=0 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>": "a  b   c\nd      e\nf      g",
    "<div style='visibility:hidden'>no<b style='visibility: visible'>yes<i>too</i></b><br>no</div>end": "yestoo\nend",
    "<p style='visibility:visible'>a<span style='VISIBILITY:collapse'>no<input type=submit value=no></span>b": "ab",
    "<span style='display:none'><b style='visibility:visible'>no</b></span>yes": "yes",
    "<table><tr><td>日本語<td>x<tr><td>ab<td>y</table>": "日本語  x\nab      y",
    "<table><tr><td>e\u0301e\u0301<td>x<tr><td>abcd<td>y</table>": "e\u0301e\u0301    x\nabcd  y",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert htmltext.to_text(page) == CASES[page]


def test_deep_and_long_pages():
    assert htmltext.to_text("<div>" * 100_000 + "deep") == "deep"
    for deep in ("<div>" * 600, "<b><i>" * 400, "<div>" * 511, "<div>" * 510):
        assert htmltext.to_text(f"{deep}<section hidden>NO<div>NO</div>NO<section hidden>NO</section>NO</section>shown<style>no</style>") == "shown"
        assert htmltext.to_text(f"{deep}<div><svg/>a</div><div style='display:none'>no<div>no</div>no</div>b").replace("\n", "") == "ab"
    assert htmltext.to_text("<div>" * 600 + "in" + "</div>" * 600 + "<p>a</p>b") == "in\n\na\n\nb"
    assert htmltext.to_text("<b><i>" * 20_000 + "x" + "<a href=\"" * 1000).startswith("x")
    rows = "".join(f"<tr><td>{'y' * (i % 7)}<td>{i}" for i in range(3000))
    assert htmltext.to_text(f"<table>{rows}<tr><td>{'w' * 50_000}<td>end</table>").count("\n") == 3000


class Plain(HTMLParser):
    """Independent reading of the visible characters, without layout."""

    def __init__(self) -> None:
        super().__init__()
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def squeezed(text):
    return re.sub(r"\s+", "", text)


def test_query_holds_all_visible_text(spark):
    got = {r.page_id: r.text for r in QUERIES["op6_html_text"](spark, FOLDER).collect()}
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        plain = Plain()
        plain.feed(page)
        plain.close()
        assert squeezed("".join(plain.out)) == squeezed(re.sub(r"(?m)^ *- ", "", got[i]))


def test_messy_rows(spark):
    rows = [(1, None, "u"), (2, "", None), (None, "<p>a", "u"), (2, "", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.text or "", r.text is None) for r in htmltext.extract_pages(pages).collect())
    assert got == [(0, "a", False), (1, "", True), (2, "", False), (2, "", False)]
    assert htmltext.extract_pages(pages.filter("false")).count() == 0
