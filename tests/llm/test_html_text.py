"""Rendering: implied tags, visibility, spacing, lists, tables; words against an independent walk over the markup."""

import re
import time
from html.parser import HTMLParser

import pytest

from cropledger.llm import html_text
from cropledger.llm.queries import QUERIES

CASES = {
    "<p>a<p>b": "a\n\nb",
    "<div>a</div><div>b</div>": "a\nb",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<b>x</b><i> y</i>  z": "x y z",
    "a <!-- b --> c<!-- d": "a c",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=3><li>a<li value=7>b<li>c</ol>": "3. a\n7. b\n8. c",
    "<ol type=a reversed><li>x<li>y</ol>": "b. x\na. y",
    "<ol type=I><li>x<li>y</ol>": "I. x\nII. y",
    "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>": "a    bb\nccc  d",
    "<table><thead><tr><th>n</thead><tr><td>long cell<td>é</table>": "n\nlong cell  é",
    "<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>": "wide one  z\na  b      c",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "x<table><tr><td>a</table>y": "x\n\na\n\ny",
    "<table>stray<tr><td>a</table>": "stray\n\na",
    "<table><caption>cap</caption><tr><td>日本<td>x<tr><td>abcd<td>y</table>": "cap\n日本  x\nabcd  y",
    "<pre>\n a\n  b</pre>c": " a\n  b\n\nc",
    "<title>t</title><style>p{}</style><script>if (a<b) '</p>'</script>v": "v",
    "<p hidden>a</p><p style='display:none'>b<b>c</b></p>d": "d",
    "<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>c": "b\nc",
    "<style>.x{display:none} #y{display:none} p.z{display:none}</style><p class='a x'>1<p id=y>2<p class=z>3<div class=z>4": "4",
    "<style>.x{display:none}.x{display:block}</style><p class=x>1": "1",
    "<style>@media print{.x{display:none}}</style><p class=x>1": "1",
    "<details><summary>s</summary>hidden</details><details open><summary>t</summary>shown</details>": "s\nt\nshown",
    "<select><option>a<option selected>b</select><input type=submit value=Go><input type=hidden value=h>": "bGo",
    "<textarea> a\n b</textarea>": " a\n b",
    "a &amp; b &lt;c&gt; &eacute;&#233;&nbsp;x": "a & b <c> éé x",
    "<h1>A</h1><h2>B</h2>text<hr>more": "A\n\nB\n\ntext\n\nmore",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<dl><dt>a<dd>b<dt>c<dd>d</dl>": "a\n  b\nc\n  d",
    "a < b <3 c": "a < b <3 c",
    "<a href='x>y' title=\"<p>\">l</a>": "l",
    "<p>a</b></i>b</p></div>c": "ab\n\nc",
    "text <a href=\"unclosed": "text",
    "<td>no table": "no table",
    "<!DOCTYPE html><html><head><title>t</title><body>b": "b",
    "<noscript>n</noscript><template>t</template><svg><title>t</title><text>s</text></svg>": "s",
    "": "",
}


@pytest.mark.parametrize("html", CASES)
def test_render(html):
    assert html_text.render(html) == CASES[html]


class Words(HTMLParser):
    """Text outside of script, style, title and comments."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.hidden:
            self.found += data.split()


def test_words_of_real_pages(spark, real):
    got = {r.page_id: r for r in QUERIES["op9_layout_html"](spark, "/root/testdata/sf0.001").collect()}
    pages = real("pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        walk = Words()
        walk.feed(page.html)
        words = re.sub(r"(?m)^ *(-|\d+\.) ", " ", got[page.page_id].text).split()
        assert "".join(sorted("".join(words))) == "".join(sorted(re.sub(r"(^|\s)-(?=\s)", " ", "".join(walk.found)))), page.page_id
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_nulls_repeats_deep_long_and_empty(spark):
    rows = [
        (1, None, "x"), (1, "", "x"), (None, "<p>a", "x"), (2, "<div>" * 5_000 + "deep", "x"), (3, "<p>word " * 100_000, "x"),
        (4, "<table><tr><td>" * 600 + "t", "x"), (5, "<" * 10_000, "x"), (6, "<a b='" * 3_000, "x"), (7, "<b><p>" * 3_000 + "</b>" * 3_000, "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got if r.page_id not in (1, None)}
    assert by[2] == "deep" and by[3].count("word") == 100_000 and "t" in by[4]
    assert html_text.extract(df.limit(0)).count() == 0


def depth_of(node):
    deepest, left = 0, [(node, 1)]
    while left:
        node, at = left.pop()
        deepest = max(deepest, at)
        left += [(c, at + 1) for c in node.children if isinstance(c, html_text.Node)]
    return deepest


@pytest.mark.parametrize("opening", ["<div>", "<b>", "<table><tr><td>", "<ul><li>", "<table>", "<span><p>", "<blockquote>", "<table><caption>"])
@pytest.mark.parametrize("n", [5_000, 100_000])
def test_depth_is_bounded_and_no_text_is_lost(opening, n):
    page = opening * n + "deepest" + "".join(f"</{t}>" for t in reversed(re.findall(r"\w+", opening))) * n + " after"
    assert depth_of(html_text.Tree(page).root) <= html_text.DEPTH + 8
    words = html_text.render(page).split()
    assert "deepest" in words and "after" in words


HOSTILE = {
    "comments in a style": "<style>" + "/*" * 500_000 + "</style>text",
    "a style without braces": "<style>" + "a " * 500_000 + "</style>text",
    "open braces": "<style>" + "a{" * 500_000 + "</style>text",
    "other media": "<style>" + "@media print " * 80_000 + "</style>text",
    "rules of one class": "<style>" + ".a{display:block}" * 30_000 + "</style>" + "".join(f"<i id=i{k} class=a></i>" for k in range(20_000)) + "text",
    "rules by id": "<style>" + "".join(f"#i{k}.a{{display:block}}" for k in range(20_000)) + "</style>" + "".join(f"<i id=i{k} class=a></i>" for k in range(20_000)) + "text",
    "quotes in a tag": "<a " + "=\"" * 400_000 + "><p>text",
    "signs": "<" * 1_000_000 + "<p>text",
    "entities": "&" * 1_000_000 + "<p>text",
    "declarations": "<!" * 500_000 + "><p>text",
    "end tags": "<p>" + "</b>" * 250_000 + "text",
    "wide rows": "<table><tr>" + "<td>a" * 20_000 + "</table>text",
    "spans": "<table>" + "<tr><td colspan=1000 rowspan=9>x" * 2_000 + "</table>text",
}


@pytest.mark.parametrize("what", HOSTILE)
def test_hostile_megabytes_take_seconds(what):
    start = time.process_time()
    html_text.render(HOSTILE[what])
    assert time.process_time() - start < 20


def test_the_last_of_equal_rules_counts_and_the_more_specific_wins():
    page = "<style>.a{display:none} i.a{display:inline} .a{display:none} #x{visibility:hidden} /* .b{display:none} */ .b{color:red}</style>"
    page += "<i class=a>one</i> <b class=a>two</b> <i class='a c' id=x>three</i> <u class=b>four</u> <style>.c{display:none}</style>"
    assert html_text.render(page).split() == ["one", "four"]
