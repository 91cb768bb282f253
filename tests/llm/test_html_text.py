import time
import tracemalloc

import pytest
from hypothesis import given, settings, strategies as st

from tramlake.llm import html_text as H


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a &amp; b&nbsp;c &lt;x&gt;", "a & b c <x>"),
    ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("<div>a</div><div>b</div>", "a\nb"), ("a<b>b</b>c <i> d</i>", "abc d"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<title>t</title><body>x", "x"), ("<head><style>p{}</style><script>'<p>'</script></head>y", "y"), ("<script>never closed", ""),
    ("a<span hidden>b</span><span style='DISPLAY : none'>c</span><template>d</template><noscript>e</noscript>f", "af"),
    ("<style>.ad, #x, q.z{display:none}</style><p class='b ad'>1<p id=x>2<p>3", "3"),
    ("<details><summary>s</summary>hid</details><details open><summary>t</summary>u</details><dialog>v</dialog>", "s\nt\nu"),
    ("<pre>\n a  b\n\n c</pre>d", " a  b\n\n c\n\nd"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>10</table>", "Name   N\napple  10"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>a<td>b<td>c</table>", "wide  x\na  b  c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "    q\n\nt\n    d"), ("x</p></div></table>y", "xy"), ("1 < 2 <3 <b", "1 < 2 <3"), ("<!-- a --><!doctype html><!---->z", "z"),
    ("<option>a<option>b", "a\nb"), ("<textarea>\n k  l</textarea>", " k  l"), ("<q>said</q>", '"said"'), ("<h1>t</h1>text<hr>more", "t\n\ntext\n\nmore"),
])
def test_pages(html, text):
    assert H.visible_text(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<p title=it's ok>Text one don't <b>x</b>", "Text one don't x"), ('<p class="a"">one <b id="x">two</b>', "one two"), ("<p it's>one</p><p>don't", "one\n\ndon't"),
    ('<p a=b"c>one <i d="e">two</i>', "one two"), ("<p = 'x>one <i>it's</i>", "one it's"), ("</p it's>one <i>it's</i>", "one it's"),
    ("<p title = 'a > b'>one<p title=\"it's > 'so'\"hidden>two<p title=a/b>three", "one\n\nthree"), ("<p title='a>b <i>c</i>", "b c"),
])
def test_a_quote_opens_a_string_only_after_the_equals_sign(html, text):
    assert H.visible_text(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"), ("<math><semantics><mi>x</mi><annotation>x tex</annotation></semantics></math>y", "xy"),
    ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd></mtr></mtable></math>", "1 2\n3"),
    ("<svg><title>t</title><desc>d<p>e</p></desc><defs><text>f</text></defs><g><text x=1>Label <tspan>one</tspan></text><text>two</text></g></svg>z", "Label one\ntwo\nz"),
    ("<svg><defs/><title/><path d='M0'/><style/><script/><text>a<tspan/>b</text></svg>c", "ab\nc"), ("<svg>not drawn<g>nor this</g><a>nor<text>this is</text></a></svg>", "this is"),
    ("<svg><style>.h{display:none}</style><text class=h>a</text><text display=none>b</text><text visibility=hidden>c</text><text>d</text></svg>", "d"),
    ("<svg><foreignObject><p>one<p>two</p></foreignObject><text>three</text></svg>", "one\n\ntwo\n\nthree"), ("<svg><g><text>a<p>b</svg>c", "a\n\nbc"),
    ("<svg><text><![CDATA[a < b]]></text></svg>", "a < b"), ("<p>x<svg><text>a</text></svg></p>y", "x\na\n\ny"), ("<svg:text>plain</svg:text><math><mi>i</svg></math>j", "plainij"),
])
def test_formulas_and_labels_of_drawings(html, text):
    assert H.visible_text(html) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<svg>", "</svg>", "<math>", "</math>", "<g>", "<g/>", "</g>", "<text>", "</text>", "<mi>", "</mi>", "<foreignObject>", "</foreignObject>", "<title>", "</title>", "<desc>", "<p>", "</p>", "<br>", "</br>", "<table>", "<td>", "</table>", "<li>", "<![CDATA[", "]]>", "<style>", "</style>", "<annotation-xml>", "x"]), max_size=25).map("".join))
def test_no_drawing_or_formula_raises(html):
    H.visible_text(html)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<li>", "<ul>", "</ul>", "<ol>", "</ol>", "<b", "</", "<!--", "-->", "<pre>", "</pre>", "x", " ", "&", "<dd>", "<q>", "</q>", "<details>", '"', "<blockquote>", "</blockquote>", "<td colspan=3 rowspan=2>"]), max_size=25).map("".join))
def test_no_page_raises(html):
    H.visible_text(html)


def test_deep_and_adversarial_pages_stay_linear():
    assert H.visible_text("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    for page in ('<a "' * 20_000, "<!-- " * 20_000, "<style>" * 20_000, "</p>" * 20_000, "<td>" * 20_000, "<" * 20_000):
        H.visible_text(page)


def test_spans_and_padding_are_bounded():
    long_cell = "<table><tr><td>" + "w " * 2500 + "<td>x" + "<tr><td>a<td>b" * 10_000 + "</table>"
    spans = "<table><tr>" + "<td colspan=100 rowspan=100>c" * 3000 + "<tr><td>d" * 200 + "</table>"
    wide = "<table><tr>" + "".join(f"<td>{'v' * 60}" for _ in range(900)) + "<tr><td colspan=899><td>x" * 5000 + "</table>"
    nested = "<table><tr><td>a<td>" * 200 + "z" + "</table>" * 200
    deep = "<blockquote>" * 400 + "<br>x" * 20_000
    many = "<table><tr><td>a<td>b</table>" * 5000
    tall = "<table>" + "<tr><td rowspan=65534>a" * 20_000 + "</table>"
    for page in (long_cell, spans, wide, nested, deep, many, tall):
        tracemalloc.start()
        began = time.process_time()
        text = H.visible_text(page)
        took, (_, peak) = time.process_time() - began, tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert len(text) <= 10 * len(page) and peak < 200e6 and took < 60, (page[:40], len(text), peak, took)
    lines = H.visible_text(long_cell).split("\n")
    assert lines[0] == ("w " * 2500).strip() + "  x" and lines[1] == "a".ljust(H.WIDE + 2) + "b"


def slow(node) -> list[str]:
    """Lines of a paragraph (a string), list (of nodes) or table (rows of words) by the plain rules."""
    kind, content = node
    if kind == "p":
        return [" ".join(content)]
    if kind == "ul":
        return [line for words in content for line in ["- " + " ".join(words)]]
    width = [max((len(row[c]) for row in content if c < len(row)), default=0) for c in range(max(map(len, content)))]
    return ["  ".join(word.ljust(width[c]) for c, word in enumerate(row)).rstrip() for row in content]


WORDS = st.lists(st.text("abcxyz", min_size=1, max_size=9), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.tuples(st.just("p"), WORDS), st.tuples(st.just("ul"), st.lists(WORDS, min_size=1, max_size=4)), st.tuples(st.just("table"), st.lists(WORDS, min_size=1, max_size=4))), max_size=5))
def test_against_plain_rules(nodes):
    html = {
        "p": lambda c: "<p>" + "\n ".join(c), "ul": lambda c: "<ul>" + "".join("<li>" + " ".join(w) for w in c) + "</ul>",
        "table": lambda c: "<table>" + "".join("<tr>" + "".join(f"<td> {w}</td>" for w in row) for row in c) + "</table>",
    }
    assert H.visible_text("".join(html[k](c) for k, c in nodes)) == "\n\n".join("\n".join(slow(n)) for n in nodes)


def test_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").union(spark.createDataFrame([(None, "u", None)], "page_id long, url string, html string"))
    html = {r.page_id: r.html for r in pages.collect()}
    got = H.query(pages).collect()
    assert len(got) == len(html) and all(r.text == H.visible_text(html[r.page_id]) and r.n_chars == len(r.text) for r in got)
    assert H.query(pages.limit(0)).count() == 0
