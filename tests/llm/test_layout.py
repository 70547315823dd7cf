import random
import re
from html.parser import HTMLParser

import pytest

from segwatch.llm.layout import render, visible_text


class Plain(HTMLParser):
    """The words outside of head, scripts and styles, by another parser."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            self.hidden.remove(tag)

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_words_of_pages_agree_with_another_parser(spark, data):
    df = spark.read.parquet(data("0.01", "pages"))
    for r in visible_text(df).collect():
        parser = Plain()
        parser.feed(r["html"])
        parser.close()
        shown = [w for w in r["text"].split() if w not in ("-", "|") and not (w[:-1].isdigit() and w[-1] == ".")]
        wanted = [w for w in parser.words if w not in ("-", "|") and not (w[:-1].isdigit() and w[-1] == ".")]
        assert "".join(shown) == "".join(wanted)


CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "a<br>b &amp; c": "a\nb & c",
    "<ul><li>a<li>b<ul><li>c</ul></ul>": "- a\n- b\n  - c",
    "<ol start=3><li>a<li>b</ol>": "3. a\n4. b",
    "<table><tr><th>h<th>long head<tr><td>1<td>2<tr><td colspan=2>x<td>y</table>": "h | long head\n1 | 2\nx |           | y",
    "<table><thead><tr><td>a</thead><tbody><tr><td>b</table>": "a\nb",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<pre> a\n  b</pre>": " a\n  b",
    "<div style='display:none'>no</div><div hidden>no</div><b>yes</b>": "yes",
    "<head><title>t</title><body>shown": "shown",
    "<script>if (a<b) x('</p>')</script>after": "after",
    "<!-- <p>no</p> -->x<![CDATA[y]]>": "x",
    "a < b and c > d": "a < b and c > d",
    "<a title='x > y'>z</a>": "z",
    "</p>x</div></table>y": "xy",
    "<h1>T</h1>text<div>d</div>": "T\n\ntext\nd",
    "<b>one</b> <i>two</i>three": "one twothree",
    "<a title=it's>zed</a> and don't stop <b>x</b>": "zed and don't stop x",
    "<p class=\"a\"\">first": "first", "<p a = 'x>y' b>q": "q", "<p a=>q": "q",
    "<table><colgroup><col><col><tr><td>a<td>b</table>": "a | b",
    "<table><tr><span><td>a<td>b</span></table>": "a | b", "<table><a><tr><td>a<td>b</a></table>": "a | b",
    "<table><tr><a href=x><td>a</td><td>b</td></a></table>": "a | b",
    "<td>loose</td> text": "loose text", "<tr><td>x</tr>y": "xy", "<table><caption>c<tr><td>a</table>": "c\na",
    "<table><tr><td colspan=0>a<td colspan=99999>b<td>c</table>": "a | b | " + " | " * 99 + "c",
    "": "", "   ": "", "<": "<", "<p": "<p",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert render(source) == CASES[source]


def _tree(draw, depth, words):
    """A random piece of HTML, and its words in ``words`` in the order of the tree."""
    def word():
        words.append(f"w{len(words)}w")
        return words[-1]

    def attributes():
        return draw.choice(["", "", " class=a", ' title="x > y"', " title='<b>'", " title=it's", ' class="a"" id=\'b\'', " a = 'q' hide"])

    def inner(d):
        return "".join(_tree(draw, d, words) for _ in range(draw.randint(1, 3)))

    kind = draw.choice(["text", "inline", "block", "list", "table"]) if depth else "text"
    if kind == "text":
        return f" {word()} "
    if kind in ("inline", "block"):
        tag = draw.choice(["a", "b", "span", "em"] if kind == "inline" else ["div", "section", "p", "h2", "blockquote"])
        body = " ".join(word() for _ in range(2)) if tag in ("p", "h2") else inner(depth - 1)
        return f"<{tag}{attributes()}>{body}" + ("" if tag == "p" and draw.random() < 0.5 and kind == "block" else f"</{tag}>")
    if kind == "list":
        end = draw.choice(["", "</li>"])
        return f"<{(t := draw.choice(['ul', 'ol']))}{attributes()}>" + "".join(f"<li{attributes()}>{inner(depth - 1)}{end}" for _ in range(2)) + f"</{t}>"
    cell, row = draw.choice(["", "</td>"]), draw.choice(["", "</tr>"])
    head = draw.choice(["", "<colgroup><col><col>", "<colgroup><col></colgroup>", "<tbody>", "<thead></thead>"])
    rows = "".join(f"<tr{attributes()}>" + "".join(f"<td{attributes()}> {inner(depth - 1)}{cell}" for _ in range(2)) + row for _ in range(2))
    return f"<table{attributes()}>{head}{rows}</table>"


def test_no_word_of_random_trees_is_lost():
    draw = random.Random(9)
    for _ in range(1000):
        words = []
        page = "".join(_tree(draw, draw.randint(0, 4), words) for _ in range(draw.randint(1, 3)))
        assert re.findall(r"w[0-9]+w", render(page)) == words, page


def test_deep_and_long_pages():
    assert render("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert render("<b>" * 20_000 + "x") == "x"
    assert render("<a b='" * 5000).startswith("<a")
    assert len(render("<table>" + "<tr><td>" + "y" * 10_000 + "<td>z" * 500 + "</table>")) > 10_000


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "<p>x", 7), (3, "<p>x", 7)], "page_id int, html string, text int")
    assert sorted((r["page_id"], r["text"]) for r in visible_text(df).collect() if r["text"] is not None) == [(2, ""), (3, "x"), (3, "x")]
    assert visible_text(df.limit(0)).collect() == []
