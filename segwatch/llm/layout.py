"""Visible text of HTML pages with its layout: blocks, lists and aligned table cells."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=[ \t\n\r\f]*+(?:"[^"]*"|'[^']*')?+)*+)>""", re.S
)  # quotes count right after an equals sign only
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
UNSEEN_STYLE = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*(hidden|collapse)")
WIDEST = 40  # cells are padded up to this width; wider ones keep all their text

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
UNSEEN = frozenset("head script style template noscript iframe object audio video canvas svg math datalist title".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre table blockquote figure hr".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside details dialog dd div dt fieldset figcaption footer form header hgroup legend "
    "li main nav search section summary caption tr option optgroup select textarea center menu".split()
)
CLOSES_P = BLOCKS - frozenset("html body caption tr option optgroup select textarea legend".split())
# A start tag ends open elements of the first set, looking no further up than the second.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}), "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
TABLE_PARTS = frozenset("caption col colgroup thead tbody tfoot tr td th".split())
MOST_SPANNED = 100  # columns a cell is padded over at the most
SCOPES = frozenset("table td th caption button html body".split())


@dataclass
class Element:
    """An open element with the lines of its closed children and the text of the line under way."""

    tag: str
    seen: bool = True
    pre: bool = False
    lines: list[str] = field(default_factory=list)
    run: list[str] = field(default_factory=list)
    rows: list[list[str]] = field(default_factory=list)
    span: int = 1
    count: int = 0

    def end_line(self) -> None:
        text = "".join(self.run)
        self.run.clear()
        if self.pre:
            self.lines.extend(text.split("\n") if text else ())
        else:
            self.lines.extend(filter(None, (SPACE.sub(" ", part).strip(" ") for part in text.split("\v"))))

    def gap(self) -> None:
        if self.lines and self.lines[-1]:
            self.lines.append("")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)} if raw.strip(" /\n\t") else {}


def _table(rows: list[list[str]]) -> list[str]:
    """Rows with their cells one below the other; what is empty at the end of a row is not padded."""
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for i, cell in enumerate(row):
            widths[i] = max(widths[i], min(WIDEST, len(cell)))
    return [" | ".join(c.ljust(w) for c, w in zip(row, widths)).rstrip(" |") for row in rows]


class Page:
    """Builds the tree as the tags come; an element that ends hands its lines to its parent."""

    def __init__(self) -> None:
        self.open = [Element("#page")]
        self.counts: Counter[str] = Counter()  # open elements by tag, so that deep pages are not searched in vain

    def text(self, raw: str) -> None:
        top = self.open[-1]
        if not top.seen or not raw:
            return
        if top.tag in ("table", "colgroup", "tr", "thead", "tbody", "tfoot", "ul", "ol", "select") and not raw.strip():
            return
        top.run.append(html.unescape(raw) if "&" in raw else raw)

    def start(self, tag: str, raw: str) -> None:
        if tag in TABLE_PARTS and not self.counts["table"]:
            return  # parts of a table mean nothing outside of one
        if any(e.tag == "head" for e in self.open[-2:]) and tag not in IN_HEAD and tag != "head":
            self.end("head")
        if tag in CLOSES_P and self.counts["p"]:
            self._end_open({"p"}, SCOPES)
        if tag in IMPLIED_END and any(self.counts[t] for t in IMPLIED_END[tag][0]):
            self._end_open(*IMPLIED_END[tag])
        top = self.open[-1]
        if tag == "br":
            top.run.append("\n" if top.pre else "\v")
            return
        if tag == "hr":
            top.end_line()
            top.gap()
            return
        if tag in VOID:
            return
        attributes = _attributes(raw)
        hidden = "hidden" in attributes or UNSEEN_STYLE.search(attributes.get("style", ""))
        element = Element(tag, top.seen and tag not in UNSEEN and not hidden, top.pre or tag in ("pre", "textarea"))
        if tag in ("td", "th"):
            given = attributes.get("colspan", "1")
            element.span = max(1, min(int(given[:9]), MOST_SPANNED)) if given.isdecimal() else 1
        if tag == "ol":
            given = attributes.get("start", "1")
            element.count = int(given) - 1 if given.isdecimal() and len(given) < 10 else 0
        if tag == "li":
            top.count += 1
        self.open.append(element)
        self.counts[tag] += 1

    def _end_open(self, tags: set[str], limits: set[str] | frozenset[str]) -> None:
        """End the outermost open element of ``tags`` below the nearest one of ``limits``."""
        found = 0
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in limits:
                break
            if self.open[i].tag in tags:
                found = i
        while found and len(self.open) > found:
            self.close()

    def end(self, tag: str) -> None:
        if tag == "p" and not self.counts["p"]:
            self.start("p", "")
        if tag == "br":
            self.start("br", "")
        if not self.counts[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                while len(self.open) > i:
                    self.close()
                return
            if self.open[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html"):
                return  # an end tag inside a cell does not reach out of it

    def close(self) -> None:
        done = self.open.pop()
        parent = self.open[-1]
        self.counts[done.tag] -= 1
        if not done.seen:
            return
        tag = done.tag
        if tag not in BLOCKS and tag not in ("td", "th", "thead", "tbody", "tfoot"):
            parent.rows.extend(done.rows)  # cells and rows wrapped in it are its parent's
            done.rows = []
            if not done.lines:  # an inline element is part of its parent's line
                parent.run.extend(done.run)
                return
        done.end_line()
        while done.lines and not done.lines[-1]:
            done.lines.pop()
        if tag in ("td", "th"):
            cell = " ".join(filter(None, done.lines))
            parent.rows.append([cell])  # one cell; a row gathers its cells below
            parent.rows[-1] += [""] * (done.span - 1)
            return
        if tag == "tr":
            row = [c for cells in done.rows for c in cells]
            if row or done.lines:
                parent.rows.append(row + ([" ".join(done.lines)] if done.lines else []))
            return
        if tag in ("thead", "tbody", "tfoot"):
            parent.rows.extend(done.rows)
            parent.lines.extend(done.lines)
            return
        if done.rows:
            done.lines.extend(_table([r for r in done.rows if r]))
        parent.end_line()
        if not done.lines:
            return
        if tag == "li":
            mark = f"{parent.count}. " if parent.tag == "ol" else "- "
            done.lines = [mark + done.lines[0], *(" " * len(mark) + x if x else x for x in done.lines[1:])]
        elif tag == "dd":
            done.lines = ["  " + x if x else x for x in done.lines]
        if tag in SPACED and not (tag in ("ul", "ol", "dl") and parent.tag in ("li", "dd")):
            parent.gap()
            parent.lines.extend(done.lines)
            parent.lines.append("")
        else:
            parent.lines.extend(done.lines)

    def finish(self) -> str:
        while len(self.open) > 1:
            self.close()
        page = self.open[0]
        page.end_line()
        if page.rows:
            page.lines.extend(_table(page.rows))
        return "\n".join(page.lines).strip("\n")


def render(source: str) -> str:
    """The visible text of one page."""
    page, at, size = Page(), 0, len(source)
    while at < size:
        m = TOKEN.search(source, at)
        if m is None:
            break
        page.text(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            page.end(tag)
            continue
        page.start(tag, m[3])
        if tag in RAW:
            closing = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            stop = closing.start() if closing else size
            page.text(source[at:stop])
            at = stop
    page.text(source[at:])
    return page.finish()


def visible_text(df: DataFrame, source: str = "html", output: str = "text") -> DataFrame:
    """Add the column ``output``: the visible text of the page in ``source``.

    Elements that may leave out their end tag are ended where HTML says so. Scripts, styles, the head and
    whatever is hidden by attribute or style is left out. Blocks start on a new line, paragraphs, headings,
    lists and tables have an empty line around them, list items are marked and indented, table
    cells stand in columns, and preformatted text keeps its spaces.

    Cells are padded over at most ``MOST_SPANNED`` columns, whatever their colspan says; text is never cut.
    NULL pages stay NULL, empty ones become the empty text, an empty table stays empty, repeated rows are treated alike, and other
    columns pass through. Each page is a row of its own, of any length and depth of nesting; nothing is shuffled.
    """

    @F.pandas_udf("string")
    def visible(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else render(page))

    return df.withColumn(output, visible(F.col(source)))
