"""Visible text of HTML pages, laid out.

A tree builder supplies implied tags (paragraphs, list items, rows, cells and
options end where the next begins) and never fails; visibility rules leave out
what a browser does not show.  The layout keeps blank lines between blocks, marks
and indents list items, keeps preformatted text, and pads table cells so that
columns stand under each other.  All visible text comes out, in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpweave.llm.common import mapped

#: nodes deeper than this become siblings
DEPTH = 150
#: rows or columns that a cell spans at most
SPAN = 100

_COMMENT = r"<!--.*?(?:-->|\Z)"
_CDATA = r"|<!\[CDATA\[(?P<cdata>.*?)\]\]>"
_OTHER = r"|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
#: quotes count behind an equals sign only
_TAG = r"""|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+')?+)*+)>"""
_TAG2 = r"|<(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
#: by whether a CDATA section may still end, and whether quotes still hide the end of a tag
_TOKENS = {(c, q): re.compile(_COMMENT + (_CDATA if c else "|(?P<cdata>(?!))") + _OTHER + (_TAG if q else "|(?P<tag>(?!))(?P<attrs>)") + _TAG2, re.S) for c in (True, False) for q in (True, False)}
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
_UNSEEN = frozenset("script style title head template noscript iframe noembed noframes object audio video canvas datalist param meta link base".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table ul caption tr".split()
)
_SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul dir fieldset".split())
_ENDS_P = frozenset(_BLOCK - {"body", "html", "caption", "tr", "option", "optgroup", "legend"})
#: tag -> (open tags it ends, tags beyond which it does not look)
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "rp": ({"rp", "rt"}, {"ruby"}),
    "rt": ({"rp", "rt"}, {"ruby"}),
    "body": ({"head"}, {"html"}),
}
#: what an open head may hold; anything else ends it
_IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: elements of other vocabularies, in which a tag may close itself
_FOREIGN = frozenset({"svg", "math"})
#: within those, what names or describes and is not shown
_FOREIGN_UNSEEN = {"svg": frozenset("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter".split()), "math": frozenset({"annotation", "annotation-xml"})}
#: a tag of a page within svg or math ends it, as the HTML standard has it
_ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: elements of svg and math that hold parts of a page again
_PAGE_WITHIN = frozenset({"foreignobject", "desc", "title", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"})
_IMPLIED["thead"] = _IMPLIED["tfoot"] = _IMPLIED["caption"] = _IMPLIED["tbody"]


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _raw_end(html: str, tag: str, at: int) -> tuple[int, int]:
    """Where the end tag of a raw element begins and what follows it; the end of the page
    if there is none."""
    for m in re.compile(rf"</{tag}(?=[\s/>])", re.I).finditer(html, at):
        end = html.find(">", m.end())
        return (m.start(), end + 1) if end >= 0 else (m.start(), len(html))
    return len(html), len(html)


def build(html: str) -> Node:
    """The tree of a page; text is in `children` as strings.

    The time is linear in the page: what can fail only for want of an end further on
    (a tag's, a CDATA section's, a quoted value's that would hide the tag's) is not
    tried again once there is none."""
    root = Node("html", {})
    open_, at, n = [root], 0, len(html)
    last_end, last_cdata, quotes = html.rfind(">"), html.rfind("]]>"), True

    def text(raw: str) -> None:
        if raw:
            if open_[-1].tag == "head" and raw.strip(" \t\n\r\f"):
                open_.pop()
            open_[-1].children.append(unescape(raw))

    def foreign() -> int:
        """Place of the open svg or math that the next tag belongs to; 0 if to none."""
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in _FOREIGN:
                return i
            if open_[i].tag in _PAGE_WITHIN:
                return 0
        return 0

    def close(ends: set | frozenset, stops: set | frozenset) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in ends:
                del open_[i:]
                return close(ends, stops)
            if open_[i].tag in stops:
                return None
        return None

    while at < n:
        if at > last_end and html.find("<!--", at) < 0:
            text(html[at:])
            break
        m = _TOKENS[at <= last_cdata, quotes].search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            open_[-1].children.append(m["cdata"])
            continue
        if m["end"] is not None:
            tag = m["end"].lower()
            if tag == "p" and all(o.tag != "p" for o in open_):
                open_[-1].children.append(Node("p", {}))
            elif tag == "br":
                open_[-1].children.append(Node("br", {}))
            elif tag not in ("html", "body"):
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == tag:
                        del open_[i:]
                        break
                    if open_[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                        break
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        quotes = quotes and m["tag"] is not None
        tag, raw = tag.lower(), m["attrs"] if m["tag"] else m["attrs2"]
        attrs = {a.lower(): unescape(x or y or z or "") for a, x, y, z in _ATTR.findall(raw)} if raw.strip(" /\n\t") else {}
        if tag == "html":
            continue
        if open_[-1].tag == "head" and tag not in _IN_HEAD:
            open_.pop()
        inside_foreign = foreign()
        if inside_foreign and tag in _ENDS_FOREIGN:
            del open_[inside_foreign:]
            inside_foreign = 0
        if inside_foreign or tag in _FOREIGN:
            node = Node(tag, attrs)
            if raw.endswith("/"):
                open_[-1].children.append(node)
            elif inside_foreign and tag in ("script", "style"):
                open_[-1].children.append(node)
                at = _raw_end(html, tag, at)[1]
            else:
                _open(open_, node)
                if inside_foreign and tag in _FOREIGN_UNSEEN[open_[inside_foreign].tag]:
                    node.attrs["hidden"] = ""
            continue
        if tag in _ENDS_P:
            close({"p"}, {"td", "th", "table", "button", "caption"})
        if tag in _IMPLIED:
            close(*_IMPLIED[tag])
        if tag in ("td", "th") and open_[-1].tag in ("table", "tbody", "thead", "tfoot"):
            _open(open_, Node("tr", {}))
        node = Node(tag, attrs)
        if tag in _VOID:
            open_[-1].children.append(node)
        elif tag in _RAW:
            end, after = _raw_end(html, tag, at)
            node.children.append(unescape(html[at:end]))
            at = after
            open_[-1].children.append(node)
        else:
            _open(open_, node)
    return root


def _open(open_: list[Node], node: Node) -> None:
    if len(open_) >= DEPTH:
        open_.pop()
    open_[-1].children.append(node)
    open_.append(node)


def hidden(node: Node) -> bool:
    a = node.attrs
    return (
        node.tag in _UNSEEN
        or "hidden" in a
        or (node.tag == "input" and a.get("type", "").lower() not in ("submit", "button", "reset"))
        or (node.tag == "dialog" and "open" not in a)
        or bool("style" in a and _HIDING.search(a["style"]))
    )


class Layout:
    """Lines of a block of a page."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.indent: list[str] = []
        self._mark = ""
        self._inline: list[str] = []
        self._kept = False
        self._gap = 0

    def text(self, text: str, keep: bool) -> None:
        if not keep:
            self._inline.append(text)
            return
        self._kept = True
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self._inline.append(first)
        for line in rest:
            self.end_line(keep_empty=True)
            self._kept = True
            self._inline.append(line)

    def end_line(self, keep_empty: bool = False) -> None:
        """Ends the current line, if anything stands on it."""
        raw, kept = "".join(self._inline), self._kept
        self._inline, self._kept = [], False
        line = raw.rstrip() if kept else _SPACES.sub(" ", raw).strip()
        if line or keep_empty:
            self._put(line)

    def gap(self, lines: int) -> None:
        """At least so many empty lines before what comes next."""
        self.end_line()
        self._gap = max(self._gap, lines)

    def mark(self, mark: str) -> None:
        self._mark = mark

    def _put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self._gap
        self._gap = 0
        before = "".join(self.indent)
        if self._mark:
            before, self._mark = "".join(self.indent[:-1]) + self._mark, ""
        self.lines.append((before + line).rstrip())

    def block(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._put(line)


def _layout(node: Node, out: Layout, keep: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.text(child, keep)
            continue
        tag = child.tag
        if hidden(child):
            continue
        if tag == "br":
            out.end_line(keep_empty=True)
        elif tag == "wbr":
            continue
        elif tag == "input":
            out.text(f" {child.attrs.get('value', '')} ", False)
        elif tag == "table":
            out.gap(1)
            out.block(_table(child))
            out.gap(1)
        elif tag in ("td", "th"):
            out.text(" ", False)
            _layout(child, out, keep)
            out.text(" ", False)
        elif tag in _BLOCK:
            nested = tag in ("ul", "ol", "menu", "dir") and bool(out.indent)
            out.gap(1 if tag in _SPACED and not nested else 0)
            if tag == "hr":
                continue
            if tag in ("ul", "ol", "menu", "dir"):
                _list(child, out, keep)
            elif tag in ("blockquote", "dd"):
                out.indent.append("    ")
                _layout(child, out, keep)
                out.end_line()
                out.indent.pop()
            else:
                _layout(child, out, keep or tag == "pre")
            out.gap(1 if tag in _SPACED and not nested else 0)
        elif tag == "q":
            out.text('"', keep)
            _layout(child, out, keep)
            out.text('"', keep)
        else:
            _layout(child, out, keep)


def _list(node: Node, out: Layout, keep: bool) -> None:
    number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and not hidden(child):
            if re.fullmatch(r"-?\d{1,9}", child.attrs.get("value", "")):
                number = int(child.attrs["value"])
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            out.end_line()
            out.indent.append(" " * len(mark))
            out.mark(mark)
            _layout(child, out, keep)
            out.end_line()
            out.mark("")
            out.indent.pop()
        else:
            holder = Node("div", {})
            holder.children.append(child)
            _layout(holder, out, keep)


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and not hidden(child):
            if child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)
            else:
                yield child
        elif isinstance(child, str) and child.strip():
            holder = Node("caption", {})
            holder.children.append(child)
            yield holder


def _span(value: str | None) -> int:
    return min(int(value), SPAN) if value and value.isdecimal() and len(value) < 9 and int(value) > 0 else 1


def _table(node: Node) -> list[str]:
    grid: list[tuple[dict[int, list[str]], list[int]] | list[str]] = []
    widths: dict[int, int] = {}
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in _rows(node):
        if row.tag != "tr":
            inside = Layout()
            holder = Node("div", {})
            holder.children.append(row)
            _layout(holder, inside, False)
            inside.end_line()
            grid.append(inside.lines)
            continue
        cells, column = {}, 0
        covered = {c: n for c, n in taken.items() if n}
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip() or isinstance(cell, Node) and hidden(cell):
                continue
            inside = Layout()
            holder = Node("div", {})
            holder.children.append(cell)
            attrs = cell.attrs if isinstance(cell, Node) else {}
            _layout(holder, inside, False)
            inside.end_line()
            while covered.get(column):
                column += 1
            wide, tall = _span(attrs.get("colspan")), _span(attrs.get("rowspan"))
            cells[column] = inside.lines
            if wide == 1:
                widths[column] = max(widths.get(column, 0), *(len(line) for line in inside.lines), 0) if inside.lines else widths.get(column, 0)
            for c in range(column, column + wide):
                if tall > 1:
                    taken[c] = tall
            column += wide
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        grid.append((cells, []))
    out: list[str] = []
    for row in grid:
        if isinstance(row, list):
            out += row
            continue
        cells = row[0]
        for k in range(max((len(c) for c in cells.values()), default=0)):
            line = ""
            at = 0
            for column in range(max(cells) + 1):
                if column in cells:
                    line = line.ljust(at) if len(line) <= at else line + "  "
                    line += cells[column][k] if k < len(cells[column]) else ""
                at += widths.get(column, 0) + 2
            out.append(line.rstrip())
    return out


def render(html: str | None) -> str:
    """Text of a page; a null or empty one has none."""
    out = Layout()
    _layout(build(html or ""), out, False)
    out.end_line()
    lines = out.lines
    while lines and not lines[-1]:
        lines.pop()
    first = next((i for i, line in enumerate(lines) if line), 0)
    return "\n".join(lines[first:])


def rendered(pages: DataFrame) -> DataFrame:
    """(page_id, text) of every row of `pages` (page_id, html)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["page_id"], pa.array([render(h) for h in batch["html"].to_pylist()], pa.string())], names=["page_id", "text"])

    return mapped(pages.select("page_id", "html"), emit, "page_id long, text string")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid-out visible text of all pages: page_id, text.

    All visible text comes out; the layout has two bounds: what is nested deeper than
    `DEPTH` stands beside its parent, and a cell spans at most `SPAN` rows or columns.

    A null or empty html, and one without visible text, gives an empty text; a null
    page_id stays null.  Repeated rows give repeated results, an empty table none;
    further columns are ignored."""
    return rendered(spark.read.parquet(f"{sf_dir}/pages.parquet"))
