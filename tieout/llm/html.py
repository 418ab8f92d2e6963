"""Text of web pages as they are laid out: a tree with implied tags, then all visible text.

Blocks stand apart, items of lists carry their marks and depth, cells of tables are aligned in
columns, and what a browser would not show is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks

# Element names by their role in the rendering.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes iframe noembed".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes"
                   " canvas audio video datalist param meta link base".split())  # fmt: skip
#: What a head may hold; anything else ends it.
IN_HEAD = frozenset("title script style template noscript noframes meta link base".split())
#: Elements of drawings and formulas that are not shown, and those whose content is HTML again.
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask pattern marker style script annotation"
                    " annotation-xml".split())  # fmt: skip
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: Tags that end an open drawing or formula.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i"
                     " img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt"
                     " u ul var".split())  # fmt: skip
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCK = PARAGRAPH | frozenset(
    "html body div section article aside header footer nav main address center details summary form"
    " figcaption dt dd li tr caption thead tbody tfoot legend select optgroup option menu xmp".split()
)
ENDS_P = PARAGRAPH | frozenset(
    "div section article aside header footer nav main address center details form dl menu".split()
)
#: A tag of the first kind closes an open one of the second kind, not beyond one of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "caption": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "colgroup": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "table": ({"table"}, {"td", "th", "caption"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: End tags do not reach beyond these.
SCOPES = frozenset({"table", "td", "th", "caption"})
#: Parts of a table; in those of the second kind only parts may stand.
PARTS = frozenset("caption colgroup col thead tbody tfoot tr td th".split())
SECTIONS = frozenset("colgroup thead tbody tfoot tr".split())
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[ \t\r\n\f]+")
DIGITS = re.compile(r"[ \t\r\n\f]*\+?([0-9]+)")
#: Tables inside tables that are laid out as such, as deep as browsers nest elements, and the
#: widest gap between cells.
DEEPEST, WIDEST = 512, 1_000
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Element:
    __slots__ = ("tag", "attributes", "children", "foreign")

    def __init__(self, tag: str, attributes: dict[str, str], foreign: bool = False):
        self.tag, self.attributes, self.foreign = tag, attributes, foreign
        self.children: list[Element | str] = []

    def hidden(self) -> bool:
        a = self.attributes
        return (
            self.tag in HIDDEN or "hidden" in a or bool(INVISIBLE.search(a.get("style", "")))
            or (self.tag == "input" and a.get("type", "").lower() == "hidden")
            or (self.tag == "object" and bool(a.get("data")))
            or (self.foreign and self.tag in UNDRAWN)
        )


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("raw", text, ""), ("open", tag, attributes) and ("close", tag, "")."""
    at, text_from, lower = 0, 0, None
    while (at := html.find("<", at)) >= 0:
        m = MARKUP.match(html, at)
        if not m:
            at += 1
            continue
        if at > text_from:
            yield "text", html[text_from:at], ""
        at = text_from = m.end()
        if tag := m["tag"]:
            tag = tag.lower()
            yield "close" if m["close"] else "open", tag, m["rest"]
            if tag in RAW and not m["close"] and not m["rest"].endswith("/"):
                lower = html.lower() if lower is None else lower
                end = lower.find(f"</{tag}", at)
                end = len(html) if end < 0 else end
                if tag == "textarea" and end > at:
                    yield "text", html[at:end], ""
                elif tag == "xmp" and end > at:
                    yield "raw", html[at:end], ""
                at = text_from = end
    if text_from < len(html):
        yield "text", html[text_from:], ""


def tree(html: str) -> Element:
    """What stands in a table outside its cells and captions comes before the table."""
    root = Element("html", {})
    stack = [root]
    is_open = Counter(["html"])
    started = False

    def cut(at: int) -> None:
        is_open.subtract(e.tag for e in stack[at:])
        del stack[at:]

    def close(tags: set[str], limits: set[str] | frozenset[str]) -> None:
        """Close the outermost open element among ``tags`` inside the nearest limit."""
        if not any(is_open[t] for t in tags):
            return
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                found = i
            elif stack[i].tag in limits or stack[i].tag == "template":
                break
        if found is not None:
            cut(found)

    def add(child: Element | str) -> None:
        """Into the open element, or before the open table if it may not stand there."""
        at = len(stack) - 1
        if (child.tag not in PARTS) if isinstance(child, Element) else child.strip(" \t\r\n\f"):
            while stack[at].tag in SECTIONS:
                at -= 1
            if stack[at].tag == "table":
                # an open table is the last child of its parent
                outside = stack[at - 1].children
                outside.insert(len(outside) - 1, child)
                return
        stack[-1].children.append(child)

    for kind, name, rest in tokens(html):
        if kind in ("text", "raw"):
            if name.strip(" \t\r\n\f"):
                started = True
                if stack[-1].tag == "head":
                    cut(len(stack) - 1)
            add(unescape(name) if kind == "text" else name)
        elif kind == "open":
            if name in ("html", "body") and is_open[name]:
                continue
            if name == "head" and started:
                continue
            started = started or name != "html"
            if stack[-1].tag == "head" and name not in IN_HEAD:
                cut(len(stack) - 1)
            if name in BREAKOUT:
                while stack[-1].foreign and stack[-1].tag not in INTEGRATION:
                    cut(len(stack) - 1)
            if name in IMPLIED:
                close(*IMPLIED[name])
            if name in PARTS and is_open["table"]:
                at = len(stack) - 1
                while at and stack[at].tag not in SECTIONS and stack[at].tag not in ("table", "template"):
                    at -= 1
                if at:
                    cut(at + 1)
            if name in ENDS_P:
                close({"p"}, SCOPES | {"li", "button"})
            attributes = {
                m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)
            } if rest else {}
            foreign = name in ("svg", "math") or (
                stack[-1].foreign and stack[-1].tag not in INTEGRATION
            )
            element = Element(name, attributes, foreign)
            add(element)
            if name not in VOID and not (rest.endswith("/") and (foreign or name in HIDDEN)):
                stack.append(element)
                is_open[name] += 1
        elif name == "p" and not is_open["p"]:
            add(Element("p", {}))
        elif name not in ("html", "body") and is_open[name]:
            limits = frozenset({"table"}) if name in IMPLIED else SCOPES
            limits = frozenset() if name == "template" else limits
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    cut(i)
                    break
                if stack[i].tag in limits:
                    break
    return root


class Layout:
    """Lines of text in the making: words run on until a block begins or ends."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = [""]
        self.mark = ""

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self.put(first)
            for part in more:
                self.end_line(True)
                self.put(part)
            return
        parts = SPACE.split(text)
        for i, word in enumerate(parts):
            if i:
                self.space = True
            if word:
                if self.space and self.line:
                    self.line.append(" ")
                self.put(word)

    def put(self, text: str) -> None:
        if text:
            self.line.append(text)
            self.space = False

    def end_line(self, even_empty: bool = False) -> None:
        text = "".join(self.line).rstrip(" \t")
        self.line, self.space = [], False
        if not text and not even_empty:
            return
        if self.gap and self.lines:
            self.lines += [""] * (self.gap - 1)
        self.gap = 1
        head = self.indent[-1]
        if self.mark:
            head, self.mark = self.indent[-2] + self.mark, ""
        self.lines.append((head + text).rstrip())

    def block(self, paragraph: bool) -> None:
        self.end_line()
        if self.lines:
            self.gap = max(self.gap, 2 if paragraph else 1)

    def lines_of(self) -> list[str]:
        self.end_line()
        return self.lines


def _rows(table: Element) -> tuple[list[Element], list[list[list[Element]]]]:
    """Captions, and groups of rows of cells, of a table, not of tables inside it. A cell that
    spans rows does so within its group: a head, body or foot, or rows that stand in none."""
    captions: list[Element] = []
    groups: list[list[list[Element]]] = [[]]
    todo: list[Element | str | None] = list(reversed(table.children))
    while todo:
        e = todo.pop()
        if e is None:  # a group ends
            groups.append([])
        elif isinstance(e, str) or e.hidden():
            continue
        elif e.tag == "caption":
            captions.append(e)
        elif e.tag == "tr":
            groups[-1].append([c for c in e.children if isinstance(c, Element) and not c.hidden()])
        elif e.tag in ("td", "th"):
            groups[-1].append([e])
        elif e.tag in ("thead", "tbody", "tfoot"):
            groups.append([])
            todo.append(None)
            todo += reversed(e.children)
        elif e.tag != "table":
            todo += reversed(e.children)
    return captions, [g for g in groups if g]


def _span(cell: Element, name: str, most: int, none: int) -> int:
    """The leading digits of an attribute as a span; ``none`` where it is 0."""
    found = DIGITS.match(cell.attributes.get(name, "1"))
    if not found:
        return 1
    digits = found[1].lstrip("0")
    return (min(most, int(digits)) if len(digits) <= 6 else most) if digits else none


def grid(groups: list[list[list[tuple[int, int]]]]) -> list[list[int]]:
    """First columns of the cells, row by row, from their (columns, rows) in groups of rows.

    A cell takes the first column that no cell from a row above reaches into. Places that cells
    reach into are kept as intervals of columns, side by side ones of one end as one."""
    out = []
    for rows in groups:
        taken: list[tuple[int, int, int]] = []  # columns from, to, and the row they are free in
        for y, cells in enumerate(rows):
            taken = [t for t in taken if t[2] > y] if cells else taken
            places, at, i = [], 0, 0
            fresh: list[tuple[int, int, int]] = []
            for across, down in cells:
                while i < len(taken) and taken[i][0] <= at:
                    at = max(at, taken[i][1])
                    i += 1
                places.append(at)
                if down > 1:
                    last = fresh[-1] if fresh else (0, -1, 0)
                    if last[1] == at and last[2] == y + down:
                        fresh[-1] = (last[0], at + across, y + down)
                    else:
                        fresh.append((at, at + across, y + down))
                at += across
            out.append(places)
            if fresh:
                taken = sorted(taken + fresh)
    return out


def _aligned(rows: list[list[list[str]]], spans: list[list[int]], places: list[list[int]]) -> list[str]:
    """Cells side by side, each column as wide as its widest one-column cell. Columns in which
    no cell begins or ends take no room, and a gap has at most ``WIDEST`` blanks."""
    edges = sorted({x for own, at in zip(spans, places, strict=True) for n, c in zip(own, at, strict=True) for x in (c, c + n)})
    column = {x: i for i, x in enumerate(edges)}
    width = [0] * len(edges)
    for cells, own, at in zip(rows, spans, places, strict=True):
        for lines, n, c in zip(cells, own, at, strict=True):
            if column[c + n] == column[c] + 1:
                width[column[c]] = max([width[column[c]], *map(len, lines)])
    offset = [0]
    for w in width:
        offset.append(offset[-1] + w + 2)
    out = []
    for cells, at in zip(rows, places, strict=True):
        for i in range(max([len(lines) for lines in cells], default=0)):
            parts, end = [], 0
            for lines, c in zip(cells, at, strict=True):
                text = lines[i] if i < len(lines) else ""
                if text:
                    start = max(offset[column[c]], end + 2 if end else 0)
                    parts.append(" " * min(start - end, WIDEST))
                    parts.append(text)
                    end = start + len(text)
            out.append("".join(parts).rstrip())
    return out


def _tables(root: Element) -> list[Element]:
    """Visible tables, outer ones before those inside them, not deeper than browsers nest."""
    out, todo = [], [(root, 0)]
    while todo:
        e, depth = todo.pop()
        if isinstance(e, str) or e.hidden():
            continue
        if e.tag == "table":
            if depth == DEEPEST:
                continue
            out.append(e)
            depth += 1
        todo += [(c, depth) for c in reversed(e.children)]
    return out


def _table_lines(table: Element, done: dict[int, list[str]]) -> list[str]:
    captions, groups = _rows(table)
    lines = [line for c in captions for line in _flow(_as_div(c), done)]
    rows = [row for group in groups for row in group]
    spans = [[_span(c, "colspan", 1_000, 1) for c in row] for row in rows]
    shape, at = [], 0
    for group in groups:
        own = []
        for y, row in enumerate(group):
            down = [_span(c, "rowspan", 65_534, 65_534) for c in row]
            own.append([(n, min(d, len(group) - y)) for n, d in zip(spans[at], down, strict=True)])
            at += 1
        shape.append(own)
    cells = [[_flow(_as_div(c), done) for c in row] for row in rows]
    return lines + _aligned(cells, spans, grid(shape))


def render(root: Element) -> list[str]:
    """Lines of the visible text: inner tables first, then what they stand in, so that nesting
    costs no stack. Tables deeper than ``DEEPEST`` run on like blocks."""
    done: dict[int, list[str]] = {}
    for table in reversed(_tables(root)):
        done[id(table)] = _table_lines(table, done)
    return _flow(root, done)


def _flow(root: Element, done: dict[int, list[str]]) -> list[str]:
    """Lines of an element's text; those of its tables are taken from ``done``. Elements wait on
    a list."""
    out = Layout()
    counters: list[int | None] = []
    flat = 0
    todo: list[tuple[str, Element | str, bool]] = [("open", root, False)]
    while todo:
        step, e, pre = todo.pop()
        if isinstance(e, str):
            out.text(e, pre)
            continue
        tag = e.tag
        if step == "close":
            if tag in ("ul", "ol", "menu"):
                counters.pop()
            if tag in ("li", "dd", "blockquote"):
                out.end_line()
                out.mark = ""
                out.indent.pop()
            flat -= tag == "table"
            out.block(tag in PARAGRAPH and not (tag in ("ul", "ol") and counters))
            continue
        if e.hidden():
            continue
        if tag == "br":
            out.end_line(True)
        elif tag == "hr":
            out.block(True)
        elif tag == "img":
            if alt := e.attributes.get("alt", "").strip():
                out.text(alt, False)
        elif tag == "input":
            out.text(e.attributes.get("value", ""), False)
        elif tag == "table" and id(e) in done:
            out.block(True)
            for line in done.pop(id(e)):
                out.put(line)
                out.end_line(True)
            out.block(True)
        else:
            flat += tag == "table"
            is_block = tag in BLOCK or (tag in ("td", "th") and flat > 0)
            if is_block:
                out.block(tag in PARAGRAPH and not (tag in ("ul", "ol") and counters))
                todo.append(("close", e, pre))
            if tag in ("ul", "menu"):
                counters.append(None)
            elif tag == "ol":
                start = e.attributes.get("start", "1").strip()
                counters.append(int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1)
            elif tag == "optgroup" or (tag == "option" and not e.children):
                if label := e.attributes.get("label", "").strip():
                    out.text(label, False)
                    out.end_line()
            elif tag == "text" and e.foreign:
                out.space = True
                todo.append(("open", " ", False))
            elif tag == "li":
                number = counters[-1] if counters else None
                out.mark = "- " if number is None else f"{number}. "
                if number is not None:
                    counters[-1] = number + 1
                out.indent.append(out.indent[-1] + " " * len(out.mark))
            elif tag in ("dd", "blockquote"):
                out.indent.append(out.indent[-1] + "  ")
            inside = pre or tag in ("pre", "textarea", "xmp")
            todo += (("open", c, inside) for c in reversed(e.children))
    return out.lines_of()


def _as_div(e: Element) -> Element:
    div = Element("div", {})
    div.children = e.children
    return div


def visible_text(html: str | None) -> str:
    """The page's text, lines joined by line breaks; empty for null and empty pages."""
    return "\n".join(render(tree(html))).strip("\n") if html else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            texts = [visible_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for each row of ``pages``: all visible text, laid out.

    Null and empty pages give an empty text; text outside any tag is kept as it is. Text that a
    table holds outside its cells is shown before it, as browsers do. Null ids
    and addresses stay null, repeated rows give repeated rows, extra columns are not looked at.
    """
    found_by_tasks(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string"
    )
