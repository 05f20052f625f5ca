"""HTML to text as a page would show it.

A tree builder supplies the tags that authors leave out (``html``, ``body``, ends of ``p``, ``li``, ``tr``, ``td`` and
so on) and moves stray text out of tables. A renderer then walks the tree: it leaves out what is not displayed, starts lines at
blocks, leaves an empty line around paragraphs, marks and indents list items, and aligns the cells of tables. Both work
with stacks of their own, so no page is nested too deeply for them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes of elements after the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
BLOCK = CLOSES_P | frozenset("html body caption legend option optgroup tr title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure hr fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title html".split())
RAW = frozenset("script style iframe noembed noframes xmp".split())
PLAIN = frozenset("textarea title".split())  # their content is text with references
HIDDEN = frozenset("head script style template title noscript noembed noframes iframe datalist audio video canvas object svg math area param rp".split())
FORMATTING = frozenset("a abbr b big cite code del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
SCOPE = frozenset("html body table td th caption template button object marquee applet".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())

# Elements that may be open at once, so that looking for one to close takes a bounded time. Deeper ones are not opened, their
# text stands where they stand; one that is not displayed is opened still, and hides what is in it.
DEEPEST = 512
WIDEST = 60  # of a column that is aligned; longer cells run over, so that padding stays in proportion to the text

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(/?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
BLANKS = re.compile(r"[ \t\n\r\f]+")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        if not self.attrs:
            return {}
        found = ATTRIBUTE.findall(self.attrs)
        return {name.lower(): html.unescape(a or b or c) for name, a, b, c in reversed(found)}


# --- tree builder -----------------------------------------------------------------------------------------------------


class Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.body = Node("body")
        self.root.children.append(self.body)
        self.open = [self.root, self.body]
        self.head: Node | None = None
        # Elements too deep to be opened, whose ends close nothing else; apart for those in a hidden one that was opened.
        self.passed: list[dict[str, int]] = [{}]

    def _close(self, tags: frozenset[str] | tuple[str, ...], bounds: frozenset[str]) -> bool:
        """Close the innermost open element of ``tags``, and all within it, unless one of ``bounds`` lies between."""
        for k in range(len(self.open) - 1, 1, -1):
            tag = self.open[k].tag
            if tag in tags:
                del self.open[k:]
                if k <= DEEPEST:
                    self.passed = self.passed[:1] if k == DEEPEST else [{}]
                return True
            if tag in bounds:
                return False
        return False

    def _has(self, tag: str, bound: str) -> bool:
        for node in reversed(self.open):
            if node.tag == tag:
                return True
            if node.tag == bound:
                return False
        return False

    def _leave_head(self) -> None:
        if self.head is not None:
            if self.head in self.open:
                del self.open[self.open.index(self.head) :]
            self.head = None

    def start(self, tag: str, attrs: str, closed: bool = False) -> None:
        if tag == "html" or tag == "body":
            if tag == "body":
                self._leave_head()
            target = self.root if tag == "html" else self.body
            target.attrs = target.attrs or attrs
            return
        if tag == "head":
            if len(self.open) == 2 and not self.body.children:
                self.head = Node("head", attrs)
                self._push(self.head)
            return
        if self.head is not None and tag not in IN_HEAD:
            self._leave_head()
        if tag in CLOSES_P:
            self._close(("p",), SCOPE)
        if tag == "li":
            self._close(("li",), SCOPE | {"ul", "ol", "menu", "dir"})
        elif tag in ("dt", "dd"):
            self._close(("dt", "dd"), SCOPE | {"dl"})
        elif tag in HEADINGS:
            if self.open[-1].tag in HEADINGS:
                self.open.pop()
        elif tag == "option":
            self._close(("option",), SCOPE | {"select", "optgroup"})
        elif tag == "optgroup":
            self._close(("option",), SCOPE | {"select", "optgroup"})
            self._close(("optgroup",), SCOPE | {"select"})
        elif tag in ("a", "button", "nobr"):
            self._close((tag,), SCOPE - {"button"})
        elif tag in ("td", "th"):
            self._close(("td", "th"), frozenset({"table"}))
            if self._has("table", "html") and not self._has("tr", "table"):
                self._push(Node("tr"))
        elif tag == "tr":
            self._close(("tr",), frozenset({"table"}))
        elif tag in ("thead", "tbody", "tfoot", "caption", "colgroup", "col"):
            self._close(("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset({"table"}))
        node = Node(tag, attrs)
        if tag in VOID:
            self._place(node)
        else:
            self._push(node)
            if closed and tag in ("svg", "math"):
                self._close((tag,), frozenset())

    def _push(self, node: Node) -> None:
        self._place(node)
        if len(self.open) < DEEPEST:
            self.open.append(node)
        elif len(self.open) == DEEPEST and not _shown(node, node.attributes()):
            self.open.append(node)
            self.passed.append({})
        else:
            self.passed[-1][node.tag] = self.passed[-1].get(node.tag, 0) + 1

    def _place(self, node: Node | str) -> None:
        top = self.open[-1]
        inside = isinstance(node, Node) and (node.tag in TABLE_PARTS or node.tag in HIDDEN or node.tag in ("td", "th", "caption", "colgroup", "col"))
        if top.tag in TABLE_PARTS and not inside:
            # What may not stand in a table goes before it.
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag == "table":
                    around = self.open[k - 1].children
                    around.insert(len(around) - 1, node)
                    return
        top.children.append(node)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if self.passed[-1].get(tag):
            self.passed[-1][tag] -= 1
            return
        if tag == "br":
            self.start("br", "")
        elif tag == "head":
            self._leave_head()
        elif tag in HEADINGS:
            self._close(HEADINGS, SCOPE)
        elif tag in FORMATTING:
            self._close((tag,), SCOPE | CLOSES_P)
        elif tag in TABLE_PARTS or tag in ("td", "th", "caption"):
            self._close((tag,), frozenset({"table"}) - {tag})
        elif tag == "li":
            self._close((tag,), SCOPE | {"ul", "ol", "menu", "dir"})
        else:
            self._close((tag,), SCOPE - {tag})

    def text(self, data: str) -> None:
        if not data:
            return
        if data.isspace():
            if self.open[-1].tag in TABLE_PARTS or self.head is not None:
                return
        elif self.head is not None and self.open[-1] is self.head:
            self._leave_head()
        self._place(data)


def parse(page: str) -> Node:
    """The tree of a page; every page has one."""
    tree, at, size = Builder(), 0, len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if token is None:
            break
        if token.start() > at:
            tree.text(html.unescape(page[at : token.start()]))
        at = token.end()
        end, start, attrs, closed = token.groups()
        if end:
            tree.end(end.lower())
        elif start:
            tag = start.lower()
            tree.start(tag, attrs, bool(closed))
            if tag in RAW or tag in PLAIN:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                stop = close.start() if close else size
                if tag in PLAIN:
                    tree.text(html.unescape(page[at:stop]))
                at = stop
                if not close:
                    tree.end(tag)
    if at < size:
        tree.text(html.unescape(page[at:]))
    return tree.root


# --- renderer ---------------------------------------------------------------------------------------------------------


class Lines:
    """Text as it is laid out: lines, the line begun, and how far the next text must stand from it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0
        self.blank = False
        self.indent: list[str] = []
        self.marker = ""

    def write(self, data: str, kept: bool) -> None:
        if kept:
            for k, line in enumerate(data.replace("\r\n", "\n").split("\n")):
                if k:
                    self.end_line()
                if line:
                    self._append(line)
            return
        data = BLANKS.sub(" ", data)
        if data.startswith(" "):
            self.blank = True
        core = data.strip(" ")
        if core:
            self._append(core)
            self.blank = data.endswith(" ")

    def _append(self, piece: str) -> None:
        if self.gap:
            if self.gap > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = 0
            self.blank = False
        if self.now:
            if self.blank:
                self.now.append(" ")
        else:
            lead = "".join(self.indent)
            self.now.append(lead[: len(lead) - len(self.marker)] + self.marker if self.marker else lead)
            self.marker = ""
        self.blank = False
        self.now.append(piece)

    def end_line(self) -> None:
        self.lines.append("".join(self.now).replace("\xa0", " ").rstrip())
        self.now, self.blank = [], False

    def stop(self, gap: int) -> None:
        """The next text starts a line, ``gap`` - 1 empty lines further down."""
        if self.now:
            self.end_line()
        self.blank = False
        self.gap = max(self.gap, gap)

    def add_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._append(line)
            self.end_line()

    def result(self) -> list[str]:
        if self.now:
            self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def _columns(text: str) -> int:
    """How many columns a text takes: two for a wide character, none for a mark on the one before."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.category(c) in ("Mn", "Me", "Cf") else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def _places(self) -> Iterator[list[tuple[int, list[str], int]]]:
        """For each row its cells with the column of each: those free of cells that reach down from rows above."""
        taken: dict[int, int] = {}
        for row in self.rows:
            placed, at, new = [], 0, {}
            for cell, wide, high in row:
                while taken.get(at, 0):
                    at += 1
                placed.append((at, cell, wide))
                if high > 1:
                    new.update(dict.fromkeys(range(at, at + wide), high))
                at += wide
            yield placed
            taken = {c: n - 1 for c, n in (taken | new).items() if n > 1}

    def lines(self) -> list[str]:
        """Rows with aligned columns, two blanks apart. A cell of several lines makes its row as high; one that spans
        columns leaves the next ones empty, one that spans rows its column in the next rows."""
        rows, widths = list(self._places()), {}
        for row in rows:
            for at, cell, span in row:
                wide = max(map(_columns, cell), default=0)
                if span == 1 and wide <= WIDEST:
                    widths[at] = max(widths.get(at, 0), wide)
        out = []
        for row in rows:
            for k in range(max((len(cell) for _, cell, _ in row), default=0)):
                pieces, next_ = [], 0
                for at, cell, span in row:
                    pieces.append(" " * sum(widths.get(c, 0) + 2 for c in range(next_, at)))
                    room = sum(widths.get(c, 0) + 2 for c in range(at, at + span))
                    text = cell[k] if k < len(cell) else ""
                    pieces.append(text + " " * max(0, room - 2 - _columns(text)) + "  ")
                    next_ = at + span
                out.append("".join(pieces).rstrip())
        return out


def _shown(node: Node, attrs: dict[str, str]) -> bool:
    if node.tag in HIDDEN or "hidden" in attrs:
        return False
    if node.tag == "dialog" and "open" not in attrs:
        return False
    return not ("style" in attrs and NOT_SHOWN.search(attrs["style"]))


def _number(value: str | None, default: int, most: int = 10**6) -> int:
    return min(int(value), most) if value is not None and re.fullmatch(r"[0-9]{1,9}", value.strip()) else default


def render(root: Node) -> str:
    """The visible text of a tree."""
    outs, tables, lists, kept = [Lines()], [], [], 0
    stack: list[tuple[Node, dict[str, str], Iterator, bool]] = [(root, {}, iter(root.children), True)]
    while stack:
        node, attrs, children, seen = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            kept -= _leave(node, attrs, outs, tables, lists)
        elif node.tag == "details" and "open" not in attrs and getattr(child, "tag", "") != "summary":
            continue  # of details that are not open, only the summary shows
        elif isinstance(child, str):
            if seen:
                outs[-1].write(child, kept > 0)
        else:
            own = child.attributes()
            if not _shown(child, own):
                continue
            # Visibility goes down to what is inside, until an element there says otherwise.
            said = VISIBILITY.findall(own["style"]) if "style" in own else ()
            now = said[-1].lower() == "visible" if said else seen
            if now or child.tag not in ("br", "input"):
                kept += _enter(child, own, outs, tables, lists)
                stack.append((child, own, iter(child.children), now))
    return "\n".join(outs[0].result())


def _enter(node: Node, attrs: dict[str, str], outs: list[Lines], tables: list[Table], lists: list[list]) -> int:
    tag, out = node.tag, outs[-1]
    if tag == "br":
        out.gap and out.stop(1)
        out.end_line() if out.now or not out.gap else None
    elif tag in ("ul", "ol", "menu", "dir"):
        out.stop(1 if lists else 2)
        lists.append([tag == "ol", _number(attrs.get("start"), 1)])
        out.indent.append("  " if tag != "ol" else "   ")
    elif tag == "li":
        out.stop(1)
        if lists and lists[-1][0]:
            lists[-1][1] = _number(attrs.get("value"), lists[-1][1])
            out.marker = f"{lists[-1][1]}. "
            lists[-1][1] += 1
        else:
            out.marker = "- "
    elif tag == "dd" or tag == "blockquote":
        out.stop(2 if tag == "blockquote" else 1)
        out.indent.append("  ")
    elif tag == "table":
        out.stop(2)
        tables.append(Table())
        outs.append(Lines())  # caption and what else has no cell
    elif tag == "tr" and tables:
        tables[-1].rows.append([])
    elif tag in ("td", "th") and tables:
        outs.append(Lines())
    elif tag in SPACED:
        out.stop(2)
    elif tag in BLOCK:
        out.stop(1)
    elif tag == "input" and attrs.get("type", "").lower() in ("submit", "button", "reset"):
        out.write(f" {attrs.get('value', '')} ", False)
    return int(tag in ("pre", "textarea", "xmp"))


def _leave(node: Node, attrs: dict[str, str], outs: list[Lines], tables: list[Table], lists: list[list]) -> int:
    tag = node.tag
    if tag in ("td", "th") and tables:
        cell = outs.pop().result()
        if not tables[-1].rows:
            tables[-1].rows.append([])
        high = _number(attrs.get("rowspan"), 1, 65_534)
        # No rows means all that follow.
        tables[-1].rows[-1].append((cell, max(1, _number(attrs.get("colspan"), 1, 1000)), high or 65_534))
    elif tag == "table":
        above, made = outs.pop().result(), tables.pop().lines()
        outs[-1].add_lines(above)
        outs[-1].add_lines(made)
        outs[-1].stop(2)
    elif tag in ("ul", "ol", "menu", "dir"):
        lists.pop()
        outs[-1].indent.pop()
        outs[-1].stop(1 if lists else 2)
    elif tag == "dd" or tag == "blockquote":
        outs[-1].indent.pop()
        outs[-1].stop(2 if tag == "blockquote" else 1)
    elif tag == "li":
        outs[-1].marker = ""
        outs[-1].stop(1)
    elif tag in SPACED:
        outs[-1].stop(2)
    elif tag in BLOCK:
        outs[-1].stop(1)
    return int(tag in ("pre", "textarea", "xmp"))


def to_text(page: str) -> str:
    """The visible text of a page; empty for an empty page."""
    return render(parse(page))


def extract(page: Column) -> Column:
    """The visible text of an HTML column; null stays null."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if p is None else to_text(p) for p in batch.to_pylist()], pa.string())

    return run(page)


def extract_pages(pages: DataFrame, page: str = "html", key: str = "page_id") -> DataFrame:
    """``(page_id, text)`` for every row of ``pages``: the whole visible text.

    A null page has a null text, an empty one an empty text. Repeated rows come out as often as they come in; an empty
    table gives an empty one. Other columns are ignored. Pages may be nested to any depth (see ``DEEPEST``).
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(page).alias("page"))
    return rows.select("page_id", extract(F.col("page")).alias("text"))
