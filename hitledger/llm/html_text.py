"""The visible text of HTML pages, laid out as a reader sees it.

A page is read in one pass into a tree: tags that may be left out are implied (a new paragraph ends
the open one, a list item the one before, a row the cells of the last), stray end tags are ignored
and what is still open at the end is closed. The tree is then walked without recursion and rendered:

- Invisible parts give nothing: head, scripts, styles, templates, ``hidden``, ``display:none``,
  ``visibility:hidden`` (unless made visible again within), closed ``details`` and ``dialog``, and
  what stands in for scripts, frames, media and canvas that a browser shows (``noscript`` and the like).
  A head ends at the first text or start tag that can't stand in one.
- Of drawings (``svg``) the text elements and foreign objects are shown; tags of HTML end a drawing.
- White space collapses but in ``pre`` and ``textarea``. Blocks start on lines of their own;
  paragraphs, headings, lists, tables and the like are set off by a blank line.
- Items of lists get ``-`` or their number, and are indented by depth.
- The cells of a table are laid out in columns as wide as their widest line; cells that span rows or
  columns keep their place. Tables within cells are laid out within. What separates two texts of a
  line, or goes before the first, is at most ``GAP`` wide: blanks and the border stand for a wider
  gap. So each line takes room and time by its own cells, however large the table.

Elements nested deeper than ``DEPTH`` become siblings at that depth, so time stays in proportion to
the page; their text is kept.

Nulls and odd input: a null page gives null, an empty one an empty text; text that is no HTML at all
is rendered as one paragraph; unfinished tags are text; repeated rows each get their text; no rows
give no rows. Columns of the input are carried whole but the page's, and the text's name is the
caller's.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hitledger.llm.shared import prepare, with_columns

DEPTH = 400
# The widest gap between two texts of a table's line, and before the first.
GAP = 100

# Quotes in a tag may hold ">"; where quotes don't pair up to the end of the page, the next ">" ends a tag.
_TOKEN, _LOOSE = (
    re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>{rest})>"
        r"|<[!?/][^>]*>"
        r"|[^<]+|<",
        re.S,
    )
    for rest in (r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+", r"[^>]*+")
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is text up to their end tag.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_INVISIBLE = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas datalist colgroup".split())
# What may stand in a head, and what in it may hold more.
_HEAD, _HEAD_FENCE = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split()), frozenset(("template", "noscript"))
# In drawings: what holds text that is shown, what is not drawn itself, and the tags that end a drawing.
_DRAWN, _UNDRAWN, _SVG_FENCE = frozenset(("text", "foreignobject")), frozenset("defs symbol desc metadata clippath mask pattern marker".split()), frozenset(("foreignobject", "desc"))
_NO_DRAWING = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# Blocks, and the blank lines that set them off.
_BLOCK = dict.fromkeys("address article aside body center dd details dialog div dt fieldset figcaption footer form header html legend li main nav section summary optgroup tr caption thead tbody tfoot td th".split(), 0) | dict.fromkeys(
    "blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split(), 1
)
_LISTS = frozenset(("ul", "ol", "menu"))
# A start tag ends the open elements named, if no element of the fence lies between.
_ROWS, _TABLE = ("td", "th", "tr"), frozenset(("table",))
_ENDS: dict[str, tuple[tuple[str, ...], frozenset[str]]] = {
    "li": (("li",), _LISTS),
    "dt": (("dt", "dd"), frozenset(("dl",))),
    "dd": (("dt", "dd"), frozenset(("dl",))),
    "option": (("option",), frozenset(("select", "datalist"))),
    "optgroup": (("option", "optgroup"), frozenset(("select",))),
    "td": (("td", "th"), frozenset(("table", "tr"))),
    "th": (("td", "th"), frozenset(("table", "tr"))),
    "tr": (_ROWS, _TABLE),
} | dict.fromkeys(("thead", "tbody", "tfoot", "caption", "colgroup"), ((*_ROWS, "thead", "tbody", "tfoot", "caption", "colgroup"), _TABLE))
_CELL_FENCE = frozenset(("table", "td", "th", "caption", "button", "object", "template"))


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)


class _Builder:
    """Open elements, the root first."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.open, self.count = [self.root], Counter(("html",))

    def pop_to(self, tags: tuple[str, ...], fence: frozenset[str]) -> None:
        """End the outermost of the elements named above the nearest fence, and all within it."""
        if not any(self.count[t] for t in tags):
            return
        found = 0
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in fence:
                break
        if found:
            self.cut(found)

    def cut(self, at: int) -> None:
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]

    def text(self, s: str) -> None:
        if self.count["head"] and s.strip(" \t\n\r\f"):
            self.pop_to(("head",), _HEAD_FENCE)
        self.open[-1].children.append(s)

    def start(self, tag: str, attributes: dict[str, str], closed: bool = False) -> Node:
        """The element's node; ``closed`` if the tag ends in a slash, which counts in drawings."""
        if tag not in _HEAD:
            self.pop_to(("head",), _HEAD_FENCE)
        if tag in ("html", "body") and self.count[tag]:
            return self.open[-1]
        if tag in _NO_DRAWING:
            self.pop_to(("svg",), _SVG_FENCE)
        if tag in _BLOCK and tag not in ("html", "body"):
            self.pop_to(("p",), _CELL_FENCE)
        if tag in _ENDS:
            self.pop_to(*_ENDS[tag])
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if tag not in _VOID and len(self.open) < DEPTH and not (closed and (tag == "svg" or self.count["svg"])):
            self.open.append(node)
            self.count[tag] += 1
        return node

    def end(self, tag: str) -> None:
        if tag == "br" or tag == "p" and not self.count["p"]:
            self.open[-1].children.append(Node(tag))
        elif tag not in ("html", "body") and self.count[tag]:
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    self.cut(at)
                    break
                if self.open[at].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                    break


def parse(page: str) -> Node:
    builder, at, token, last = _Builder(), 0, _TOKEN, page.rfind(">")
    while at < len(page):
        if at > last:  # no tag can end
            rest = page[at : None if (note := page.find("<!--", at)) < 0 else note]
            builder.text(html.unescape(rest))
            break
        m = token.match(page, at)
        tag = m["tag"]
        if m[0] == "<" and token is _TOKEN and page[at + 1 : at + 3].lstrip("/")[:1].isalpha():
            token = _LOOSE
            continue
        at = m.end()
        if tag is None:
            if len(m[0]) == 1 or not m[0].startswith(("<!", "<?", "</")):
                builder.text(html.unescape(m[0]))
            continue
        tag = tag.lower()
        if m["close"]:
            builder.end(tag)
            continue
        rest = m["rest"]
        attributes = {a.lower(): html.unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(rest)} if rest else {}
        node = builder.start(tag, attributes, rest.endswith("/"))
        if tag in _RAW:
            stop = _RAW[tag].search(page, at)
            body = page[at : stop.start() if stop else len(page)]
            if tag in ("textarea", "title"):
                body = html.unescape(body)
            node.children.append(body)
            if builder.open[-1] is node:
                builder.end(tag)
            at = stop.end() if stop else len(page)
    return builder.root


class Flow:
    """Lines of text; what follows on a line, and how many blank lines go before it, is kept back until there is text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.space = 0, False
        self.indent, self.marker = "", ""

    def _begin(self) -> None:
        if not self.parts:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap, self.space = 0, False
            self.parts.append(self.indent[: len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent)
            self.marker = ""

    def text(self, s: str) -> None:
        words = _SPACES.split(s)
        shown = " ".join(w for w in words if w)
        if not shown:
            self.space |= bool(s)
            return
        starts = not self.parts
        space = self.space or not words[0]
        self._begin()
        if space and not starts:
            self.parts.append(" ")
        self.parts.append(shown)
        self.space = not words[-1]

    def plain(self, s: str) -> None:
        """Text whose white space counts."""
        for i, line in enumerate(s.replace("\r\n", "\n").split("\n")):
            if i:
                self.line()
            if line:
                self._begin()
                self.parts.append(line)

    def line(self) -> None:
        """End the line, also an empty one."""
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
        elif self.lines:
            self.lines.append("")
        self.space = False

    def block(self, gap: int) -> None:
        if self.parts:
            self.line()
            self.gap = 0
        self.gap, self.space = max(self.gap, gap), False

    def done(self) -> list[str]:
        if self.parts:
            self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class _Table:
    """Cells by row and column: each where it starts, with its lines and the columns and rows it spans."""

    rows: list[dict[int, tuple[list[str], int, int]]] = field(default_factory=list)
    # Columns that cells of earlier rows cover, and the row where they end; the next free column of this row.
    hanging: list[tuple[int, int, int]] = field(default_factory=list)
    below: list[tuple[int, int, int]] = field(default_factory=list)
    free: int = 0
    passed: int = 0

    def row(self) -> None:
        self.rows.append({})
        r = len(self.rows) - 1
        self.hanging, self.below = sorted(h for h in (*self.hanging, *self.below) if h[2] > r), []
        self.free = self.passed = 0

    def add(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        r = len(self.rows) - 1
        while self.passed < len(self.hanging) and self.hanging[self.passed][0] <= self.free:
            self.free = max(self.free, self.hanging[self.passed][1])
            self.passed += 1
        if down > 1:
            self.below.append((self.free, self.free + across, r + down))
        self.rows[r][self.free] = lines, across, down
        self.free += across

    def laid_out(self) -> list[str]:
        width = self._widths()
        used = sorted(width)
        start = list(accumulate((width[c] + 3 for c in used), initial=0))
        places = [[(bisect_left(used, c), bisect_left(used, c + across), lines, down) for c, (lines, across, down) in row.items()] for row in self.rows]
        # Columns that a cell covers beside its first have no border to their left.
        inner, ends = _Sums(len(used) + 1), defaultdict(list)
        out = []
        for r, row in enumerate(places):
            for i, j in ends.pop(r, ()):
                inner.add(i + 1, -1)
                inner.add(j, 1)
            for i, j, _, down in row:
                if j - i > 1:
                    inner.add(i + 1, 1)
                    inner.add(j, -1)
                    ends[r + down].append((i, j))
            shown = [(i, lines) for i, j, lines, _ in row if i < j]
            own = {i for i, _ in shown}
            pieces: list[list[tuple[int, str]]] = [[] for _ in range(max((len(lines) for _, lines in shown), default=0))]
            for i, lines in shown:
                for n, line in enumerate(lines):
                    if line:
                        pieces[n].append((i, line))
            for line in pieces:
                parts, at = [], 0
                for i, text in line:
                    gap = start[i] - at
                    if gap > GAP:
                        parts.append(" | ".rjust(GAP))
                    elif gap:
                        blank = [" "] * gap
                        for k in range(bisect_left(start, at + 3), i + 1):
                            if k in own or not inner.before(k + 1):
                                blank[start[k] - 2 - at] = "|"
                        parts += blank
                    parts.append(text)
                    at = start[i] + len(text)
                out.append("".join(parts))
        return out

    def _widths(self) -> dict[int, int]:
        """Widths of the columns that hold text: cells of one column first; what doesn't fit a wider cell widens its last column."""
        width: dict[int, int] = {}
        wide = []
        for row in self.rows:
            for c, (lines, across, _) in row.items():
                size = max(map(len, lines), default=0)
                if across > 1:
                    wide.append((across, c, size))
                elif size > width.get(c, 0):
                    width[c] = size
        last = sorted({*width, *(c + across - 1 for across, c, _ in wide)})
        room = _Sums(len(last))
        for c in width if wide else ():
            room.add(bisect_left(last, c), width[c] + 3)
        for across, c, size in sorted(wide):
            end = bisect_left(last, c + across - 1)
            before = room.before(end) - room.before(bisect_left(last, c))
            old = width.get(last[end], 0)
            if size > max(0, before + old if old else before - 3):
                width[last[end]] = max(1, size - before)
                room.add(end, width[last[end]] - old + (0 if old else 3))
        return width


class _Sums:
    """Numbers at places, added to one by one, and their sums (a binary indexed tree)."""

    def __init__(self, n: int) -> None:
        self.sums = [0] * (n + 1)

    def add(self, at: int, more: int) -> None:
        at += 1
        while at < len(self.sums):
            self.sums[at] += more
            at += at & -at

    def before(self, at: int) -> int:
        """The sum of the numbers at places under ``at``."""
        total = 0
        while at:
            total += self.sums[at]
            at &= at - 1
        return total


def _visible(node: Node, hidden: bool) -> tuple[bool, bool]:
    """Whether the node is laid out at all, and whether its own text is hidden."""
    a = node.attributes
    if node.tag in _INVISIBLE or "hidden" in a or node.tag == "dialog" and "open" not in a:
        return False, hidden
    for name, value in _STYLE.findall(a.get("style", "")):
        if name.lower() == "display" and value.lower() == "none":
            return False, hidden
        if name.lower() == "visibility":
            hidden = value.lower() in ("hidden", "collapse")
    return True, hidden


def _number(value: str | None, other: int, most: int = 1_000_000_000) -> int:
    return min(int(value), most) if value and re.fullmatch(r"-?[0-9]{1,10}", value) else other


def _shown_children(node: Node) -> list:
    if node.tag == "details" and "open" not in node.attributes:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag == "select":
        options = [o for c in node.children if isinstance(c, Node) for o in ([c] if c.tag == "option" else [x for x in c.children if isinstance(x, Node) and x.tag == "option"])]
        return [o for o in options if "selected" in o.attributes][:1] or options[:1]
    return node.children


def render(root: Node) -> str:
    flows, tables, lists = [Flow()], [], []
    # What is left to do: a node or text to enter with its state (hidden, preformatted, in a drawing), or a call for a node's end.
    todo: list = [(root, False, False, False)]
    while todo:
        step = todo.pop()
        if callable(step):
            step()
            continue
        node, hidden, pre, drawing = step
        flow = flows[-1]
        if isinstance(node, str):
            if not hidden and not drawing:
                (flow.plain if pre else flow.text)(node)
            continue
        shown, hidden = _visible(node, hidden)
        if not shown or drawing and node.tag in _UNDRAWN:
            continue
        tag, a = node.tag, node.attributes
        drawn_text = drawing and tag in _DRAWN
        drawing = tag == "svg" or drawing and not drawn_text
        if tag == "br":
            flow.line()
        elif tag == "input" and a.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number") and not hidden:
            flow.text(" " + a.get("value", "") + " ")
        if tag in _VOID and tag != "hr":
            continue
        ends: list = []
        if tag in ("td", "th", "caption") and tables and tag != "caption":
            flows.append(Flow())

            def cell(a: dict = a) -> None:
                lines = flows.pop().done()
                tables[-1].add(lines, max(1, _number(a.get("colspan"), 1, 1000)), max(1, _number(a.get("rowspan"), 1, 1000)))

            ends.append(cell)
        elif tag == "tr" and tables:
            tables[-1].row()
        elif tag == "table":
            flow.block(1)
            tables.append(_Table())

            def table() -> None:
                for line in tables.pop().laid_out():
                    flows[-1].plain(line)
                    flows[-1].block(0)
                flows[-1].block(1)

            ends.append(table)
        elif tag in _BLOCK:
            gap = _BLOCK[tag] if not (tag in _LISTS and lists) else 0
            flow.block(gap)
            before = flow.indent
            if tag in _LISTS:
                lists.append([tag, _number(a.get("start"), 1)])
                ends.append(lists.pop)
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    lists[-1][1] = _number(a.get("value"), lists[-1][1])
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.indent, flow.marker = before + " " * len(marker), marker
            elif tag in ("blockquote", "dd"):
                flow.indent = before + "  "

            def block(flow: Flow = flow, gap: int = gap, before: str = before) -> None:
                flow.block(gap)
                flow.indent, flow.marker = before, ""

            ends.append(block)
        elif tag == "q" and not hidden:
            flow.text("“")
            ends.append(lambda: flows[-1].text("”"))
        elif drawn_text or tag in ("option", "button", "select", "label", "textarea"):
            flow.text(" ")
            ends.append(lambda: flows[-1].text(" "))
        todo += ends[::-1] if len(ends) > 1 else ends
        inner = pre or tag in ("pre", "textarea", "xmp", "listing")
        todo += [(c, hidden, inner, drawing) for c in reversed(_shown_children(node))]
    return "\n".join(flows[0].done())


def visible_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def extract(pages: DataFrame, page: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the visible text in place of the page."""
    prepare(pages.sparkSession)
    kept = [c for c in pages.columns if c != page and c.lower() != name.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(x) for x in batch.column(page).to_pylist()]
            yield with_columns(batch.select(kept), **{name: pa.array(texts, pa.string())})

    return pages.mapInArrow(run, T.StructType([*pages.select(kept).schema.fields, T.StructField(name, T.StringType())]))
