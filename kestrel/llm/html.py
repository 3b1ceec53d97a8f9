"""Layout-aware rendering of HTML pages as text.

A tree is built from the tags (implied end tags, implied table parts, void and raw-text elements,
stray end tags ignored) and rendered without recursion: blocks on lines of their own, a blank line
around paragraphs, headings, lists and tables, bullets and numbers before list items, table cells
padded to columns, white space kept in ``pre``.  All visible text comes out; what a browser doesn't
show (``head``, scripts, styles, templates, ``hidden``, ``display: none``, closed ``details``)
doesn't.  ``visibility`` is inherited: a visible element inside a hidden one is shown.  Of a ``select`` the
chosen option is shown, of a list box all options.  Formulas (``math``) and the text of diagrams
(``svg``) come out in the order they are written, without annotations, titles, descriptions, metadata
and definitions; their layout is lost.

Attributes are read as browsers do: a quote opens a value only behind ``=``, elsewhere it is a
character of a name or of an unquoted value.  A value whose quote never closes ends like an unquoted one.

A null or empty page gives an empty text.  Unclosed and deeply nested elements, unknown tags and
broken entities are rendered as far as they go.  Repeated rows are rendered one by one, an empty
table gives no rows.  Columns named ``into`` are replaced, others pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.textnum import map_batches

# Classes of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object datalist "
                   "audio video canvas meta link base".split())
#: Elements without visible text inside math and svg.
UNSEEN_INSIDE = {"math": frozenset("annotation annotation-xml".split()),
                 "svg": frozenset("title desc defs metadata".split())}
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "p pre search section summary table ul xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr menu dir fieldset".split())
CLOSES_P = BLOCKS - frozenset("body caption html legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
SECTIONS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
#: Elements that an implied end tag doesn't reach beyond.
SCOPE = frozenset("html table td th caption template button object".split())

# a name, and a value behind "=": quoted, or up to the next space; possessive, so that no tag is tried twice
_ATTRIBUTE = re.compile(r"(=?+[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_TAG = r"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)>"
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|{_TAG}|<[!?/][^>]*(?:>|\Z)", re.S)
_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*([a-z-]+)", re.I)
_VISIBILITY = re.compile(r"(?:^|[;\s])visibility\s*:\s*([a-z]+)", re.I)
#: Tags without an end after which the rest of a page counts as text.
MISSES = 50
_SPACES = " \t\n\r\f"
_RUN = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element; children are nodes and texts."""

    __slots__ = ("tag", "attributes", "children", "unseen", "apart", "veiled")

    def __init__(self, tag: str, attributes: str = "", veiled: bool = False):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.unseen = self.apart = False  # not shown, a line of its own: by where it is
        self.veiled = veiled  # its own text isn't visible: inherited, unless its style says otherwise
        if "visibility" in attributes.lower() and (told := _VISIBILITY.findall(self.attribute("style") or "")):
            if told[-1].lower() in ("visible", "hidden", "collapse"):
                self.veiled = told[-1].lower() != "visible"

    def attribute(self, name: str) -> str | None:
        """Value of an attribute ('' if it has none), None if it is missing."""
        if name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(next((v for v in m.groups()[1:] if v is not None), ""))
        return None

    def shown(self) -> list:
        """Children that may be seen: texts only if the element is visible itself."""
        return [c for c in self.children if not isinstance(c, str)] if self.veiled else self.children

    def hidden(self) -> bool:
        """True if a browser shows nothing of it, nor of anything inside."""
        if self.tag in UNSEEN or self.unseen:
            return True
        if not self.attributes:
            return self.tag == "dialog"
        if self.attribute("hidden") is not None:
            return True
        if (told := _DISPLAY.findall(self.attribute("style") or "")) and told[-1].lower() == "none":
            return True
        return self.tag == "dialog" and self.attribute("open") is None


class Builder:
    """Builds the tree of a page."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}  # open elements by tag, so that deep pages aren't searched in vain

    def pop(self, i: int) -> None:
        """Close the open elements from position ``i`` on."""
        for node in self.open[i:]:
            self.count[node.tag] -= 1
        del self.open[i:]

    def close(self, tags: frozenset[str] | set[str], stop: frozenset[str] = SCOPE) -> bool:
        """Close the innermost open element among ``tags``, and all inside it, unless one of
        ``stop`` lies between."""
        if not any(self.count.get(tag) for tag in tags):
            return False
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self.pop(i)
                return True
            if self.open[i].tag in stop:
                return False
        return False

    def imply(self, tag: str) -> None:
        """End and start tags that ``tag`` implies."""
        if tag in CLOSES_P:
            self.close({"p"})
        if tag == "li":
            self.close({"li"}, SCOPE | LISTS)
        elif tag in ("dt", "dd"):
            self.close({"dt", "dd"}, SCOPE | {"dl"})
        elif tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop(len(self.open) - 1)
        elif tag in ("option", "optgroup"):
            inside = frozenset({"select", "html", "template"})
            self.close({"option"}, inside)
            if tag == "optgroup":
                self.close({"optgroup"}, inside)
        elif tag in CELLS or tag == "tr" or tag in SECTIONS or tag in ("caption", "colgroup"):
            inside = frozenset({"table", "html", "template"})
            self.close(CELLS | {"caption"}, inside)
            if tag not in CELLS:
                self.close({"tr"}, inside)
            if tag in SECTIONS or tag in ("caption", "colgroup"):
                self.close(SECTIONS, inside)
            top = self.open[-1].tag
            if tag in CELLS and top != "tr":
                if top == "table":
                    self.start("tbody", "")
                if self.open[-1].tag in SECTIONS:
                    self.start("tr", "")
            elif tag == "tr" and top == "table":
                self.start("tbody", "")
        elif tag == "body":
            self.close({"head"}, frozenset())

    def start(self, tag: str, attributes: str) -> None:
        """A start tag."""
        if tag == "html" or (tag == "body" and any(n.tag == "body" for n in self.open[:3])):
            return
        self.imply(tag)
        if tag not in ("head", "title", "meta", "link", "script", "style", "base", "noscript", "template") \
                and self.open[-1].tag == "head":
            self.pop(len(self.open) - 1)
        node = Node(tag, attributes, self.open[-1].veiled)
        self.open[-1].children.append(node)
        inside = next((t for t in UNSEEN_INSIDE if self.count.get(t)), None)
        if inside:
            node.unseen = tag in UNSEEN_INSIDE[inside] or inside == "svg" and node.attribute("display") == "none"
            node.apart = inside == "svg" and tag == "text"
        if tag not in VOID and not ((inside or tag in UNSEEN_INSIDE) and attributes.rstrip().endswith("/")):
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        """An end tag; one without its start tag is ignored (``</br>`` is a line break)."""
        if tag == "br":
            self.open[-1].children.append(Node("br", "", self.open[-1].veiled))
        elif tag in ("table", "template") or tag in SECTIONS or tag in ("tr", "caption") or tag in CELLS:
            self.close({tag}, frozenset({"template"} if tag == "table" else {"table", "template"}) - {tag})
        elif tag in HEADINGS:
            self.close(HEADINGS)
        elif tag in ("body", "html"):
            return
        elif tag in BLOCKS:
            self.close({tag}, frozenset({"td", "th", "table", "caption"}) - {tag})
        else:  # an inline element's end doesn't close blocks inside it
            self.close({tag}, BLOCKS | CELLS)

    def text(self, text: str) -> None:
        """Character data."""
        top = self.open[-1]
        if top.tag == "head":
            if not text.strip(_SPACES):
                return
            self.pop(len(self.open) - 1)
            top = self.open[-1]
        top.children.append(text)


def parse(page: str) -> Node:
    """The tree of a page."""
    builder, at, n, misses = Builder(), 0, len(page), 0
    while at < n:
        begin, m = page.find("<", at), None
        while begin >= 0 and misses < MISSES and not (m := _TOKEN.match(page, begin)):
            misses += page[begin + 1:begin + 2].isalpha()  # a tag without an end was read up to the page's end
            begin = page.find("<", begin + 1)
        if not m:
            builder.text(html.unescape(page[at:]))
            break
        if begin > at:
            builder.text(html.unescape(page[at:begin]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            builder.end(tag)
            continue
        builder.start(tag, m[3])
        if tag in RAW and builder.open[-1].tag == tag:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            raw = page[at:end.start() if end else n]
            if tag in ("textarea", "title"):
                raw = html.unescape(raw)
            if raw and builder.open[-1].tag == tag:
                builder.open[-1].children.append(raw)
            at = end.end() if end else n
            builder.close({tag}, frozenset())
    return builder.root


class Flow:
    """Lines of text that blocks and inline text are laid out on."""

    __slots__ = ("lines", "line", "space", "gap", "started")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # white space is pending inside the line
        self.gap = False  # a blank line is pending before the next line

    def inline(self, text: str) -> None:
        """Text with runs of white space as one space."""
        shown = _RUN.sub(" ", text)
        words = shown.strip(" ")
        if not words:
            self.space |= bool(text)
            return
        if self.line and (self.space or shown[0] == " "):
            self.line.append(" ")
        self.line.append(words)
        self.space = shown[-1] == " "

    def verbatim(self, text: str) -> None:
        """Text with its white space."""
        first, *rest = text.expandtabs().split("\n")
        self.line.append(first)
        for part in rest:
            self.end_line(True)
            self.line.append(part)

    def end_line(self, keep: bool = False) -> None:
        """End the current line; an empty one counts only if ``keep``."""
        if self.line or keep:
            self.append("".join(self.line).rstrip())
            self.line = []
        self.space = False

    def append(self, line: str) -> None:
        """A finished line."""
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def block(self, spaced: bool) -> None:
        """The edge of a block."""
        self.end_line()
        self.gap |= spaced and bool(self.lines)

    def nested(self, lines: list[str], first: str, rest: str) -> None:
        """Lines of a finished flow, each behind a prefix."""
        self.end_line()
        for i, line in enumerate(lines or [""]):
            self.append(((first if i == 0 else rest) + line).rstrip())


class Table:
    """Cells of a table as they are finished."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []  # (columns taken, lines)
        self.spans: dict[int, int] = {}  # column -> rows that a cell from above still takes
        self.column = 0

    def row(self) -> None:
        """Begin a row."""
        self._skip()
        self.rows.append([])
        self.spans = {c: n - 1 for c, n in self.spans.items() if n > 1}
        self.column = 0

    def _skip(self) -> None:
        """Leave out the columns that cells from above take."""
        while self.spans.get(self.column, 0) > 0 and self.rows:
            self.rows[-1].append((1, []))
            self.column += 1

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        """Add a cell to the row."""
        if not self.rows:
            self.row()
        self._skip()
        self.rows[-1].append((columns, lines))
        for c in range(self.column, self.column + columns) if rows > 1 else ():
            self.spans[c] = rows
        self.column += columns

    def lines(self) -> list[str]:
        """The rows with their columns aligned."""
        wide: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for columns, lines in row:
                if columns == 1:
                    wide[at] = max([wide.get(at, 0), *map(len, lines)])
                at += columns
        out = []
        for row in self.rows:
            for i in range(max([len(lines) for _, lines in row], default=0)):
                at, parts = 0, []
                for columns, lines in row:
                    room = sum(wide.get(c, 0) for c in range(at, at + columns)) + 3 * (columns - 1)
                    parts.append((lines[i] if i < len(lines) else "").ljust(room))
                    at += columns
                out.append(" | ".join(parts).rstrip())
        return out


def _number(value: str | None, default: int, most: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(int(m[1]), most) if m else default


def verbatim(node: Node) -> str:
    """All visible text below a node as it is written, with a line break for each ``br``."""
    out, todo = [], list(reversed(node.shown()))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x.replace("\r\n", "\n").replace("\r", "\n"))
        elif x.tag == "br":
            out.append("\n")
        elif not x.hidden():
            todo.extend(reversed(x.shown()))
    return "".join(out)


def options(node: Node) -> list[Node]:
    """The options of a ``select`` that are seen: all of a list box, else the chosen one, which is the
    last that is marked or the first that isn't disabled."""
    found, todo = [], list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str) or x.hidden():
            continue
        if x.tag == "option":
            found.append(x)
        elif x.tag == "optgroup":
            todo.extend(reversed(x.children))
    if node.attribute("multiple") is not None or _number(node.attribute("size"), 1, 10**9) > 1:
        return found
    marked = [x for x in found if x.attribute("selected") is not None]
    return marked[-1:] or [x for x in found if x.attribute("disabled") is None][:1]


def render(root: Node) -> str:
    """Visible text of a tree, laid out."""
    flow = Flow()
    flows, tables, lists = [flow], [], []
    # entries: (node or text, None) to enter, (node, what to do) to leave
    todo: list[tuple] = [(child, None) for child in reversed(root.children)]
    while todo:
        node, leave = todo.pop()
        flow = flows[-1]
        if leave:
            leave(node)
            continue
        if isinstance(node, str):
            flow.inline(node)
            continue
        tag = node.tag
        if node.hidden():
            continue
        if tag == "br":
            flow.end_line(True)
            continue
        if tag == "hr":
            flow.block(True)
            if not node.veiled:
                flow.append("---")
                flow.gap = True
            continue
        children = node.shown()
        if tag == "details" and node.attribute("open") is None:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        after = None
        if tag in ("li", "dd", "blockquote"):
            flow.block(tag == "blockquote")
            flows.append(Flow())
            if tag == "li" and lists and lists[-1] is not None:
                lists[-1] = _number(node.attribute("value"), lists[-1], 10**9)
                mark = f"{lists[-1]}. "
                lists[-1] += 1
            else:
                mark = {"li": "- ", "dd": "  ", "blockquote": "> "}[tag]
            if node.veiled:
                mark = " " * len(mark)

            def after(node, mark=mark):
                inner = flows.pop()
                inner.end_line()
                if inner.lines or node.tag == "li" and not node.veiled:
                    flows[-1].nested(inner.lines, mark, mark if node.tag == "blockquote" else " " * len(mark))
                flows[-1].gap |= node.tag == "blockquote"
        elif tag in LISTS:
            flow.block(not lists)
            lists.append(_number(node.attribute("start"), 1, 10**9) if tag == "ol" else None)

            def after(node):
                lists.pop()
                flows[-1].block(not lists)
        elif tag == "table":
            flow.block(True)
            tables.append(Table())

            def after(node):
                lines = tables.pop().lines()
                flows[-1].block(True)
                if lines:
                    flows[-1].nested(lines, "", "")
                    flows[-1].gap = True
        elif tag == "tr" and tables:
            tables[-1].row()
        elif tag in CELLS and tables:
            flows.append(Flow())
            lists.append(None)

            def after(node):
                inner = flows.pop()
                lists.pop()
                inner.end_line()
                tables[-1].cell(inner.lines, max(_number(node.attribute("colspan"), 1, 1000), 1),
                                max(_number(node.attribute("rowspan"), 1, 65534), 1))
        elif tag == "select":
            # a control of its own: apart from the words beside it
            children, flow.space = options(node), True
            many = len(children) > 1
            for x in children:
                x.apart = many

            def after(node, many=many):
                flows[-1].space = True
                if many:
                    flows[-1].block(False)
        elif tag == "option":
            if node.apart:
                flow.block(False)
            if label := node.attribute("label"):
                children = [] if node.veiled else [label]
        elif tag in ("pre", "xmp"):
            flow.block(True)
            flow.verbatim(verbatim(node).removeprefix("\n").rstrip("\n"))
            flow.block(True)
            continue
        elif tag in BLOCKS or tag in CELLS or tag == "tr" or node.apart:
            spaced = tag in SPACED
            flow.block(spaced)

            def after(node, spaced=spaced):
                flows[-1].block(spaced)
        if after:
            todo.append((node, after))
        todo.extend((child, None) for child in reversed(children))
    flows[0].end_line()
    return "\n".join(flows[0].lines).strip("\n")


def to_text(page: str | None) -> str:
    """Visible text of a page, laid out; '' for null."""
    return render(parse(page)) if page else ""


def extract(pages: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with ``into``, the laid-out text, in place of ``column``."""
    rest = [c for c in pages.columns if c not in (column, into)]
    schema = T.StructType([*(pages.schema[c] for c in rest), T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                texts = pa.array([to_text(x) for x in rows.column(column).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in rest), texts], [*rest, into])

    return map_batches(pages.select(*dict.fromkeys([*rest, column])), run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """Text of every page."""
    return extract(pages.select("page_id", "html")).select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"))
