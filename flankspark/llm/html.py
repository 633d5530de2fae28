"""HTML extraction with layout.

Each page's markup becomes a tree: tags that HTML implies are closed, void elements hold nothing, and stray end tags are passed over. The
tree is walked without recursion. Invisible parts (scripts, styles, templates, hidden elements, the head) are left out; all other
text is emitted, with blank lines between blocks, one line for each line break, marks and indents for lists, and the cells of tables
padded to columns, over rows and columns that they span. Cells wider than WIDEST don't widen their column, and a column that begins beyond
FARTHEST isn't reached by padding, so a page's text stays in proportion to the page; no text is lost by that.

Visibility comes from the elements: their names, the attribute hidden, whether a dialog or details is open (of closed details only the first
summary is seen), and their own style (display, and visibility, which is inherited and
can be set back). Style sheets aren't applied, and what scripts would add isn't there. Text in drawings and formulas is text.

A page is handled in one piece, pages by Spark's partitions; there is no shuffle.

Edge cases: null and empty pages have an empty text; any depth of nesting is walked by a stack; markup that breaks off keeps what was
read; repeated pages give equal texts; an empty table gives an empty result. Only the id and the page are read, so other columns can't
clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flankspark.llm.common import batched

# Fixed sets of element names, as the HTML standard gives them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title meta link object iframe audio video canvas datalist desc metadata noframes rp annotation annotation-xml".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split()
)
SPACED_OUT = frozenset("address article aside blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre section table ul".split())
LISTS = frozenset(("ul", "ol", "menu"))
#: A start tag closes an open element of these names, unless one of the fences stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("td", "th", "tr", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)), "tbody": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)), "tfoot": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "body": (("head",), ()),
}
CLOSES_P = BLOCKS - {"body", "html", "dd", "dt", "li"} | {"li", "dd", "dt"}
P_FENCES = frozenset(("table", "td", "th", "button", "caption", "object"))
HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
#: Widest cell that its column is padded to, and the farthest place on a line to which cells are padded.
WIDEST, FARTHEST = 80, 600
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element; visible is None where it is inherited, shut is 1 if what it holds is unseen but for a summary, 2 once it has one."""

    __slots__ = ("children", "high", "name", "shut", "start", "unseen", "visible", "wide")

    def __init__(self, name: str, unseen: bool = False, wide: int = 1, high: int = 1, start: int = 1, visible: bool | None = None):
        self.name, self.unseen, self.wide, self.high, self.start, self.visible, self.children, self.shut = name, unseen, wide, high, start, visible, [], 0


class Tree(HTMLParser):
    """Builds the tree of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        #: The depths at which each name is open, so no tag needs a walk over open elements.
        self.depths: dict[str, list[int]] = {"html": [0]}

    def _pop(self) -> None:
        self.depths[self.open.pop().name].pop()

    def _depth(self, name: str) -> int:
        """The depth of the innermost open element of a name; 0, that of the root, where there is none."""
        own = self.depths.get(name)
        return own[-1] if own else 0

    def _close(self, names: tuple[str, ...], fences) -> None:
        """Closes up to the outermost open element of these names inside the nearest fence; of a single name, the innermost one."""
        fence = max(map(self._depth, fences), default=0)
        if len(names) == 1:
            found = [d for d in (self._depth(names[0]),) if d > fence]
        else:
            found = [own[k] for n in names if (own := self.depths.get(n)) and (k := bisect_right(own, fence)) < len(own)]
        if found:
            self._close_to(min(found))

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._pop()

    def handle_starttag(self, name: str, attrs: list) -> None:
        if name == "html":
            return
        if name in CLOSES:
            self._close(*CLOSES[name])
        if name in CLOSES_P:
            self._close(("p",), P_FENCES)
        if self._depth("head") and (name in BLOCKS or self.open[-1].name == "head" and name not in IN_HEAD):
            self._close(("head",), ())
        if name in ("td", "th") and not self._inside("tr"):
            self._push(Node("tr"))
        given = dict(attrs)
        style = given.get("style") or ""
        hidden = name in UNSEEN or name == "dialog" and "open" not in given or "hidden" in given and (given["hidden"] or "").lower() != "until-found" or bool(HIDDEN.search(style)) or name == "input" and (given.get("type") or "").lower() == "hidden"
        visible = [x.lower() == "visible" for x in VISIBILITY.findall(style)]
        node = Node(name, hidden, visible=visible[-1] if visible else None)
        node.shut = int(name == "details" and "open" not in given)
        if name in ("td", "th"):
            node.wide, node.high = number(given.get("colspan"), 1, 1000), number(given.get("rowspan"), 0, 65534)
        elif name == "ol":
            node.start = number(given.get("start"), 1, 10**9)
        if name in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _inside(self, name: str) -> bool:
        # Cells outside of any table are plain text.
        return self._depth(name) >= self._depth("table")

    def _push(self, node: Node) -> None:
        above = self.open[-1]
        if above.shut:
            first = node.name == "summary" and above.shut == 1
            node.unseen |= not first
            above.shut += first
        above.children.append(node)
        self.depths.setdefault(node.name, []).append(len(self.open))
        self.open.append(node)

    def handle_startendtag(self, name: str, attrs: list) -> None:
        self.handle_starttag(name, attrs)

    def handle_endtag(self, name: str) -> None:
        if name == "br":
            self.open[-1].children.append(Node("br"))
        elif name not in ("html", "body") and (depth := self._depth(name)) and (name == "table" or self._depth("table") <= depth):
            self._close_to(depth)

    def handle_data(self, data: str) -> None:
        if self.open[-1].name == "head" and SPACE.sub("", data):
            self._close(("head",), ())
        if not self.open[-1].shut:
            self.open[-1].children.append(data)


def number(text: str | None, least: int, top: int) -> int:
    found = re.match(r"\s*(\d{1,9})", text or "")
    return min(top, max(least, int(found[1]))) if found else 1


class Writer:
    """Lines of text, with spaces collapsed and gaps between blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.gap = False
        self.prefix = self.hang = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            for i, line in enumerate(data.split("\n")):
                if i:
                    self.line(True)
                if line:
                    self._add(line.replace("\r", ""))
            return
        pieces = SPACE.sub(" ", data)
        if not pieces:
            return
        if pieces[0] == " ":
            self.space = bool(self.parts)
        body = pieces.strip(" ")
        if body:
            self._add((" " if self.space else "") + body)
            self.space = pieces[-1] == " "

    def _add(self, text: str) -> None:
        if not self.parts:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.parts.append(self.prefix or self.hang)
            self.prefix = ""
        self.parts.append(text)
        self.space = False

    def line(self, always: bool = False) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
        elif always and self.lines:
            self.lines.append("")
        self.parts, self.space = [], False

    def block(self, apart: bool) -> None:
        self.line()
        self.gap |= apart

    def done(self) -> str:
        self.line()
        return re.sub(r"\n{3,}", "\n\n", "\n".join(self.lines)).strip("\n")


class Table:
    """Rows of cells (text, columns, rows; 0 rows: all that follow)."""

    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []

    def placed(self) -> list[list[tuple[int, int, str]]]:
        """For each row its cells as (first column, end, text), those that reach in from above as empty ones; columns are where any cell starts."""
        below: dict[int, tuple[int, int]] = {}
        rows, starts = [], set()
        for cells in self.rows:
            out, at, free = [], 0, dict(below)
            below = {c: (end, left - 1) for c, (end, left) in free.items() if left != 1}
            for text, wide, high in cells:
                while at in free:
                    out.append((at, free[at][0], ""))
                    at = free.pop(at)[0]
                # A cell ends where one from above begins.
                end = min([at + wide, *(c for c in free if c > at)])
                out.append((at, end, text))
                if high != 1:
                    below[at] = (end, high - 1)
                at = end
            starts |= {c for c, _, _ in out}
            rows.append(out)
        order = sorted(starts)
        column = {c: i for i, c in enumerate(order)}
        return [[(column[a], bisect_left(order, b), text) for a, b, text in row] for row in rows]

    def render(self) -> list[str]:
        """Lines in which each column is as wide as its widest cell; a cell of several lines takes several."""
        rows = [[(a, b, text.split("\n")) for a, b, text in row] for row in self.placed() if any(text for _, _, text in row)]
        cells = [(b - a, a, b, min(WIDEST, max(map(len, lines)))) for row in rows for a, b, lines in row if max(map(len, lines)) <= WIDEST]
        widths = [0] * max((b for row in rows for _, b, _ in row), default=0)
        for span, a, b, size in sorted(cells):
            # What a cell over several columns has more than they do goes to the last one.
            widths[b - 1] += max(0, size - sum(widths[a:b]) - 3 * (span - 1))
        begins = [0]
        for w in widths:
            begins.append(begins[-1] + w + 3)
        lines = []
        for row in rows:
            for k in range(max(len(x) for _, _, x in row)):
                out = []
                for a, b, own in row:
                    text = own[k] if k < len(own) else ""
                    pad = begins[b] - 3 - begins[a] - len(text) if begins[b] <= FARTHEST else 0
                    out += [text, " " * pad, " | "]
                lines.append("".join(out[:-1]).rstrip(" "))
        return lines


def render(page: str | None) -> str:
    """The visible text of a page."""
    tree = Tree()
    tree.feed(page or "")
    tree.close()
    writer, writers, tables, lists, pre = Writer(), [], [], [], 0
    seen = [True]
    stack: list[tuple] = [(tree.root, False)]
    while stack:
        node, leaving = stack.pop()
        if isinstance(node, str):
            if seen[-1]:
                writer.text(node, pre > 0)
            continue
        if node.unseen:
            continue
        name = node.name
        if leaving:
            seen.pop()
        else:
            if name == "br":
                writer.line(True)
                continue
            if name == "img" or name in VOID and name != "hr":
                continue
            if name in BLOCKS or name in ("tr", "caption", "option", "textarea"):
                # A list in a list follows its item's line directly.
                writer.block(name in SPACED_OUT and not (name in LISTS and lists))
            if name in LISTS:
                lists.append([name, node.start, writer.hang])
            elif name == "li":
                kind = lists[-1] if lists else ["ul", 1, writer.hang]
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                writer.prefix, writer.hang = kind[2] + mark, kind[2] + " " * len(mark)
            elif name == "pre":
                pre += 1
            elif name == "table":
                tables.append(Table())
            elif name == "tr" and tables:
                tables[-1].rows.append([])
            elif name in ("td", "th") and tables and tables[-1].rows:
                writers.append((writer, lists, pre))
                writer, lists, pre = Writer(), [], 0
            elif name in ("td", "th"):
                writer.text(" ", False)
            seen.append(seen[-1] if node.visible is None else node.visible)
            stack.append((node, True))
            stack.extend((x, False) for x in reversed(node.children))
            continue
        if name in ("td", "th") and tables and tables[-1].rows and writers:
            text = writer.done()
            writer, lists, pre = writers.pop()
            tables[-1].rows[-1].append((text, node.wide, node.high))
            continue
        if name == "table":
            for line in tables.pop().render():
                writer.line()
                writer._add(line)
        if name in LISTS and lists:
            writer.hang = lists.pop()[2]
        elif name == "li":
            writer.line()
            writer.prefix, writer.hang = "", (lists[-1][2] if lists else "")
        elif name == "pre":
            pre -= 1
        if name in BLOCKS or name in ("tr", "caption", "option", "textarea"):
            writer.block(name in SPACED_OUT and not (name in LISTS and lists))
    return writer.done()


def extract_text(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """id, text, n_chars and n_lines of each row of pages."""
    batched(pages.sparkSession)
    slim = pages.select(F.col(id_col), F.col(html).cast("string").alias("__html"))
    kind = slim.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array([x.count("\n") + bool(x) for x in texts], pa.int64())],
                names=[id_col, "text", "n_chars", "n_lines"],
            )

    return slim.mapInArrow(run, f"`{id_col}` {kind}, text string, n_chars long, n_lines long")
