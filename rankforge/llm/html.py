"""Layout-aware HTML extraction.

A tree builder reads tags, closes elements whose end is implied, and lays out
each element as it closes: block spacing, list markers and indents, tables
with aligned cells.  All visible text is kept; what a browser does not show
(scripts, styles, the head, hidden elements, comments) is left out.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head script style template iframe noembed noframes noscript title object audio "
                   "video canvas datalist".split())
#: Roots of foreign elements, and what of them is not shown.
FOREIGN = frozenset(("svg", "math"))
UNSEEN_FOREIGN = frozenset("title desc defs metadata symbol clippath mask pattern marker lineargradient "
                           "radialgradient filter annotation annotation-xml".split())
IN_HEAD = frozenset("base link meta title style script template noscript".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main
menu nav ol option p pre search section summary ul table caption thead tbody tfoot tr td th
optgroup select plaintext xmp""".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset menu dir".split())
NO_P = BLOCK - frozenset("body html li dd dt td th tr thead tbody tfoot caption option optgroup "
                         "select legend".split())
#: start tag: (elements that it ends, elements that bound the search)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (
        {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}))}
#: Nested lists and quotes are indented up to this depth; deeper ones like this one.
DEPTH = 20
#: Cells are padded to columns while that adds at most so many spaces for each
#: character of the table (a cell counts as eight at least); cells of a sparser
#: table stand beside each other unaligned, so a page's text stays in proportion.
PADDING = 16

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
#: A tag with a quote that never closes ends at the next ``>``.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_TAG_START = re.compile(r"</?[a-zA-Z]")
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_GONE = re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


class Box:
    """Lines of a flow of blocks, with the line being filled."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False          # white space since the last text of the line
        self.gap = False            # an empty line is due before the next one
        self.mark = ""              # of a list item, due before the next text

    def text(self, s: str) -> None:
        for k, part in enumerate(_SPACE.split(s)):
            self.space |= k > 0
            if part:
                if self.mark and not self.line:
                    self.line.append(self.mark)
                    self.mark, self.space = "", False
                if self.space and self.line:
                    self.line.append(" ")
                self.line.append(part)
                self.space = False

    def verbatim(self, s: str) -> None:
        first, *rest = s.expandtabs(8).split("\n")
        self.line.append(first)
        for line in rest:
            self.end(keep=True)
            self.line.append(line)

    def end(self, apart: bool = False, keep: bool = False) -> None:
        if self.line or keep:
            self.add(["".join(self.line)])
            self.line = []
        self.space = False
        self.gap |= apart

    def add(self, lines: list[str]) -> None:
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines += lines


class Node:
    """An open element: where its text goes and what its end does."""

    def __init__(self, tag: str, hidden: bool, box: Box, depth: int, veiled: bool = False) -> None:
        self.tag, self.hidden, self.box, self.depth = tag, hidden, box, depth
        self.veiled = veiled                             # visibility, which a child may turn on again
        self.foreign = False                             # in SVG or MathML, not in HTML within it
        self.count = 1                                   # of list items
        self.span = self.down = 1                        # columns and rows of a cell
        self.rows: list[list[tuple[list[str], int, int]]] = []     # of a table


def _attributes(s: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(s):
        out.setdefault(m[1].lower(), entities.unescape((m[2] or "").strip("\"'")))
    return out


def _placed(rows: list[list[tuple[list[str], int, int]]], most: int) \
        -> list[list[tuple[list[str], int]]] | None:
    """Rows with an empty cell in each column that a cell from above still
    takes; None if that makes more than ``most`` cells."""
    out, taken, cells = [], {}, 0                        # column: rows still taken
    for row in rows:
        placed, at, new = [], 0, {}
        for lines, span, down in row:
            while at in taken:
                placed.append(([""], 1))
                at += 1
            placed.append((lines, span))
            if down > 1:
                new.update(dict.fromkeys(range(at, at + span), down))
                cells += span
            at += span
        for at in range(at, max(taken, default=-1) + 1):
            placed.append(([""], 1))
        cells += len(placed) + len(taken)
        if cells > most:
            return None
        out.append(placed)
        taken = {c: n - 1 for c, n in {**taken, **new}.items() if n > 1}
    return out


def _table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Cells in aligned columns, `` | `` between them; a cell of several lines
    makes its row as high.  A cell that spans columns widens none of them.
    Beyond ``PADDING`` the cells of a row stand beside each other unaligned."""
    text = sum(max(8, sum(map(len, lines))) for row in rows for lines, _, _ in row)
    placed, aligned = _placed(rows, PADDING * text), False
    if placed is not None:
        widths: dict[int, int] = {}
        ends = []
        for row in placed:
            at = 0
            for lines, span in row:
                if span == 1:
                    widths[at] = max(widths.get(at, 0), *map(len, lines), 0)
                at += span
            ends.append(at)
        upto = [0]
        for at in range(max(ends, default=0)):
            upto.append(upto[-1] + widths.get(at, 0) + 3)
        size = sum(upto[at] * max((len(lines) for lines, _ in row), default=0)
                   for row, at in zip(placed, ends))
        aligned = size <= PADDING * text
    if not aligned:
        placed = [[(lines, 1) for lines, _, _ in row] for row in rows]
    out = []
    for row in placed:
        if not any(any(lines) for lines, _ in row):
            continue
        for k in range(max(len(lines) for lines, _ in row)):
            parts, at = [], 0
            for lines, span in row:
                part = lines[k] if k < len(lines) else ""
                parts.append(part.ljust(upto[at + span] - upto[at] - 3) if aligned else part)
                at += span
            out.append(" | ".join(parts if aligned else filter(None, parts)).rstrip())
    return out


class Layout:
    """Tree builder that lays out elements as they end."""

    def __init__(self) -> None:
        self.stack = [Node("#root", False, Box(), 0)]
        self.open: dict[str, list[int]] = {}             # places of open elements by tag

    def start(self, tag: str, attributes: str) -> None:
        if self.open.get("head") and tag not in IN_HEAD and tag != "head":
            self.stop("head")
        if tag in ("html", "body", "head") and self.open.get(tag):
            return
        if tag in NO_P and self.open.get("p"):
            self.stop("p", {"td", "th", "button", "object"})
        if tag[0] == "h" and tag[1:].isdigit() and self.stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.stop(self.stack[-1].tag)
        if tag in IMPLIED:
            ends, bounds = IMPLIED[tag]
            self.cut(self.last(bounds) + 1, ends)
        if tag in ("td", "th") and self.open.get("table") and self.stack[-1].tag in (
                "table", "tbody", "thead", "tfoot"):
            self.start("tr", "")
        given = _attributes(attributes) if attributes.strip(" /") else {}
        top = self.stack[-1]
        style = given.get("style", "")
        foreign = top.foreign
        hidden = top.hidden or tag in (UNSEEN_FOREIGN | {"script", "style"} if foreign else UNSEEN) \
            or "hidden" in given or bool(_GONE.search(style)) \
            or tag == "dialog" and "open" not in given
        said = _VISIBILITY.findall(style) or ([given["visibility"]] if foreign and "visibility" in given else [])
        veiled = said[-1].lower() in ("hidden", "collapse") if said else top.veiled
        if not hidden:
            if tag in BLOCK:
                top.box.end(tag in APART and not top.tag == "li")
            if tag == "br":
                top.box.end(keep=True)
            elif veiled:
                pass
            elif tag == "hr":
                top.box.add(["---"])
                top.box.gap = True
            elif tag == "img" and given.get("alt", "").strip():
                top.box.text(given["alt"])
            elif tag == "input" and given.get("type", "text").lower() in (
                    "submit", "button", "reset", "text", "search") and given.get("value"):
                top.box.text(given["value"])
        if tag in VOID or (foreign or tag in FOREIGN) and attributes.endswith("/"):
            return
        depth = top.depth + (tag in ("li", "dd", "blockquote"))
        own = tag in ("td", "th", "table", "caption") or depth > top.depth and depth <= DEPTH
        if tag == "li" and not own and not hidden:       # deep: its lines go on in the same flow
            top.box.mark = self.item_mark()
        node = Node(tag, hidden, Box() if own and not hidden else top.box, depth, veiled)
        node.foreign = tag in FOREIGN or foreign and tag not in ("foreignobject", "annotation-xml")
        if tag in ("td", "th"):
            span = given.get("colspan", "")
            node.span = min(1000, max(1, int(span))) if span.isdecimal() and len(span) < 5 else 1
            down = given.get("rowspan", "")
            node.down = (int(down) or 65_534) if down.isdecimal() and len(down) < 6 else 1
        if tag == "ol" and given.get("start", "").lstrip("-").isdecimal() and len(given["start"]) < 10:
            node.count = int(given["start"])
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        if tag == "tr" and not hidden and (table := self.table()):
            table.rows.append([])

    def last(self, tags) -> int:
        """Place of the innermost open element of ``tags``; 0 without one."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def table(self) -> Node | None:
        return self.stack[self.last(("table",))] if self.open.get("table") else None

    def item_mark(self) -> str:
        """Mark of the next item of the innermost list."""
        at = self.last(("ol", "ul", "menu", "dir"))
        holder = self.stack[at] if at else self.stack[-1]
        holder.count += 1
        return f"{holder.count - 1}. " if holder.tag == "ol" else "- "

    def cut(self, low: int, ends: set[str]) -> None:
        """End the lowest open element of ``ends`` from place ``low`` on, and all above it."""
        low = max(1, low)
        found = [x[k] for x in (self.open.get(t, ()) for t in ends)
                 if (k := bisect_left(x, low)) < len(x)]
        if found:
            at = min(found)
            while len(self.stack) > at:
                self.pop()

    def stop(self, tag: str, bounds: frozenset | set = frozenset()) -> None:
        """The end tag: ends the innermost such element, if no bound is in between."""
        if not self.open.get(tag):
            if tag == "p":
                self.stack[-1].box.end(True)
            return
        at = self.open[tag][-1]
        if self.last(bounds - {tag}) < at:
            while len(self.stack) > at:
                self.pop()

    def pop(self) -> None:
        node = self.stack.pop()
        self.open[node.tag].pop()
        tag, box, top = node.tag, node.box, self.stack[-1]
        if node.hidden:
            return
        if box is top.box:
            if tag == "li":
                box.mark = ""
            if tag in BLOCK:
                box.end(tag in APART)
            return
        box.end()
        lines = box.lines
        if tag in ("td", "th", "caption") and (table := self.table()):
            if tag == "caption":
                table.box.add(lines)
            else:
                if not table.rows:
                    table.rows.append([])
                table.rows[-1].append((lines or [""], node.span, node.down))
            return
        if tag == "table":
            lines = lines + _table(node.rows)
        elif tag == "li":
            mark = self.item_mark()
            if lines:
                pad = " " * len(mark)
                lines = [mark + lines[0]] + [(pad + x) if x else x for x in lines[1:]]
        else:
            mark = "> " if tag == "blockquote" else "  "
            lines = [(mark + x).rstrip() for x in lines]
        top.box.end()
        top.box.add(lines)
        top.box.gap |= tag in APART

    def data(self, s: str) -> None:
        if self.open.get("head") and s.strip(" \t\n\r\f") and self.stack[-1].tag == "head":
            self.stop("head")
        top = self.stack[-1]
        if top.hidden or top.veiled or not s:
            return
        if self.open.get("pre") or self.open.get("textarea"):
            top.box.verbatim(s)
            return
        if top.tag in ("table", "thead", "tbody", "tfoot", "tr") and not s.strip(" \t\n\r\f"):
            return
        top.box.text(s)

    def finish(self) -> str:
        while len(self.stack) > 1:
            self.pop()
        root = self.stack[0].box
        root.end()
        return "\n".join(line.rstrip() for line in root.lines).strip("\n")


def render(source: str) -> str:
    """All visible text of an HTML document, laid out."""
    out, at, n = Layout(), 0, len(source)
    last, pattern = source.rfind(">"), _TAG
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            out.data(entities.unescape(source[at:]))
            break
        if lt > at:
            out.data(entities.unescape(source[at:lt]))
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif source.startswith(("<!", "<?"), lt):
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
        elif m := pattern.match(source, lt) if lt < last else None:
            tag, at = m[2].lower(), m.end()
            if m[1]:
                out.stop(tag, {"td", "th", "table"} - {tag} if tag not in (
                    "table", "tr", "tbody", "thead", "tfoot", "body", "html") else frozenset())
                if tag == "br":
                    out.start("br", "")
                continue
            foreign = out.stack[-1].foreign
            out.start(tag, m[3])
            if tag in RAW and not foreign:
                closing = _RAW_END[tag].search(source, at)
                end = closing.start() if closing else n
                if tag == "textarea":
                    out.data(entities.unescape(source[at:end]))
                elif tag == "xmp":
                    out.data(source[at:end])
                at = end
                if not closing:
                    break
        elif lt < last and pattern is _TAG and _TAG_START.match(source, lt):
            pattern, at = _PLAIN_TAG, lt                 # a quote that is never closed
        else:                                            # no tag after all
            out.data("<")
            at = lt + 1
    return out.finish()


def text_column(html: Column) -> Column:
    """Visible text of an HTML column; null gives null."""
    @F.arrow_udf("string")
    def of(sources: pa.Array) -> pa.Array:
        return pa.array([None if s is None else render(s) for s in sources.to_pylist()], pa.string())
    return of(html)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the visible text in ``text_col`` (replaced if there)
    instead of the HTML: null HTML gives null, HTML without visible text an
    empty text; rows and other columns stay as they are."""
    out = pages.withColumn(text_col, text_column(F.col(html_col).cast("string")))
    return out if html_col == text_col else out.drop(html_col)
