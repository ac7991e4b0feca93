"""Operator 4: HTML to text by layout: all visible text, with block spacing, lists and aligned tables.

A tokenizer and a tree builder with implied tags (html, head, body, tbody, tr; end tags of p, li, dt,
dd, option, tr, td, th and others) turn any byte soup into a tree; text and elements that may not stand
between the parts of a table go before it, as in browsers; visibility rules drop what a
browser does not show (head, scripts, templates, closed details and dialogs, ``hidden``, display:none,
visibility:hidden unless a child is visible again, hidden inputs); the renderer walks the rest. Nothing is
scored or cut as boilerplate: menus and footers are visible text.

Rendering: white space collapses except in pre and textarea; paragraphs, headings, lists, quotations and tables stand
apart by a blank line, other blocks by a line break; list items carry "- " or their number and
hang from it; table cells are laid out in columns padded to the widest cell of up to ``COLUMN``
characters (a longer one pushes the rest of its own row to the right, and no gap is over ``GAP``), two spaces
apart, with colspan and rowspan; cells of several lines stay aligned.

Each page is rendered by itself in an Arrow-batched UDF: no shuffle, and no page affects another.
Building and rendering keep their own stacks, so nesting depth is no limit; tables nested more than
``MAX_TABLES`` deep are rendered as blocks. Time is linear in the page for any input.

Defined results: null html gives null text, empty or invisible html gives an empty text. Unclosed
comments, quotes and raw-text elements run to the end of the page, as in browsers. Null ids and repeated rows come
back once per row. Other input columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from html import unescape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TABLES = 50
#: lists and quotations deeper than this no longer move to the right
MAX_INDENT = 40

# ---- fixed values: element classes of the HTML standard ------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript title textarea".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: parts of a table, and the open elements that each of them may stand in
TABLE_PARTS = {
    **{t: frozenset(("tr", "tbody", "thead", "tfoot", "table")) for t in ("td", "th")},
    "tr": frozenset(("tbody", "thead", "tfoot", "table")), "col": frozenset(("colgroup", "table")),
    **{t: frozenset(("table",)) for t in ("tbody", "thead", "tfoot", "caption", "colgroup")},
}
#: inside these only parts of a table and IN_TABLE may stand; anything else goes before the table
TABLE_LEVELS = frozenset("table tbody thead tfoot tr colgroup".split())
IN_TABLE = frozenset("script style template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN = frozenset("area audio base canvas datalist head iframe link meta noembed noframes noscript object param rp script "
                   "source style svg template title track video".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
BLOCKS = SPACED | CLOSES_P | frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr xmp".split())
#: opening the key ends the open elements named first, looking no further out than those named second
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "rt": (("rt", "rp"), ("ruby",)), "rp": (("rt", "rp"), ("ruby",)),
    "td": (("td", "th", "caption"), ("table", "tr")), "th": (("td", "th", "caption"), ("table", "tr")),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    **{t: (("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)) for t in ("tbody", "thead", "tfoot")},
    "caption": (("caption",), ("table",)),
}
FENCES = frozenset("table td th caption button template html".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*(?:>|\Z)|"
    r"<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"']?[^\s>]*+))*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]*+)))?")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(s: str) -> dict:
    out: dict[str, str] = {}
    if s and not s.isspace():
        for m in ATTRIBUTE.finditer(s):
            v = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
            out.setdefault(m[1].lower(), unescape(v) if "&" in v else v)
    return out


class Builder:
    """Open elements, innermost last; ``open`` has the places in the stack of each tag's open elements."""

    def __init__(self):
        self.root = Node("html")
        self.stack, self.open = [self.root], {"html": [0]}
        self.body = False

    def add(self, what: Node | str) -> None:
        """Into the innermost open element, or before its table if it may not stand there (foster parenting)."""
        tag = what.tag if isinstance(what, Node) else None
        misplaced = not what.isspace() if tag is None else not (
            tag in TABLE_PARTS or tag in IN_TABLE or (tag == "input" and what.attrs.get("type", "").lower() == "hidden"))
        if misplaced and self.stack[-1].tag in TABLE_LEVELS and self.open.get("table"):
            # an open table is the last child of what it stands in
            self.stack[self.open["table"][-1] - 1].children.insert(-1, what)
        else:
            self.stack[-1].children.append(what)

    def push(self, node: Node) -> None:
        self.add(node)
        self.open.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def pop(self) -> None:
        self.open[self.stack.pop().tag].pop()

    def _fence(self, fences) -> int:
        return max((self.open[f][-1] for f in fences if self.open.get(f)), default=0)

    def close(self, tags: tuple, fences) -> bool:
        """End the outermost element of ``tags`` inside the nearest fence (all that stands in it ends too)."""
        places = [p for t in tags if (p := self.open.get(t))]
        if not places:
            return False
        fence = self._fence(fences)
        inside = [p[i] for p in places if (i := bisect_right(p, fence)) < len(p)]
        if not inside:
            return False
        while len(self.stack) > min(inside):
            self.pop()
        return True

    def in_table(self) -> bool:
        """Whether a table is open with no template in it."""
        return self._fence(("table",)) > self._fence(("template",))

    def in_cell(self) -> bool:
        return self._fence(("td", "th", "caption")) > self._fence(("table",))

    def in_body(self) -> None:
        if not self.body:
            while len(self.stack) > 1:
                self.pop()
            self.push(Node("body"))
            self.body = True

    def start(self, tag: str, attrs: dict) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self.in_body()
                self.stack[1].attrs = attrs | self.stack[1].attrs
            return
        if tag == "head":
            if not self.body and not self.open.get("head"):
                self.push(Node("head"))
            return
        if tag not in IN_HEAD:
            self.in_body()
        if tag in CLOSES_P:
            self.close(("p",), FENCES)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.pop()
        if self.in_table() and (tag in TABLE_PARTS or tag == "table" and not self.in_cell()):
            # a part ends all that is open inside the part it belongs to; a table between rows ends the one before
            if tag == "table":
                self.close_nearest(tag)
            else:
                while self.stack[-1].tag not in TABLE_PARTS[tag]:
                    self.pop()
        elif tag in ENDS:
            self.close(*ENDS[tag])
        top = self.stack[-1].tag
        if tag in ("td", "th", "tr") and top == "table":
            self.push(Node("tbody"))
            top = "tbody"
        if tag in ("td", "th") and top in ("tbody", "thead", "tfoot"):
            self.push(Node("tr"))
        node = Node(tag, attrs)
        if tag == "form" and self.in_table() and not self.in_cell():
            self.stack[-1].children.append(node)  # stays empty: rows in it are the table's
        elif tag in VOID:
            self.add(node)
        else:
            self.push(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "head":
            if not self.body and self.open.get("head"):
                while self.open["head"]:
                    self.pop()
        elif tag in HEADINGS:
            for h in HEADINGS if not self.open.get(tag) else (tag,):
                if self.close((h,), FENCES):
                    break
        elif tag not in ("html", "body") and self.open.get(tag):
            self.close_nearest(tag)

    def close_nearest(self, tag: str) -> None:
        fences = FENCES if tag not in FENCES else ("table",) if tag in ("td", "th", "caption") else ()
        at = self.open[tag][-1]
        if at > self._fence(fences):
            while len(self.stack) > at:
                self.pop()

    def text(self, s: str) -> None:
        if not self.body and not s.isspace():
            self.in_body()
        if self.body:
            self.add(unescape(s) if "&" in s else s)


_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in RAW}


def parse(html: str) -> Node:
    """The tree of a page; always has html, and body if anything can be visible."""
    b, at, n = Builder(), 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            b.text(html[at:])
            break
        if m.start() > at:
            b.text(html[at:m.start()])
        at = m.end()
        if m[1]:
            b.end(m[1].lower())
        elif m[2]:
            tag, attrs = m[2].lower(), _attributes(m[3])
            b.start(tag, attrs)
            if tag in RAW:
                e = _RAW_END[tag].search(html, at)
                if tag in ("textarea", "xmp"):
                    inner = html[at:e.start() if e else n]
                    b.stack[-1].children.append(unescape(inner) if tag == "textarea" else inner)
                at = e.end() if e else n
                b.pop()
    return b.root


# ---- visibility ----------------------------------------------------------------------
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_SEEN = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)


def _shown(node: Node) -> bool:
    """False if neither the node nor anything in it is ever shown."""
    a, t = node.attrs, node.tag
    return not (t in HIDDEN or "hidden" in a or (t == "dialog" and "open" not in a) or ("style" in a and _NONE.search(a["style"]))
                or (t == "input" and a.get("type", "").lower() in ("hidden", "checkbox", "radio", "file", "image", "password")))


def _visible(node: Node, inherited: bool) -> bool:
    m = _SEEN.search(node.attrs["style"]) if "style" in node.attrs else None
    return m[1].lower() == "visible" if m else inherited


# ---- rendering -----------------------------------------------------------------------
class Out:
    """Lines of text. ``need``: line breaks due before the next text; ``indents``: [text, marker still to come]."""

    def __init__(self):
        self.parts: list[str] = []
        self.need, self.space, self.fresh = 0, False, True
        self.indents: list[list] = []

    def _begin(self) -> None:
        if self.need and self.parts:
            self.parts.append("\n" * self.need)
            self.fresh = True
        if self.fresh:
            for level in self.indents:
                self.parts.append(level[1] or level[0])
                level[1] = None
        elif self.space:
            self.parts.append(" ")
        self.need, self.space, self.fresh = 0, False, False

    def text(self, s: str) -> None:
        words = s.split()
        if words:
            self.space = self.space or s[0].isspace()
            self._begin()
            self.parts.append(" ".join(words))
        if s and s[-1].isspace():
            self.space = True

    def lines(self, lines: list[str]) -> None:
        for i, line in enumerate(lines):
            if i:
                self.need += 1
            if line:
                self._begin()
                self.parts.append(line)

    def block(self, breaks: int) -> None:
        self.need, self.space = max(self.need, breaks), False

    def br(self) -> None:
        self.need, self.space = self.need + 1, False

    def result(self) -> str:
        return "\n".join(line.rstrip(" \t") for line in "".join(self.parts).split("\n")).rstrip()


def _number(s: str | None, default: int, most: int = 1000) -> int:
    s = (s or "").strip()
    return max(0, min(int(s), most)) if re.fullmatch(r"\d{1,6}", s) else default


def _ordinal(s: str | None, default: int) -> int:
    """The number of a list item: any integer of up to nine digits."""
    s = (s or "").strip()
    return int(s) if re.fullmatch(r"[+-]?\d{1,9}", s) else default


def _children(node: Node) -> list:
    """What of a node is laid out; a closed details shows its summary alone."""
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return node.children


def render(root: Node, depth: int = 0, inherited: bool = True, content_only: bool = False) -> str:
    """The visible text of a node (with ``content_only`` of its children)."""
    out = Out()
    # (what, visible, in pre) to come, innermost first; a callable ends an element
    todo: list = [(c, inherited, False) for c in reversed(_children(root))] if content_only else [(root, inherited, False)]
    counters: list = []
    while todo:
        node, seen, pre = todo.pop()
        if callable(node):
            node()
            continue
        if isinstance(node, str):
            if seen:
                if pre:
                    out.lines(node.replace("\r\n", "\n").split("\n"))
                else:
                    out.text(node)
            continue
        tag = node.tag
        if not _shown(node):
            continue
        seen = _visible(node, seen)
        if tag == "br":
            out.br()
            continue
        if tag == "input":
            if seen:
                out.text(f" {node.attrs.get('value', '')} ")
            continue
        if tag == "table" and depth < MAX_TABLES:
            out.block(2)
            if (text := _table(node, depth + 1, seen)):
                out.lines(text.split("\n"))
            out.block(2)
            continue
        if tag in ("tr", "td", "th", "tbody", "thead", "tfoot") and depth < MAX_TABLES:
            out.block(1)
        breaks = 0 if tag not in BLOCKS else 2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and counters) else 1
        if breaks:
            out.block(breaks)
            todo.append((lambda breaks=breaks: out.block(breaks), seen, pre))
        if tag in ("ul", "ol", "menu"):
            counters.append(_ordinal(node.attrs.get("start"), 1) if tag == "ol" else None)
            todo.append((counters.pop, seen, pre))
        elif tag == "li":
            mark = "- "
            if counters and counters[-1] is not None:
                counters[-1] = _ordinal(node.attrs.get("value"), counters[-1])
                mark = f"{counters[-1]}. "
                counters[-1] += 1
            out.indents.append([" " * len(mark) if len(out.indents) < MAX_INDENT else "", mark])
            todo.append((out.indents.pop, seen, pre))
        elif tag in ("blockquote", "dd"):
            out.indents.append(["  " if len(out.indents) < MAX_INDENT else "", None])
            todo.append((out.indents.pop, seen, pre))
        elif tag == "q" and seen:
            out.text('"')
            todo.append(('"', seen, False))
        pre = pre or tag in ("pre", "textarea", "xmp")
        todo.extend((c, seen, pre) for c in reversed(_children(node)))
    return out.result()


def _rows(table: Node, seen: bool) -> tuple[list[Node], list[Node]]:
    """(captions, rows) of a table: head rows first, foot rows last."""
    captions, parts = [], {"thead": [], "tbody": [], "tfoot": []}
    for c in table.children:
        if not isinstance(c, Node) or not _shown(c):
            continue
        if c.tag == "caption":
            captions.append(c)
        elif c.tag in parts:
            parts[c.tag] += [r for r in c.children if isinstance(r, Node) and r.tag == "tr" and _shown(r)]
        elif c.tag == "tr":
            parts["tbody"].append(c)
    return captions, parts["thead"] + parts["tbody"] + parts["tfoot"]


#: the widest column that other rows are padded to, and the longest run of padding: longer cells push their own row's
#: later cells to the right, so that a table's text grows with its cells and not with rows times width
COLUMN, GAP = 120, 400


def _table(table: Node, depth: int, seen: bool) -> str:
    captions, rows = _rows(table, seen)
    grid: list[list[tuple[int, int, list[str]]]] = []  # per row: (column, span, lines)
    taken: list[tuple[int, int, int]] = []             # (first column, end, rows) still taken from above, by first column
    for r in rows:
        row_seen, line, col, above = _visible(r, seen), [], 0, 0
        new: list[tuple[int, int, int]] = []
        for c in r.children:
            if not isinstance(c, Node) or c.tag not in ("td", "th") or not _shown(c):
                continue
            while above < len(taken) and taken[above][0] <= col:
                col, above = max(col, taken[above][1]), above + 1
            span, down = max(1, _number(c.attrs.get("colspan"), 1)), max(1, _number(c.attrs.get("rowspan"), 1))
            text = render(c, depth, _visible(c, row_seen), content_only=True)
            line.append((col, span, text.split("\n")))
            if down > 1:
                new.append((col, col + span, down))
            col += span
        taken = sorted((a, b, v - 1) for a, b, v in taken + new if v > 1)
        grid.append(line)
    width: dict[int, int] = {}
    for span_first in (True, False):
        for line in grid:
            for col, span, lines in line:
                w = min(max(map(len, lines)), COLUMN)
                if span == 1 and span_first:
                    width[col] = max(width.get(col, 0), w)
                elif span > 1 and not span_first:  # what the columns under it lack goes to the last of them
                    have = sum(width.get(k, 0) for k in range(col, col + span)) + 2 * (span - 1)
                    width[col + span - 1] = width.get(col + span - 1, 0) + max(0, w - have)
    used = sorted(k for k, w in width.items() if w)
    at, x = {}, 0
    for k in used:
        at[k] = x
        x += width[k] + 2
    done = [t for c in captions if (t := render(c, depth, _visible(c, seen), content_only=True))]
    for line in grid:
        for i in range(max((len(lines) for _, _, lines in line), default=0)):
            s = ""
            for col, _, lines in line:
                if i < len(lines) and lines[i]:
                    gap = at.get(col, 0) - len(s)  # none behind a text wider than its column
                    s += " " * (min(gap, GAP) if gap > 0 else 2 if s else 0) + lines[i]
            if s:
                done.append(s)
    return "\n".join(done)


def html_to_text(html: str | None) -> str | None:
    return None if html is None else render(parse(html))


# ---- Spark ---------------------------------------------------------------------------
def text_of(html: Column) -> Column:
    @F.pandas_udf("string")
    def to_text(pages: pd.Series) -> pd.Series:
        return pd.Series([html_to_text(h) for h in pages], dtype=object)
    return to_text(html)


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text), one row per page."""
    return pages.select(F.col(page_id).alias("page_id"), text_of(F.col(html).cast("string")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
