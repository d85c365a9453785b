"""HTML extraction by layout-aware rendering: all visible text, laid out as a page would be.

A tokenizer feeds a tree builder that supplies implied tags: a paragraph ends where a block begins,
a list item where the next begins, a cell with its row, a head where content begins; a cell
without a row gets one. Elements are laid out when they close, from the inside to the outside, so
depth costs no recursion. Blocks stand on lines of their own, paragraphs and headings with an
empty line around them; list items get a dash or their number and are indented by depth; the cells
of a table are padded to columns. Preformatted text keeps its spaces.

Not visible: head, scripts, styles, templates and other elements that show nothing, ``hidden``,
``display:none`` and ``visibility:hidden``, closed details but for their summary, comments. Nothing
visible is dropped, wherever it stands.

Rows are independent. Defined results: null or empty html gives empty text; text without tags is
itself with white space collapsed; broken markup is read on a best effort and never fails.
Ties, repeated rows, null ids, clashing columns and empty tables need no rule.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm.common import field

# Fixed sets of element names, as HTML defines them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = set("""
head script style template noscript iframe noembed noframes object audio video canvas datalist
title""".split())
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset menu dir".split())
BLOCK = SPACED | set("""
html body address article aside center dd details dialog div dt figcaption footer form header
hgroup legend li main nav option optgroup search section select summary tr td th caption thead
tbody tfoot""".split())
LISTS = {"ul", "ol", "menu", "dir"}
GROUPS = {"thead", "tbody", "tfoot"}
CELLS = {"td", "th"}
ENDS_PARAGRAPH = BLOCK - {"option", "optgroup", "select", "tr", "td", "th", "caption", "html", "body"} - GROUPS | {"hr"}
# What a start tag closes, and the elements that stop the search for it.
IMPLIED_END = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}),
    "thead": (GROUPS | {"tr", "caption"}, {"table"}), "tbody": (GROUPS | {"tr", "caption"}, {"table"}),
    "tfoot": (GROUPS | {"tr", "caption"}, {"table"}),
}
TABLE_PARTS = {"table", "tr", "td", "th", "caption"} | GROUPS

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
# An attribute: its name, and its value in quotes or bare.
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
DECLARATION = re.compile(r"""((?:[^;"'(]++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|\([^)]*+(?:\)|\Z))++)""")
DIGITS = re.compile(r"\s*\+?([0-9]{1,4})")
SPACES = re.compile(r"[ \t\n\r\f]+")
BREAK = object()
# Padding of a column stops here; longer cells just run on.
WIDEST = 60


def attributes_of(source: str) -> dict[str, str]:
    """Names and values of a tag's attributes; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def hides(attributes: dict[str, str]) -> bool:
    """Whether the element is ``hidden`` or its style declares it so; the last valid declaration counts."""
    if "hidden" in attributes:
        return True
    style = attributes.get("style", "").lower()
    if "none" not in style and "hidden" not in style:
        return False
    last: dict[str, tuple[bool, str]] = {}
    for declaration in DECLARATION.findall(COMMENT.sub(" ", style)):
        name, _, value = declaration.partition(":")
        value, mark, rest = value.strip().partition("!")
        name, important = name.strip(), bool(mark) and rest.strip() == "important"
        if value.strip() and (important or not last.get(name, (False, ""))[0]):
            last[name] = important, value.strip()
    return last.get("display", (False, ""))[1] == "none" or last.get("visibility", (False, ""))[1] == "hidden"


class Box:
    """An open element: what it holds so far is text, line breaks, and laid-out blocks."""

    __slots__ = ("tag", "hidden", "pre", "parts", "number", "span", "shut")

    def __init__(self, tag: str, hidden: bool = False, pre: bool = False) -> None:
        self.tag, self.hidden, self.pre = tag, hidden, pre
        self.parts: list = []
        self.number = 1
        self.span = 1
        self.shut = False  # closed details show only their summary


class Block:
    """Lines of a closed element, and whether it keeps an empty line around it."""

    __slots__ = ("tag", "lines", "spaced", "span")

    def __init__(self, tag: str, lines: list[str], spaced: bool, span: int = 1) -> None:
        self.tag, self.lines, self.spaced, self.span = tag, lines, spaced, span


def lines_of(parts: list, pre: bool) -> list[str]:
    """Lays out the parts of an element one below the other."""
    out: list[str] = []
    inline: list[str] = []
    gap = False  # the block above wants an empty line below it

    def flush() -> None:
        nonlocal gap
        text = "".join(inline)
        inline.clear()
        if pre:
            found = text.split("\n")
            while found and not found[0].strip():
                found.pop(0)
            while found and not found[-1].strip():
                found.pop()
        else:
            text = SPACES.sub(" ", text).strip(" ")
            found = [text] if text else []
        if found:
            if gap and out:
                out.append("")
            out.extend(found)
            gap = False

    for part in parts:
        if part is BREAK:
            if pre:
                inline.append("\n")
            else:
                flush()
        elif isinstance(part, str):
            inline.append(part)
        else:
            flush()
            if not part.lines:
                continue
            if out and (gap or part.spaced):
                out.append("")
            out.extend(part.lines)
            gap = part.spaced
    flush()
    return out


def table_lines(parts: list) -> list[str]:
    """Rows with their cells padded to columns; what is not in a row stands above or below."""
    rows: list[list[Block]] = []
    above: list = []
    for part in parts:
        if isinstance(part, Block) and part.tag == "tr":
            rows.append(part.lines)  # of a row: its cells
        else:
            above.append(part)
    widths: list[int] = []
    for row in rows:
        at = 0
        for cell in row:
            widths.extend([0] * (at + cell.span - len(widths)))
            if cell.span == 1:
                widths[at] = min(WIDEST, max([widths[at], *map(len, cell.lines)]))
            at += cell.span
    out = lines_of(above, False)
    for row in rows:
        for i in range(max((len(c.lines) for c in row), default=0)):
            line, at = [], 0
            for cell in row:
                width = sum(widths[at : at + cell.span]) + 2 * (cell.span - 1)
                line.append((cell.lines[i] if i < len(cell.lines) else "").ljust(width))
                at += cell.span
            out.append("  ".join(line).rstrip())
    return out


class Page:
    """Tree builder over a stack of open elements."""

    def __init__(self) -> None:
        self.stack = [Box("body")]
        self.opened: dict[str, int] = {}

    def _close(self) -> None:
        box = self.stack.pop()
        self.opened[box.tag] -= 1
        above = self.stack[-1]
        tag = box.tag
        if box.hidden or tag == "head":
            return
        if tag == "details" and box.shut:
            box.parts = [p for p in box.parts if isinstance(p, Block) and p.tag == "summary"]
        if tag not in BLOCK:
            above.parts += box.parts
            return
        if tag == "table":
            above.parts.append(Block(tag, table_lines(box.parts), True))
        elif tag in GROUPS:
            if above.tag == "table":
                above.parts += box.parts
            else:
                above.parts.append(Block("div", table_lines(box.parts), False))
        elif tag == "tr":
            cells = [p for p in box.parts if isinstance(p, Block) and p.tag in CELLS]
            rest = [p for p in box.parts if not (isinstance(p, Block) and p.tag in CELLS)]
            stray = lines_of(rest, False)
            if stray:
                cells.append(Block("td", stray, False))
            if above.tag == "table" or above.tag in GROUPS:
                above.parts.append(Block(tag, cells, False))
            else:
                above.parts.append(Block("div", table_lines([Block(tag, cells, False)]), False))
        elif tag == "li":
            lines = lines_of(box.parts, box.pre)
            mark = "- "
            holder = next((b for b in reversed(self.stack) if b.tag in LISTS), None)
            if holder is not None and holder.tag == "ol":
                mark = f"{holder.number}. "
                holder.number += 1
            indent = " " * len(mark)
            above.parts.append(Block(tag, [
                (indent if i else mark) + x if x else x for i, x in enumerate(lines)], False))
        else:
            lines = lines_of(box.parts, box.pre)
            if tag in ("blockquote", "dd"):
                lines = ["  " + x if x else x for x in lines]
            nested = tag in LISTS and self.opened.get("li", 0) > 0
            above.parts.append(Block(tag, lines, tag in SPACED and not nested, box.span))

    def _in_table(self) -> bool:
        return self.opened.get("table", 0) > 0

    def _close_to(self, tags: set[str], stops: set[str]) -> bool:
        """Closes the nearest open element of the tags and all inside it, unless a stop is nearer."""
        if not any(self.opened.get(t) for t in tags):
            return False
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self._close()
                return True
            if tag in stops:
                return False
        return False

    def start(self, tag: str, source: str) -> None:
        attributes = attributes_of(source) if source else {}
        if tag in ("html", "body"):
            if tag == "body":
                self._close_to({"head"}, set())
            if hides(attributes):
                self.stack[0].hidden = True
            return
        if tag == "head" and (len(self.stack) > 1 or any(not isinstance(p, str) or p.strip() for p in self.stack[0].parts)):
            return  # a head has its place before all content only
        if self.opened.get("head") and tag not in IN_HEAD:
            self._close_to({"head"}, set())
        if tag in ENDS_PARAGRAPH:
            self._close_to({"p"}, {"table", "td", "th", "caption", "button", "object"})
        if tag in IMPLIED_END:
            while self._close_to(*IMPLIED_END[tag]):
                pass
        if tag in CELLS and self._in_table() and self.stack[-1].tag in ({"table"} | GROUPS):
            self._open(Box("tr", self.stack[-1].hidden))
        above = self.stack[-1]
        if tag == "br":
            above.parts.append(BREAK)
            return
        if tag == "hr":
            above.parts.append(Block("hr", [], True))
            return
        if tag in VOID:
            return
        box = Box(tag, above.hidden or tag in UNSEEN or hides(attributes),
                  above.pre or tag in ("pre", "textarea", "xmp"))
        if tag == "ol" and (number := DIGITS.match(attributes.get("start", ""))):
            box.number = int(number[1])
        elif tag in CELLS and (number := DIGITS.match(attributes.get("colspan", ""))):
            box.span = min(max(1, int(number[1])), 1000)
        if tag == "details":
            box.shut = "open" not in attributes
        self._open(box)

    def _open(self, box: Box) -> None:
        self.stack.append(box)
        self.opened[box.tag] = self.opened.get(box.tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.stack[-1].parts.append(BREAK)
        elif tag == "p" and not self.opened.get("p"):
            self.stack[-1].parts.append(Block("p", [], True))
        elif tag not in ("html", "body"):
            self._close_to({tag}, {"table"} if tag in TABLE_PARTS - {"table"} else
                           set() if tag == "table" else {"td", "th", "table"} - {tag})

    def text(self, text: str) -> None:
        if self.stack[-1].tag == "head" and text.strip():
            self._close_to({"head"}, set())
        if not self.stack[-1].hidden:
            self.stack[-1].parts.append(html.unescape(text) if "&" in text else text)

    def finish(self) -> str:
        while len(self.stack) > 1:
            self._close()
        return "" if self.stack[0].hidden else "\n".join(lines_of(self.stack[0].parts, False))


def render(source: str | None) -> str:
    """The visible text of a page."""
    if not source:
        return ""
    page, at, size = Page(), 0, len(source)
    last = source.rfind(">") + 1  # no tag ends beyond
    while at < size:
        found = TAG.search(source, at, last) if at < last else None
        if found is None:
            page.text(source[at:].partition("<!--")[0])
            break
        if found.start() > at:
            page.text(source[at : found.start()])
        at = found.end()
        if found[2] is None:  # comment, doctype or the like
            if found[0].startswith("<![CDATA["):
                page.text(html.escape(found[0][9:].removesuffix("]]>"), False))
            continue
        tag = found[2].lower()
        if found[1]:
            page.end(tag)
            continue
        page.start(tag, found[3])
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            inner, at = (source[at:], size) if close is None else (source[at : close.start()], close.end())
            if tag in ("textarea", "xmp"):
                page.text(inner)
            page.end(tag)
    return page.finish()


@F.pandas_udf(T.StringType())
def rendered(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(render)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select(field("page_id"), field("url"), rendered(field("html")).alias("text"))
