"""Text of web pages as a browser lays it out.

Pages are parsed to a tree: tags are read by the rules of HTML for quotes,
comments and raw text, missing end tags are implied, and table parts that stand
outside of their place are put right. The tree is then rendered: elements that
are not displayed leave no text, blocks stand on lines of their own with a blank
line where a page has a margin, list items have their markers and indentation,
preformatted text keeps its white space, and the cells of a table are aligned in
columns. What hides an element: its kind, the ``hidden`` attribute, its style,
simple rules of the page's style sheets for screens (not those in ``@`` blocks), a closed ``details``
or ``dialog``, an ``object`` that has data. Cells with a column to their right wrap at
80 characters, so that columns are aligned at any width.

Defined results: a null or empty page has the empty text; a page is read whole,
however long or deeply nested; a tag that never ends drops what follows it, as
in a browser; repeated rows have equal texts; other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import source

# How HTML's elements behave.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
HIDDEN = frozenset("head title script style template noscript noframes noembed iframe audio video canvas "
                   "datalist rp area base link meta param source track defs desc metadata".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
                  "option p pre search section summary table ul xmp".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul xmp dir".split())
CLOSE_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
                    "table ul li dd dt xmp".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
CELLS = frozenset(("td", "th"))
SCOPE = frozenset("applet caption html table td th marquee object template button".split())
INDENTED = frozenset(("blockquote", "dd"))
#: Tables in more tables than this are laid out as blocks (browsers bound the depth of
#: their trees, too). Columns with another one to their right wrap at this width.
TABLE_DEPTH, COLUMN = 40, 80

_SPACE = " \t\n\r\f"
_NAME = re.compile(r"[a-zA-Z][^\t\n\f\r />]*")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+|=[^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?""")
_OPEN_QUOTE = re.compile(r"[ \t\n\r\f]*+=[ \t\n\r\f]*+[\"']")
_RULE = re.compile(r"([^{}]*+)\{([^{}]*+)\}")
_CSS_MARK = re.compile(r"""\\.|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|[@{};]""", re.S)
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*)?([.#][\w-]+)?\Z")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes_of(page: str, at: int) -> tuple[dict[str, str], int]:
    """A tag's attributes from behind its name, and where it ends; -1: nowhere."""
    end = page.find(">", at)
    if end < 0:
        return {}, -1
    if end - at <= 1:
        return {}, end + 1
    found: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m:
            if m[2] is None and _OPEN_QUOTE.match(page, m.end()):
                return {}, -1  # a quoted value without end
            value = m[2] or ""
            if value[:1] in ("'", '"') and value:
                value = value[1:-1]
            found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
            at = m.end()
            continue
        while at < len(page) and (page[at] in _SPACE or page[at] == "/"):
            at += 1
        if at >= len(page):
            return {}, -1
        if page[at] == ">":
            return found, at + 1
        at += 1


class Parser:
    """Builds the tree of one page."""

    def __init__(self, page: str):
        self.root = Node("html", {})
        self.stack = [self.root]
        self.opened: dict[str, int] = {}  # how many elements of each tag are open
        self.rules: list[tuple[str, str, str]] = []  # kind, name, declarations
        self.parse(page)

    # -- tree building

    def text(self, value: str) -> None:
        top = self.stack[-1]
        if top.tag in ("table", "tr") or top.tag in SECTIONS:
            if value.strip(_SPACE):
                self.before_table(value)
            return
        top.children.append(value)

    def before_table(self, child) -> Node:
        """Content that has no place in a table stands before it."""
        i = max(k for k, n in enumerate(self.stack) if n.tag == "table")
        siblings, table = self.stack[i - 1].children, self.stack[i]
        place = len(siblings) - 1 if siblings and siblings[-1] is table else len(siblings)
        siblings.insert(place, child)
        return child

    def open_in(self, tags: frozenset | tuple, until: frozenset) -> int:
        """The innermost open element of the tags, not beyond one of ``until``; -1."""
        if not any(map(self.opened.get, tags)):
            return -1
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                return i
            if tag in until:
                return -1
        return -1

    def close(self, tags: frozenset | tuple, until: frozenset = SCOPE) -> bool:
        i = self.open_in(tags, until)
        if i > 0:
            self.cut(i)
        return i > 0

    def cut(self, i: int, end: int | None = None) -> None:
        """Close the open elements from place ``i`` on."""
        for n in self.stack[i:end]:
            self.opened[n.tag] -= 1
        del self.stack[i:end]

    def opens(self, node: Node) -> None:
        self.opened[node.tag] = self.opened.get(node.tag, 0) + 1
        self.stack.append(node)

    def imply(self, tag: str) -> None:
        """End and start the elements that the start of ``tag`` implies."""
        if tag in CLOSE_P:
            self.close(("p",))
        if tag == "li":
            self.close(("li",), SCOPE | LISTS)
        elif tag in ("dd", "dt"):
            self.close(("dd", "dt"), SCOPE | {"dl"})
        elif tag in ("option", "optgroup"):
            self.close(("option",), SCOPE | {"select", "datalist"})
            if tag == "optgroup":
                self.close(("optgroup",), SCOPE | {"select"})
        elif tag in ("rt", "rp"):
            self.close(("rt", "rp"), SCOPE | {"ruby"})
        elif tag in ("button", "a"):
            self.close((tag,), SCOPE - {"button"})
        elif tag == "caption" or tag in SECTIONS or tag == "tr" or tag in CELLS:
            table = self.open_in(("table",), frozenset(("template",)))
            if table < 0:
                return
            keep = table
            if tag == "tr" or tag in CELLS:
                section = next((k for k in range(table + 1, len(self.stack)) if self.stack[k].tag in SECTIONS), -1)
                if section < 0:
                    self.cut(table + 1)
                    self.push(Node("tbody", {}))
                    section = table + 1
                keep = section
            if tag in CELLS:
                row = next((k for k in range(keep + 1, len(self.stack)) if self.stack[k].tag == "tr"), -1)
                if row < 0:
                    self.cut(keep + 1)
                    self.push(Node("tr", {}))
                    row = keep + 1
                keep = row
            self.cut(keep + 1)

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.opens(node)

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> None:
        if tag in ("html", "body"):
            for k, v in attributes.items():
                self.root.attributes.setdefault(k, v)
            self.close(("head",), frozenset())
            return
        if self.stack[-1].tag == "head" and tag not in HIDDEN:
            self.cut(len(self.stack) - 1)  # the body begins
        if tag in ("table", "input", "textarea") and self.opened.get("select"):
            self.close(("select",), frozenset(("template",)))
        if tag == "table" and self.opened.get("table"):
            # A table that begins outside of the cells of the one that is open ends that one.
            i = self.open_in(("table", "td", "th", "caption", "template"), frozenset())
            if self.stack[i].tag == "table":
                self.cut(i)
        self.imply(tag)
        if tag in CELLS or tag == "tr" or tag in SECTIONS or tag == "caption":
            if self.open_in(("table",), frozenset(("template",))) < 0:
                return  # outside of a table such tags are nothing
        node = Node(tag, attributes)
        top = self.stack[-1].tag
        if (top == "table" or top == "tr" or top in SECTIONS) and not (
                tag in CELLS or tag == "tr" or tag in SECTIONS or tag in ("caption", "colgroup", "col", "script", "style", "template")):
            self.before_table(node)
            if tag not in VOID and not closed:
                self.opens(node)
            return
        if tag in VOID or closed and tag in ("path", "circle", "rect", "use", "g", "svg"):
            self.stack[-1].children.append(node)
        else:
            self.push(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {}, False)
        elif tag == "p" and self.open_in(("p",), SCOPE) < 0:
            self.start("p", {}, False)
            self.close(("p",))
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.close(("h1", "h2", "h3", "h4", "h5", "h6"))
        elif tag in ("html", "body"):
            return
        elif tag in BLOCK or tag in CELLS or tag in SECTIONS or tag in ("tr", "caption", "head", "select", "button"):
            until = frozenset(("template",)) if tag in ("table", "head") else frozenset(("table",)) \
                if tag in CELLS or tag in SECTIONS or tag in ("tr", "caption") else SCOPE - {tag}
            self.close((tag,), until | LISTS if tag == "li" else until)
        else:
            # An inline element may end while blocks in it are open; they stay open.
            i = self.open_in((tag,), SCOPE - {tag})
            if i > 0:
                if any(n.tag in BLOCK for n in self.stack[i + 1:]):
                    self.cut(i, i + 1)
                else:
                    self.cut(i)

    # -- tokens

    def parse(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                part = page[at:lt]
                self.text(unescape(part) if "&" in part else part)
            if lt == n:
                return
            after = page[lt + 1:lt + 2]
            if after == "!" or after == "?":
                if page.startswith("<!--", lt):
                    if page.startswith((">", "->"), lt + 4):
                        at = page.find(">", lt + 4) + 1
                        continue
                    end = page.find("-->", lt + 4)
                    other = page.find("--!>", lt + 4, end if end >= 0 else n)
                    at = other + 4 if other >= 0 else end + 3 if end >= 0 else n
                else:
                    end = page.find(">", lt)
                    at = end + 1 if end >= 0 else n
                continue
            closing = after == "/"
            name = _NAME.match(page, lt + 1 + closing)
            if not name:
                if closing:
                    end = page.find(">", lt)
                    at = end + 1 if end >= 0 else n
                else:
                    self.text("<")
                    at = lt + 1
                continue
            tag = name[0].lower()
            attributes, at = attributes_of(page, name.end())
            if at < 0:
                return
            if closing:
                self.end(tag)
                continue
            self.start(tag, attributes, page[at - 2] == "/")
            if tag in RAW and self.stack[-1].tag == tag:
                at = self.raw(page, tag, at)
            elif tag == "plaintext":
                self.text(page[at:])
                return

    def raw(self, page: str, tag: str, at: int) -> int:
        """The content of an element that holds no tags; where it ends."""
        m = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
        content = page[at:m.start() if m else len(page)]
        node = self.stack[-1]
        self.cut(len(self.stack) - 1)
        if tag == "style" and on_screen(node.attributes.get("media", "")):
            self.sheet(content)
        elif tag in ("textarea", "title", "xmp"):
            node.children.append(content if tag == "xmp" else unescape(content))
        if not m:
            return len(page)
        end = page.find(">", m.end())
        return end + 1 if end >= 0 else len(page)

    def sheet(self, css: str) -> None:
        """Keep the rules with simple selectors that decide what is displayed."""
        css = re.sub(r"/\*.*?(\*/|\Z)", "", css, flags=re.S)
        for selectors, body in _RULE.findall(without_at_rules(css)):
            if re.search(r"display|visibility|white-space", body, re.I):
                for s in selectors.split(","):
                    m = _SIMPLE.match(s.strip())
                    if m and (m[1] or m[2]):
                        self.rules.append(((m[1] or "").lower(), m[2] or "", body))


def on_screen(media: str) -> bool:
    """Whether a sheet for these media is used on a screen."""
    parts = [p.strip() for p in media.lower().split(",")]
    return not media.strip() or any(re.match(r"(only\s+)?(all|screen)\b|\(|not\s+(?!all\b|screen\b)", p) for p in parts)


def without_at_rules(css: str) -> str:
    """A sheet without its ``@...;`` and ``@...{...}``, whose end is that of their
    braces; one without end takes the rest. Strings and escapes are passed over."""
    out, at, depth, last = [], 0, 0, 0
    start, base = -1, 0  # of the at-rule that is open
    for m in _CSS_MARK.finditer(css):
        mark = m[0]
        if mark == "@":
            # In a rule's body only where a declaration can begin.
            if start < 0 and (depth == 0 or not css[last:m.start()].strip()):
                out.append(css[at:m.start()])
                start, base = m.start(), depth
            continue
        if mark not in "{};":
            continue
        last = m.end()
        depth = max(0, depth + (mark == "{") - (mark == "}"))
        if start >= 0 and mark != "{" and depth <= base:
            # A brace that closes the rule around an at-rule without a block stays.
            at, start = m.start() if depth < base else m.end(), -1
    if start < 0:
        out.append(css[at:])
    return "".join(out)


def declared(body: str, found: dict[str, str]) -> None:
    for part in body.lower().split(";"):
        key, colon, value = part.partition(":")
        if colon:
            found[key.strip()] = value.replace("!important", "").strip()


def style_of(node: Node, rules: list[tuple[str, str, str]]) -> dict[str, str]:
    found: dict[str, str] = {}
    if rules:
        classes = node.attributes.get("class", "").split()
        name = node.attributes.get("id")
        for tag, mark, body in rules:
            if (not tag or tag == node.tag) and (not mark or (mark[1:] in classes if mark[0] == "." else mark[1:] == name)):
                declared(body, found)
    if "style" in node.attributes:
        declared(node.attributes["style"], found)
    return found


class Page:
    """Lines of text under construction."""

    def __init__(self):
        self.parts: list[str] = []
        self.need = 0        # line ends due before the next text
        self.space = False   # a collapsed space is due
        self.fresh = True    # at the start of a line
        self.indents: list[str] = []
        self.marker = ""     # of a list item that has no text yet

    def lead(self) -> None:
        """What comes before text: line ends, indentation and a marker."""
        if self.need and self.parts:
            self.parts.append("\n" * self.need)
            self.fresh = True
        if self.fresh:
            indent = "".join(self.indents)
            if self.marker:
                indent = indent[:len(indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.parts.append(indent)
        elif self.space:
            self.parts.append(" ")
        self.need, self.space, self.fresh = 0, False, False

    def text(self, value: str) -> None:
        words = value.split()
        if not words:
            self.space = self.space or bool(value)
            return
        if value[0].isspace():
            self.space = True
        self.lead()
        self.parts.append(" ".join(words))
        self.space = value[-1].isspace()

    def kept(self, value: str) -> None:
        """Text whose white space counts."""
        for i, line in enumerate(re.split(r"\r\n|\r|\n", value)):
            if i:
                self.line()
            if line:
                self.lead()
                self.parts.append(line)

    def line(self) -> None:
        """A line end in a block."""
        self.need = self.need + 1 if self.parts else 0
        self.space = False

    def block(self, n: int) -> None:
        """At least ``n`` line ends before the next text."""
        self.need = max(self.need, n)
        self.space = False

    def result(self) -> str:
        return "".join(self.parts)


def marker(node: Node, count: int) -> str:
    """The marker of a list item of an ordered list."""
    kind = node.attributes.get("type", "1")
    if kind in ("a", "A") and count > 0:
        out = ""
        while count:
            count, r = divmod(count - 1, 26)
            out = chr(97 + r) + out
        return (out.upper() if kind == "A" else out) + ". "
    if kind in ("i", "I") and 0 < count < 4000:
        out = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1),
                               "m cm d cd c xc l xl x ix v iv i".split()):
            while count >= value:
                out, count = out + sign, count - value
        return (out.upper() if kind == "I" else out) + ". "
    return f"{count}. "


def number(value: str | None, default: int, low: int = -10**9, high: int = 10**9) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m[1]), low), high) if m else default


def render(node: Node, rules: list[tuple[str, str, str]], depth: int = 0, visible: bool = True, pre: bool = False) -> str:
    """The text of a node's children. Open elements stand on a list, not on the
    interpreter's stack, so nesting has no bound; only tables call this again."""
    out = Page()
    # Work to do, last first: a child with its context, or a function to call at an element's end.
    todo: list = [(c, node, visible, pre) for c in reversed(node.children)]
    counts: dict[int, int] = {}
    while todo:
        job = todo.pop()
        if callable(job):
            job()
            continue
        child, parent, visible, pre = job
        if isinstance(child, str):
            if visible:
                (out.kept if pre else out.text)(child)
            continue
        tag, attributes = child.tag, child.attributes
        style = style_of(child, rules) if rules or "style" in attributes else {}
        display = style.get("display", "")
        if display == "none" or not display and (
                tag in HIDDEN or "hidden" in attributes or tag == "dialog" and "open" not in attributes
                or tag == "object" and "data" in attributes):
            continue
        if parent.tag == "details" and "open" not in parent.attributes and tag != "summary":
            continue
        if "visibility" in style:
            visible = style["visibility"] not in ("hidden", "collapse")
        if "white-space" in style:
            pre = style["white-space"].startswith(("pre", "break-spaces")) and style["white-space"] != "pre-line"
        if tag == "br":
            if visible:
                out.line()
            continue
        if tag == "input":
            if visible and attributes.get("type", "").lower() in ("submit", "button", "reset"):
                out.text(" " + attributes.get("value", "") + " ")
            continue
        if tag == "select":
            options = [c for c in flat(child) if c.tag == "option"]
            shown = [c for c in options if "selected" in c.attributes] or options[:1]
            if visible and shown:
                out.text(f" {render(shown[-1], rules, depth + 1, visible, pre)} ")
            continue
        if tag == "table" and depth < TABLE_DEPTH and display in ("", "table", "block"):
            lines = table_lines(child, rules, depth, visible, pre)
            out.block(2)
            for i, line in enumerate(lines):
                if i:
                    out.line()
                if line:
                    out.lead()
                    out.parts.append(line)
            out.block(2)
            continue
        block = tag in BLOCK or tag in CELLS or tag in ("tr", "caption")
        if display:
            block = not display.startswith("inline") and display != "contents"
        margin = 2 if tag in SPACED and not (tag in LISTS and parent.tag == "li") else 1
        if block:
            out.block(margin)
        indent = ""
        if tag == "li":
            if parent.tag == "ol":
                here = counts.get(id(parent))
                here = number(parent.attributes.get("start"), 1) if here is None else here + 1
                here = number(attributes.get("value"), here)
                counts[id(parent)] = here
                out.marker = marker(parent, here)
            else:
                out.marker = "- "
            indent = " " * len(out.marker)
        elif tag in INDENTED:
            indent = "  "
        if tag in ("pre", "textarea", "xmp") and "white-space" not in style:
            pre = True
            if child.children and isinstance(child.children[0], str):
                child.children[0] = re.sub(r"\A(\r\n|\r|\n)", "", child.children[0])
        if indent:
            out.indents.append(indent)
        if tag == "q" and visible:
            out.lead()
            out.parts.append('"')

        def end(tag=tag, block=block, margin=margin, indent=indent, visible=visible) -> None:
            if tag == "q" and visible:
                out.parts.append('"')
            if indent:
                out.indents.pop()
                if tag == "li":
                    out.marker = ""
            if block:
                out.block(margin)

        todo.append(end)
        if tag == "details" and "open" not in attributes:
            if visible:
                children = [c for c in child.children if not isinstance(c, str) and c.tag == "summary"][:1]
            else:
                children = []
        else:
            children = child.children
        todo += [(c, child, visible, pre) for c in reversed(children)]
    return out.result()


def flat(node: Node) -> Iterator[Node]:
    """All elements under a node, in order."""
    todo = [c for c in reversed(node.children) if not isinstance(c, str)]
    while todo:
        child = todo.pop()
        yield child
        todo += [c for c in reversed(child.children) if not isinstance(c, str)]


def shown(node: Node, rules: list) -> bool:
    style = style_of(node, rules) if rules or "style" in node.attributes else {}
    return style.get("display", "none" if "hidden" in node.attributes else "") != "none"


def table_lines(table: Node, rules: list, depth: int, visible: bool, pre: bool) -> list[str]:
    """A table's caption and rows, its cells aligned in columns two spaces apart."""
    parts: dict[str, list[Node]] = {"caption": [], "thead": [], "tbody": [], "tfoot": []}
    for c in table.children:
        if not isinstance(c, str) and c.tag in parts and shown(c, rules):
            parts[c.tag].append(c)
    lines: list[str] = []
    for c in parts["caption"]:
        lines += render(c, rules, depth + 1, visible, pre).split("\n")
    rows: list[list[tuple[int, int, list[str]]]] = []
    below: dict[int, int] = {}  # column -> rows that a cell above still takes
    for section in (*parts["thead"], *parts["tbody"], *parts["tfoot"]):
        below.clear()
        for row in section.children:
            if isinstance(row, str) or row.tag != "tr" or not shown(row, rules):
                continue
            cells, column, taken = [], 0, {k: n - 1 for k, n in below.items() if n > 1}
            for cell in row.children:
                if isinstance(cell, str) or cell.tag not in CELLS or not shown(cell, rules):
                    continue
                while below.get(column, 0) > 0:
                    column += 1
                wide = number(cell.attributes.get("colspan"), 1, 1, 1000)
                high = number(cell.attributes.get("rowspan"), 1, 0, 65534) or 65534
                style = style_of(cell, rules) if rules or "style" in cell.attributes else {}
                seen = style["visibility"] not in ("hidden", "collapse") if "visibility" in style else visible
                cells.append((column, wide, render(cell, rules, depth + 1, seen, pre).split("\n")))
                if high > 1:
                    taken.update({k: high - 1 for k in range(column, column + wide)})
                column += wide
            below.clear()
            below.update(taken)
            rows.append(cells)
    widths: dict[int, int] = {}
    for cells in rows:
        some = [i for i, (_, _, text) in enumerate(cells) if any(text)]
        for i in some[:-1]:
            column, wide, text = cells[i]
            cells[i] = column, wide, [part for line in text for part in wrapped(line, COLUMN * wide)]
        for column, wide, text in cells:
            if wide == 1:
                widths[column] = max(widths.get(column, 0), min(COLUMN, max(map(len, text))))
    used = sorted({c for cells in rows for c, _, text in cells if any(text)} | {c for c, w in widths.items() if w})
    at, place = 0, {}
    for c in used:
        place[c] = at
        at += widths.get(c, 0) + 2
    for cells in rows:
        for i in range(max((len(text) for _, _, text in cells), default=0)):
            line = ""
            for column, _, text in cells:
                if i < len(text) and text[i]:
                    gap = place[column] - len(line)
                    line += " " * (max(gap, 2) if line else max(gap, 0)) + text[i]
            lines.append(line)
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return lines


def wrapped(line: str, width: int) -> list[str]:
    """A line in parts of at most ``width`` characters, between words where it can."""
    out = []
    while len(line) > width:
        at = line.rfind(" ", 1, width + 1)
        at = at if line[:max(at, 0)].strip() else -1
        out.append(line[:at] if at > 0 else line[:width])
        line = line[at + 1:] if at > 0 else line[width:]
    return [*out, line]


def page_text(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    parser = Parser(page.replace("\0", ""))
    return render(parser.root, parser.rules)


def extract(html: Column) -> Column:
    """The visible text of each page."""

    @F.arrow_udf("string")
    def visible_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([page_text(p) for p in pages.to_pylist()], pa.string())

    return visible_text(html.cast("string"))


def extract_pages(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the visible text of each; a column of the name ``text`` is replaced."""
    return pages.withColumn(text, extract(F.col(html)))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages, laid out."""
    return extract_pages(source(spark, sf_dir, "pages", "page_id", "html")).select(
        "page_id", F.length("text").cast("long").alias("n_chars"), "text")
