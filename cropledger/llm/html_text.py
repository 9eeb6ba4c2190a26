"""Visible text of HTML pages, laid out: block spacing, list markers, aligned table cells.

A page becomes a tree first: tags that HTML lets one leave out are implied, misplaced ones closed or moved the way
browsers do. Visibility follows: elements that never show, the ``hidden`` attribute, closed ``details`` and ``dialog``,
and display, visibility and opacity from inline styles and from simple selectors of ``style`` elements. What is left is
rendered top down. Blocks start lines; paragraphs, headings, lists, tables and the like stand between empty lines; table
columns are as wide as their widest cell.

Defined results: null or empty pages have empty text. Unclosed tags, quotes and comments end with the page. Elements more
than ``DEPTH`` levels deep become siblings, as in browsers; tables there lay out no cells of their own. Rows are rendered one by
one, repeated rows and null ids too. Work is in proportion to the page, whatever it holds.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 400

# Fixed values of the HTML standard: which elements are what.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = set(
    "head title script style template noscript noembed noframes iframe object audio video canvas datalist rp "
    "meta link base area param source track defs desc metadata".split()
)
PARAGRAPH = set("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre listing xmp figure table hr fieldset".split())
LINE = set(
    "html body div section article aside nav header footer main address center form details summary dialog li dt dd "
    "figcaption legend caption option optgroup search hgroup tr thead tbody tfoot textarea".split()
)
CLOSES_P = PARAGRAPH | set(
    "address article aside center details dialog div fieldset figcaption footer form header hgroup main nav search "
    "section summary".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FORMATTING = set("a b big code em font i nobr s small strike strong tt u span label abbr cite q mark sub sup".split())
GROUPS = {"thead", "tbody", "tfoot"}
CELLS = {"td", "th"}
SCOPE = {"table", "td", "th", "caption", "html", "template"}
#: A start tag closes these if open, up to the nearest of the second set.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"} | SCOPE),
    "dt": ({"dt", "dd"}, {"dl"} | SCOPE),
    "dd": ({"dt", "dd"}, {"dl"} | SCOPE),
    "option": ({"option"}, {"select", "optgroup"} | SCOPE),
    "optgroup": ({"option", "optgroup"}, {"select"} | SCOPE),
    "td": (CELLS, {"tr", "table"}),
    "th": (CELLS, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "tbody": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "thead": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "tfoot": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "caption": (GROUPS | {"caption", "colgroup"}, {"table"}),
}

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)?))?")
BLANK = re.compile(r"[ \t\n\r\f]+")
OTHER_MEDIA = re.compile(r"@media\s+(?:print|speech)[^{@]*\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}")
SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class Tree:
    """Builds the tree of a page; ``styles`` gathers its style sheets."""

    def __init__(self, html: str):
        self.root = Node("html")
        self.open = [self.root]
        self.ignored = 0  # tables below the depth that is kept
        self.next: dict[str, int] = {}
        self.styles: list[str] = []
        self._read(html)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            tag = html.find("<", at)
            if tag < 0:
                self._text(html[at:])
                return
            if tag > at:
                self._text(html[at:tag])
            at = self._markup(html, tag)

    def _find(self, html: str, sign: str, at: int) -> int:
        """Next place of a character, -1 if there is none; looked for once, not for every tag."""
        known = self.next.get(sign, -2)
        if known != -1 and known < at:
            known = self.next[sign] = html.find(sign, at)
        return known

    def _markup(self, html: str, at: int) -> int:
        """Handle what starts with < at ``at``; where it ends."""
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at) + 1
            end = html.find("-->", at + 4)
            return len(html) if end < 0 else end + 3
        closing = html.startswith("</", at)
        name = NAME.match(html, at + 1 + closing)
        if not name:
            if html[at + 1 : at + 2] in ("!", "?", "/"):
                end = html.find(">", at)
                return len(html) if end < 0 else end + 1
            self._text("<")
            return at + 1
        tag, pos, attrs = name[0].lower(), name.end(), {}
        while True:
            if html.startswith(">", pos):
                pos += 1
                break
            found = ATTRIBUTE.match(html, pos)
            if not found or found.end() == pos:
                close = self._find(html, ">", pos)
                quote = min((k for k in (self._find(html, '"', pos), self._find(html, "'", pos)) if k >= 0), default=-1)
                if close < 0 or 0 <= quote < close and html.find(html[quote], quote + 1) < 0:
                    return len(html)  # the page ends inside a tag
                pos = max(close, pos) if quote < 0 or quote > close else quote + 1
                if pos == close:
                    pos += 1
                    break
                continue
            value = next((v for v in found.group(2, 3, 4) if v is not None), "")
            attrs.setdefault(found[1].lower(), unescape(value) if "&" in value else value)
            pos = found.end()
            rest = BLANK.match(html, pos)
            if rest:
                pos = rest.end()
            if html.startswith("/", pos):
                pos += 1
        if closing:
            self._end(tag)
            return pos
        self._start(tag, attrs)
        if tag in RAW and self.open[-1].tag == tag:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, pos)
            raw = html[pos : stop.start() if stop else len(html)]
            if tag == "style":
                self.styles.append(raw)
            elif tag in ("textarea", "title"):
                self.open[-1].children.append(unescape(raw.removeprefix("\n")))
            elif tag == "xmp":
                self.open[-1].children.append(raw)
            self.open.pop()
            if not stop:
                return len(html)
            end = html.find(">", stop.end())
            return len(html) if end < 0 else end + 1
        return pos

    def _has(self, tags: set[str], stop: set[str]) -> bool:
        for node in reversed(self.open):
            if node.tag in tags:
                return True
            if node.tag in stop:
                return False
        return False

    def _close(self, tags: set[str], stop: set[str]) -> None:
        """Close the nearest of ``tags`` with all inside it, unless one of ``stop`` comes first."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return

    def _put(self, node: Node | str) -> None:
        """Append to the open element; what a table may not hold directly goes before the table."""
        top = self.open[-1]
        if top.tag in GROUPS or top.tag in ("table", "tr"):
            tag = node.tag if isinstance(node, Node) else ""
            if isinstance(node, str) and not node.strip():
                return
            if tag not in CELLS and tag not in GROUPS and tag not in ("tr", "caption", "colgroup", "col", "style", "script", "template"):
                k = max(k for k, x in enumerate(self.open) if x.tag == "table")
                parent, table = self.open[k - 1], self.open[k]
                spot = next((i for i in range(len(parent.children) - 1, -1, -1) if parent.children[i] is table), len(parent.children))
                parent.children.insert(spot, node)
                return
        top.children.append(node)

    def _text(self, raw: str) -> None:
        self._put(unescape(raw) if "&" in raw else raw)

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body", "head"):
            if tag == "body":
                self._close({"head"}, {"table"})
            if tag != "head":
                self.root.attrs = attrs | self.root.attrs
            if tag == "head" and len(self.open) == 1 and not self.root.children:
                self._push(Node("head", attrs))
            return
        if self.open[-1].tag == "head" and tag not in NEVER:
            self.open.pop()
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE | {"button"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag in CELLS or tag == "tr" or tag in GROUPS or tag == "caption":
            if not self._has({"table"}, set()):
                return  # a cell without a table is no cell
            if tag in CELLS:
                self._close(CELLS, {"tr", "table"})
                if not self._has({"tr"}, {"table"}):
                    self._start("tr", {})
            elif tag == "tr":
                self._close({"tr", "caption", "colgroup"}, {"table"})
                if not self._has(GROUPS, {"table"}):
                    self._push(Node("tbody"))
            else:
                self._close(*CLOSED_BY[tag])
            while self.open[-1].tag not in ("table", "tr", *GROUPS):
                self.open.pop()
        elif tag == "table" and len(self.open) >= DEPTH:
            self.ignored += 1
            return
        elif tag == "table" and self.open[-1].tag in ("table", "tr", *GROUPS):
            self._close({"table"}, set())
        elif tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
        if tag == "image":
            tag = "img"
        if tag in VOID:
            self._put(Node(tag, attrs))
        else:
            self._push(Node(tag, attrs))

    def _push(self, node: Node) -> None:
        """Open an element; at the depth kept, in place of the one it would lie in. Parts of a table stay open."""
        if len(self.open) >= DEPTH and self.open[-1].tag not in ("table", "tr", "caption", *GROUPS, *CELLS):
            self.open.pop()
        self._put(node)
        self.open.append(node)

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._put(Node("br"))
        elif tag == "p" and not self._has({"p"}, SCOPE | {"button"}):
            self._put(Node("p"))
        elif tag in HEADINGS:
            self._close(HEADINGS, SCOPE)
        elif tag in FORMATTING:
            self._close({tag}, SCOPE | CLOSES_P | LINE)
        elif tag in CELLS or tag == "caption" or tag == "tr" or tag in GROUPS:
            self._close({tag}, {"table"})
        elif tag == "table" and self.ignored:
            self.ignored -= 1
        elif tag == "table":
            self._close({"table"}, set())
        elif tag == "head":
            self._close({"head"}, set())
        elif tag not in ("html", "body"):
            self._close({tag}, SCOPE)


def _declared(text: str) -> dict[str, str]:
    """Of a declaration list, what bears on visibility and white space; a later one wins unless the earlier is important."""
    found: dict[str, tuple[bool, str]] = {}
    for item in text.split(";"):
        key, colon, value = item.partition(":")
        key, value = key.strip().lower(), value.strip().lower()
        if colon and key in ("display", "visibility", "opacity", "white-space", "list-style", "list-style-type"):
            important = value.endswith("!important")
            if not found.get(key, (False,))[0] or important:
                found[key] = (important, value.removesuffix("!important").strip())
    return {k: v for k, (_, v) in found.items()}


def _uncommented(sheet: str) -> str:
    """A style sheet without comments; an unclosed one goes to the end."""
    out, at = [], 0
    while (start := sheet.find("/*", at)) >= 0:
        out.append(sheet[at:start])
        end = sheet.find("*/", start + 2)
        at = len(sheet) if end < 0 else end + 2
    return "".join([*out, sheet[at:]])


def _rules(sheet: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of each innermost pair of braces."""
    for piece in sheet.split("}")[:-1]:
        head, brace, body = piece.rpartition("{")
        if brace:
            yield head.rpartition("{")[2], body


class Styles:
    """Rules of simple selectors (element, classes, id), for every medium or screens.

    A rule lies under the rarest name of its selector, so that an element meets few others than its own.
    """

    def __init__(self, sheets: list[str]):
        last: dict[tuple, tuple[int, str]] = {}  # of equal selectors and properties the last counts
        for sheet in sheets:
            for selectors, body in _rules(OTHER_MEDIA.sub("", _uncommented(sheet))):
                said = _declared(body)
                for one in selectors.split(",") if said else ():
                    plain = SIMPLE.fullmatch(one.strip())
                    if plain and one.strip():
                        ids = frozenset(re.findall(r"#([\w-]+)", plain[2]))
                        kinds = frozenset(re.findall(r"\.([\w-]+)", plain[2]))
                        tag = "" if plain[1] in (None, "*") else plain[1].lower()
                        for key, value in said.items():
                            last[tag, kinds, ids, key] = (len(last), value)
        names = Counter(n for tag, kinds, ids, _ in last for n in self._names(tag, kinds, ids))
        self.rules: dict[str, list[tuple]] = defaultdict(list)
        for (tag, kinds, ids, key), (at, value) in last.items():
            under = min(self._names(tag, kinds, ids), key=lambda n: (names[n], n), default="")
            self.rules[under].append(((len(ids), len(kinds), bool(tag), at), tag, kinds, ids, key, value))
        self.known = names.keys()
        self.seen: dict[frozenset, dict[str, str]] = {}

    @staticmethod
    def _names(tag: str, kinds: frozenset, ids: frozenset) -> list[str]:
        return [*([tag] if tag else []), *("." + k for k in kinds), *("#" + i for i in ids)]

    def of(self, node: Node) -> dict[str, str]:
        attrs = node.attrs
        said: dict[str, str] = {}
        if self.rules:
            kinds, own = set(attrs.get("class", "").split()), attrs.get("id", "")
            names = frozenset(n for n in self._names(node.tag, kinds, {own}) if n in self.known)
            if names not in self.seen:
                met = [r for n in ("", *names) for r in self.rules.get(n, ())]
                met = [r for r in met if (not r[1] or r[1] == node.tag) and r[2] <= kinds and r[3] <= {own}]
                self.seen[names] = {r[4]: r[5] for r in sorted(met, key=lambda r: r[0])}
            said = self.seen[names]
        return said | _declared(attrs["style"]) if "style" in attrs else said


class Flow:
    """Lines of one block: inline text gathers in a line until a block boundary ends it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.exact = False
        self.gap = 0

    def text(self, value: str, exact: bool) -> None:
        if exact:
            self.exact = True
            first, *rest = value.replace("\r\n", "\n").split("\n")
            self.inline.append(first)
            for line in rest:
                self.end_line(force=True)
                self.exact = True
                self.inline.append(line)
        else:
            self.inline.append(BLANK.sub(" ", value))

    def end_line(self, force: bool = False) -> None:
        line = "".join(self.inline)
        if not self.exact:
            line = BLANK.sub(" ", line).strip(" ")
        elif not force and not line.strip():
            line = ""
        self.inline, self.exact = [], False
        if line or force:
            self._add([line])

    def _add(self, lines: list[str]) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.lines += lines
        self.gap = 1

    def boundary(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str], gap: int) -> None:
        self.boundary(gap)
        if lines:
            self._add(lines)
            self.gap = gap

    def done(self) -> list[str]:
        self.end_line()
        lines = [x.replace("\xa0", " ").rstrip() for x in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def width(text: str) -> int:
    """Columns a text takes in a fixed-width view."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _number(value: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return int(found[1]) if found else default


def _roman(n: int) -> str:
    out = ""
    for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
        out += sign * (n // value)
        n %= value
    return out


def marker(kind: str, n: int) -> str:
    """Number of a list item in the style of the list's type attribute."""
    if kind in ("a", "A") and n > 0:
        word = ""
        while n:
            n, k = divmod(n - 1, 26)
            word = chr(97 + k) + word
        return (word if kind == "a" else word.upper()) + "."
    if kind in ("i", "I") and 0 < n < 4000:
        return (_roman(n) if kind == "i" else _roman(n).upper()) + "."
    return f"{n}."


#: A step of the rendering: it hands out the steps it needs done first, and is sent what they return.
Step = Generator["Step", object, object]


def _done(step: Step) -> object:
    """What a step returns; steps wait on a list, not on the stack of the interpreter."""
    waiting, value = [step], None
    while waiting:
        try:
            step = waiting[-1].send(value)
        except StopIteration as end:
            waiting.pop()
            value = end.value
        else:
            waiting.append(step)
            value = None
    return value


class Page:
    def __init__(self, html: str):
        tree = Tree(html)
        self.styles = Styles(tree.styles)
        flow = Flow()
        _done(self._children(tree.root, flow, True, False))
        self.lines = flow.done()

    def _children(self, node: Node, flow: Flow, seen: bool, exact: bool) -> Step:
        for child in node.children:
            if isinstance(child, str):
                if seen:
                    flow.text(child, exact)
            else:
                yield self._element(child, flow, seen, exact)

    def _look(self, node: Node, seen: bool, exact: bool) -> tuple[bool, bool, bool, dict[str, str]]:
        """Is it rendered at all, does its own text show, is white space kept, its styles."""
        said = self.styles.of(node)
        display = said.get("display", "none" if "hidden" in node.attrs else "")
        closed = node.tag == "dialog" and "open" not in node.attrs and not said.get("display")
        if node.tag in NEVER or display == "none" or closed or said.get("opacity") in ("0", "0.0", "0%"):
            return False, False, exact, said
        visibility = said.get("visibility")
        if visibility in ("hidden", "collapse"):
            seen = False
        elif visibility == "visible":
            seen = True
        if node.tag in ("pre", "listing", "xmp", "textarea"):
            exact = True
        space = said.get("white-space", "")
        if space:
            exact = space.startswith("pre") or space == "break-spaces"
        return True, seen, exact, said

    def _element(self, node: Node, flow: Flow, seen: bool, exact: bool) -> Step:
        shown, seen, exact, said = self._look(node, seen, exact)
        if not shown:
            return
        tag = node.tag
        if tag == "br":
            flow.end_line(force=True)
        elif tag == "wbr" or tag in ("img", "col", "embed"):
            return
        elif tag == "input":
            kind = node.attrs.get("type", "text").lower()
            if seen and kind not in ("hidden", "password", "checkbox", "radio", "file", "image", "range", "color"):
                flow.text(node.attrs.get("value", {"submit": "Submit", "reset": "Reset"}.get(kind, "")), False)
        elif tag == "table" and said.get("display", "table") in ("table", "inline-table"):
            flow.block((yield self._table(node, seen, exact)), 2)
        elif tag in ("ul", "ol", "menu", "dir"):
            yield self._list(node, flow, seen, exact, said)
        elif tag == "li":
            yield self._item(node, flow, seen, exact, "-")
        elif tag == "select":
            yield self._select(node, flow, seen)
        elif tag == "details" and "open" not in node.attrs:
            flow.boundary(1)
            first = next((c for c in node.children if isinstance(c, Node) and c.tag == "summary"), None)
            if first:
                yield self._element(first, flow, seen, exact)
            flow.boundary(1)
        elif tag in ("blockquote", "dd"):
            inner = Flow()
            yield self._children(node, inner, seen, exact)
            flow.block(["  " + x if x else x for x in inner.done()], 2 if tag == "blockquote" else 1)
        else:
            gap = 2 if tag in PARAGRAPH else 1 if tag in LINE else 0
            display = said.get("display", "")
            if display in ("block", "flex", "grid", "list-item", "flow-root") and not gap:
                gap = 1
            elif display.startswith("inline") or display == "contents":
                gap = 0
            if gap:
                flow.boundary(gap)
            if tag in ("td", "th") and not gap:
                flow.text(" ", False)
            first = node.children[0] if exact and tag in ("pre", "listing") and node.children else None
            if isinstance(first, str) and first.startswith("\n"):
                node.children[0] = first[1:]
            yield self._children(node, flow, seen, exact)
            if gap:
                flow.boundary(gap)

    def _list(self, node: Node, flow: Flow, seen: bool, exact: bool, said: dict[str, str]) -> Step:
        nested = node.attrs.get("\0nested") is not None
        flow.boundary(1 if nested else 2)
        bare = "none" in (said.get("list-style", "") + " " + said.get("list-style-type", "")).split()
        items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
        back = "reversed" in node.attrs
        n = _number(node.attrs.get("start"), items if back else 1)
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li":
                n = _number(child.attrs.get("value"), n)
                sign = "" if bare else marker(node.attrs.get("type", "1"), n) if node.tag == "ol" else "-"
                shown, own, kept, _ = self._look(child, seen, exact)
                if shown:
                    yield self._item(child, flow, own, kept, sign)
                    n += -1 if back else 1
            elif isinstance(child, Node):
                yield self._element(child, flow, seen, exact)
            elif seen:
                flow.text(child, exact)
        flow.boundary(1 if nested else 2)

    def _item(self, node: Node, flow: Flow, seen: bool, exact: bool, sign: str) -> Step:
        for child in node.children:
            if isinstance(child, Node) and child.tag in ("ul", "ol", "menu", "dir"):
                child.attrs["\0nested"] = ""
        inner = Flow()
        yield self._children(node, inner, seen, exact)
        lines = inner.done()
        if sign and lines:
            pad = " " * (len(sign) + 1)
            lines = [f"{sign} {lines[0]}", *(pad + x if x else x for x in lines[1:])]
        flow.block(lines, 1)

    def _select(self, node: Node, flow: Flow, seen: bool) -> Step:
        options, stack = [], list(reversed(node.children))
        while stack:
            child = stack.pop()
            if isinstance(child, Node):
                if child.tag == "option":
                    options.append(child)
                else:
                    stack += reversed(child.children)
        several = "multiple" in node.attrs or _number(node.attrs.get("size"), 1) > 1
        picked = options if several else [o for o in options if "selected" in o.attrs][-1:] or options[:1]
        for option in picked:
            if several:
                flow.boundary(1)
            yield self._children(option, flow, seen, False)
        if several:
            flow.boundary(1)

    def _table(self, node: Node, seen: bool, exact: bool) -> Step:
        """Caption lines, then rows: cells padded to the widest of their column, two spaces apart."""
        captions: list[str] = []
        rows: dict[str, list[list[tuple[list[str], int, int]]]] = {"thead": [], "tbody": [], "tfoot": []}
        for child in node.children:
            if not isinstance(child, Node):
                continue
            shown, own, kept, _ = self._look(child, seen, exact)
            if not shown:
                continue
            if child.tag == "caption":
                inner = Flow()
                yield self._children(child, inner, own, kept)
                captions += inner.done()
            elif child.tag in GROUPS:
                for row in child.children:
                    if isinstance(row, Node) and row.tag == "tr":
                        shown, mine, keep, _ = self._look(row, own, kept)
                        if shown:
                            rows[child.tag].append((yield self._cells(row, mine, keep)))
        return captions + _aligned(rows["thead"] + rows["tbody"] + rows["tfoot"])

    def _cells(self, row: Node, seen: bool, exact: bool) -> Step:
        cells = []
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in CELLS:
                shown, own, kept, _ = self._look(cell, seen, exact)
                if shown:
                    inner = Flow()
                    yield self._children(cell, inner, own, kept)
                    across = min(max(_number(cell.attrs.get("colspan"), 1), 1), 1000)
                    down = min(max(_number(cell.attrs.get("rowspan"), 1), 0), 65534)
                    cells.append((inner.done(), across, down))
        return cells


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    placed: list[list[tuple[int, int, list[str]]]] = []
    busy: dict[int, int] = {}  # column -> rows it is still taken from above
    wide: dict[int, int] = {}
    for r, row in enumerate(rows):
        line, column = [], 0
        taken = {c for c, n in busy.items() if n > 0}
        for lines, across, down in row:
            while column in taken:
                column += 1
            line.append((column, across, lines))
            if across == 1:
                wide[column] = max(wide.get(column, 0), *map(width, lines), 0) if lines else wide.get(column, 0)
            if down != 1:
                for c in range(column, column + across):
                    busy[c] = (down if down else len(rows) - r)
            column += across
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
        placed.append(line)
    used = sorted({c for line in placed for c, _, _ in line})
    step = {c: k for k, c in enumerate(used)}
    for line in placed:
        for k, (column, across, lines) in enumerate(line):
            if across > 1 and lines:
                inside = [c for c in used if column <= c < column + across]
                room = sum(wide.get(c, 0) for c in inside) + 2 * (len(inside) - 1)
                need = max(map(width, lines)) - room
                if need > 0 and k < len(line) - 1:
                    wide[inside[-1]] = wide.get(inside[-1], 0) + need
    left, at = {}, 0
    for c in used:
        left[c] = at
        at += wide.get(c, 0) + (2 if wide.get(c, 0) else 0)
    out = []
    for line in placed:
        for k in range(max((len(lines) for _, _, lines in line), default=0)):
            text, reached = [], 0
            for column, _, lines in line:
                if k < len(lines) and lines[k]:
                    text.append(" " * max(left[column] - reached, 2 if reached else 0) + lines[k])
                    reached = max(left[column], reached + 2 if reached else 0) + width(lines[k])
            out.append("".join(text))
    return out if step else []


def render(html: str | None) -> str:
    """Visible text of one page."""
    return "\n".join(Page(html).lines) if html else ""


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(x) for x in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), pa.array(texts, pa.string())]
        columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "text", "n_chars", "n_lines"])


def extract(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page: page_id, text, n_chars (code points), n_lines."""
    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).alias("html"))
    return slim.mapInArrow(_render, "page_id long, text string, n_chars long, n_lines long")
