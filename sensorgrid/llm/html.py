"""HTML extraction by layout-aware rendering (operator 1).

Each page is parsed into a tree and rendered to the text a reader would see:

* The tree builder closes what HTML lets authors leave open (paragraphs, list items, cells,
  options, ...), opens tables' missing rows and bodies, ignores stray end tags, and treats the
  contents of ``script``, ``style`` and the like as one raw text.
* Visibility: ``head`` (but for its title, which is a column of its own), raw-text elements,
  comments, ``template``, ``noscript``, ``hidden`` attributes, ``display:none`` and
  ``visibility:hidden`` styles, hidden inputs and ``aria-hidden`` elements leave no text; nothing
  else is dropped, navigation and footers included.
* Layout: white space is collapsed except in ``pre`` and ``textarea``; blocks begin new lines,
  paragraphs, headings, lists and tables are set apart by a blank line; list items carry a
  bullet or their number and are indented by depth; table cells are padded to their column's
  width, with ``colspan`` and ``rowspan`` in place; images show their ``alt``.

A drawing's or formula's text is shown without its descriptions, a button input shows its value,
``details`` shows its summary alone unless it is open, an element of a hidden one may be visible
again, and plain selectors (element, class, id) of the page's own styles are followed; other
selectors, and rules inside @ blocks, are not.

Defined cases: a null or empty page gives empty text and title; a page without tags is plain text;
unfinished tags at the end are text, unfinished comments and raw texts run to the end.  Nesting has
no limit: neither parsing nor rendering recurses, and no character of a tag is looked at twice.
Whole pages are read.  Rows are independent, so repeated rows and null ids each give a row.  Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from sensorgrid.llm.common import map_batches, quoted

# Element kinds of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = set("script style template noscript iframe noembed noframes object audio video canvas datalist".split())
#: Descriptions and alternatives inside drawings and formulas.
UNDRAWN = set("desc metadata defs annotation annotation-xml".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table caption ul".split()
)
APART = set("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure fieldset hr".split())
LISTS = {"ul", "ol", "menu", "dir"}
ROW_GROUPS = {"thead", "tbody", "tfoot"}
#: Blocks that end an open paragraph.
ENDS_P = (BLOCK - {"body", "html", "caption", "option", "optgroup", "select", "legend"}) | {"xmp"}
#: What a start tag closes, up to the elements that keep it in.
CLOSES = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: Elements that an end tag outside them does not reach through.
FENCES = {"table", "td", "th", "caption", "template"}

MARKUP = re.compile(r"<!--(?:.*?-->|.*\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
BETWEEN = re.compile(r"[\s/]*")
NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
UNQUOTED = re.compile(r"[^\s>]*")
UNDISPLAYED = re.compile(r"display\s*:\s*none", re.IGNORECASE)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
#: The selectors that are understood.
SELECTOR = re.compile(r"([a-zA-Z][\w-]*)?(?:([.#])([\w-]+))?\Z")
PREFORMATTED = re.compile(r"white-space\s*:\s*(?:pre|break-spaces)", re.IGNORECASE)
#: Columns and rows of a cell at most, by the standard.
COLSPAN, ROWSPAN = 1000, 65534
SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Tags:
    """Reads the rest of tags.  Every character is looked at once, whatever quotes are left open."""

    def __init__(self, html: str):
        self.html, self.open = html, {'"': True, "'": True}

    def rest(self, at: int) -> tuple[int, dict[str, str]] | None:
        """The end of the tag whose name ends at ``at``, and its attributes; None if it has no end."""
        html, size, out = self.html, len(self.html), {}
        while True:
            at = BETWEEN.match(html, at).end()
            if at >= size:
                return None
            if html[at] == ">":
                return at + 1, out
            name = NAME.match(html, at)
            at, value = name.end(), ""
            equals = EQUALS.match(html, at)
            if equals:
                at = equals.end()
                quote = html[at : at + 1]
                end = -1
                if quote in self.open and self.open[quote]:
                    end = html.find(quote, at + 1)
                    # Not one is left, so none is looked for again.
                    self.open[quote] = end >= 0
                if end >= 0:
                    value, at = html[at + 1 : end], end + 1
                else:
                    found = UNQUOTED.match(html, at)
                    value, at = found[0], found.end()
            out.setdefault(name[0].lower(), unescape(value) if "&" in value else value)


class Stack(list):
    """The open elements, and how many of each there are."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.append(node)
        self.open[node.tag] += 1

    def cut(self, place: int) -> None:
        for node in self[place:]:
            self.open[node.tag] -= 1
        del self[place:]


def parse(html: str) -> Node:
    """The page's tree; texts are strings among the children."""
    root = Node("", {})
    stack, at, size, tags = Stack(root), 0, len(html), Tags(html)
    while at < size:
        found = MARKUP.search(html, at)
        if found is None:
            _text(stack, html[at:])
            break
        if found.start() > at:
            _text(stack, html[at : found.start()])
        at = found.end()
        closing, tag = found.group(1), found.group(2)
        if tag is None:
            continue
        rest = tags.rest(at)
        if rest is None:
            _text(stack, html[found.start() :])
            break
        at, attributes = rest
        tag = tag.lower()
        if closing:
            _end(stack, tag)
            continue
        _start(stack, tag, attributes)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            raw = html[at : stop.start() if stop else size]
            if raw and stack[-1].tag == tag:
                stack[-1].children.append(unescape(raw) if tag in ("title", "textarea") else raw)
            at = stop.end() if stop else size
            _end(stack, tag)
    return root


def _text(stack: Stack, raw: str) -> None:
    stack[-1].children.append(unescape(raw) if "&" in raw else raw)


def _close(stack: Stack, tags: set[str], within: set[str]) -> None:
    """Closes the outermost open element of ``tags`` inside the nearest of ``within``."""
    if not any(stack.open[tag] for tag in tags):
        return
    place = None
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            place = i
        elif stack[i].tag in within or stack[i].tag in FENCES - tags:
            break
    if place is not None:
        stack.cut(place)


def _push(stack: Stack, tag: str, attributes: dict[str, str]) -> None:
    node = Node(tag, attributes)
    stack[-1].children.append(node)
    if tag not in VOID:
        stack.push(node)


def _start(stack: Stack, tag: str, attributes: dict[str, str]) -> None:
    if tag in ENDS_P:
        _close(stack, {"p"}, {"button"})
    if len(tag) == 2 and tag[0] == "h" and stack[-1].tag in {"h1", "h2", "h3", "h4", "h5", "h6"}:
        stack.cut(len(stack) - 1)
    if tag in CLOSES:
        _close(stack, *CLOSES[tag])
    if tag == "body" and stack[-1].tag == "head":
        stack.cut(len(stack) - 1)
    if tag in ("td", "th") and stack[-1].tag in ROW_GROUPS | {"table"}:
        _start(stack, "tr", {})
    if tag == "tr" and stack[-1].tag == "table":
        _push(stack, "tbody", {})
    if tag not in RAW | VOID | {"html", "head", "base", "link", "meta", "template", "noscript"} and stack[-1].tag == "head":
        stack.cut(len(stack) - 1)
    _push(stack, tag, attributes)


def _end(stack: Stack, tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1) if stack.open[tag] else ():
        if stack[i].tag == tag:
            stack.cut(i)
            return
        if stack[i].tag in FENCES and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
            break
        if stack[i].tag == "table" and tag != "table":
            break
    if tag == "p":
        _start(stack, "p", {})
        stack.cut(len(stack) - 1)
    elif tag == "br":
        _push(stack, "br", {})


def _rules(style: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules outside @ blocks."""
    style = COMMENT.sub(" ", style)
    start, depth, selectors = 0, 0, ""
    for found in re.finditer(r"[{};]", style):
        text, start = style[start : found.start()].strip(), found.end()
        if found[0] == "{":
            depth += 1
            selectors = text if depth == 1 else ""
            body: list[str] = []
        elif depth and found[0] == ";":
            body.append(text)
        elif depth:
            depth -= 1
            if not depth and selectors and selectors[0] != "@":
                yield selectors, ";".join([*body, text])


def _unseen_selectors(root: Node) -> set[tuple[str, str, str]]:
    """(element, . or #, name) of the plain selectors that a style element of the page does not display."""
    out, stack = set(), [root]
    while stack:
        node = stack.pop()
        if node.tag == "style":
            for selectors, body in _rules("".join(c for c in node.children if isinstance(c, str))):
                if UNDISPLAYED.search(body):
                    for selector in selectors.split(","):
                        found = SELECTOR.match(selector.strip())
                        if found and selector.strip():
                            out.add((found[1] or "", found[2] or "", found[3] or ""))
        stack += [c for c in node.children if isinstance(c, Node)]
    return out


def _displayed(node: Node, unseen: set[tuple[str, str, str]]) -> bool:
    a, tag = node.attributes, node.tag
    if tag in HIDDEN or tag in ("head", "title") or tag in UNDRAWN:
        return False
    if unseen:
        names = [("", "")] + [(".", c) for c in a.get("class", "").split()] + ([("#", a["id"])] if "id" in a else [])
        if any((t, *n) in unseen for t in ("", tag) for n in names):
            return False
    if not a:
        return True
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or (tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    return not ("style" in a and UNDISPLAYED.search(a["style"]))


class Page:
    """Lines of text as they grow; ``indent`` goes before every line."""

    def __init__(self, unseen: set[tuple[str, str, str]] = frozenset(), visible: bool = True):
        self.unseen, self.visible = unseen, visible
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent, self.mark, self.gap, self.blocks = "", "", False, 0

    def shows(self, node: Node) -> bool:
        return _displayed(node, self.unseen)

    def add(self, text: str) -> None:
        if not self.visible:
            return
        text = SPACE.sub(" ", text)
        if not self.line or self.line[-1].endswith(" "):
            text = text.lstrip(" ")
        if text:
            self.line.append(text)

    def end_line(self) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line.clear()
        if text:
            self.put(text)

    def put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.blocks += self.gap or not self.lines
        self.gap = False
        self.lines.append(self.indent + self.mark + text)
        if self.mark:
            self.indent += " " * len(self.mark)
            self.mark = ""

    def apart(self) -> None:
        self.end_line()
        self.gap = True


Steps = Iterator["Steps"]


def run(steps: Steps) -> None:
    """Runs a generator that yields the generators it depends on, without recursion."""
    stack = [steps]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        else:
            stack.append(inner)


def _list_item(node: Node, page: Page, mark: str) -> Steps:
    page.end_line()
    indent, outer = page.indent, page.mark
    if outer:
        page.indent += " " * len(outer)
    page.mark = mark
    yield _children(node, page)
    page.end_line()
    page.indent, page.mark = indent, ""


def _list(node: Node, page: Page) -> Steps:
    nested = bool(page.indent or page.mark)
    page.end_line() if nested else page.apart()
    number = int(node.attributes["start"]) if re.fullmatch(r"-?\d{1,9}", node.attributes.get("start", "")) else 1
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and page.shows(child):
            if re.fullmatch(r"-?\d{1,9}", child.attributes.get("value", "")):
                number = int(child.attributes["value"])
            visible = page.visible
            page.visible = _visibility(child, visible)
            yield _list_item(child, page, f"{number}. " if node.tag == "ol" else "- ")
            page.visible = visible
            number += 1
        else:
            yield _render(child, page)
    page.end_line() if nested else page.apart()


def _rows(node: Node, page: Page) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and page.shows(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ROW_GROUPS:
                yield from (c for c in child.children if isinstance(c, Node) and c.tag == "tr" and page.shows(c))


def _span(node: Node, name: str, most: int) -> int:
    value = node.attributes.get(name, "1")
    return min(max(int(value), 1), most) if re.fullmatch(r"\d{1,9}", value) else 1


def _table(node: Node, page: Page) -> Steps:
    page.apart()
    for child in node.children:  # captions, and what stands in a table outside its cells
        if not isinstance(child, Node) or child.tag not in ROW_GROUPS | {"tr", "colgroup", "col"}:
            yield _render(child, page)
    page.end_line()
    grid, taken = [], {}
    for y, row in enumerate(_rows(node, page)):
        cells, x = [], 0
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in ("td", "th"):
                yield _render(cell, page)
                continue
            if not page.shows(cell):
                continue
            while taken.get(x, 0) > y:
                x += 1
            inner = Page(page.unseen, _visibility(cell, _visibility(row, page.visible)))
            yield _children(cell, inner)
            inner.end_line()
            wide = _span(cell, "colspan", COLSPAN)
            cells.append((x, wide, [line for line in inner.lines if line] or [""]))
            for c in range(x, x + wide):
                taken[c] = y + _span(cell, "rowspan", ROWSPAN)
            x += wide
        grid.append(cells)
    page.end_line()
    starts = _columns([(x, wide, max(map(len, lines))) for cells in grid for x, wide, lines in cells])
    for cells in grid:
        placed = [(starts[x], lines) for x, _, lines in cells]
        for i in range(max((len(lines) for _, lines in placed), default=0)):
            out = ""
            for start, lines in placed:
                text = lines[i] if i < len(lines) else ""
                if start and len(out) < start:
                    out = out.ljust(start - 3) + " | "
                elif start:
                    out += " | "
                out += text
            if out.strip(" |"):
                page.put(out.rstrip())
    page.apart()


def _columns(cells: list[tuple[int, int, int]]) -> dict[int, int]:
    """Where the columns of cells (column, columns wide, text size) start.  The last column of a
    cell over several gets what the others lack, narrow cells first."""
    widths: dict[int, int] = {}
    last = {x + wide - 1 for x, wide, _ in cells} | {x for x, _, _ in cells}
    for x, wide, size in sorted(cells, key=lambda c: c[1]):
        end = x + wide - 1
        room = sum(widths.get(c, 0) + 3 for c in range(x, end)) if wide > 1 and size > 3 * (wide - 1) else 3 * (wide - 1)
        widths[end] = max(widths.get(end, 0), size - room)
    starts, at = {}, 0
    for c in range(max(last, default=-1) + 1):
        starts[c] = at
        at += widths.get(c, 0) + 3
    return starts


def _children(node: Node, page: Page) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            page.add(child)
        else:
            yield _render(child, page)


def _visibility(node: Node, visible: bool) -> bool:
    """Visibility is inherited, and an element inside a hidden one may be visible again."""
    found = VISIBILITY.search(node.attributes["style"]) if "style" in node.attributes else None
    return found[1].lower() == "visible" if found else visible


def _render(node: Node | str, page: Page) -> Steps:
    if isinstance(node, str):
        page.add(node)
        return
    if not page.shows(node):
        return
    visible = page.visible
    if node.attributes:
        page.visible = _visibility(node, visible)
    tag = node.tag
    if tag == "br":
        page.end_line()
    elif tag == "img":
        page.add(node.attributes.get("alt", ""))
    elif tag == "input":
        if node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
            page.add(f" {node.attributes.get('value', '')} ")
    elif tag == "hr":
        page.apart()
    elif tag in LISTS:
        yield _list(node, page)
    elif tag == "li":
        yield _list_item(node, page, "- ")
    elif tag == "table":
        yield _table(node, page)
    elif tag in ("pre", "textarea") or "style" in node.attributes and tag in BLOCK and PREFORMATTED.search(node.attributes["style"]):
        page.apart()
        for line in _plain(node, page).strip("\n").split("\n"):
            page.put(line.rstrip()) if line.strip() else page.lines.append("")
        page.apart()
    elif tag == "details" and "open" not in node.attributes:
        page.end_line()
        for child in node.children:
            if isinstance(child, Node) and child.tag == "summary":
                yield _render(child, page)
                break
        page.end_line()
    elif tag in BLOCK:
        page.apart() if tag in APART else page.end_line()
        yield _children(node, page)
        page.apart() if tag in APART else page.end_line()
    else:
        if tag in ("td", "th"):
            page.add(" ")
        yield _children(node, page)
    page.visible = visible


def _plain(node: Node, page: Page) -> str:
    """The text of preformatted elements, as it stands."""
    out, stack = [], [(c, page.visible) for c in reversed(node.children)]
    while stack:
        now, visible = stack.pop()
        if isinstance(now, str):
            if visible:
                out.append(now)
        elif now.tag == "br":
            out.append("\n")
        elif page.shows(now):
            visible = _visibility(now, visible)
            stack += [(c, visible) for c in reversed(now.children)]
    return "".join(out).replace("\r\n", "\n")


def _title(node: Node) -> str | None:
    stack = [node]
    while stack:
        now = stack.pop()
        if now.tag == "title":
            return SPACE.sub(" ", _plain(now, Page())).strip()
        if now.tag != "svg":
            stack += [c for c in reversed(now.children) if isinstance(c, Node)]
    return None


def render(html: str) -> tuple[str, str, int]:
    """Title, text and number of blocks of a page."""
    root = parse(html)
    page = Page(_unseen_selectors(root))
    run(_children(root, page))
    page.end_line()
    return _title(root) or "", "\n".join(page.lines).strip("\n"), page.blocks


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            part = batch.slice(start, 128)
            rows = [render(html or "") for html in part.column(1).to_pylist()]
            titles, texts, blocks = (list(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string()), pa.array(blocks, pa.int64())],
                names=["page_id", "title", "text", "n_blocks"],
            )


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, title, text, n_blocks`` of each page."""
    rows = pages.select(quoted(id_col).alias("page_id"), quoted(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(rows, _extract, f"page_id {kind}, title string, text string, n_blocks long")
