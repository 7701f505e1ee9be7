"""HTML extraction by layout: a tree builder with implied tags, visibility rules, and a text renderer.

All visible text is kept: blocks on lines of their own with blank lines around paragraphs and headings, list items with
their bullet or number, table cells aligned in columns, preformatted text as it stands. The text of drawings and formulas
stays too; where a page holds a formula twice (as MathML and drawn by style sheets), so does its text.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import lean, text_bytes

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head title script style template noscript iframe object annotation annotation-xml datalist noembed noframes audio video canvas".split())
# In a drawing these show nothing where they stand; of the rest only text and foreign objects hold words that show.
NOT_DRAWN = frozenset("defs symbol title desc metadata clippath mask pattern marker".split())
NO_VALUE = frozenset("hidden password checkbox radio file color range image".split())
HEAD_ONLY = frozenset("base link meta title style script".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup html legend li main menu nav option search section summary tbody td tfoot th thead tr".split())
SCOPE = frozenset("table td th caption html template".split())
TABLED = frozenset("table tr tbody thead tfoot".split())
# What a start tag closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_STYLE_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


class _Open:
    """The open elements, and where those of each tag are, so that no tag's search goes through all of them."""

    def __init__(self, nodes: list[Node]):
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.reset(nodes)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def reset(self, nodes: list[Node]) -> None:
        self.cut(0)
        for n in nodes:
            self.push(n)

    def last(self, tags) -> int:
        """Place of the innermost open element of some tags, or 0."""
        return max((found[-1] for tag in tags if (found := self.places.get(tag))), default=0)

    def end(self, name: str) -> None:
        """An end tag closes the innermost open element of its name, if no scope lies between; tags of tables pass scopes."""
        at = self.last((name,))
        if at and (name in TABLED or at >= self.last(SCOPE)):
            self.cut(at)

    def close(self, tags, stops) -> None:
        """Close the outermost open element of tags above the nearest stop."""
        floor = self.last(stops)
        above = [found[k] for tag in tags if (found := self.places.get(tag)) and (k := bisect.bisect_right(found, floor)) < len(found)]
        if above:
            self.cut(min(above))


def parse(source: str) -> Node:
    """The tree of a page; its root is html with head and body as the tags imply them."""
    root, body = Node("html", {}), Node("body", {})
    head = Node("head", {})
    root.kids += [head, body]
    open_ = _Open([root, head])
    stack = open_.nodes
    at, size, drawings = 0, len(source), ("svg", "math")

    def in_head() -> bool:
        return len(stack) > 1 and stack[1] is head

    def enter_body() -> None:
        if stack[-1] is root or in_head():
            open_.reset([root, body])

    while at < size:
        m = _TOKEN.match(source, at)
        token, name = m[0], m[1]
        at = m.end()
        if name is None:
            if token.startswith("<") and len(token) > 1:
                continue
            if token.strip() or (len(stack) > 1 and not in_head()):
                enter_body()
                stack[-1].kids.append(html.unescape(token) if "&" in token else token)
            continue
        name = name.lower()
        if token[1] == "/":
            if name == "br":
                enter_body()
                stack[-1].kids.append(Node("br", {}))
            elif name == "head":
                open_.reset([root])
            elif name not in ("html", "body"):
                open_.end(name)
                if len(stack) == 1:
                    open_.push(head)
            continue
        rest = m[2] or ""
        attrs = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTR.finditer(rest)} if rest.strip("/ \t\r\n\f") else {}
        if name in ("html", "head"):
            if name == "head" and stack[-1] is root:
                open_.push(head)
            continue
        if name == "body":
            body.attrs.update(attrs)
            enter_body()
            continue
        if not (name in HEAD_ONLY | {"noscript", "template"} and (stack[-1] is head or stack[-1] is root)):
            enter_body()
        parent = stack[-1]
        if name in CLOSES_P:
            open_.close({"p"}, SCOPE | {"button"})
        if name in CLOSES:
            open_.close(*CLOSES[name])
        parent = stack[-1]
        if name == "tr" and parent.tag == "table" or name in ("td", "th") and parent.tag in ("table", "tbody", "thead", "tfoot"):
            for implied in ("tbody", "tr"):
                if implied != name and not (implied == "tbody" and parent.tag != "table"):
                    made = Node(implied, {})
                    parent.kids.append(made)
                    open_.push(made)
                    parent = made
        node = Node(name, attrs)
        stack[-1].kids.append(node)
        if name in VOID or token.endswith("/>") and (name in ("svg", "math", "path") or open_.last(drawings)):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            text = source[at : end.start() if end else size]
            node.kids.append(html.unescape(text) if name in ("title", "textarea") else text)
            at = (source.find(">", end.end()) + 1 or size) if end else size
            continue
        open_.push(node)
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN:
        return False
    if not a:
        return True
    return not ("hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden") or _STYLE_HIDDEN.search(a.get("style", "")))


def shown(node: Node) -> list:
    """Kids that may show: all, but for a drawing its texts alone, with spaces around them."""
    if node.tag != "svg":
        return node.kids
    out, todo = [], node.kids[::-1]
    while todo:
        k = todo.pop()
        if isinstance(k, str) or k.tag in NOT_DRAWN or not visible(k):
            continue
        if k.tag in ("text", "foreignobject"):
            out += [" ", k, " "]
        else:
            todo += reversed(k.kids)
    return out


def _run(walk: Generator) -> list[str]:
    """What a walk returns; the walks it yields run on a list, so that depth has no limit."""
    open_, got = [walk], None
    while open_:
        try:
            open_.append(open_[-1].send(got))
            got = None
        except StopIteration as e:
            open_.pop()
            got = e.value
    return got


class _Sub:
    """Lines further in: the first one behind a mark, the others as much to the right."""

    __slots__ = ("mark", "lines")

    def __init__(self, mark: str, lines: list):
        self.mark, self.lines = mark, lines


def flat(lines: list) -> list[str]:
    """Lines and those further in, each with all that stands before it; a line is built once, however deep it is."""
    out: list[str] = []
    open_ = [(iter(lines), "", 0)]  # what is left, what stands before its first line, how far in the others are
    while open_:
        rest, first, depth = open_[-1]
        item = next(rest, None)
        if item is None:
            open_.pop()
            continue
        if item != "":
            open_[-1] = (rest, None, depth)
        before = " " * depth if first is None else first
        if isinstance(item, _Sub):
            open_.append((iter(item.lines), before + item.mark, depth + len(item.mark)))
        else:
            out.append(before + item if item else "")
    return out


class _Lines:
    """Lines under construction: runs of inline text, block ends and blank lines."""

    def __init__(self) -> None:
        self.lines: list = []
        self.now: list[str] = []
        self.gap = False

    def text(self, s: str) -> None:
        if s:
            self.now.append(s)

    def end(self) -> None:
        line = _SPACES.sub(" ", "".join(self.now)).strip(" ")
        self.now = []
        if line:
            self.put([line])

    def put(self, lines: list) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines += lines

    def blank(self) -> None:
        self.end()
        self.gap = True


def _render(root: Node) -> Generator:
    """Lines of an element, for ``_run``."""
    out = _Lines()
    todo: list[tuple[str, Node | str]] = [("kids", root)]
    while todo:
        step, node = todo.pop()
        if step == "close":
            out.blank() if node.tag in SPACED else out.end()
            continue
        if step == "node":
            if isinstance(node, str):
                out.text(node)
                continue
            if not visible(node):
                continue
            tag = node.tag
            if tag == "br":
                if any(x.strip(" \t\n\r\f") for x in out.now):
                    out.end()
                continue
            if tag == "img":
                out.text(node.attrs.get("alt", ""))
                continue
            if tag == "input":
                if node.attrs.get("type", "text").lower() not in NO_VALUE:
                    out.text(node.attrs.get("value", ""))
                continue
            if tag in ("hr", "wbr"):
                if tag == "hr":
                    out.blank()
                continue
            if tag in ("ul", "ol", "menu", "dir", "table", "pre", "blockquote", "dd"):
                out.blank() if tag in SPACED else out.end()
                lines = _pre(node) if tag == "pre" else (yield _table(node) if tag == "table" else _indented(node, "  ") if tag in ("blockquote", "dd") else _list(node))
                if lines:
                    out.put(lines)
                out.gap = out.gap or (bool(lines) and tag in SPACED)
                continue
            if tag in BLOCK:
                out.blank() if tag in SPACED else out.end()
                todo.append(("close", node))
        todo += [("node", k) for k in reversed(shown(node))]
    out.end()
    return out.lines


def _indented(node: Node, by: str) -> Generator:
    lines = yield _render(node)
    return [_Sub(by, lines)] if lines else []


def _pre(node: Node) -> list[str]:
    parts: list[str] = []
    todo: list = [node]
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            parts.append(k)
        elif k is node or visible(k):
            parts.append("\n" if k.tag == "br" else k.attrs.get("alt", "") if k.tag == "img" else k.attrs.get("value", "") if k.tag == "input" and k.attrs.get("type", "text").lower() not in NO_VALUE else "")
            todo += reversed(shown(k))
    lines = [x.rstrip() for x in "".join(parts).expandtabs(8).replace("\r\n", "\n").split("\n")]
    while lines and not lines[0]:
        lines.pop(0)
    while lines and not lines[-1]:
        lines.pop()
    return lines


def _list(node: Node) -> Generator:
    out: list = []
    back = node.tag == "ol" and "reversed" in node.attrs
    start, step = node.attrs.get("start", ""), -1 if back else 1
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else sum(isinstance(k, Node) and k.tag == "li" for k in node.kids) if back else 1
    loose = Node("li", {})
    for kid in [*node.kids, None]:
        if isinstance(kid, Node) and kid.tag == "li":
            if visible(kid):
                value = kid.attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else number
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += step
                lines = yield _render(kid)
                if lines:
                    out.append(_Sub(mark, lines))
        elif kid is not None and (isinstance(kid, Node) or kid.strip()):
            loose.kids = [kid]
            out += yield _indented(loose, "  ")
    return out


def _table(node: Node) -> Generator:
    """Caption, then rows with cells padded to the width of their column; a cell of many lines takes many lines."""
    rows: list[list[list[str]]] = []
    before: list = []
    below: dict[int, int] = {}  # columns that cells of earlier rows reach into, and for how many rows
    todo: list = [node]
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            if k.strip():
                before.append(_SPACES.sub(" ", k).strip())
        elif k is not node and not visible(k):
            continue
        elif k.tag == "tr":
            cells: list[list[str]] = []
            reach: dict[int, int] = {}
            for c in k.kids:
                while below.get(len(cells), 0):
                    cells.append([])
                if isinstance(c, str):
                    if c.strip():
                        cells.append([_SPACES.sub(" ", c).strip()])
                elif visible(c):
                    lines = flat((yield _render(c if c.tag in ("td", "th") else _wrap(c))))
                    across, down = _span(c, "colspan", 1000), _span(c, "rowspan", 65534)
                    if down > 1:
                        reach.update(dict.fromkeys(range(len(cells), len(cells) + across), down - 1))
                    cells += [lines] + [[]] * (across - 1)
            below = {x: n - 1 for x, n in below.items() if n > 1} | reach
            if any(cells):
                rows.append(cells)
        elif k is node or k.tag in ("tbody", "thead", "tfoot"):
            todo += reversed(k.kids)
        elif k.tag not in ("col", "colgroup"):
            before += yield _render(_wrap(k))
    n = max((len(r) for r in rows), default=0)
    width = [0] * n
    for r in rows:
        for k, c in enumerate(r):
            width[k] = max(width[k], max(map(len, c), default=0))
    lines = list(before)
    for r in rows:
        for i in range(max(len(c) for c in r)):
            lines.append(" | ".join((c[i] if i < len(c) else "").ljust(width[k]) for k, c in enumerate(r)).rstrip())
    return lines


def _span(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell takes, as the standard reads and bounds it."""
    m = re.match(r"[ \t\n\r\f]*([0-9]{1,9})", cell.attrs.get(name, ""))
    return min(max(int(m[1]), 1), most) if m else 1


def _wrap(kid: Node) -> Node:
    made = Node("div", {})
    made.kids.append(kid)
    return made


def render(source: str) -> str:
    """Visible text of a page."""
    root = parse(source)
    body = root.kids[1]
    return "\n".join(flat(_run(_render(body)))) if visible(body) else ""


def extract(pages: DataFrame, page_id: str = "page_id", source: str = "html") -> DataFrame:
    """page_id, n_chars, text: one row per page, nothing shuffled.

    Null and empty pages give empty text; ill-formed UTF-8 is read as U+FFFD; markup may be nested to any depth. Repeated
    and null ids stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [render(body.as_py().decode("utf-8", "replace")) for body in b.column("body")]
            yield pa.RecordBatch.from_pydict({"page_id": b.column("id"), "n_chars": [len(t) for t in texts], "text": texts})

    return pages.select(F.col(page_id).cast("long").alias("id"), text_bytes(source).alias("body")).mapInArrow(lean(run), "page_id long, n_chars long, text string")
