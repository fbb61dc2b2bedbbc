"""Layout-aware text of web pages.

A tree builder reads tags, closes what HTML allows to be left open, and tells the
renderer when an element opens and closes. The renderer keeps what a reader would
see: it skips elements that are not displayed, collapses white space outside
preformatted text, separates blocks by line breaks and paragraphs by blank lines,
marks and indents list items, and lays table cells out in aligned columns. Both work
on explicit stacks, so depth is bounded by memory only.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import map_rows, texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    # a quote opens a value only after the = of a name, elsewhere it is an ordinary character
    r"|<([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?)*+)>?|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"'][^\s>]*+))?)?")
HIDING = re.compile(r"(?i)(?:^|;)\s*(display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)")
SHOWING = re.compile(r"(?i)(?:^|;)\s*visibility\s*:\s*visible\s*(?:;|$)")
VISIBILITY = re.compile(r"(?i)(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)([^;]*)")
#: Of media queries only these hold on every screen.
ALWAYS = re.compile(r"(?i)\s*@(?:media\s*(?:(?:only\s+)?(?:all|screen))?|layer\b[^,]*)\s*\Z")
CSS_PART = re.compile(r"""((?:[^{};"']|"(?:[^"\\\n]|\\.)*+"?|'(?:[^'\\\n]|\\.)*+'?)*+)([{};]|\Z)""", re.S)
SIMPLE = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9]*|[.#][\w-]+)\Z")
SPACE = re.compile(r"[ \t\n\r\f]+")

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
NOT_SHOWN = frozenset(
    "area audio base canvas datalist embed head iframe link meta noembed noframes noscript object param rp script "
    "source style template title track video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre "
    "search section summary table caption tbody thead tfoot tr td th ul xmp".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
CLOSES_P = BLOCKS - frozenset("body html caption tbody thead tfoot tr td th option optgroup legend".split())
#: In drawings and formulas these hold what is not shown in place.
NOT_DRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
#: Opening the key closes the open elements named, up to the nearest of the limits.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
#: End tags do not reach through these.
WALLS = frozenset("table td th caption html body template".split())
P_WALLS = WALLS | {"button", "object"}


@dataclass
class Element:
    name: str
    attrs: dict[str, str]
    shown: bool = True
    seen: bool = True
    pre: bool = False
    context: Context | None = None
    count: int = 0
    step: int = 1
    foreign: str = ""


@dataclass
class Context:
    """Lines being written: of the page, or of one table cell."""

    lines: list[str] = field(default_factory=list)
    line: list[str] = field(default_factory=list)
    gap: int = 0  # blank lines owed before the next text
    indent: int = 0
    marker: str = ""
    space: bool = False  # a collapsed blank is owed
    rows: list[list[tuple[list[str], int, int]]] = field(default_factory=list)  # of the table it belongs to

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._put(first)
            for more in rest:
                self.end_line(force=True)
                self._put(more)
            return
        if not data:
            return
        body = SPACE.sub(" ", data)
        if body[0] == " ":
            self.space = True
            body = body[1:]
        tail = body.endswith(" ")
        if body:
            self._put((" " if self.space and self.line and not self.line[-1].endswith(" ") else "") + (body[:-1] if tail else body))
            self.space = tail

    def _put(self, data: str) -> None:
        if not data:
            return
        if not self.line:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            left = " " * self.indent
            if self.marker:
                left = " " * max(0, self.indent - len(self.marker)) + self.marker
                self.marker = ""
            self.line.append(left)
        self.line.append(data)

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).replace("\xa0", " ").rstrip())
            self.line = []
        elif force and self.lines and not self.gap:
            self.lines.append("")
        self.space = False

    def block(self, blank: bool) -> None:
        self.end_line()
        if blank:
            self.gap = 1

    def paste(self, lines: list[str]) -> None:
        for line in lines:
            self._put(line) if line else self.lines.append("")
            self.end_line()

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def rules(css: str, so_far: dict[tuple[str, str], tuple[bool, bool]] | None = None) -> set[str]:
    """Simple selectors (a tag, a class, an id) that a style sheet does not display.

    A later rule for a selector replaces an earlier one unless only that is important;
    ``so_far`` keeps both over several sheets. Rules under a condition (print, widths,
    features) do not count.
    """
    last = {} if so_far is None else so_far
    css = re.sub(r"/\*.*?(\*/|\Z)|<!--|-->", "", css, flags=re.S)
    blocks: list[tuple[str, bool]] = []  # open ones: selectors (empty for at-rules) and whether they count
    body = ""

    def declared() -> None:
        selectors, counts = blocks[-1]
        if not counts:
            return
        for kind, value, rest in VISIBILITY.findall(body):
            hides = value.lower() == "none" if kind.lower() == "display" else value.lower() in ("hidden", "collapse")
            important = "!important" in rest.replace(" ", "").lower()
            for one in filter(SIMPLE.match, map(str.strip, selectors.split(","))):
                at = (one, kind.lower())
                if important or not last.get(at, (False, False))[1]:
                    last[at] = hides, important

    pos = 0
    while pos < len(css):
        m = CSS_PART.match(css, pos)
        pos = max(m.end(), pos + 1)
        if m[2] == "{":
            head = m[1].strip()
            within = not blocks or blocks[-1][1] and not blocks[-1][0]
            blocks.append(("", within and bool(ALWAYS.match(head))) if head.startswith("@") else (head, within))
            body = ""
        elif blocks:
            body += m[1] + ";"
            if m[2] != ";":  # a block that is left open ends with the sheet
                declared()
                blocks.pop()
                body = ""
    return {one for (one, _), (hides, _) in last.items() if hides}


class Renderer:
    def __init__(self) -> None:
        self.page = Context()
        self.open: list[Element] = []
        #: Where the open elements of each name stand in ``open``.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.contexts = [self.page]
        self.hidden: set[str] = set()
        self.sheets: dict[tuple[str, str], tuple[bool, bool]] = {}

    # what is open -----------------------------------------------------------
    def _hides(self, name: str, attrs: dict[str, str]) -> bool:
        if name in NOT_SHOWN or "hidden" in attrs and attrs["hidden"].lower() != "until-found":
            return True
        if name == "input" or name == "dialog" and "open" not in attrs:
            return True
        style = HIDING.search(attrs.get("style", ""))
        if style and style.group(1).lower().startswith("display"):
            return True
        if self.hidden:
            names = {name, "#" + attrs.get("id", ""), *("." + c for c in attrs.get("class", "").split())}
            return not names.isdisjoint(self.hidden)
        return False

    def start(self, name: str, attrs: dict[str, str]) -> Element:
        above = self.open[-1] if self.open else None
        e = Element(name, attrs)
        if above is not None:
            e.shown, e.seen, e.pre = above.shown, above.seen, above.pre
            # closed details show their summary only; a select its chosen option
            if above.name == "details" and "open" not in above.attrs and name != "summary":
                e.shown = False
        e.shown = e.shown and not self._hides(name, attrs)
        if above is not None:
            e.foreign = "" if name == "foreignobject" else above.foreign
        if name in ("svg", "math"):
            e.foreign = name
        elif e.foreign and name in NOT_DRAWN:
            e.shown = False
        elif name == "text" and e.foreign == "svg":
            e.foreign = "svg text"
            if e.shown:
                self.contexts[-1].text(" ", False)
        style = attrs.get("style", "")
        if HIDING.search(style):
            e.seen = False
        elif SHOWING.search(style):
            e.seen = True
        e.pre = e.pre or name in ("pre", "textarea", "listing", "xmp", "plaintext") or "white-space:pre" in style.replace(" ", "")
        self.places[name].append(len(self.open))
        self.open.append(e)
        if e.shown:
            self._begin(e)
        return e

    def nearest(self, names: Iterable[str]) -> int:
        """The innermost open element of these names, or -1; no walk over what is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def _begin(self, e: Element) -> None:
        top, name = self.contexts[-1], e.name
        if name == "br":
            top.end_line(force=True)
        if name not in BLOCKS:
            return
        lists = sum(x.name in ("ul", "ol", "menu", "dir") for x in self.open[-64:])
        top.block(name in SPACED and not (name in ("ul", "ol", "menu") and lists > 1))
        if name in ("ul", "ol", "menu", "dir"):
            e.step = -1 if "reversed" in e.attrs else 1
            first = e.attrs.get("start", "")
            e.count = (int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1) - e.step
        elif name == "li":
            at = self.nearest(("ul", "ol", "menu", "dir"))
            owner = self.open[at] if at >= 0 else None
            marker = "- "
            if owner is not None and owner.name == "ol":
                value = e.attrs.get("value", "")
                owner.count = int(value) if re.fullmatch(r"-?\d{1,9}", value) else owner.count + owner.step
                marker = f"{owner.count}. "
            e.count = len(marker)
            top.indent += len(marker)
            top.marker = marker if e.seen else ""
        elif name in ("blockquote", "dd"):
            top.indent += 2
        elif name == "table":
            e.context = Context()
            self.contexts.append(e.context)
        elif name == "tr":
            table = self._table()
            if table is not None:
                table.rows.append([])
        elif name in ("td", "th"):
            if self._table() is not None:
                e.context = Context()
                self.contexts.append(e.context)

    def _table(self) -> Context | None:
        """The context of the nearest table, if no cell of it is open."""
        for x in reversed(self.open[:-1]):
            if x.name == "table" and x.context is not None:
                return x.context
            if x.name in ("td", "th"):
                return None
        return None

    def end(self) -> None:
        e = self.open.pop()
        self.places[e.name].pop()
        if not e.shown:
            return
        if e.name in ("table", "td", "th") and e.context is not None:
            while self.contexts.pop() is not e.context:
                pass
            if e.name == "table":
                lines = e.context.done()
                self.contexts[-1].paste(lines + aligned(e.context.rows))
            else:
                owner = next(x.context for x in reversed(self.open) if x.name == "table" and x.context is not None)
                if not owner.rows:
                    owner.rows.append([])
                across, down = (int(v) if re.fullmatch(r"\d{1,4}", v := e.attrs.get(a, "")) and int(v) else 1 for a in ("colspan", "rowspan"))
                owner.rows[-1].append((e.context.done(), across, down))
                return
        top = self.contexts[-1]
        if e.name in BLOCKS:
            lists = sum(x.name in ("ul", "ol", "menu", "dir") for x in self.open[-64:])
            top.block(e.name in SPACED and not (e.name in ("ul", "ol", "menu") and lists))
        if e.name == "li":
            top.indent -= e.count
            top.marker = ""
        elif e.name in ("blockquote", "dd"):
            top.indent -= 2

    def text(self, data: str) -> None:
        above = self.open[-1] if self.open else None
        if above is not None and above.foreign == "svg":  # a drawing shows its text elements only
            return
        if above is None or above.shown and above.seen and not (above.name == "details" and "open" not in above.attrs):
            self.contexts[-1].text(data, above is not None and above.pre)


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Cells of a table in columns, two blanks apart; spanning cells take the columns they span."""
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # column -> rows still covered from above
    for row in rows:
        placed, column, below = [], 0, {}
        for lines, across, down in row:
            while taken.get(column, 0):
                column += 1
            placed.append((column, across, lines))
            if down > 1:
                below |= {c: down - 1 for c in range(column, column + across)}
            column += across
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | below
        grid.append(placed)
    widths: dict[int, int] = {}
    for placed in grid:
        for column, across, lines in placed:
            if across == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    for placed in grid:  # what spans several columns widens the last of them
        for column, across, lines in placed:
            if across > 1:
                have = sum(widths.get(c, 0) for c in range(column, column + across)) + 2 * (across - 1)
                need = max(map(len, lines), default=0) - have
                if need > 0:
                    widths[column + across - 1] = widths.get(column + across - 1, 0) + need
    used = sorted(widths)
    left, at = {}, 0
    for c in used:
        left[c] = at
        at += widths[c] + 2 * (widths[c] > 0)
    out = []
    for placed in grid:
        for i in range(max((len(lines) for *_, lines in placed), default=0)):
            line = ""
            for column, _, lines in placed:
                if i < len(lines) and lines[i]:
                    line = line.ljust(left.get(column, 0)) + lines[i]
            out.append(line)
    return out


def visible_text(html: str) -> str:
    """All text a reader sees, laid out in lines."""
    view, pos = Renderer(), 0
    end = len(html)
    while pos < end:
        m = TOKEN.match(html, pos)
        pos = m.end()
        closing, opening = m.group(1), m.group(2)
        if opening:
            name = opening.lower()
            found = m.group(3)
            attrs = {}
            for a in ATTRIBUTE.finditer(found):
                attrs.setdefault(a[1].lower(), unescape(next((v for v in a.groups()[1:] if v is not None), "")))
            _open(view, name, attrs)
            if name in VOID or found.endswith("/") and view.open and view.open[-1].foreign:
                view.end()
            elif name in RAW:
                stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, pos) if name != "plaintext" else None
                body = html[pos : stop.start() if stop else end]
                if name == "style":
                    if ALWAYS.match("@media " + attrs.get("media", "")):
                        view.hidden = rules(body, view.sheets)
                elif name in ("textarea", "title"):
                    view.text(unescape(body))
                elif name in ("xmp", "plaintext"):
                    view.text(body)
                pos = html.find(">", stop.end()) + 1 if stop else end
                pos = pos or end
                view.end()
        elif closing:
            _close(view, closing.lower())
        elif not (m.group().startswith(("<!", "<?"))):
            _text(view, m.group() if "&" not in m.group() else unescape(m.group()))
    while view.open:
        view.end()
    return "\n".join(view.page.done())


def _pop_until(view: Renderer, index: int) -> None:
    while len(view.open) > index:
        view.end()


def _open(view: Renderer, name: str, attrs: dict[str, str]) -> None:
    stack = view.open
    if name in ("html", "body") and view.places.get(name):
        return
    if stack and stack[-1].name == "head" and name not in NOT_SHOWN:
        view.end()  # head ends where the page begins
    if name in CLOSES_P:
        paragraph = view.nearest(("p",))
        if paragraph > view.nearest(P_WALLS):
            _pop_until(view, paragraph)
    if name in IMPLIED:
        closes, limits = IMPLIED[name]
        if name not in ("li", "dt", "dd"):
            limits = limits | {"table"}
        while (at := view.nearest(closes)) > view.nearest(limits):
            _pop_until(view, at)
            if name in ("li", "dt", "dd", "td", "th", "option"):
                break
    if len(name) == 2 and name[0] == "h" and name[1] in "123456" and stack and stack[-1].name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        view.end()
    view.start(name, attrs)


def _close(view: Renderer, name: str) -> None:
    if name == "br":  # </br> is a line break
        view.start("br", {})
        view.end()
        return
    if name in ("html", "body"):
        return
    at = view.nearest((name,))
    if at >= 0 and (name in ("table", "tr", "tbody", "thead", "tfoot") or at >= view.nearest(WALLS)):
        _pop_until(view, at)


def _text(view: Renderer, data: str) -> None:
    stack = view.open
    if stack and stack[-1].name in ("table", "tbody", "thead", "tfoot", "tr", "colgroup") and not data.strip():
        return
    if stack and stack[-1].name == "head" and data.strip():
        view.end()
    view.text(data)


def page_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text) of every row.

    A null or empty page has the empty text. Pages are read by themselves, repeated
    rows too; other columns are not read, an empty table gives no rows.
    """
    base = texts(pages, key, html).withColumn("doc_id", F.col("doc_id").cast("long"))

    def rows(ids: list, bodies: list) -> Iterator[tuple]:
        for page, body in zip(ids, bodies):
            yield page, visible_text(body)

    return map_rows(base, rows, "page_id long, text string", ["page_id", "text"], [pa.int64(), pa.string()])
