"""HTML extraction by layout: a tree with implied tags, visibility rules, and a rendering that keeps blocks, lists and tables."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.texts import as_text

# Fixed values of the HTML standard: element classes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object embed canvas audio video svg annotation annotation-xml datalist noembed noframes rp".split())
# Blocks with a blank line around them, and those that only start on a line of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure form fieldset hr article section".split())
BLOCK = SPACED | frozenset(
    "html body div main nav aside header footer address li dt dd tr td th caption thead tbody tfoot center details summary dialog figcaption legend option optgroup select hgroup menu search xmp".split()
)
# A start tag closes these open elements, looked for up to one of the boundaries.
P_CLOSERS = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul xmp".split()
)
IMPLIED_END = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"), "rt": ("rt", "rp"), "rp": ("rt", "rp"),
    "thead": ("tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"),
    "tbody": ("tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"),
    "tfoot": ("tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"),
    "body": ("head",),
}
BOUNDARY = {
    "li": frozenset("ul ol menu table td th body html".split()), "dt": frozenset("dl table body html".split()), "dd": frozenset("dl table body html".split()),
    "p": frozenset("td th table button body html li dd blockquote div section article".split()),
}
TABLE_SCOPE = frozenset(["table", "html"])

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)[^;!]*(!\s*important)?", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_COMPOUND = re.compile(r"(?:[a-z][\w-]*)?(?:[.#][\w-]+)*", re.I)
_CSS_STEP = re.compile(r"""[^{};"']+|"(?:\\.|[^"\\])*(?:"|\Z)|'(?:\\.|[^'\\])*(?:'|\Z)|[{};]""", re.S)
_FEATURE = re.compile(r"\(\s*(min-|max-)(width|height)\s*:\s*([\d.]+)(px|em|rem)\s*\)")
# The screen that pages are laid out for, in CSS pixels.
SCREEN = {"width": 1280, "height": 800}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self) -> dict[str, str]:
        if not isinstance(self.attributes, dict):
            found = {}
            for m in _ATTRIBUTE.finditer(self.attributes):
                value = next((v for v in m.groups()[1:] if v is not None), "")
                found.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
            self.attributes = found
        return self.attributes


def for_screen(media: str) -> bool | None:
    """Whether a media query list holds on SCREEN; None where that depends on what isn't known here."""
    found = []
    for query in media.lower().split(","):
        query = query.strip()
        negated = query.startswith("not ")
        parts = [x.strip() for x in re.split(r"\sand\s|\band\b(?=\s*\()", re.sub(r"^(?:not|only)\s+", "", query))]
        truth: bool | None = True
        for part in parts:
            if m := _FEATURE.fullmatch(part):
                try:
                    size = float(m[3]) * (1 if m[4] == "px" else 16)
                    own = SCREEN[m[2]] >= size if m[1] == "min-" else SCREEN[m[2]] <= size
                except ValueError:
                    own = None
            else:
                own = True if part in ("", "all", "screen") else None if "(" in part else False
            truth = False if own is False or truth is False else None if own is None else truth
        found.append(truth if truth is None else truth != negated)
    return True if True in found else None if None in found else False


class Styles:
    """Which elements the style sheets of a page hide: of the display declarations that fit one, the strongest and last counts.

    Selectors are tags, classes, ids and compounds of these. Of others, as of rules whose condition isn't known, only those
    that show an element count, by the last compound, so that nothing visible is dropped; states such as :hover don't count.
    """

    def __init__(self):
        self.rules: dict[str, list[tuple]] = {}
        self.count = 0

    def add(self, css: str, media: str = "") -> None:
        css = re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)
        held: list[bool | None] = [for_screen(media)]
        prelude: list[str] = []
        rule: str | None = None
        skipped = 0
        for m in _CSS_STEP.finditer(css):
            piece = m[0]
            if skipped:
                skipped += (piece == "{") - (piece == "}")
                if not skipped:
                    prelude = []
            elif piece == "{":
                head = "".join(prelude).strip()
                prelude = []
                if rule is not None:
                    # A rule inside a rule: what comes before it in the last declaration's place is its selector.
                    skipped = 1
                elif head.startswith("@"):
                    name, _, rest = head[1:].partition(" ") if "(" not in head.split(" ")[0] else (*head[1:].partition("("),)
                    name = name.lower()
                    if name in ("media", "supports", "layer", "container", "scope"):
                        own = for_screen(rest if head[1 + len(name)] != "(" else "(" + rest) if name == "media" else True if name == "layer" else None
                        held.append(False if False in (own, held[-1]) else None if None in (own, held[-1]) else True)
                    else:
                        skipped = 1
                else:
                    rule = head
            elif piece == "}":
                if rule is not None:
                    self.rule(rule, "".join(prelude), held[-1])
                    rule = None
                elif len(held) > 1:
                    held.pop()
                prelude = []
            elif piece == ";" and rule is None:
                prelude = []
            else:
                prelude.append(piece)
        if rule is not None and not skipped:
            self.rule(rule, "".join(prelude), held[-1])

    def rule(self, selectors: str, body: str, held: bool | None) -> None:
        shown = display_of(body)
        if shown is None or held is False:
            return
        hides, important = shown
        for selector in selectors.split(","):
            plain = re.sub(r"\[[^\]]*\]", "", selector).strip()
            last = re.split(r"[\s>+~]+", plain)[-1]
            if not last or ":" in selector or not _COMPOUND.fullmatch(last) or (hides and (held is None or last != selector.strip())):
                continue
            parts = re.findall(r"[.#]?[\w-]+", last)
            parts = [x if x[0] in ".#" else x.lower() for x in parts]
            ids, classes = sum(x.count("#") for x in re.findall(r"#[\w-]+", selector)), len(re.findall(r"\.[\w-]+|\[", selector))
            tags = len(re.findall(r"(?:^|[\s>+~])[a-zA-Z]", selector.strip()))
            self.count += 1
            self.rules.setdefault(parts[-1], []).append((frozenset(parts), (important, ids, classes, tags, self.count), hides))

    def of(self, node: Node) -> tuple[bool, bool] | None:
        """(hides, important) of the declaration that counts for a node."""
        names = {node.tag}
        if node.attributes:
            given = node.get()
            names.update("." + c for c in given.get("class", "").split())
            names.add("#" + given.get("id", ""))
        fit = [(rank, hides) for name in names for needed, rank, hides in self.rules.get(name, ()) if needed <= names]
        if not fit:
            return None
        rank, hides = max(fit)
        return hides, rank[0]


def display_of(body: str) -> tuple[bool, bool] | None:
    """(display is none, important) of the declaration that counts in a block, if there is one."""
    found = [(bool(m[2]), i, m[1].lower() == "none") for i, m in enumerate(_DISPLAY.finditer(body))]
    if not found:
        return None
    important, _, hides = max(found)
    return hides, important


def build_tree(source: str) -> tuple[Node, Styles]:
    """The tree of a page, and what its style sheets hide on a screen."""
    root = Node("html")
    stack, styles = [root], Styles()
    opened: Counter = Counter()
    at, end, lenient = 0, len(source), False

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    def close(names: tuple[str, ...], boundary: frozenset) -> None:
        """Pop up to and with the outermost open element of these names inside the boundary."""
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in names:
                if i == 1 or stack[i - 1].tag not in names:
                    pop_to(i)
                    return
            elif tag in boundary:
                return

    while at < end:
        m = _TOKEN.match(source, at)
        name = m[2]
        if name is None:
            text = m[0]
            at = m.end()
            if text[0] != "<":
                stack[-1].children.append(html.unescape(text) if "&" in text else text)
            elif text == "<":
                if at < end and (source[at].isalpha() or source[at] == "/"):
                    # A tag whose quotes never close: it ends at the next bracket, as do all later ones of that sort.
                    stop = source.find(">", at)
                    broken = re.match(r"(/?)([A-Za-z][^\s/>\"']*)", source[at : at + 64])
                    at = end if stop < 0 else stop + 1
                    lenient = True
                    if not broken or stop < 0:
                        continue
                    closing, name, attributes = broken[1], broken[2], ""
                else:
                    stack[-1].children.append("<")
            if name is None:
                continue
        else:
            closing, attributes, at = m[1], m[3], m.end()
        if lenient and (stop := source.find("<", m.start() + 1, at)) >= 0 and m[2]:
            at = stop
        tag = name.lower()
        if closing:
            if tag == "br":
                stack[-1].children.append(Node("br"))
                continue
            scope = frozenset() if tag in ("table", "body", "html") else TABLE_SCOPE
            for i in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in scope:
                    break
            continue
        if tag in ("html", "body") and (tag == "html" or opened[tag]):
            continue
        if tag in P_CLOSERS:
            close(("p",), BOUNDARY["p"])
        if tag in IMPLIED_END:
            close(IMPLIED_END[tag], BOUNDARY.get(tag, TABLE_SCOPE))
        if stack[-1].tag == "head" and tag not in ("title", "meta", "link", "script", "style", "base", "noscript", "template"):
            pop_to(len(stack) - 1)
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            inner = source[at : stop.start() if stop else end]
            if tag == "style":
                if not opened["noscript"] and not opened["template"]:
                    styles.add(inner, node.get().get("media", "") if attributes else "")
            elif tag in ("textarea", "title"):
                node.children.append(html.unescape(inner))
            elif tag == "xmp":
                node.children.append(inner)
            close_at = source.find(">", stop.start()) if stop else -1
            at = end if close_at < 0 else close_at + 1
        elif tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "math", "path")):
            stack.append(node)
            opened[tag] += 1
    return root, styles


def is_hidden(node: Node, styles: Styles, parent: Node | None) -> bool:
    """Not shown: elements without visible content, the hidden attribute, no display by style, closed details and dialogs."""
    if node.tag in HIDDEN:
        return True
    if parent is not None and parent.tag == "details" and node.tag != "summary" and "open" not in parent.get():
        return True
    if node.tag == "dialog" and "open" not in node.get():
        return True
    sheet = styles.of(node) if styles.rules else None
    if not node.attributes:
        return sheet is not None and sheet[0]
    given = node.get()
    if node.tag == "input" and given.get("type", "").lower() == "hidden":
        return True
    inline = display_of(given["style"]) if "style" in given else None
    if inline is not None and (sheet is None or inline[1] or not sheet[1]):
        return inline[0]
    return sheet[0] if sheet is not None else "hidden" in given


class Page:
    """Lines of text under way: blanks collapse, blocks break lines, and blank lines stand between spaced blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank_owed = self.space_owed = False
        self.prefix: list[str] = []
        self.marker: str | None = None

    def text(self, value: str) -> None:
        value = _BLANKS.sub(" ", value)
        if value == " ":
            self.space_owed = bool(self.line)
            return
        if value[0] == " " or self.space_owed:
            value = (" " if self.line else "") + value.lstrip(" ")
        self.space_owed = value[-1] == " "
        self.line.append(value.rstrip(" ") if self.space_owed else value)

    def exact(self, value: str) -> None:
        *whole, rest = value.replace("\r\n", "\n").split("\n")
        for line in whole:
            self.line.append(line)
            self.end_line(True)
        if rest:
            self.line.append(rest)

    def end_line(self, even_empty: bool = False) -> None:
        content = "".join(self.line)
        self.line, self.space_owed = [], False
        if not content and not even_empty:
            return
        if self.blank_owed and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank_owed = False
        lead = "".join(self.prefix)
        if self.marker is not None and self.prefix:
            lead, self.marker = "".join(self.prefix[:-1]) + self.marker, None
        self.lines.append((lead + content).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.blank_owed |= spaced

    def result(self) -> str:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def align(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Table rows as lines: columns as wide as their widest one-line cell, two blanks between; cells of more lines keep them."""
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for cell, span in row:
            if span == 1:
                widths[column] = max(widths.get(column, 0), *(len(x) for x in cell.split("\n")))
            column += span
    lines = []
    for row in rows:
        columns, column = [], 0
        for cell, span in row:
            width = sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
            columns.append((cell.split("\n"), width))
            column += span
        for i in range(max((len(c) for c, _ in columns), default=0)):
            line = "  ".join((c[i] if i < len(c) else "").ljust(w) for c, w in columns).rstrip()
            if line:
                lines.append(line)
    return lines


def render(source: str | None) -> dict:
    """All visible text of a page, and counts of blocks, list items and table rows that show text."""
    root, styles = build_tree(source or "")
    page = Page()
    counts = {"n_items": 0, "n_rows": 0}
    lists: list[list] = []
    tables: list[list] = []
    # (node, parent, leaving, inherited visibility, inside pre)
    work: list[tuple] = [(root, None, False, True, False)]
    while work:
        node, parent, leaving, shown, pre = work.pop()
        if isinstance(node, str):
            if shown and node and not (parent.tag == "details" and "open" not in parent.get()):
                (page.exact if pre else page.text)(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and tables and tables[-1]["cell"]:
                inner, page = page.result(), tables[-1]["cell"].pop()
                span = node.get().get("colspan", "1") if node.attributes else "1"
                tables[-1]["rows"][-1].append((inner, min(max(1, int(span)), 1000) if span.isdecimal() and len(span) < 5 else 1))
            elif tag == "table" and tables:
                made = tables.pop()
                rows = [r for r in made["rows"] if any(c for c, _ in r)]
                counts["n_rows"] += len(rows)
                page.block(True)
                for line in align(rows):
                    page.line.append(line)
                    page.end_line()
                page.block(True)
            elif tag in ("ul", "ol", "menu"):
                lists.pop()
                page.block(not lists)
            elif tag in ("li", "dd", "blockquote"):
                page.end_line()
                page.prefix.pop()
                page.marker = None
                page.block(tag == "blockquote")
            elif tag in BLOCK:
                page.block(tag in SPACED)
            continue
        if is_hidden(node, styles, parent):
            continue
        if node.attributes and (v := _VISIBILITY.search(node.get().get("style", ""))):
            shown = v[1].lower() == "visible"
        if tag == "br":
            page.end_line(True)
            continue
        if tag == "hr":
            page.block(True)
            continue
        if tag == "input":
            given = node.get()
            if shown and given.get("type", "").lower() in ("submit", "button", "reset") and given.get("value"):
                page.text(given["value"])
            continue
        if tag in VOID:
            continue
        pre = pre or tag in ("pre", "textarea", "xmp")
        work.append((node, parent, True, shown, pre))
        if tag == "table":
            page.block(True)
            tables.append({"rows": [[]], "cell": []})
        elif tag == "tr" and tables:
            tables[-1]["rows"].append([])
        elif tag in ("td", "th"):
            if tables:
                tables[-1]["cell"].append(page)
                page = Page()
            else:
                page.block(False)
        elif tag in ("ul", "ol", "menu"):
            page.block(not lists)
            start = node.get().get("start", "1") if node.attributes else "1"
            lists.append([tag, int(start) if start.isdecimal() and len(start) < 10 else 1])
        elif tag == "li":
            page.end_line()
            marker = "- "
            if lists and lists[-1][0] == "ol":
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            page.prefix.append(" " * len(marker))
            page.marker = marker
            counts["n_items"] += 1
        elif tag in ("dd", "blockquote"):
            page.block(tag == "blockquote")
            page.prefix.append("  ")
        elif tag in BLOCK:
            page.block(tag in SPACED)
        for child in reversed(node.children):
            work.append((child, node, False, shown, pre))
    text = page.result()
    return {"text": text, "n_blocks": sum(1 for b in text.split("\n\n") if b.strip()), **counts}


def extract_text(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """Rendered text of each page: key, text, n_blocks (parts between blank lines), n_items, n_rows.

    Null and empty pages give an empty text. Markup that never closes, nesting of any depth and unknown elements are
    rendered as far as they go; nothing visible is dropped. Rows are kept one for one, repeated keys too; other columns
    are left out. A task holds a few pages at a time.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["text", "n_blocks", "n_items", "n_rows"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_text(batch.column(1))
            for lo in range(0, len(texts), 128):
                made = [render(t) for t in texts.slice(lo, 128).to_pylist()]
                columns = [pa.array([m[n] for m in made], pa.string() if n == "text" else pa.int64()) for n in names]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 128), *columns], names=["key", *names])

    made = rows.mapInArrow(work, f"key {kind}, text string, n_blocks bigint, n_items bigint, n_rows bigint")
    return made.withColumnRenamed("key", key)
