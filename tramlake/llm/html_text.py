"""Visible text of web pages, laid out.

A page is parsed into a tree (implied end tags, void elements, raw-text elements, scope limits of tables and lists) and rendered by
walking it: what the head holds, scripts, templates, hidden and undisplayed elements, and closed details and dialogs give nothing;
everything else gives its text, formulas and the labels of drawings too. Elements of these are named math/... and svg/... in the
tree; each label is a line, and each row of a formula's table. Blocks begin new lines, paragraphs, headings, lists and tables stand apart by an empty line, items get
their bullets or numbers and are indented by level up to INDENT, preformatted text keeps its white space, and table cells are padded to
columns, spans included. A cell of more than WIDE characters does not widen its column: it runs on, and the next cell of its row
follows it. A page's padding is PADDING times its html at most: tables that would need more have their cells apart by two spaces.

Defined cases: null and empty pages give empty text; text without tags is collapsed text; an unterminated tag at the end is left out;
a quote that nothing closes opens no string;
elements nested more than DEPTH deep become children of the deepest one, as browsers have it; spans end with their table, and columns
beyond COLUMNS are not aligned. So a page's time, memory and text are in proportion to its html (times DEPTH or COLUMNS at most, and
its text no more than ten times it). No page raises; columns other than the id and the html are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DEPTH = 512
#: Columns of a table that are aligned, and that a cell spans at most; characters to which a cell widens its column, and an item is indented.
COLUMNS, WIDE, INDENT = 1000, 40, 24
#: Spaces that tables of a page are padded with, times the length of its html.
PADDING = 4

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD = frozenset("base link meta noscript script style template title".split())
UNSEEN = frozenset(
    "head script style template title noscript iframe noembed noframes object audio video canvas datalist param source track area map rp "
    "svg/defs svg/desc svg/metadata svg/title svg/symbol svg/clippath svg/mask svg/marker svg/pattern svg/lineargradient svg/radialgradient svg/filter svg/script svg/style "
    "math/annotation math/annotation-xml math/mphantom math/script math/style".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp svg/text svg/foreignobject math/mtr math/mlabeledtr".split()
)
APART = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir xmp".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
    "search section summary table ul xmp".split()
)
LISTS = frozenset("ul ol menu dir".split())
#: Elements of drawings and formulas that hold HTML, and start tags that end a drawing or formula.
POINTS = frozenset("svg/foreignobject svg/desc svg/title math/mi math/mo math/mn math/ms math/mtext".split())
BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup "
    "table tt u ul var".split()
)
CELLS = frozenset("td th".split())
SECTIONS = frozenset("thead tbody tfoot".split())
#: What a start tag ends: the nearest of these, unless one of those stands between.
ENDS = {
    "li": (frozenset(["li"]), LISTS | POINTS), "dt": (frozenset(["dt", "dd"]), POINTS | {"dl"}), "dd": (frozenset(["dt", "dd"]), POINTS | {"dl"}),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (CELLS, frozenset(["tr", "table"])), "th": (CELLS, frozenset(["tr", "table"])),
    "thead": (SECTIONS, frozenset(["table"])), "tbody": (SECTIONS, frozenset(["table"])), "tfoot": (SECTIONS, frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])), "optgroup": (frozenset(["optgroup"]), frozenset(["select"])),
}
P_LIMIT = frozenset("button caption td th table body html object".split()) | POINTS
END_LIMIT = frozenset("td th caption table".split()) | POINTS
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())

#: As the standard's tokenizer reads them: a quote opens a string only directly after "=" and white space, else it is part of a name or value.
ATTRIBUTE = r"""(=?[^ \t\n\f\r/>=]++|=)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+("[^"]*+"|'[^']*+'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+))?+"""
TOKEN = re.compile(rf"""<(?:!--.*?(?:--!?>|\Z)|[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|!\w[^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[ \t\n\f\r/]++|{ATTRIBUTE})*+(?:>|\Z)))""", re.S)
ATTRIBUTE = re.compile(ATTRIBUTE)
HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SIMPLE = re.compile(r"[a-z0-9]*(?:[.#][\w-]+)?", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" else value) if value else "")
    return out


def kind(tag: str, inside: str, attrs: dict[str, str]) -> str:
    """The name in the tree of an element that starts inside another."""
    space, _, name = inside.rpartition("/")
    if not space or inside in POINTS and not (space == "math" and tag in ("mglyph", "malignmark")):
        return f"{tag}/{tag}" if tag in ("svg", "math") else tag
    if tag in BREAKS or tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")):
        return tag
    return "svg/svg" if name == "annotation-xml" and tag == "svg" else f"{space}/{tag}"


def parse(html: str) -> tuple[list, set[str]]:
    """The tree (nodes are [tag, attributes, children], texts are strings) and the simple selectors that style sheets hide."""
    root = ["#root", {}, []]
    open_, hidden, at, end = [root], set(), 0, len(html)
    count: Counter[str] = Counter()  # of open elements, so that nothing is looked for in vain

    def close(tags, limit) -> None:
        if not any(count[t] for t in tags):
            return
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] in tags:
                count.subtract(node[0] for node in open_[k:])
                del open_[k:]
                return
            if open_[k][0] in limit:
                return

    def text(data: str) -> None:
        if data:
            if open_[-1][0] == "head" and not data.isspace():
                close(("head",), ())
            open_[-1][2].append(data)

    while at < end:
        found = TOKEN.search(html, at)
        if not found:
            text(unescape(html[at:]))
            break
        text(unescape(html[at : found.start()]))
        inside = open_[-1][0]
        if "/" in inside and html.startswith("<![CDATA[", found.start()):
            stop = html.find("]]>", found.start())
            text(html[found.start() + 9 : stop if stop >= 0 else end])
            at = stop + 3 if stop >= 0 else end
            continue
        at, tag = found.end(), found[2]
        if tag is None:
            continue
        if not found[3].endswith(">"):
            break
        tag = tag.lower()
        source = found[3][:-1]
        attrs = attributes(source) if source.strip() else {}
        if "/" in inside:
            space = inside.partition("/")[0]
            if found[1] and tag not in ("br", "p"):
                if count[f"{space}/{tag}"]:
                    k = next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == f"{space}/{tag}" or "/" not in open_[k][0])
                    if k and "/" in open_[k][0]:
                        count.subtract(node[0] for node in open_[k:])
                        del open_[k:]
                        continue
            elif found[1] or kind(tag, inside, attrs) == tag:
                while "/" in open_[-1][0] and open_[-1][0] not in POINTS:
                    count[open_.pop()[0]] -= 1
        tag = tag if found[1] else kind(tag, open_[-1][0], attrs)
        if found[1]:
            if tag == "br":
                open_[-1][2].append(["br", {}, []])
            else:
                close((tag,), frozenset(["table"]) if tag in TABLE_PARTS and tag != "table" else () if tag in ("table", "body", "html") else END_LIMIT)
            continue
        if tag in ("html", "body"):
            close(("head",), ())
            if count[tag]:
                continue
        elif tag not in HEAD:
            close(("head",), ())
        if tag in ENDS_P:
            close(("p",), P_LIMIT)
        if tag in ENDS:
            close(*ENDS[tag])
        node = [tag, attrs, []]
        open_[-1][2].append(node)
        if "/" in tag and source.endswith("/"):
            continue
        if tag in RAW or tag in ("svg/script", "svg/style"):
            tag = tag.rpartition("/")[2]
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            data = html[at : stop.start() if stop else end]
            node[2].append(unescape(data) if tag in ("title", "textarea") else data)
            if tag == "style":
                for rule in data.split("}"):
                    selectors, _, rules = rule.rpartition("{")
                    selectors = selectors.rpartition("{")[2]
                    if HIDES.search(rules):
                        hidden.update(s for s in (x.strip() for x in selectors.split(",")) if s and SIMPLE.fullmatch(s))
            at = html.find(">", stop.start()) + 1 or end if stop else end
        elif tag not in VOID and len(open_) < DEPTH:
            open_.append(node)
            count[tag] += 1
    return root, hidden


def visible(node: list, hidden: set[str]) -> bool:
    tag, attrs, _ = node
    if tag in UNSEEN or tag == "dialog" and "open" not in attrs:
        return False
    space, _, name = tag.rpartition("/")
    if attrs and ("hidden" in attrs and space != "svg" or "style" in attrs and HIDES.search(attrs["style"])):
        return False
    if space == "svg" and (attrs.get("display", "").strip() == "none" or attrs.get("visibility", "").strip() in ("hidden", "collapse")):
        return False
    if hidden:
        marks = [f".{c}" for c in attrs.get("class", "").split()] + ([f"#{attrs['id']}"] if "id" in attrs else [])
        return name not in hidden and not any(m in hidden or name + m in hidden for m in marks)
    return True


class Sheet:
    """Lines that grow as text, breaks and gaps come."""

    def __init__(self):
        self.lines, self.now, self.space, self.gap, self.indent, self.mark = [], [], False, False, 0, ""

    def put(self, word: str) -> None:
        if not self.now:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap, self.space = False, False
            self.now.append(" " * max(0, min(INDENT, self.indent) - len(self.mark)) + self.mark)
            self.mark = ""
        elif self.space:
            self.now.append(" ")
        self.space = False
        self.now.append(word)

    def text(self, data: str) -> None:
        words = SPACE.split(data)
        self.space |= not words[0] and len(words) > 1
        for k, word in enumerate(words):
            if word:
                self.put(word)
                self.space = k < len(words) - 1

    def exact(self, data: str) -> None:
        for k, line in enumerate(data.replace("\r\n", "\n").split("\n")):
            if k:
                self.end(True)
            if line:
                self.space = False
                self.put(line)

    def end(self, always: bool = False) -> None:
        if self.now or always:
            if not self.now and self.gap and self.lines:
                self.lines.append("")
            self.gap = False if not self.now else self.gap
            self.lines.append("".join(self.now).replace("\xa0", " ").rstrip())
            self.now = []
        self.space = False

    def apart(self) -> None:
        self.end()
        self.gap = True

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?\d{1,9}", value.strip()) else default


def table_lines(rows: list[list[tuple[list[str], int, int]]], room: list[int]) -> list[str]:
    """Rows of cells (lines, columns, rows) as lines, cells padded to their columns as long as the page's `room` for spaces lasts."""
    until, wide = np.zeros(COLUMNS, np.int64), 0  # the row until which a column is taken, and the columns in use
    placed, by_row = [], []
    for r, row in enumerate(rows):
        c, cells = 0, []
        for lines, across, down in row:
            if c < wide and until[c] > r:
                free = until[c:wide] <= r
                c = c + int(free.argmax()) if free.any() else wide
            across = min(across, COLUMNS - c)
            until[c : c + across] = r + min(down, len(rows) - r)
            cells.append((c, lines))
            if across and lines:
                placed.append((across, c, min(WIDE, max(map(len, lines)))))
            c += across
            wide = max(wide, c)
        by_row.append(cells)
    width = [0] * wide
    for across, c, w in sorted(placed):  # cells of fewer columns first; wider ones stretch their last column
        short = w - sum(width[c : c + across]) - 2 * (across - 1)
        width[c + across - 1] += max(0, short)
    start = [0]
    for w in width:
        start.append(start[-1] + (w + 2 if w else 0))
    pads = sum(max((start[c] for c, lines in cells if lines), default=0) * max((len(lines) for _, lines in cells), default=0) for cells in by_row)
    if pads > room[0]:
        start = [0] * len(start)
    else:
        room[0] -= pads
    return [line for cells in by_row for line in row_lines(cells, start)]


def row_lines(cells: list[tuple[int, list[str]]], start: list[int]) -> list[str]:
    out = []
    for k in range(max((len(lines) for _, lines in cells), default=0)):
        line = ""
        for c, lines in cells:
            if k < len(lines) and lines[k]:
                line = (line + "  " if line and len(line) > start[c] - 2 else line.ljust(start[c])) + lines[k]
        out.append(line)
    return out


def visible_text(html: str | None) -> str:
    if not html:
        return ""
    tree, hidden = parse(html)
    sheets, tables, lists, pre, labels = [Sheet()], [], [], 0, 0
    room = [PADDING * len(html)]
    todo: list = [(tree, True)]
    while todo:
        node, enter = todo.pop()
        sheet = sheets[-1]
        if isinstance(node, str):
            sheet.exact(node) if pre else sheet.text(node)
            continue
        tag, attrs, children = node
        if enter:
            if not visible(node, hidden):
                continue
            if tag == "br":
                sheet.end(True)
                continue
            if tag == "input":
                if attrs.get("type", "").lower() in ("submit", "button", "reset") and attrs.get("value"):
                    sheet.text(attrs["value"])
                continue
            if tag in APART and not (tag in LISTS and lists):
                sheet.apart()
            elif tag in BLOCK and tag not in CELLS:
                sheet.end()
            if tag == "hr" or tag in VOID:
                continue
            if tag in LISTS:
                lists.append([tag, number(attrs.get("start"), 1)])
            elif tag == "li":
                level = lists[-1] if lists else ["ul", 1]
                level[1] = number(attrs.get("value"), level[1]) if level[0] == "ol" else level[1]
                sheet.indent += 3 if level[0] == "ol" else 2
                sheet.mark = f"{level[1]}. " if level[0] == "ol" else "- "
                level[1] += 1
            elif tag in ("blockquote", "dd"):
                sheet.indent += 4
            elif tag in ("pre", "xmp", "textarea"):
                pre += 1
                if children and isinstance(children[0], str) and children[0].startswith("\n"):
                    children = [children[0][1:], *children[1:]]
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELLS and tables:
                sheets.append(Sheet())
            elif tag == "q":
                sheet.text('"')
            elif tag == "svg/text":
                labels += 1
            elif tag == "math/mtd":
                sheet.space = True
            if tag.startswith("svg/") and not labels and tag != "svg/foreignobject":  # text of a drawing that is in no label is not drawn
                children = [x for x in children if not isinstance(x, str)]
            todo.append((node, False))
            if tag == "details" and "open" not in attrs:
                children = [x for x in children if not isinstance(x, str) and x[0] == "summary"][:1]
            todo += [(x, True) for x in reversed(children)]
            continue
        if tag in LISTS:
            lists.pop()
        elif tag == "li":
            sheet.end()
            sheet.mark = ""
            sheet.indent -= 3 if (lists[-1] if lists else ["ul"])[0] == "ol" else 2
        elif tag in ("blockquote", "dd"):
            sheet.end()
            sheet.indent -= 4
        elif tag in ("pre", "xmp", "textarea"):
            pre -= 1
        elif tag in CELLS and tables:
            lines = sheets.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((lines, min(COLUMNS, max(1, number(attrs.get("colspan"), 1))), max(1, number(attrs.get("rowspan"), 1))))
            continue
        elif tag == "table":
            sheet.end()
            for line in table_lines(tables.pop(), room):
                sheet.put(line) if line else None
                sheet.end(True)
        elif tag == "q":
            sheet.put('"')
        elif tag == "svg/text":
            labels -= 1
        if tag in APART and not (tag in LISTS and lists):
            sheet.apart()
        elif tag in BLOCK:
            sheet.end()
    return "\n".join(sheets[0].done())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars and n_lines of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def told(batches):
        for batch in batches:
            texts = [visible_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                names=["page_id", "text", "n_chars", "n_lines"],
            )

    return pages.select("page_id", "html").mapInArrow(told, f"page_id {kind}, text string, n_chars bigint, n_lines bigint")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
