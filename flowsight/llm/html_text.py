"""Visible text of web pages: a tree with implied tags, then a layout of blocks, lists and tables.

Neither step uses recursion, and both take about linear time: the tree keeps the places of open
tags by name, and the layout writes each line once, with the indent it will have.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from flowsight.llm.batches import map_batches, required

# Elements by how they are built and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style template noscript iframe object canvas audio video head title datalist rp noembed noframes defs desc metadata symbol".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
LISTS = frozenset({"ul", "ol", "menu"})
CELLS = frozenset({"td", "th"})
SECTIONS = frozenset({"thead", "tbody", "tfoot"})
# Elements whose content is text up to their end tag.
RAW_TEXT = frozenset("textarea title iframe noembed noframes".split())
# Drawings, and what in them is shown as text.
FOREIGN = ("svg", "math")
DRAWN_TEXT = ("text", "foreignobject")
# What rows, cells and sections may stand in, and what a search for that must not leave.
ROW_PLACES = (*sorted(SECTIONS), "table", "tr")
ROW_LIMITS = (*sorted(CELLS), "template", "select", "svg", "object")
# A tag that opens closes these open elements, looking outwards up to the given ends.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
}
# What may stand in a head; any other tag and any text ends it.
IN_HEAD = frozenset("base link meta title style script noscript template".split())
SCOPE = ("table", "td", "th", "html", "body", "caption")
# Fields that show what they hold, and the words on buttons that have none of their own.
FIELDS = frozenset({"", "text", "search", "email", "url", "tel", "number", "date", "time", "month", "week", "datetime-local"})
BUTTONS = {"submit": "Submit", "reset": "Reset", "button": ""}
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
WHITE = re.compile(r"[ \t\n\x0b\x0c\r]+")
CUT_SHORT = re.compile(r"<[a-zA-Z/!?]")
# Widest column that cells are padded to, deepest indent, and the columns that spans may fill: one cell or one
# nest of lists must not blow up all lines.
MAX_PAD = 100
MAX_COLUMNS = 1_000


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def style(self, pattern: re.Pattern) -> str | None:
        found = pattern.findall(self.attrs.get("style") or "")
        return found[-1].lower() if found else None

    def displayed(self) -> bool:
        """Whether the element and what is in it takes part in the page; a style wins over the attribute."""
        if self.tag in HIDDEN or self.tag == "dialog" and "open" not in self.attrs:
            return False
        display = self.style(DISPLAY)
        return display != "none" if display else "hidden" not in self.attrs

    def shown(self, outer: bool) -> bool:
        """Whether texts in the element can be seen; unlike what is not displayed, an inner element may differ."""
        value = self.style(VISIBILITY)
        return outer if value in (None, "inherit") else value not in ("hidden", "collapse")

    def shown_children(self) -> list:
        """Of closed details the summary only, of a list to choose from the chosen entries."""
        if self.tag == "details" and "open" not in self.attrs:
            return [child for child in self.children if isinstance(child, Node) and child.tag == "summary"][:1]
        if self.tag == "select":
            return self.chosen()
        return self.children

    def chosen(self) -> list:
        groups = [self, *(child for child in self.children if isinstance(child, Node) and child.tag == "optgroup")]
        options = [child for group in groups for child in group.children if isinstance(child, Node) and child.tag == "option"]
        if "multiple" in self.attrs:
            return [part for option in options for part in (option, Node("br", {}))]
        picked = [option for option in options if "selected" in option.attrs]
        return picked[-1:] or options[:1]

    def field_text(self) -> str:
        """What an input field or button shows."""
        kind = (self.attrs.get("type") or "").strip().lower()
        value = self.attrs.get("value")
        if kind in BUTTONS:
            return BUTTONS[kind] if value is None else value
        if kind in ("hidden", "password", "checkbox", "radio", "file", "image", "color", "range"):
            return self.attrs.get("alt") or "" if kind == "image" else ""
        return value or self.attrs.get("placeholder") or ""


class TreeBuilder(HTMLParser):
    """Builds the tree of a page; ends that are left out are implied by the tags that follow."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        # the places in ``open`` of each tag, in order
        self.places: dict[str, list[int]] = defaultdict(list)

    def build(self, page: str) -> Node:
        """The tree of a whole page. A tag or comment that is cut short by the end of the page is not shown."""
        self.feed(page)
        if self.cdata_elem:
            self.handle_data(self.rawdata)
        elif not CUT_SHORT.match(self.rawdata):
            self.close()
        return self.root

    def parse_marked_section(self, i, report=1):
        # sections of the form <![...]> are comments in HTML
        return self.parse_bogus_comment(i)

    def unknown_decl(self, data):
        pass

    def last(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost open element of these tags, 0 if there is none."""
        return max([self.places[tag][-1] for tag in tags if self.places.get(tag)], default=0)

    def close_to(self, place: int) -> None:
        for node in self.open[place:]:
            self.places[node.tag].pop()
        del self.open[place:]

    def enter(self, node: Node) -> None:
        self.places[node.tag].append(len(self.open))
        self.open.append(node)

    def end_head(self) -> None:
        if self.open[-1].tag == "head":
            self.close_to(len(self.open) - 1)

    def imply_ends(self, tag: str) -> None:
        closes, ends = IMPLIED.get(tag, ((), ()))
        if tag in BLOCKS and not closes:
            closes, ends = ("p",), SCOPE
        if not any(self.places.get(name) for name in closes):
            return
        end = self.last(ends)
        inside = []
        for name in closes:
            places = self.places.get(name) or []
            first = bisect_right(places, end)
            inside += places[first : first + 1]
        if inside:
            self.close_to(min(inside))

    def enter_rows(self, tag: str) -> None:
        """Ends what stands between a row, cell or section and its place in the table; a cell outside of a row gets one."""
        place = self.last(ROW_PLACES)
        if not place or self.last(ROW_LIMITS) > place:
            return
        self.close_to(place + 1)
        if tag in CELLS and self.open[place].tag != "tr":
            row = Node("tr", {})
            self.open[-1].children.append(row)
            self.enter(row)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.root.attrs |= dict(attrs)
            return
        if tag not in IN_HEAD:
            self.end_head()
        self.imply_ends(tag)
        if tag in CELLS or tag in SECTIONS or tag == "tr":
            self.enter_rows(tag)
        node = Node(tag, dict(attrs))
        # a form among rows holds nothing, so that the rows in it are rows of the table
        empty = tag in VOID or tag == "form" and self.open[-1].tag in ROW_PLACES
        self.open[-1].children.append(node)
        if not empty:
            self.enter(node)
            if tag in RAW_TEXT and not self.last(FOREIGN):
                self.set_cdata_mode(tag)

    def handle_startendtag(self, tag, attrs):
        """Only in drawings does a slash end an element."""
        drawn = tag in FOREIGN or self.last(FOREIGN) > self.last(("foreignobject",))
        self.handle_starttag(tag, attrs)
        if drawn and self.open[-1].tag == tag:
            self.close_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
            return
        place = self.places[tag][-1] if self.places.get(tag) else 0
        if place and (tag in BLOCKS and tag != "form" or self.last(SCOPE) <= place):
            self.close_to(place)
        elif not place and tag == "p":
            self.open[-1].children.append(Node("p", {}))

    def handle_data(self, data):
        if self.cdata_elem in RAW_TEXT:
            data = unescape(data)
        if WHITE.sub("", data):
            self.end_head()
        if self.places.get("svg") and self.places["svg"][-1] > self.last(DRAWN_TEXT):
            return
        self.open[-1].children.append(data)


class Layout:
    """Lines of a block; blank lines between spaced blocks are kept to one.

    The items of a list write to the lines of what the list is in: ``mark`` stands before the first
    line of an item and ``indent`` before the others.
    """

    __slots__ = ("lines", "parts", "gap", "begun", "indent", "mark")

    def __init__(self, lines: list[str] | None = None, indent: str = "", mark: str | None = None):
        self.lines: list[str] = [] if lines is None else lines
        self.parts: list[str] = []
        self.gap = self.begun = False
        self.indent, self.mark = indent, mark

    def flush(self) -> None:
        line = WHITE.sub(" ", "".join(self.parts)).strip(" ")
        self.parts = []
        if line:
            self.put([line])

    def before_line(self) -> str:
        if self.mark is None:
            return self.indent
        mark, self.mark = self.mark, None
        return mark

    def put(self, lines: list[str]) -> None:
        if self.gap and self.begun:
            self.lines.append("")
        self.gap, self.begun = False, True
        for line in lines:
            before = self.before_line()
            self.lines.append(before + line if line else before.rstrip())

    def space(self) -> None:
        self.flush()
        self.gap = True

    def item(self, mark: str) -> Layout:
        """The layout of an item of a list that begins here."""
        if self.gap and self.begun:
            self.lines.append("")
        self.gap, self.begun = False, True
        before = self.before_line()
        return Layout(self.lines, (self.indent + " " * len(mark))[:MAX_PAD], before + mark)

    def end_item(self) -> None:
        self.flush()
        if self.mark is not None:
            self.lines.append(self.before_line().rstrip())


def reach(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell takes; ``most`` is the limit of the HTML standard."""
    value = (cell.attrs.get(name) or "").strip()[:9]
    return max(1, min(most, int(value))) if value.isascii() and value.isdigit() else 1


class Table:
    """Texts of the cells by row and column; places that a cell takes besides its first are empty."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.row: list[str] = []
        self.below: dict[int, int] = {}
        self.outside, self.loose = Layout(), Layout()

    def skip_taken(self) -> None:
        while self.below.get(len(self.row), 0):
            self.below[len(self.row)] -= 1
            self.row.append("")

    def add_cell(self, cell: Node, text: str) -> None:
        self.skip_taken()
        wide = min(reach(cell, "colspan", MAX_COLUMNS), max(1, MAX_COLUMNS - len(self.row)))
        deep = reach(cell, "rowspan", 65_534)
        for place in range(len(self.row), len(self.row) + wide if deep > 1 else 0):
            self.below[place] = deep - 1
        self.row.append(text)
        self.row.extend([""] * (wide - 1))

    def end_row(self) -> None:
        self.skip_taken()
        self.loose.flush()
        self.row.append(" ".join(self.loose.lines))
        while self.row and not self.row[-1]:
            self.row.pop()
        if self.row:
            self.rows.append(self.row)
        self.row, self.loose = [], Layout()

    def lines(self) -> list[str]:
        """Cells of a column begin at the same place; text outside of rows comes before them.

        Cells longer than ``MAX_PAD`` are whole, but the other cells of the column are not padded to them.
        """
        widths: list[int] = []
        for row in self.rows:
            widths.extend([0] * (len(row) - len(widths)))
            for place, cell in enumerate(row):
                widths[place] = max(widths[place], min(len(cell), MAX_PAD))
        self.outside.flush()
        return self.outside.lines + [
            " | ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() for row in self.rows
        ]


class Renderer:
    """Lays out a tree by a stack of steps, each of which may put others on top of it."""

    def __init__(self):
        self.layouts = [Layout()]
        self.steps: list[tuple] = []

    def render(self, nodes: list) -> list[str]:
        self.push_all(nodes, True)
        while self.steps:
            step, *arguments = self.steps.pop()
            step(*arguments)
        self.layouts[0].flush()
        return self.layouts[0].lines

    def push_all(self, nodes: list, shown: bool) -> None:
        self.steps.extend((self.node, node, shown) for node in reversed(nodes))

    def node(self, node: Node | str, shown: bool) -> None:
        layout = self.layouts[-1]
        if isinstance(node, str):
            if shown:
                layout.parts.append(node)
            return
        if not node.displayed():
            return
        shown = node.shown(shown)
        tag = node.tag
        if tag in ("br", "hr"):
            layout.flush()
        elif tag == "img" or tag == "input":
            if shown:
                layout.parts.append((node.attrs.get("alt") or "") if tag == "img" else f" {node.field_text()} ")
        elif tag in LISTS:
            self.list(node, shown)
        elif tag == "table":
            layout.space()
            self.table(node, shown)
        elif tag in ("pre", "textarea"):
            layout.space()
            body = "".join(kept_text(node, shown)).strip("\n")
            if body:
                layout.put(body.split("\n"))
            layout.space()
        else:
            if tag in BLOCKS or tag == "text":
                layout.space() if tag in SPACED else layout.flush()
                self.steps.append((self.end_block, tag))
            self.push_all(node.shown_children(), shown)

    def end_block(self, tag: str) -> None:
        self.layouts[-1].space() if tag in SPACED else self.layouts[-1].flush()

    def list(self, node: Node, shown: bool) -> None:
        """Items with a mark; further lines of an item are set in under it."""
        start = (node.attrs.get("start") or "").strip()[:9]
        number = int(start) - 1 if re.fullmatch(r"-?[0-9]+", start) else 0
        steps: list[tuple] = []
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li":
                if child.displayed():
                    number += 1
                    steps.append((self.item, child, f"{number}. " if node.tag == "ol" else "- ", shown))
            else:
                steps.append((self.node, child, shown))
                if isinstance(child, Node) or child.strip():
                    steps.append((self.end_block, ""))
        self.layouts[-1].space()
        self.steps.append((self.end_block, node.tag))
        self.steps.extend(reversed(steps))

    def item(self, node: Node, mark: str, shown: bool) -> None:
        self.layouts[-1].flush()
        self.layouts.append(self.layouts[-1].item(mark))
        self.steps.append((self.end_item,))
        self.push_all(node.children, node.shown(shown))

    def end_item(self) -> None:
        self.layouts.pop().end_item()

    def table(self, node: Node, shown: bool) -> None:
        found = Table()
        self.steps.append((self.end_table, found))
        self.rows(found, node, shown)

    def rows(self, table: Table, node: Node, shown: bool) -> None:
        """Rows of a table or a section; anything else in it stands outside of the rows."""
        for child in reversed(node.children):
            if isinstance(child, Node) and child.tag == "tr":
                if child.displayed():
                    self.steps.append((self.row, table, child, child.shown(shown)))
            elif isinstance(child, Node) and child.tag in SECTIONS:
                if child.displayed():
                    self.steps.append((table.outside.parts.append, " "))
                    self.steps.append((self.rows, table, child, child.shown(shown)))
                    self.steps.append((table.outside.parts.append, " "))
            else:
                self.inside(table.outside, [child], shown)

    def inside(self, layout: Layout, nodes: list, shown: bool) -> None:
        """Lay out nodes in a layout of their own, later."""
        self.steps.append((self.layouts.pop,))
        self.steps.extend((self.node, node, shown) for node in reversed(nodes))
        self.steps.append((self.layouts.append, layout))

    def row(self, table: Table, node: Node, shown: bool) -> None:
        self.steps.append((table.end_row,))
        for child in reversed(node.children):
            if isinstance(child, Node) and child.tag in CELLS:
                if child.displayed():
                    own = Layout()
                    self.steps.append((self.end_cell, table, child, own))
                    self.inside(own, child.children, child.shown(shown))
            else:
                self.inside(table.loose, [child], shown)

    def end_cell(self, table: Table, cell: Node, own: Layout) -> None:
        own.flush()
        table.add_cell(cell, " ".join(line for line in own.lines if line))

    def end_table(self, table: Table) -> None:
        lines = table.lines()
        if lines:
            self.layouts[-1].put(lines)
        self.layouts[-1].space()


def kept_text(node: Node, shown: bool) -> list[str]:
    """The shown texts in an element, white space as it is."""
    parts, stack = [], [(child, shown) for child in reversed(node.children)]
    while stack:
        current, seen = stack.pop()
        if isinstance(current, str):
            parts.append(current if seen else "")
        elif current.displayed():
            seen = current.shown(seen)
            inner = ["\n"] if current.tag == "br" else current.shown_children()
            stack.extend((child, seen) for child in reversed(inner))
    return parts


def visible_text(html: str | None) -> str:
    """All visible text of a page, blocks on lines of their own."""
    return "\n".join(Renderer().render(TreeBuilder().build(html or "").children))


def extract(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id, text`` of every row, in one pass without a shuffle.

    A null or empty page has an empty text; a null page_id stays null; repeated rows each have their
    row; an empty table gives an empty result; other columns are ignored.
    """

    def convert(columns):
        return {"page_id": columns[0], "text": [visible_text(value) for value in columns[1]]}

    chosen = required(pages, page_id, html)
    return map_batches(chosen.select(chosen[page_id].cast("bigint"), chosen[html]), "page_id bigint, text string", convert)
