import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowsight.llm import html_text

SPACED = {"p", "ul", "ol", "table"}
# a tree is a text or (tag, attributes, children)
TEXT = st.sampled_from(["a", "bc ", " d", "e f", " ", "\n"])


def element(inner):
    blocks = st.sampled_from(["div", "section", "b", "span"])
    plain = st.tuples(blocks, st.sampled_from(["", "", "", " hidden", " style='display:none'", " aria-hidden='true'"]), st.lists(inner, max_size=3))
    item = st.tuples(st.just("li"), st.just(""), st.lists(inner, max_size=3))
    lists = st.tuples(st.sampled_from(["ul", "ol"]), st.just(""), st.lists(item, max_size=3))
    cell = st.tuples(st.just("td"), st.just(""), st.lists(inner, max_size=2))
    row = st.tuples(st.just("tr"), st.just(""), st.lists(cell, min_size=1, max_size=3))
    table = st.tuples(st.just("table"), st.just(""), st.lists(row, max_size=3))
    return st.one_of(plain, lists, table, st.just(("br", "", [])))


TREES = st.lists(st.recursive(TEXT, element, max_leaves=14), max_size=4)


def as_html(node):
    if isinstance(node, str):
        return node
    tag, attributes, children = node
    return f"<{tag}{attributes}>" + ("" if tag == "br" else "".join(map(as_html, children)) + f"</{tag}>")


class Block:
    def __init__(self):
        self.lines, self.text, self.gap = [], "", False

    def flush(self):
        line = " ".join(re.split(r"[ \t\n\r\f]+", self.text)).strip(" ")
        self.text = ""
        if line:
            self.put([line])

    def put(self, lines):
        self.lines += ([""] if self.gap and self.lines else []) + lines
        self.gap = False


def slow_lines(nodes):
    """The lines of nodes by plain recursion, each list and table on its own."""
    block = Block()
    fill(nodes, block)
    block.flush()
    return block.lines


def fill(nodes, block):
    for node in nodes:
        if isinstance(node, str):
            block.text += node
            continue
        tag, attributes, children = node
        if "hidden" in attributes.replace("aria-hidden", "") or "none" in attributes:
            continue
        if tag == "br":
            block.flush()
        elif tag in ("ul", "ol", "table"):
            block.flush()
            block.gap = True
            lines = slow_table(children) if tag == "table" else slow_list(tag, children)
            if lines:
                block.put(lines)
            block.gap = True
        else:
            if tag in ("div", "section"):
                block.flush()
            fill(children, block)
            if tag in ("div", "section"):
                block.flush()


def slow_list(tag, items):
    lines = []
    for number, (_, _, children) in enumerate(items, 1):
        mark = f"{number}. " if tag == "ol" else "- "
        own = slow_lines(children) or [""]
        lines.append((mark + own[0]).rstrip())
        lines += [" " * len(mark) + line if line else "" for line in own[1:]]
    return lines


def slow_table(rows):
    texts = []
    for _, _, cells in rows:
        row = [" ".join(line for line in slow_lines(children) if line) for _, _, children in cells]
        while row and not row[-1]:
            row.pop()
        if row:
            texts.append(row)
    widths = [max(len(row[place]) for row in texts if len(row) > place) for place in range(max(map(len, texts), default=0))]
    return [" | ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() for row in texts]


@settings(max_examples=600, deadline=None)
@given(TREES)
def test_layout_equals_plain_recursion(nodes):
    assert html_text.visible_text("<body>" + "".join(map(as_html, nodes)) + "</body>") == "\n".join(slow_lines(nodes))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(
    ["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<table>", "</table>", "<tr>", "<td colspan=3 rowspan=2>", "</td>", "<ul>", "<li>", "</ul>", "<svg>",
     "</svg>", "<svg/>", "<select>", "<option>", "</select>", "<textarea>", "</textarea>", "<![x[y]]>", "<!", "<!--", "-->", "<", ">", "&", "&amp;", "x", " y ",
     "<details>", "<summary>", "</details>", "<head>", "<title>", "</title>", "<body>", "<form>", "</form>", "<script>", "</script>", "<dl><dt>", "<?p ?>",
     "<a href='", "'>", "</", "<br/>", "<tbody>", "<caption>", "<math>", "<text>", "<li value='9", "\x00"]), max_size=40))
def test_no_page_fails(parts):
    html_text.visible_text("".join(parts))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<![foo[bar]]>x", "x"), ("<td colspan=" + "9" * 5_000 + ">a", "a"), ("<ol start=" + "9" * 5_000 + "><li>a</ol>", "999999999. a"),
        ("<span aria-hidden=true>x</span>", "x"),
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b><br>c</div>d", "b\nd"),
        ("<div style='display:block' hidden>a</div>", "a"), ("<div hidden>a<b style='visibility:visible'>b</b></div>c", "c"),
        ("<p>a<svg />b<p>c", "ab\n\nc"), ("<svg>no<g><text>yes</text></g><title>t</title></svg>z", "yes\nz"),
        ("<div/>a</div>b", "a\nb"), ("<textarea>a\n<b>&amp;</textarea>q", "a\n<b>&\n\nq"),
        ("<select><option>a<option selected>b<option>c</select>d", "bd"), ("<select><optgroup label=x><option>a</optgroup></select>", "a"),
        ("<select multiple><option>a<option>b</select>", "a\nb"),
        ("<input type=submit><input type=button value=Go><input placeholder=Name><input type=hidden value=x><input type=password value=y>", "Submit Go Name"),
        ("<details><summary>s</summary>gone</details><details open><summary>s</summary>in</details>", "s\ns\nin"),
        ("a<!-- gone", "a"), ("a<div", "a"), ("a<b x=\"", "a"), ("a < b <", "a < b <"), ("a</b", "a"), ("x &amp", "x &"), ("<textarea>rest <b>", "rest <b>"),
        ("<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>", "漢kan"),
        ("<ul><li><ul><li>a<li>b</ul><li></ul>", "- - a\n  - b\n-"),
    ],
)
def test_what_is_shown(page, want):
    assert html_text.visible_text(page) == want


@pytest.mark.parametrize(
    "page",
    ["<b>" * 20_000 + "<div>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<ul><li>x" * 20_000, "<ul><li>x" * 20_000 + "</li></ul>" * 20_000,
     "<p>" + "<b>" * 20_000 + "<p>" * 20_000, "<li>x" * 20_000, "<p><font>" * 20_000, "<a href=x>" * 20_000 + "</p>" * 20_000, "<table><tr><td>x" * 20_000,
     "<dl><dt>x<dd>" * 20_000, "&" * 20_000, "<" * 20_000, "<!" * 20_000, "<svg><text>x" * 20_000],
)
def test_twenty_thousand_open_tags_take_seconds(page):
    started = time.perf_counter()
    html_text.visible_text(page)
    # about a second on an idle core
    assert time.perf_counter() - started < 10


def test_all_words_of_deep_pages_are_there():
    rng = random.Random(1)
    numbers = [f"n{place}" for place in range(3_000)]
    page = "".join(rng.choice(["<div>", "<ul><li>", "<table><tr><td>", "<ol><li>", "<b>", "<section>"]) + number + " " for number in numbers)
    found = [word for word in re.findall(r"\w+", html_text.visible_text(page)) if word.startswith("n")]
    assert found == numbers
