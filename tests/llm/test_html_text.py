"""Layout of pages, implied tags, visibility, and pages that are no HTML."""

import re
import time
from html import unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitledger.llm.html_text import DEPTH, extract, visible_text

CASES = [
    ("<p>One<p>Two", "One\n\nTwo"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b<li value=20>c</ol>", "9. a\n10. b\n20. c"),
    ("<h1>T</h1><p>x <b>y</b> z</p>", "T\n\nx y z"),
    ("x<b> y</b>z", "x yz"),
    ("<pre>a\n  b\n\nc</pre>", "a\n  b\n\nc"),
    ("a<script>if (x < 1) '</p>'</script>b<style>p{}</style>c<!-- no <p> -->d", "abcd"),
    ("<title>t</title><template>u</template><noscript>v</noscript>w", "w"),
    ("<p hidden>a</p><p style='color:red; display : none'>b</p><p style='visibility:hidden'>c<i style='visibility:visible'>d</i></p>", "d"),
    ("<details><summary>s</summary>t</details><details open><summary>s</summary>t</details>", "s\ns\nt"),
    ("<table><tr><th>A<th>Long name<tr><td>first<td>2</table>", "A     | Long name\nfirst | 2"),
    ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x | 1\n  | 2"),
    ("<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>", "wide cell | z\na | b     | c"),
    ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |".rstrip(" |")),
    ("<table><tr><td><table><tr><td>1<td>2</table><td>x</table>", "1 | 2 | x"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("&lt;b&gt; &amp;amp; &copy; &nosuch; &#65;", "<b> &amp; © &nosuch; A"),
    ("a < b > c <3 <", "a < b > c <3 <"),
    ("<p title='a>b'>x</p><a href=\"<p>\">y</a>", "x\n\ny"),
    ("</p></div></span>x</b>", "x"),
    ("<select><option>a<option selected>b</select> <textarea>\n c</textarea>", "b\n c"),
    ("<a href='x", "<a href='x"),
    ("", ""),
    (" \n ", ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_layout(page, text):
    assert visible_text(page) == text


WORDS = st.sampled_from(["aa", "bb", "cc", "&amp;", "é"])
BITS = st.one_of(WORDS, st.sampled_from([" ", "<p>", "</p>", "<div>", "</div>", "<b>", "</i>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", "<br>", "<h2>", "</h2>", "<ol>", "<dd>", "<span>"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(BITS, max_size=40))
def test_no_visible_letter_is_lost(bits):
    page = "".join(bits)
    # Cells side by side change the order of lines, not the letters.
    want = sorted(unescape(re.sub(r"<[^>]*>|\s", "", page)))
    got = sorted(c for c in re.sub(r"\s|(?m:^ *- )|(?m:^ *[0-9]+\. )", "", visible_text(page)) if c not in "|-0123456789.")
    assert got == [c for c in want if c not in "-"]


SHOWN = [
    ("<head><title>T</title>Some <b>text</b>", "Some text"),
    ("<html><head><meta charset=utf-8><title>T</title><a href=x>link</a> and <i>more</i>", "link and more"),
    ("<head><title>T</title><style>p{}</style>\n<script>x</script>\n</head>\n<body>b", "b"),
    ("<head><noscript><p>no</p></noscript><template><p>u</p></template><title>T</title><span>x", "x"),
    ("<svg><title>t</title><path d='M0 0'/><text x=1>shown</text><defs><text>no</text></defs> no </svg> after", "shown after"),
    ("a <svg/> b <svg><g><desc/><text><tspan>c</tspan></text> d", "a b c"),
    ("<svg><foreignObject><p>in</p></foreignObject><circle><p>out", "in\n\nout"),
    ("<map name=m>over <area href=x> here</map>", "over here"),
]


@pytest.mark.parametrize("page, text", SHOWN)
def test_head_drawings_and_maps(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("tag", ["textarea", "xmp"])
def test_raw_text_is_kept_at_any_depth(tag):
    for depth in (DEPTH - 2, DEPTH - 1, DEPTH, 2 * DEPTH):
        assert visible_text("<span>" * depth + f"<{tag}>a <b> c</{tag}>").split() == ["a", "<b>", "c"]


SPANS = [
    ("<table><tr><td colspan=2>Title</td></tr></table>", "Title"),
    ("<table><tr><td colspan=3>ab</td></tr></table>", "ab"),
    ("<table><tr><td colspan=2>Head<tr><td><td>x</table>", "Head\nx"),
    ("<table><tr><td>a<td colspan=2>Title<td>b<tr><td>c<td><td>x<td>d</table>", "a | Title | b\nc | x     | d"),
    ("<table><tr><td colspan=3>long heading<tr><td>a<td><td>b</table>", "long heading\na | b"),
    ("<table><tr><td>a|<td>|<tr><td>b |</table>", "a|  | |\nb |"),
]


@pytest.mark.parametrize("page, text", SPANS)
def test_spanning_cells(page, text):
    assert visible_text(page) == text


CELLS = st.builds(lambda t, a, d, x: f"<{t} colspan={a} rowspan={d}>{x}", st.sampled_from(["td", "th"]), st.integers(1, 4), st.integers(1, 3), st.sampled_from(["", "a", "bb|", "|", "cc dd<br>e", "<table><tr><td colspan=2>f</table>", "a longer text"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(CELLS, max_size=5), max_size=6))
def test_no_letter_of_a_table_is_lost(rows):
    page = "<table>" + "".join("<tr>" + "".join(row) for row in rows) + "</table>"
    want, got = re.sub(r"<[^>]*>|\s", "", page), re.sub(r"\s", "", visible_text(page))
    assert sorted(c for c in got if c != "|") == sorted(c for c in want if c != "|")
    assert got.count("|") >= want.count("|")


@pytest.mark.parametrize("bit", ['<a "', "<li>", "<table><tr><td>", "<!--", "</div>", "<p><span>", "<b>", "<", "<td>", "<ul><li>", "&amp", "<script>", "</table>"])
def test_time_is_bounded(bit):
    start = time.monotonic()
    visible_text(bit * 20_000 + "x")
    assert time.monotonic() - start < 20


def test_table_of_pages(spark):
    rows = [(1, "u", "<p>a", "clash"), (2, None, None, None), (None, "u", "", "x"), (1, "u", "<p>a", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id or 0, r.text or "") for r in got.collect()) == [(0, ""), (1, "a"), (1, "a"), (2, "")]
    assert got.where("page_id = 2").first().text is None
    assert extract(pages.limit(0)).count() == 0


def letters(text):
    return sorted(c for c in text if c.isalnum())


WIDE = "".join(f"<tr><td colspan={n}>{'w' * 30}" for n in range(1, 900))


@pytest.mark.parametrize(
    "page",
    [
        "<table>" + "<td colspan=1000 rowspan=1000>x" * 10 + "</table>",
        "<table><tr>" + "<td>x" * 1000 + "<tr><td colspan=1000 rowspan=1000>y" + "<tr>" * 1000 + "</table>",
        "<table><tr>" + "<td>xx" * 500 + "".join("<tr>" + "<td>" * n + "z" for n in range(1, 500)) + "</table>",
        f"<table>{WIDE}</table>",
        "<table>" + "<tr><td colspan=7 rowspan=3>a<td rowspan=1000>b<td>c<br>d" * 2000 + "</table>",
    ],
)
def test_tables_of_large_spans_stay_small(page):
    import tracemalloc

    tracemalloc.start()
    began = time.monotonic()
    text = visible_text(page)
    took, most = time.monotonic() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert letters(text) == letters(re.sub("<[^>]*>", "", page))
    assert len(text) < 10 * len(page) and most < 100e6 and took < 30


def plain_grid(rows):
    """Where each cell of rows of (across, down) starts, place by place."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        for across, down in row:
            c = next(c for c in range(10**6) if (r, c) not in taken)
            taken |= {(r + i, c + j) for i in range(down) for j in range(across)}
            out.append((r, c))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=5), max_size=6))
def test_cells_start_where_the_first_place_is_free(rows):
    from hitledger.llm.html_text import _Table

    table = _Table()
    for row in rows:
        table.row()
        for across, down in row:
            table.add(["x"], across, down)
    assert [(r, c) for r, row in enumerate(table.rows) for c in row] == plain_grid(rows)


@pytest.mark.parametrize("first", ["w" * 500, "<table>" + "<td>v" * 120 + "</table>"])
def test_rows_are_laid_out_alike_however_many_follow(first):
    def lines(n):
        return visible_text(f"<table><tr><td>{first}<td>x<tr><td>ab<td>y" + "<tr><td>a<td>b" * n + "</table>").split("\n")

    few = lines(1)
    for n in (10, 100, 1000):
        many = lines(n)
        assert many[:3] == few and many[2:] == few[2:] * n
    assert few[2].startswith("a ") and few[2].endswith(" | b")
