"""Listing pages with markup beyond the plain form; expected cells are written by hand."""

import pytest

from placeflow.sources import listing as ls

HEAD = ["特店名稱", "行業別", "電話", "地址"]


def page(rows, head="<tr>" + "".join(f"<td>{x}</td>" for x in [*HEAD, "備註"]) + "</tr>"):
    return f"<html><body><table>{head}{rows}</table></body></html>"


@pytest.mark.parametrize("html,want", [
    (page("<tr><td>a<td>b<td>c<td>d<td>e<tr><td>f<td>g<td>h<td>i<td>j"), [["a", "b", "c", "d"], ["f", "g", "h", "i"]]),
    (page("<tr><td colspan=2>a</td><td>c</td><td>d</td><td>e</td></tr>"), [["a", "a", "c", "d"]]),
    (page("<tr><td rowspan=2>a</td><td>b</td><td>c</td><td>d</td><td>e</td></tr><tr><td>g</td><td>h</td><td>i</td><td>j</td></tr>"),
     [["a", "b", "c", "d"], ["a", "g", "h", "i"]]),
    (page("<tr><td>a &amp; b</td><td> x\n\ny </td><td>&#20013;</td><td><b>d</b>!</td><td></td></tr>"), [["a & b", "x y", "中", "d!"]]),
    ("<table><tr><td>" + page("<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td></tr>") + "</td></tr></table>", [["a", "b", "c", "d"]]),
    (page("<tr><td>a</td><td>b</td></tr>"), [["a", "b", None, None]]),
    ("<TABLE>" + "<TR><TH>x</TH><TH>y</TH></TR>" + page("")[len("<html><body><table>"):], []),
    (page("<tr><td>a</td><td colspan=bad>b</td><td>c</td><td>d</td><td>e</td></tr>"), [["a", "b", "c", "d"]]),
])
def test_target_rows(html, want):
    rows = ls.target_rows(ls.page_tables(html))
    assert rows[0] == HEAD and rows[1:] == want


@pytest.mark.parametrize("html", [
    page("", "<tr>" + "".join(f"<th>{x}</th>" for x in [*HEAD, "備註"]) + "</tr>"),  # a column header is no data row
    page("", "<thead><tr>" + "".join(f"<td>{x}</td>" for x in [*HEAD, "備註"]) + "</tr></thead>"),
    "<table><tr><td>特店名稱</td><td>x</td></tr></table>", "<p>no table", "", "<table></table>", "<!-- <table><tr><td>特店名稱 -->",
])
def test_no_target(html):
    assert ls.target_rows(ls.page_tables(html)) is None


def test_kinds(spark):
    rows = [(1, None), (2, ""), (3, "<p>x</p>"), (4, page("")), (5, "<table><tr><td>x</td></tr></table>"), (6, "<p>查無資料</p>"),
            (7, "<table><tr><td>" + page("") + "</td></tr></table>")]
    got = {r.i: (r.kind, r.n_tables) for r in ls.classify_pages(spark.createDataFrame(rows, "i int, html string")).collect()}
    assert got == {1: ("failed", 0), 2: ("failed", 0), 3: ("failed", 0), 4: ("target", 1), 5: ("empty", 1), 6: ("marker", 0), 7: ("target", 2)}
