"""Typed records of pages: whole trees, odd markup, pages of another kind."""

from lakeweave.sources import records as R


def test_detail_of_a_plain_page():
    html = """<h1>#7 Some &amp; Thing</h1><table><tr><td class="foo">Name</td><td class="a foo">
      Specialty </td></tr> <tr><td class="cen"><table><tr><td><u>Grow</u><td><u>Burn</u><td><u>Grow</u></table><u>not in a table</u></td>
      <td class="cen">in <u>Bright</u> or <u>Dark</u></td><td class="cen"><u>Soft stuff</u><br><u></u><u>Soft stuff</u></td></tr></table>"""
    assert R.detail(html) == ("Some & Thing", "007", ["Grow", "Burn"], "Bright", ["Soft stuff", "Soft stuff"], None)


def test_pages_of_another_kind_say_why():
    assert R.detail(None)[-1] == "no page" and R.detail("")[-1] == "no heading" and R.detail("<h1>Thing</h1>") == (None,) * 5 + ("unexpected heading",)
    assert R.detail("<h1># 1234 X</h1>") == ("X", "1234", [], None, [], None)
    assert R.detail("<h1># 1 X</h1><td class=foo>Specialty</td>") == ("X", "001", [], None, [], None)          # a header cell outside any row
    two = "<h1># 1 X</h1><table><tr><td class=foo>Specialty</td></tr><tr><td class=cen><u>a</u></td><td class=cen></td></tr></table>"
    assert R.detail(two)[2:5] == ([], None, [])                                                               # too few cells
    assert R.listed("<h2>Other</h2><table></table>") == ([], "no list") and R.listed("<h2>LIST OF AVAILABLE</h2>") == ([], "no table")


def test_deep_and_broken_markup_is_walked_without_recursion():
    deep = "<div>" * 20_000 + "<h1># 3 Deep</h1>" + "</span></div>" * 9_000
    assert R.detail(deep)[:2] == ("Deep", "003")
    assert R.summary("<html lang=''><title> a </title><nav><a>x</a><a href='/b'>b<i> c</i></a></nav><h2>t") == (None, "a", ["t"], ["/b"], ["bc"])
    assert R.summary(None) == (None, None, [], [], [])


def test_records_over_a_frame_keep_every_page(spark):
    rows = [(1, "<h1># 2 A</h1>", "x"), (None, None, "y"), (1, "<h1># 2 A</h1>", "x"), (3, "", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, name string").repartition(3)
    got = sorted(((r["page_id"] or 0, r["name"], r["specialties"], r["problem"]) for r in R.detail_records(pages).collect()), key=str)
    assert got == sorted([(1, "A", [], None), (1, "A", [], None), (0, None, None, "no page"), (3, None, None, "no heading")], key=str)
    assert R.detail_records(pages.limit(0)).count() == 0 and R.page_records(pages).count() == 4
