"""Weather: page table rows, daily records, hourly expansion, gap fill, store merge."""

import datetime as dt

from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import weather as WX

PAGE = """<html><body><table><tr><td>ignored</td></tr></table>
<div class="toprint"><table><caption><div>Mai <div>2025</div></div></caption>
<tr><th>Date</th></tr>
<tr><td>Jeu. 01</td><td>8</td><td>19</td><td>13,5 °C</td><td>10 km/h</td><td>30</td><td>5 h</td><td>0</td><td>1000</td><td>1010</td></tr>
<tr><td>Ven. 02</td><td>8</td><td>19</td><td>--</td><td></td><td>30</td><td>5 h</td><td>0</td><td>1000</td><td></td></tr>
<tr><td>Sam. 03</td><td>short</td></tr>
<tr><td>Dim. <b>31</b></td><td>8</td><td>19</td><td>-2</td><td>36</td><td>30</td><td>5 h</td><td>0</td><td>--</td><td>1012</td></tr>
</table></div><table><tr><td>second table</td></tr></table></body></html>"""


def test_page_rows_and_daily_records(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    rows = WX.page_table_rows(pages)
    got = rows.orderBy("row_index").collect()
    assert [len(r.cells) for r in got] == [10, 10, 2, 10]
    assert got[3].cells[0] == "Dim. 31"
    # June has 30 days: day 31 is dropped; the short row is dropped
    rec = WX.daily_record_from_cells(rows, F.lit(2025), F.lit(6)).orderBy("day").collect()
    assert [r.day for r in rec] == [dt.date(2025, 6, 1), dt.date(2025, 6, 2)]
    assert (rec[0].temp_celsius, rec[0].pressure_hpa, rec[0].wind_speed_ms) == (13.5, 1005.0, 2.778)
    assert (rec[1].temp_celsius, rec[1].pressure_hpa, rec[1].wind_speed_ms) == (None, 1000.0, None)


def test_tags_in_either_case_and_entities(spark):
    html = '<DIV CLASS="toprint"><TABLE><TR><TD>Jeu.&nbsp;01</TD><TD>&nbsp;13,5&nbsp;&deg;C </TD><TD>a &amp;lt; b</TD></TR></TABLE></DIV>'
    got = WX.page_table_rows(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert [r.cells for r in got] == [["Jeu. 01", "13,5 °C", "a &lt; b"]]
    assert spark.range(1).select(X.locale_number(F.lit("13,5 °C"))).first()[0] == 13.5


def test_store_refresh_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "store")
    page = lambda t: ('<div class="toprint"><table>' + "".join(f"<tr><td>{d}</td><td></td><td></td><td>{t}</td><td>36</td>" + "<td></td>" * 3
                      + "<td>1000</td><td>1010</td></tr>" for d in range(1, 28)) + "</table></div>")
    pages = spark.createDataFrame([(2024, 1, page(5)), (2024, 2, page(7))], "year int, month int, html string")
    bounds = lambda a, b: spark.createDataFrame([(a, b)], "start_date date, end_date date")
    first = WX.refresh_store(bounds(dt.date(2024, 1, 20), dt.date(2024, 1, 30)), pages, path).collect()
    assert len(first) == 11 * 24 and sum(r.is_imputed for r in first) == 3 * 24 and {r.temp_celsius for r in first} == {5.0}
    changed = spark.createDataFrame([(2024, 1, page(99)), (2024, 2, page(7))], "year int, month int, html string")
    second = WX.refresh_store(bounds(dt.date(2024, 1, 25), dt.date(2024, 2, 2)), changed, path).collect()
    assert {r.temp_celsius for r in second if r.observed_at.month == 1 and r.observed_at.day < 31} == {5.0}  # stored hours win
    assert {r.temp_celsius for r in second if r.observed_at.month == 2} == {7.0}
    from forgeline.sources.files import read_weather_store

    assert read_weather_store(spark, path).count() == (31 + 27) * 24


def test_hourly_expansion_monthly_fill_and_merge(spark):
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 5.0, 1000.0, 2.0), (dt.date(2025, 1, 3), 7.0, 1010.0, 4.0)],
                                  "day date, temp_celsius double, pressure_hpa double, wind_speed_ms double")
    hourly = WX.expand_daily_to_hourly(daily)
    assert hourly.count() == 48 and hourly.where("is_imputed").count() == 0
    means = WX.monthly_means(hourly)
    assert means.first().temp_celsius == 6.0
    bounds = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 1, 2))], "s date, e date")
    future = WX.hours_of(bounds, "s", "e").select("observed_at")
    filled = WX.fill_future_hours(future, means)
    assert filled.count() == 48 and filled.where("temp_celsius = 6.0 and is_imputed").count() == 48
    merged = WX.merge_store(hourly, filled.unionByName(hourly.withColumn("temp_celsius", F.lit(99.0))))
    assert merged.count() == 96 and merged.where("temp_celsius = 99.0").count() == 0
    missing = WX.missing_months(WX.months_of(spark.createDataFrame([(dt.date(2025, 1, 5), dt.date(2025, 3, 1))], "s date, e date"), "s", "e"), hourly)
    assert sorted((r.year, r.month) for r in missing.collect()) == [(2025, 2), (2025, 3)]


def _walked(html):
    """What a page parser that keeps the same state finds: (row number, cells) of every marked table."""
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        marked = in_table = in_row = in_cell = False
        begun = 0

        def __init__(self):
            super().__init__()
            self.cell, self.row, self.rows = [], [], []

        def handle_starttag(self, tag, attrs):
            if tag == "div" and (dict(attrs).get("class") or "").strip() == "toprint":
                self.marked = True
            if tag == "table" and self.marked:
                self.in_table = True
            if tag == "tr" and self.in_table:
                self.in_row, self.row, self.begun = True, [], self.begun + 1
            if tag == "td" and self.in_row:
                self.in_cell, self.cell = True, []

        def handle_endtag(self, tag):
            if tag == "table" and self.in_table:
                self.in_table = self.marked = False
            elif tag == "tr" and self.in_table and self.in_row:
                if self.row:
                    self.rows.append((self.begun - 1, self.row))
                self.in_row = False
            elif tag == "td" and self.in_row:
                self.row.append(" ".join(self.cell))
                self.in_cell = False

        def handle_data(self, data):
            if self.in_cell and data.split():
                self.cell.append(" ".join(data.split()))

    walk = Walk()
    walk.feed(html)
    walk.close()
    return walk.rows


MARK = '<div class="toprint">'
PAGES = [
    f"{MARK}<table><tr><td>1<td>2</td></tr><tr><td>lost<tr><td>3</td><td>4</td></tr><tr><td>open</table>",  # unclosed cells and rows
    f"{MARK}<table><tr><td>a</td></tr></table><table><tr><td>no</td></tr></table>{MARK}<p><table><tr><td>b</td></tr></table>",  # every marked table
    f"{MARK}<table><tr><td>x<!-- <td>y</td></tr> -->z</td></tr><!-- </table> --><tr><td>w</td></tr></table>",  # comments
    f"{MARK}<table><tr><td>&#233;&#xE9;&#x1F600;&eacute;&nbsp;&hellip;&euro; &amp;lt; &unknown; 5 & 6 &#0; &#x110000;</td></tr></table>",  # references
    "<DIV id=1 CLASS = toprint ><TABLE BORDER=1><TR><TD title='a>b'>u</TD><td> v\n <b>w</b>\t</td><th>h</th></TR></TABLE></DIV>",  # attributes
    "<div class=' toprint '><table><tr><th>head</th></tr><tr></tr><tr><td></td></tr></table>",  # rows without cells, an empty cell
    f"{MARK}<table><tr><td>out<table><tr><td>in</td></tr></table>rest</td></tr><tr><td>after</td></tr></table>",  # a table in a cell
    f"{MARK}<table><tr><td>1</td></td></tr></tr><td>2</td></table></table>",  # surplus end tags
    f"{MARK}<table><tr><td>if 3 < 4 then</td><td>tail",  # a bare sign, a cut page
    "<table><tr><td>unmarked</td></tr></table>", "<div class='toprint'>no table", "", "plain text",
    f"{MARK}<style>td > tr {{}}</style><script>document.write('<table><tr><td>script</td></tr></table>')</script><table><tr><td>ok</td></tr></table>",
]


def test_pages_as_a_parser_walks_them(spark):
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(PAGES)] + [(99, None)], "page_id long, html string")
    got = {}
    for r in WX.page_table_rows(pages).orderBy("page_id", "row_index").collect():
        got.setdefault(r.page_id, []).append((r.row_index, r.cells))
    for i, h in enumerate(PAGES):
        want = [(k, [c.replace("\x00", "\ufffd") for c in cells]) for k, cells in _walked(h)]
        assert got.get(i, []) == want, h
    assert 99 not in got


def test_random_pages(spark):
    import random

    rng = random.Random(4)
    parts = [MARK, "</div>", "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<td class='x'>", "<b>", "</b>", "text ", " 12,5 ", "&deg;C", "&#38;", "<!-- c -->", "<th>h</th>", "\n"]
    pages = ["".join([MARK, "<table>", *rng.choices(parts, weights=[1, 1, 1, 1, 5, 5, 8, 8, 2, 1, 1, 6, 6, 2, 2, 1, 1, 2], k=60)]) for _ in range(160)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = {}
    for r in WX.page_table_rows(df).orderBy("page_id", "row_index").collect():
        got.setdefault(r.page_id, []).append((r.row_index, r.cells))
    assert sum(map(len, got.values())) > 60
    for i, h in enumerate(pages):
        assert got.get(i, []) == _walked(h), h
