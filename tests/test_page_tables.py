"""Table extraction from page text: markup variants and Spark-side choices."""

import html as html_text

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.operators import bronze, page_tables


def pages(spark, *htmls):
    rows = [(i, f"http://site/{i}", html) for i, html in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def grid(rows):
    return [(r.page_id, r.headers, r.cells) for r in rows.orderBy("page_id", "row_idx").collect()]


HEAD = "<thead><tr><th colspan=2>Group</th></tr><tr><th>A</th><th>B</th></tr></thead>"


def test_last_header_row_and_skipped_rows(spark):
    html = (
        f'<table id="t">{HEAD}<tbody><tr><td>1</td><td> x </td></tr>'
        '<tr class="spacer partial"><td></td></tr><tr class="over thead"><th>A</th></tr>'
        "<tr><th>2</th><td></td></tr></tbody><tbody><tr><td>9</td><td>9</td></tr></tbody></table>"
    )
    rows = page_tables.table_rows(pages(spark, html), "t")
    assert grid(rows) == [(0, ["A", "B"], ["1", "x"]), (0, ["A", "B"], ["2", None])]


def test_headers_are_padded_cut_and_numbered(spark):
    wide = '<table id=t><tr><th>A</th><th>A</th></tr><tr><td>1<td>2<td>3</tr><tr><td>4</table>'
    narrow = '<table id=t><tr><th>A<th>B<th>C</tr><tr><td>1</td></tr></table>'
    bare = '<table id=t><thead><tr><td>no header cell</td></tr></thead><tbody><tr><td>1<td>2</tbody></table>'
    rows = page_tables.table_rows(pages(spark, wide, narrow, bare), "t")
    assert grid(rows) == [
        (0, ["A", "A.1", "col_2"], ["1", "2", "3"]),
        (0, ["A", "A.1", "col_2"], ["4", None, None]),
        (1, ["A"], ["1"]),
        (2, ["0", "1"], ["1", "2"]),
    ]


def test_markup_wins_over_comment_and_ids_in_order(spark):
    hidden = '<!-- <table id="a"><tr><th>H</th></tr><tr><td>hidden</td></tr></table> -->'
    direct = '<table id="a"><tr><th>H</th></tr><tr><td>direct</td></tr></table>'
    other = '<table id="b"><tr><th>H</th></tr><tr><td>second</td></tr></table>'
    found = page_tables.table_rows(pages(spark, hidden + direct, hidden, other, "<p>"), "a", "b")
    cells = {r.page_id: (r.cells[0], r.in_comment) for r in found.collect()}
    assert cells == {0: ("direct", False), 1: ("hidden", True), 2: ("second", False)}


def test_all_tables_last_direct_first_hidden(spark):
    def one(tid, text):
        return f'<table id="{tid}"><tr><th>H</th></tr><tr><td>{text}</td></tr></table>'

    html = (
        one("a", "a1") + f"<!--{one('b', 'b1')}-->" + one("a", "a2") + f"<!--{one('b', 'b2')}-->"
        f"<!--{one('a', 'a3')}-->" + "<table><tr><th>x</th></tr><tr><td>no id</td></tr></table>"
    )
    rows = page_tables.all_table_rows(pages(spark, html)).collect()
    assert sorted((r.table_id, r.cells[0]) for r in rows) == [("a", "a2"), ("b", "b1")]


def test_text_of_cells(spark):
    html = (
        "<script>var t = '<table id=t>';</script><style>a > b {}</style>"
        '<table id="t"><tr><th>H</th></tr><tr><td> a &amp; b <b>c </b>d<!-- no --> 3 < 4</td></tr></table>'
    )
    assert grid(page_tables.table_rows(pages(spark, html), "t")) == [(0, ["H"], ["a & bcd3 < 4"])]


def test_nested_table_rows_count_for_the_outer_table(spark):
    html = (
        '<table id="o"><tr><th>H</th></tr><tr><td>x<table id="i"><tr><td>h</td></tr>'
        "<tr><td>y</td></tr></table></td></tr><tr><td>z</td></tr></table>"
    )
    outer = page_tables.table_rows(pages(spark, html), "o").orderBy("row_idx").collect()
    assert [r.cells[0] for r in outer] == ["xhy", "h", "y", "z"]
    inner = page_tables.table_rows(pages(spark, html), "i").collect()
    assert [r.cells for r in inner] == [["y"]]


@pytest.mark.parametrize("rows", [0, 1, 7])
def test_rendered_table_reads_back(spark, rows):
    names = ["Date", "Home", "Score"]
    data = [[f"{r}-{c}" for c in range(3)] for r in range(rows)]
    html = (
        '<html><body><table id="t"><thead><tr>'
        + "".join(f"<th>{n}</th>" for n in names)
        + "</tr></thead><tbody>"
        + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in data)
        + "</tbody></table></body></html>"
    )
    found = page_tables.table_rows(pages(spark, html), "t")
    assert [r[2] for r in grid(found)] == data


def test_match_links_need_path_and_text(spark):
    html = (
        '<a href="/matches/0">Match-Report</a><!-- <table id="sched_all"><tr><td>h</td></tr>'
        '<tr><td><a href="/matches/1">Match-Report</a><a href="/squads/2">Match-Report</a>'
        '<a href="/matches/3">Head-to-Head</a><a>Match-Report</a>'
        '<a href="http://x/matches/4"><b>Match-</b>Report</a></td></tr></table> -->'
    )
    links = page_tables.match_links(pages(spark, html), "https://site/en").orderBy("link_idx")
    assert [(r.href, r.match_url) for r in links.collect()] == [
        ("/matches/1", "https://site/en/matches/1"),
        ("http://x/matches/4", "http://x/matches/4"),
    ]


def test_schedule_page_to_matches(spark):
    html = (
        '<table id="sched_all"><thead><tr><th>Date</th><th>Home</th><th>xG</th><th>Score</th>'
        "<th>xG</th><th>Away</th><th>Attendance</th></tr></thead><tbody>"
        "<tr><td>2024-09-14</td><td>Arsenal</td><td>2.1</td><td>2–0</td><td>0.5</td><td>Wolves</td>"
        "<td>60,253</td></tr>"
        "<tr><td>2024-09-21</td><td>Wolves</td><td></td><td></td><td></td><td>Arsenal</td><td></td></tr>"
        "<tr><td>2024-09-22</td><td>Leeds</td><td></td><td>(4) 1–1 (3)</td><td></td><td>Hull</td>"
        "<td></td></tr>"
        "<tr><td>soon</td><td>Leeds</td><td></td><td>1–1</td><td></td><td>Hull</td><td></td></tr>"
        "</tbody></table>"
    )
    rows = page_tables.table_rows(pages(spark, html), "sched_all")
    texts = page_tables.columns_of(
        rows, ["page_id"], "Date", "Home", "Score", "Away", "xG", "xG.1", "Attendance", "Venue"
    )
    matches = bronze.soccer_matches(texts, "2024-2025", "Premier League").orderBy("match_date")
    first, second = matches.collect()
    assert (first.home_team, first.home_goals, first.away_goals) == ("Arsenal", 2.0, 0.0)
    assert (first.home_xg, first.away_xg, first.attendance) == (2.1, 0.5, 60253.0)
    assert first.venue is None and first.match_url is None
    assert (second.home_team, second.home_goals, second.away_goals) == ("Leeds", None, None)


def test_page_text_is_read_once(spark):
    rows = page_tables.table_rows(pages(spark, "<table id=t>"), "t")
    texts = page_tables.columns_of(rows, ["page_id"], "Score").where("Score like '%-%'")
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


TEXT = st.text(
    st.characters(codec="utf-8", exclude_categories=("Cc", "Cs", "Zs", "Zl", "Zp")), min_size=1
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(TEXT, min_size=3, max_size=3), min_size=1, max_size=4), st.booleans())
def test_any_text_survives_rendering(rows, hidden):
    """Cells come back whatever characters they hold, in markup or in a comment."""
    cells = "".join(
        "<tr>" + "".join(f"<td>{html_text.escape(c)}</td>" for c in row) + "</tr>" for row in rows
    )
    table = f'<table id="t"><thead><tr><th>A<th>B<th>C</tr></thead><tbody>{cells}</tbody></table>'
    page = f"<p>x{f'<!--{table}-->' if hidden else table}<p>y"
    (found,) = page_tables._tables_of(page)
    assert found["grid"] == rows
    assert (found["headers"], found["in_comment"]) == (["A", "B", "C"], hidden)


def test_broken_markup_loses_no_cell_and_takes_linear_time():
    import time

    from matchlake.operators.page_tables import _tables_of

    def grid(html):
        return [t["grid"] for t in _tables_of(html)]

    head = "<table id=x><tr><th>a</th><th>b</th></tr>"
    assert grid(f"{head}<tr><td title='it's'>1</td><td>2</td></tr></table>") == [[["1", "2"]]]
    assert grid(f"<!-- x {head}<tr><td>1</td><td>2</td></tr></table>") == [[["1", "2"]]]
    assert grid(f"{head}<tr><td>1</td><td>2</td></tr></table><script>var x = '<table>'") == [[["1", "2"]]]
    assert grid(f"<title>t</title>{head}<tr><td>1</td></tr></table>") == [[["1"]]]

    def seconds(html):
        start = time.perf_counter()
        _tables_of(html)
        return time.perf_counter() - start

    for piece in ("<td title='x>1</td>", '<td title="x>1</td>', "<!-- x ", "<title ", "<script>x", "<table"):
        small, large = (seconds(head + piece * n) for n in (4_000, 32_000))
        assert large < 0.2 + 20 * small
