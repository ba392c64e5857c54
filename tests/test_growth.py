"""What is done once, in place or in pieces, so that it grows no faster than its input."""

import random
import re
import time
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.operators import bronze, page_tables
from matchlake.plans import jobs
from matchlake.plans.incremental_gold import GoldState
from matchlake.session import CLEANUP
from matchlake.sinks import writers
from matchlake.sources import scans
from matchlake.workloads import fixtures as fx
from matchlake.workloads import storage_queries as sq


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_orders_meet_customers_before_lines(spark):
    plan = fx.matches(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if re.search(r"Join Inner, \(o_custkey#\d+L = c_custkey#\d+L\)", line))
    depth = re.search(r"[A-Z]", plan[at]).start()
    below = [line for line in plan[at + 1 :] if re.search(r"[A-Z]", line).start() > depth]
    assert below and not any("l_orderkey" in line for line in plan[at : at + 1 + len(below)])


def test_refresh_evaluates_the_matches_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(league):
        seen.add(1)
        return league

    rows = [(f"m{i}", "2024", "A", "2024-01-01", "X", "Y", 1, 0, 1.0, 0.5, "H") for i in range(6)]
    names = "match_id string, season string, league string, match_date string, home_team string, away_team string, home_goals bigint, away_goals bigint, home_xg double, away_xg double, result string"
    counted = F.udf(count, "string").asNondeterministic()
    matches = spark.createDataFrame(rows, names).withColumn("league", counted("league"))
    state = GoldState(spark, f"{tmp_path}/state")
    state.refresh(matches)
    assert seen.value == 6
    assert state.league_standings().count() == 2
    assert {p.name for p in Path(f"{tmp_path}/state").iterdir()} == {"standings", "pairs", "form"}


def test_first_lines_are_found_without_sorting_all_lines(spark, tmp_path):
    for i in range(5):
        Path(tmp_path, f"{i}.csv").write_text(f"a,{'b' if i % 2 else 'c'}\n" + "9,9\n0,0\n" * 50)
    found = scans._first_lines(spark, str(tmp_path))
    assert sorted(row["header"] for row in found.collect()) == ["a,b"] * 2 + ["a,c"] * 3
    assert "SortAggregate" not in _plan(found)


def test_whole_numbers_with_a_point_are_not_cast_as_they_stand(spark, tmp_path):
    values = ["110.0", "110", "7.5", "1e2", " 8 ", ".", "x", "9223372036854775807", "-3.0"]
    Path(tmp_path, "log.json").write_text("".join(f'{{"PTS": "{v}"}}\n' for v in values))
    found = scans.scan_landing(spark, str(tmp_path), "player_game_log")
    assert [row["PTS"] for row in found.select("PTS").collect()] == [110, 110, None, 100, 8, None, None, 2**63 - 1, -3]
    assert "Contains(" in _plan(found) or "contains" in _plan(found).lower()


def test_a_snapshot_of_one_folder_moves_no_rows(spark, tmp_path, monkeypatch):
    rows = spark.range(90).repartition(3).select(F.col("id").alias("n"), F.lit("2024").alias("season"))
    assert writers.write_snapshot(rows, str(tmp_path), "basketball", "one", "d", one_folder=True) == 90
    assert len(list(Path(tmp_path).rglob("*.parquet"))) == 3
    told = {}
    monkeypatch.setattr(jobs.writers, "write_snapshot", lambda df, root, sport, dataset, date, one: told.setdefault((sport, dataset), one) or 0)
    own = jobs.Lake("", "b", "s", sources=[jobs.Source("football", "own", None)])
    for lake, sport, dataset in ((own, "football", "own"), (own, "football", "games"), (own, "soccer", "teams")):
        jobs._ingested(spark, lake, sport, "2024", "d", dataset, lambda: None)
    assert told == {("football", "own"): False, ("football", "games"): True, ("soccer", "teams"): False}


def test_silver_rows_that_come_by_season_stay_where_they_are(spark, tmp_path):
    rows = spark.range(90).repartition(3).select(F.col("id").alias("n"), F.lit("2024").alias("season"))
    path = writers.write_silver(rows, str(tmp_path), "basketball", "players", arranged=True)
    assert len(list(Path(path).rglob("*.parquet"))) == 3


def _games(spark, *rows):
    """Football games of (id, home team, season)."""
    given = spark.createDataFrame(rows, "game_id string, home_team string, season string")
    known = {"away_team": F.lit("B"), "home_score": F.lit(3), "away_score": F.lit(1)}
    columns = [F.col(f.name) if f.name in given.columns else known.get(f.name, F.lit(None)) for f in schemas.bronze("football/games")]
    return given.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, schemas.bronze("football/games"), strict=True)])


def test_refined_rows_are_not_kept_twice(spark, tmp_path, monkeypatch):
    schema = f"once_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    lake = jobs.Lake("", f"{tmp_path}/bronze", f"{tmp_path}/silver", schema, quarantine=f"{tmp_path}/aside")
    moved, write = [], writers.write_silver
    monkeypatch.setattr(jobs.writers, "write_silver", lambda *given, **more: moved.append((not more["arranged"], spark.conf.get(CLEANUP))) or write(*given, **more))
    before = spark.conf.get(CLEANUP)
    for rows, rejected in (([("1", "A", "2024"), ("2", None, "2024")], ["2"]), ([("1", "A", "2024"), ("3", "A", "2024")], []), ([("1", "A", "2023"), ("4", None, "2023")], ["4"])):
        writers.write_snapshot(_games(spark, *rows), lake.bronze, "football", "games", "2024-01-01", one_folder=True)
        (outcome,) = jobs.refine(spark, lake)
        assert outcome.rejected == len(rejected)
        aside = spark.read.parquet(f"{tmp_path}/aside/football/games")
        assert [r["game_id"] for r in aside.collect()] == rejected and "reasons" in aside.columns
    # rows of one season stay in place, those of two are moved; shuffle files go with the query that made them
    assert moved == [(False, "true"), (False, "true"), (True, "true")] and spark.conf.get(CLEANUP) == before
    assert sorted(r["game_id"] for r in spark.table(f"{schema}.nfl_games").collect()) == ["1", "3"]
    lake.bronze = f"{tmp_path}/none"
    writers.write_dataset(_games(spark).withColumn("date", F.lit("2024-01-01")), f"{lake.bronze}/football/games")
    assert [o.rows for o in jobs.refine(spark, lake)] == [0]


def test_landed_lines_are_compressed(spark):
    files = sq._landing_json(spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all(name.endswith(".json.gz") for name in files)


def test_pages_are_read_in_pieces(spark):
    n = 2 * page_tables._PAGES_AT_ONCE + 7
    html = F.when(F.col("id") % 9 > 0, F.concat(F.lit("<table id='t'><tr><th>a<tr class=x><td>"), "id", F.lit("</td></tr></table>")))
    pages = spark.range(n).coalesce(1).withColumn("html", html)
    rows = page_tables.columns_of(page_tables.table_rows(pages, "t"), ["id"], "a").collect()
    assert sorted((row["id"], row["a"]) for row in rows) == [(i, str(i)) for i in range(n) if i % 9]


_BITS = ["<table>", '<table id="t">', "<TABLE ID='x'>", "</table>", "</TABLE>", "</table >", "<tr>", '<tr class="spacer x">', "</tr>", "<td>", '<td a="b>c">', "</td>", '<th scope="row" >', "</th>", "<thead>", "</thead>", "<tbody>", "</tbody>", '<a href="/m?a&amp;b" href="z">', "<a>", "</a>", "<br />", "<!-- ", "-->", "<script>", "</script>", " x ", "&amp;", "1 < 2", "a<b", "<td", '<td a="', '<td a="b"c="d">', '<td a="</table>">', "<td/>"]


def test_plain_tables_are_read_like_others(monkeypatch):
    """Tags cut apart at once give what reading them one by one gives."""
    draw, pages = random.Random(6), []
    for _ in range(4000):
        body = "".join(draw.choices(_BITS, k=draw.randint(1, 25)))
        pages.append(draw.choice(["", '<table id="q"><thead><tr><th>a</th><th>a</th></tr></thead>']) + body + draw.choice(["", "</table>", "</table><table><tr><td>2</table>"]))
    plain = '<table id="q"><tr class="r"><td>a &amp; b</td><td></td></tr><tr><td><a href="/x">y</a></td></tr></table>'
    found = [page_tables._tables_of(page) for page in [*pages, plain]]
    assert page_tables._arrow(found).type.to_pandas_dtype() and page_tables._arrow([[], *found]).to_pylist()[0] == []
    tags = []
    monkeypatch.setattr(page_tables, "_start_tag", lambda *given, start=page_tables._start_tag: tags.append(given[1]) or start(*given))
    assert page_tables._tables_of(plain) == found[-1] and tags == ["table"]
    monkeypatch.setattr(page_tables, "_read_plain", lambda *given: None)
    assert [page_tables._tables_of(page) for page in [*pages, plain]] == found
    assert page_tables._arrow(found[-1:]).to_pylist() == [[{"table_id": "q", "in_comment": False, "headers": ["a & b"], "grid": [["y"]], "links": [{"href": "/x", "text": "y"}]}]]


def test_odd_pages_take_linear_time():
    def seconds(piece, n):
        start = time.perf_counter()
        page_tables._tables_of("<table id=x><tr><th>a</th></tr>" + piece * n + "</table>")
        return time.perf_counter() - start

    for piece in ("</TABLE><table>x", "</table ><table>x", '<td a="', "<td   ", '<td a="b', "<!-- </table> --><tr>", "</tablex>"):
        assert seconds(piece, 32_000) < 0.2 + 20 * seconds(piece, 4_000)


def test_cells_are_read_once(spark):
    """The filters on a match see its date and score as columns, not as expressions over the page's table."""
    html = F.lit('<table id="sched_all"><tr><th>Date<th>Home<th>Score<th>Away<tr><td>2024-01-02<td>A<td>2\u20131<td>B<tr><td>x<td>A<td>2\u20131<td>B</table><table id="o"></table>')
    pages = spark.range(3).select(F.col("id").alias("page_id"), F.when(F.col("id") != 1, html).otherwise("<table></table>").alias("html"))
    rows = page_tables.columns_of(page_tables.table_rows(pages, "none", "sched_all"), ["page_id"], "Date", "Home", "Score", "Away")
    matches = bronze.soccer_matches(rows, "2024", F.lit("L"))
    filters = [line for line in matches._jdf.queryExecution().optimizedPlan().toString().splitlines() if re.search(r"\bFilter\b", line)]
    assert filters and not any("array_position" in line or "filter(" in line or "lambda" in line for line in filters)
    assert [(str(r["match_date"])[:10], r["home_team"], r["home_goals"]) for r in matches.collect()] == [("2024-01-02", "A", 2.0)] * 2
