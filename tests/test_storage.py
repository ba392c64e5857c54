"""Readers, writers, checks and whole jobs on temporary folders."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.operators import quality, silver
from matchlake.plans import jobs
from matchlake.session import shared_folder
from matchlake.sinks import writers
from matchlake.sources import aliases, scans
from matchlake.streaming.incremental import refresh_silver


@pytest.fixture
def schema(spark, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def tree(root):
    """Dated single files as another writer leaves them; types have drifted."""
    for season, date, scores in [("2023", "2024-01-01", [1, 2]), ("2024", "2024-01-02", [3.0, None])]:
        folder = root / f"season={season}" / f"date={date}"
        folder.mkdir(parents=True)
        frame = pd.DataFrame({"game_id": ["a", "b"], "season": [season + "-x"] * 2, "score": scores})
        frame.to_parquet(folder / "games.parquet", index=False)
        pd.DataFrame({"other": [1]}).to_parquet(folder / "player_stats.parquet", index=False)
    return str(root)


def test_scan_file_and_tree(spark, tmp_path):
    root = tree(tmp_path / "basketball")
    leaf = f"{root}/season=2023/date=2024-01-01/games.parquet"
    single = scans.scan_file(spark, leaf)
    assert single.columns == ["game_id", "season", "score"]
    assert {r.season for r in single.collect()} == {"2023-x"}
    found = scans.scan_tree(
        spark, root, "games.parquet", schemas.T.StructType.fromDDL("game_id string, season string"),
        with_source=True,
    )
    assert found.count() == 4 and {r.season for r in found.collect()} == {"2023-x", "2024-x"}
    assert found.agg(F.max("source_file")).first()[0].endswith("date=2024-01-02/games.parquet")
    with pytest.raises(FileNotFoundError):
        scans.scan_tree(spark, root, "teams.parquet")
    with pytest.raises(FileNotFoundError):
        scans.scan_file(spark, f"{root}/none.parquet")


def test_scan_bronze_prunes_folders(spark, tmp_path):
    contract = schemas.bronze("football/games")
    row = {f.name: None for f in contract} | {"season": 2023, "game_id": "g"}
    games = spark.createDataFrame([row, row | {"season": 2024}], contract)
    writers.write_snapshot(games, str(tmp_path), "football", "games", "2024-01-01")
    found = scans.scan_bronze(spark, str(tmp_path), "football", "games", 2024, "2024-01-01")
    assert found.count() == 1
    assert found.schema["season"].dataType.simpleString() == "bigint"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "season#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_snapshot_replaces_only_its_day_and_leagues(spark, tmp_path):
    contract = schemas.bronze("soccer/teams")

    def teams(league, team):
        row = {f.name: None for f in contract} | {"season": "2024-2025", "league": league, "team": team}
        return spark.createDataFrame([row], contract)

    root = str(tmp_path)
    assert writers.write_snapshot(teams("La Liga", "A"), root, "soccer", "teams", "d1") == 1
    writers.write_snapshot(teams("Serie A", "B"), root, "soccer", "teams", "d1")
    writers.write_snapshot(teams("La Liga", "C"), root, "soccer", "teams", "d2")
    writers.write_snapshot(teams("La Liga", "D"), root, "soccer", "teams", "d1")
    assert writers.write_snapshot(teams("x", "y").where("false"), root, "soccer", "teams", "d1") == 0
    found = scans.scan_bronze(spark, root, "soccer", "teams")
    assert sorted((r.league_slug, r.date, r.team) for r in found.collect()) == [
        ("la_liga", "d1", "D"), ("la_liga", "d2", "C"), ("serie_a", "d1", "B"),
    ]


def test_load_table(spark, schema):
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    two = spark.createDataFrame([("b", 2)], "name string, id int")
    assert writers.load_table(one.where("false"), "t", schema) == 0
    assert not spark.catalog.tableExists(f"{schema}.t")
    assert writers.load_table(one, "t", schema) == 1
    assert writers.load_table(two, "t", schema) == 1
    assert writers.load_table(one.where("false"), "t", schema, "replace") == 0
    assert sorted(map(tuple, spark.table(f"{schema}.t").collect())) == [(1, "a"), (2, "b")]
    assert writers.load_table(two, "t", schema, "replace") == 1
    assert spark.table(f"{schema}.t").columns == ["name", "id"]
    assert writers.row_counts(spark, "t", schema=schema).first().total_rows == 1
    with pytest.raises(ValueError):
        writers.load_table(one, "t", schema, "merge")


def test_failed_replace_keeps_the_old_table(spark, schema):
    good = spark.createDataFrame([(1,)], "id int")
    writers.load_table(good, "t", schema)
    broken = good.select(F.raise_error(F.lit("lost")).cast("int").alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.load_table(broken, "t", schema, "replace")
    assert [r.id for r in spark.table(f"{schema}.t").collect()] == [1]


def test_init_schema_creates_tables_defaults_and_views(spark, schema):
    writers.init_schema(spark, schema)
    tables = {t.name for t in spark.catalog.listTables(schema)}
    assert tables >= {*schemas.gold_tables(), *writers.VIEWS}
    for view in writers.VIEWS:
        assert writers.query(spark, f"SELECT * FROM {schema}.{view}").count() == 0
    writers.execute(
        spark, f"INSERT INTO {schema}.nba_player_games (player_id, player_name) VALUES (1, 'x')"
    )
    assert spark.table(f"{schema}.nba_player_games").first().points == 0


def test_check_rules_and_uniqueness(spark):
    contract = schemas.bronze("basketball/games")
    base = {f.name: None for f in contract} | {
        "game_id": "1", "game_date": dt.datetime(2024, 1, 1), "home_team_id": 1,
        "away_team_id": 2, "home_score": 5, "away_score": None,
    }
    bad = base | {"game_id": None, "home_score": -1}
    df = spark.createDataFrame([base, base, bad], contract)
    found = {
        (r["column"], r.rule): r.violations
        for r in quality.check_rules(df, quality.BASKETBALL_GAME_RULES).collect()
        if r.violations
    }
    assert found == {("game_id", "not_null"): 1, ("home_score", "at_least 0"): 1}
    copies = quality.check_unique(df, ["game_id"]).collect()
    assert [(r.game_id, r.copies) for r in copies] == [("1", 2)]
    games = spark.createDataFrame([], schemas.gold("nba_games"))
    assert {r.violations for r in quality.check_rules(games, quality.gold_rules("nba_games")).collect()} == {0}
    missing = quality.check_rules(df, [quality.Rule("nope", "not_null")]).first()
    assert missing.violations == 3


def test_quality_profile(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", nan), ("b", None), (None, -0.0), (None, 0.0)], "k string, x double"
    )
    profile = {(r.metric, r["column"]): r.value for r in quality.quality_profile(df, "t").collect()}
    assert profile == {
        ("rows", None): 7.0, ("columns", None): 2.0, ("duplicates", None): 4.0,
        ("null_pct", "k"): 0.286, ("null_pct", "x"): 0.286,
    }
    empty = {r.metric: r.value for r in quality.quality_profile(df.where("false"), "t").collect()}
    assert (empty["rows"], empty["duplicates"], empty["null_pct"]) == (0.0, 0.0, None)


def landing(spark, root):
    """Feeds of all three sports in their landing formats."""

    def put(sport, feed, season, rows, ddl, format="json"):
        df = spark.createDataFrame(rows, ddl)
        writer = df.write.option("header", True) if format == "csv" else df.write
        writer.format(format).save(f"{root}/{sport}/{feed}/season={season}")

    put(
        "basketball", "team_game_log", "2024-25",
        [("1", "2024-10-22", 1, "LA Lakers", "LAL vs. BOS", 110), ("1", "2024-10-22", 2, "Celtics", "BOS @ LAL", 105)],
        "GAME_ID string, GAME_DATE string, TEAM_ID bigint, TEAM_NAME string, MATCHUP string, PTS bigint",
    )
    put(
        "basketball", "player_game_log", "2024-25",
        [("1", "2024-10-22", 23, "L. James", 1, "LA Lakers", "LAL vs. BOS", 10, 20)],
        "GAME_ID string, GAME_DATE string, PLAYER_ID bigint, PLAYER_NAME string, TEAM_ID bigint, "
        "TEAM_NAME string, MATCHUP string, FGM bigint, FGA bigint",
    )
    put(
        "football", "schedules", "2024",
        [("g1", 1, "2024-09-05", "BAL", "KC", 20, 27), ("g2", 2, "2024-09-12", "KC", "BAL", None, None)],
        "game_id string, week bigint, gameday string, home_team string, away_team string, "
        "home_score bigint, away_score bigint",
        "csv",
    )
    put(
        "football", "player_weeks", "2024", [("p1", "P.M", "P. Mahomes", "KC", 1, 28, 291.0)],
        "player_id string, player_name string, player_display_name string, team string, week bigint, "
        "attempts bigint, passing_yards double",
        "csv",
    )
    head = "<thead><tr><th>Date</th><th>Home</th><th>Score</th><th>Away</th></tr></thead>"
    page = (
        f'<table id="sched_all">{head}<tbody><tr><td>2024-09-14</td><td>Arsenal</td><td>2–0</td>'
        "<td>Wolves</td></tr></tbody></table>"
        '<!-- <table id="results"><tr><th>Squad</th><th>MP</th><th>Pts</th></tr>'
        "<tr><td>Arsenal</td><td>1</td><td>3</td></tr></table> -->"
        '<table id="stats_1_summary"><tr><th>Player</th><th>Min</th></tr><tr><td>B. S</td><td>90</td></tr></table>'
    )
    put(
        "soccer", "pages", "2024-2025", [(1, "u", page, "Premier League"), (2, "u", page.replace("Arsenal", "Betis"), "La Liga")],
        "page_id bigint, url string, html string, league string",
        "parquet",
    )


NAMES = {
    "soccer": {"Wolverhampton": {"page": "Wolves"}},
    "basketball": {"Los Angeles Lakers": {"feed": "LA Lakers"}},
    "football": {"Kansas City Chiefs": {"feed": "KC"}, "Baltimore Ravens": {"feed": "BAL"}},
}


def test_whole_run_of_all_sports(spark, tmp_path, schema):
    landing(spark, f"{tmp_path}/landing")
    lake = jobs.Lake(
        landing=f"{tmp_path}/landing", bronze=f"{tmp_path}/bronze", silver=f"{tmp_path}/silver",
        schema=schema, names=NAMES,
        seasons={"soccer": ["2024-2025"], "basketball": ["2024-25"], "football": ["2024"]},
        formats={"schedules": "csv", "player_weeks": "csv", "pages": "parquet"},
    )
    outcomes = {o.source: o for o in jobs.run(spark, lake)}
    failed = {name for name, o in outcomes.items() if o.error}
    # The feed without files is reported; the others go on.
    assert failed == {"basketball/team_stats/2024-25"}
    assert outcomes["soccer/matches/2024-2025"].rows == 2
    assert outcomes["soccer/teams/2024-2025"].rows == 2
    assert outcomes["soccer/player_stats"].rows == 2
    assert outcomes["football/team_stats/2024"].rows == 2
    assert outcomes["nba_team_form"].rows == 2
    standings = writers.query(spark, f"SELECT * FROM {schema}.v_nfl_standings ORDER BY rank")
    assert [(r.team, r.wins) for r in standings.collect()] == [
        ("Kansas City Chiefs", 1), ("Baltimore Ravens", 0),
    ]
    points = writers.query(spark, f"SELECT league, team, points FROM {schema}.v_soccer_league_standings")
    assert sorted(map(tuple, points.collect())) == [
        ("La Liga", "Betis", 3), ("La Liga", "Wolverhampton", 0),
        ("Premier League", "Arsenal", 3), ("Premier League", "Wolverhampton", 0),
    ]
    assert spark.table(f"{schema}.soccer_head_to_head").count() == 2
    # A filter on the season reaches the files below a view.
    one = spark.sql(f"SELECT * FROM {schema}.v_nfl_standings WHERE season = 2024")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(season,2024)" in plan.split("PushedFilters: [")[1].split("]")[0]
    contract = schemas.gold("nfl_games")
    silver_games = scans.scan_silver(spark, lake.silver, "football", "games", contract, 2024)
    assert silver_games.schema == contract and silver_games.count() == 2
    # Again without ingest: same tables.
    jobs.run(spark, lake, skip_ingest=True, skip_gold=True)
    assert spark.table(f"{schema}.nba_games").first().home_team == "Los Angeles Lakers"


def test_incremental_refresh_equals_the_batch_and_replays(spark, tmp_path):
    contract = schemas.bronze("basketball/games")
    lookup = aliases.alias_lookup(aliases.alias_entries(spark, NAMES))

    def game(season, game_id, score, hour):
        row = {f.name: None for f in contract}
        return row | {
            "extract_timestamp": dt.datetime(2024, 1, 1, hour), "season": season,
            "game_id": game_id, "home_team_name": "LA Lakers", "home_score": score,
        }

    def project(snapshots):
        return silver.basketball_games(snapshots, lookup)

    def refresh():
        refresh_silver(
            spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", "basketball", "games", project,
            f"{tmp_path}/progress",
        )
        found = scans.scan_silver(
            spark, f"{tmp_path}/silver", "basketball", "games", schemas.gold("nba_games")
        )
        return sorted((r.season, r.game_id, r.home_score) for r in found.collect())

    def snapshot(date, *rows):
        df = spark.createDataFrame(list(rows), contract)
        writers.write_snapshot(df, f"{tmp_path}/bronze", "basketball", "games", date)

    snapshot("d1", game("s1", "a", 1, 1), game("s2", "b", 1, 1))
    assert refresh() == [("s1", "a", 1), ("s2", "b", 1)]
    snapshot("d2", game("s1", "a", 2, 2), game("s1", "c", 3, 2))
    snapshot("d3", game("s1", "a", 9, 0))
    assert refresh() == [("s1", "a", 2), ("s1", "c", 3), ("s2", "b", 1)]
    assert refresh() == [("s1", "a", 2), ("s1", "c", 3), ("s2", "b", 1)]


def test_incremental_refresh_keeps_null_seasons_and_moves_games(spark, tmp_path):
    contract = schemas.bronze("basketball/games")
    lookup = aliases.alias_lookup(aliases.alias_entries(spark, NAMES))

    def project(snapshots):
        return silver.basketball_games(snapshots, lookup)

    def silver_rows():
        found = scans.scan_silver(
            spark, f"{tmp_path}/silver", "basketball", "games", schemas.gold("nba_games")
        )
        return sorted((r.season or "", r.game_id, r.home_score) for r in found.collect())

    def arrive(date, *rows):
        games = [
            {f.name: None for f in contract}
            | {
                "extract_timestamp": dt.datetime(2024, 1, 1, hour), "season": season,
                "game_id": game_id, "home_team_name": "LA Lakers", "home_score": hour,
            }
            for season, game_id, hour in rows
        ]
        df = spark.createDataFrame(games, contract)
        writers.write_snapshot(df, f"{tmp_path}/bronze", "basketball", "games", date)
        refresh_silver(
            spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", "basketball", "games", project,
            f"{tmp_path}/progress", key=["game_id"],
        )
        batch = project(scans.scan_bronze(spark, f"{tmp_path}/bronze", "basketball", "games"))
        assert silver_rows() == sorted(
            (r.season or "", r.game_id, r.home_score) for r in batch.collect()
        )

    arrive("d1", ("s1", "a", 1), (None, "a2", 1))
    assert silver_rows() == [("", "a2", 1), ("s1", "a", 1)]
    arrive("d2", ("s2", "a", 2), (None, "b", 2))  # its only game leaves s1
    assert silver_rows() == [("", "a2", 1), ("", "b", 2), ("s2", "a", 2)]
    arrive("d3", ("s1", "c", 3))  # an old copy of a in s1 does not come back
    assert silver_rows() == [("", "a2", 1), ("", "b", 2), ("s1", "c", 3), ("s2", "a", 2)]


def test_csv_files_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("game_id,home_team,away_team,home_score,away_score\ng1,KC,PHI,20.0,10\n")
    (tmp_path / "b.csv").write_text("away_score,away_team,game_id,home_score,home_team\n7,KC,g2,3,PHI\n")
    found = scans.scan_landing(spark, str(tmp_path), "schedules", "csv")
    rows = sorted((r.game_id, r.home_team, r.away_team, r.home_score, r.away_score) for r in found.collect())
    assert rows == [("g1", "KC", "PHI", 20, 10), ("g2", "PHI", "KC", 3, 7)]


def test_json_numbers_written_as_floats_and_broken_lines(spark, tmp_path):
    lines = ['{"GAME_ID": "g", "PTS": 110.0}', '{"GAME_ID": "h", "PTS": 1.5}', '{"GAME_ID": "i", "PTS', ""]
    (tmp_path / "log.json").write_text("\n".join(lines))
    found = scans.scan_landing(spark, str(tmp_path), "team_game_log", with_landed=True).collect()
    assert sorted((r.GAME_ID, r.PTS) for r in found) == [("g", 110), ("h", None)]
    assert all(r.landed.file_path.endswith("log.json") for r in found)
    assert scans.broken_lines(spark, str(tmp_path)) == 1


def test_replace_keeps_a_table_for_readers(spark, schema):
    writers.load_table(spark.range(3), "t", schema, "replace")
    reader = spark.table(f"{schema}.t")
    assert writers.load_table(spark.range(5), "t", schema, "replace") == 5
    assert spark.table(f"{schema}.t").count() == 5 and reader.columns == ["id"]
    assert writers.load_table(spark.range(0), "t", schema, "replace") == 0
    assert spark.table(f"{schema}.t").count() == 5
    writers.load_table(spark.range(2).selectExpr("id", "id AS more"), "t", schema, "replace")
    assert spark.table(f"{schema}.t").columns == ["id", "more"]


def test_refine_broadcasts_its_own_lookup_below_the_limit_only(spark):
    lookup = aliases.alias_lookup(aliases.alias_entries(spark, NAMES))
    rows = spark.range(1000).selectExpr("concat('team ', id % 7) AS team")
    named = aliases.normalize_names(rows, lookup, "basketball", {"team": "name"})
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(lower(btrim(team" not in plan
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = aliases.normalize_names(rows, lookup, "basketball", {"team": "name"})
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.name for r in shuffled.collect()) == sorted(r.name for r in named.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
