"""Typing, names, bronze and silver on small literal frames."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from matchlake import functions as fn
from matchlake import schemas
from matchlake.operators import bronze, projection, silver
from matchlake.sources import aliases

NAMES = {
    "soccer": {"Wolverhampton Wanderers": {"page": "Wolves"}},
    "basketball": {
        "Los Angeles Lakers": {"feed": "LA Lakers", "abbreviation": "LAL"},
        "Boston Celtics": {"abbreviation": "BOS"},
    },
    "football": {"Kansas City Chiefs": {"feed": "KC"}, "Philadelphia Eagles": {"feed": "PHI"}},
}
STAMP = dt.datetime(2024, 11, 1, 12)


@pytest.fixture(scope="module")
def lookup(spark):
    return aliases.alias_lookup(aliases.alias_entries(spark, NAMES)).cache()


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_coerce_number(spark):
    texts = [" 12 ", "-1.5", "+.5", "5.", "1e3", "inf", "", "x", "1.0f", "7d", "0x1p3", "1,000", None]
    assert values(spark, fn.coerce_number, texts) == [
        12.0, -1.5, 0.5, 5.0, 1000.0, float("inf"), *[None] * 7,
    ]


def test_strip_text(spark):
    assert values(spark, fn.strip_text, [" \t a b \n", "", None]) == ["a b", "", None]


def test_coerce_date(spark):
    texts = ["2024-09-14", "2024-09-14 20:00:00", "2024-02-30", "soon", "", None]
    assert values(spark, fn.coerce_date, texts) == [dt.date(2024, 9, 14)] * 2 + [None] * 4


def test_flags(spark):
    texts = ["OT", "1", "", "0", "0.0", "False", " no ", None]
    assert values(spark, fn.presence_flag, texts) == [
        True, True, False, True, True, True, True, False,
    ]
    assert values(spark, fn.truth_flag, texts) == [True, True, *[False] * 6]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    assert [r[0] for r in df.select(fn.round_to(F.col("x"), 2)).collect()] == [0.13, -0.13, 2.5]


def test_counts_and_ratios(spark):
    df = spark.createDataFrame([(7.9,), (float("nan"),), (None,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(fn.count_or_zero(F.col("x"))).collect()] == [7, 0, 0, -2]
    df = spark.createDataFrame([(1, 2), (1, 0), (0, -1), (None, 4)], "m int, a int")
    assert [r[0] for r in df.select(fn.safe_ratio(F.col("m"), F.col("a"))).collect()] == [
        0.5, None, None, None,
    ]


def test_absolute_url_and_slug(spark):
    assert values(spark, lambda c: fn.absolute_url(c, "http://s"), ["/a", "https://b"]) == [
        "http://s/a",
        "https://b",
    ]
    assert values(spark, fn.slug, ["La Liga", "Serie A"]) == ["la_liga", "serie_a"]


def test_normalize_names(spark, lookup):
    df = spark.createDataFrame(
        [(1, " la LAKERS "), (2, "boston celtics"), (3, " Elsewhere "), (4, None), (5, "")],
        "i int, raw string",
    )
    named = aliases.normalize_names(df, lookup, "basketball", {"raw": "team"}).orderBy("i")
    assert [r.team for r in named.collect()] == [
        "Los Angeles Lakers", "Boston Celtics", "Elsewhere", None, "",
    ]
    other = aliases.normalize_names(df, lookup, "soccer", {"raw": "team"}).where("i = 1")
    assert other.first().team == "la LAKERS"


def test_later_alias_wins_without_doubling_rows(spark):
    names = {"s": {"First": {"a": "X", "b": "x"}, "Second": {"a": "X"}, "Third": {"a": "First"}}}
    found = aliases.alias_lookup(aliases.alias_entries(spark, names)).collect()
    assert {r.alias_lower: r.canonical for r in found} == {
        "x": "Second", "first": "Third", "second": "Second", "third": "Third",
    }
    assert len(found) == 4


def test_alias_json_and_reverse_lookup(spark, tmp_path):
    path = tmp_path / "names.json"
    path.write_text(json.dumps(NAMES, indent=1))
    entries = aliases.read_alias_json(spark, str(path))
    literal = aliases.alias_entries(spark, NAMES)
    same = [sorted(aliases.alias_lookup(e).collect()) for e in (entries, literal)]
    assert same[0] == same[1]
    df = spark.createDataFrame([("Boston Celtics",), ("Nobody",)], "team string")
    short = aliases.team_abbreviation(df, entries, "basketball", "team", "abbr")
    assert {r.team: r.abbr for r in short.collect()} == {"Boston Celtics": "BOS", "Nobody": None}
    feed = aliases.source_alias(df, entries, "basketball", "feed", "team", "feed")
    assert {r.feed for r in feed.collect()} == {None}


def test_basketball_bronze_and_silver(spark, lookup):
    log = spark.createDataFrame(
        [
            ("1", "2024-10-22", 1, "Los Angeles Lakers", "LAL vs. BOS", 110, "W", 240),
            ("1", "2024-10-22", 2, "Boston Celtics", "BOS @ LAL", 105, "L", 240),
            ("2", "2024-10-23", 1, "LA Lakers", "LAL @ GSW", 90, "L", 240),
        ],
        schemas.raw("team_game_log"),
    )
    games = bronze.basketball_games(log, "2024-25", F.lit(STAMP))
    (game,) = games.collect()
    assert (game.home_team_id, game.away_team_id, game.status) == (1, 2, "Final")
    again = games.withColumns(
        {"extract_timestamp": F.lit(STAMP + dt.timedelta(days=1)), "home_score": F.lit(111)}
    )
    (row,) = silver.basketball_games(games.unionByName(again), lookup).collect()
    assert (row.home_team, row.home_score, row.home_win, row.total_points) == (
        "Los Angeles Lakers", 111, True, 216,
    )
    unplayed = games.withColumn("away_score", F.lit(None).cast("bigint"))
    (row,) = silver.basketball_games(unplayed, lookup).collect()
    assert (row.home_win, row.total_points) == (None, None)


def test_basketball_players(spark, lookup):
    raw = spark.createDataFrame(
        [
            ("22024", 23, " L. James ", 1, "LAL", "LA Lakers", "1", "2024-10-22", "LAL vs. BOS", "W",
             35.0, 25, 7, 8, 1, 1, 3, 10, 20, 2, 6, 3, 0, 5.0),
            ("22024", 7, "J. Brown", 2, "BOS", "Boston Celtics", "1", "2024-10-22", "BOS @ LAL", "L",
             None, None, 7, 8, 1, 1, 3, 0, 0, 2, 5, 0, 0, None),
        ],
        schemas.raw("player_game_log"),
    )
    lines = bronze.basketball_players(raw, "2024-25", F.lit(STAMP))
    assert [r.is_home for r in lines.orderBy("player_id").collect()] == [False, True]
    rows = {r.player_id: r for r in silver.basketball_players(lines, lookup).collect()}
    james, brown = rows[23], rows[7]
    assert (james.player_name, james.team, james.field_goal_pct) == (
        "L. James", "Los Angeles Lakers", 0.5,
    )
    assert james.free_throw_pct is None
    assert (brown.minutes, brown.points, brown.plus_minus, brown.field_goal_pct) == (0.0, 0, 0.0, None)


def test_missing_required_source_column_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "TEAM_ID int")
    with pytest.raises(ValueError, match="team_name"):
        bronze.basketball_teams(df, "2024-25")


def schedule(spark):
    return spark.createDataFrame(
        [
            ("g1", 2024, 1, "2024-09-05", "BAL", "KC", 20, 27, None),
            ("g2", 2024, 1, "bad", "PHI", "GB", 34, 29, "OT"),
            ("g3", 2024, 2, "2024-09-15", "CIN", "KC", None, None, "0"),
        ],
        "game_id string, season bigint, week bigint, gameday string, home_team string, "
        "away_team string, home_score bigint, away_score bigint, overtime string",
    )


def test_football_games(spark, lookup):
    games = bronze.football_games(schedule(spark), 2024, extracted_at=F.lit(STAMP))
    assert games.columns == schemas.bronze("football/games").names
    rows = {r.game_id: r for r in silver.football_games(games, lookup).collect()}
    assert (rows["g1"].away_team, rows["g1"].home_win, rows["g1"].total_points) == (
        "Kansas City Chiefs", False, 47,
    )
    assert (rows["g2"].game_date, rows["g2"].overtime) == (None, True)
    assert (rows["g3"].overtime, rows["g3"].home_win, rows["g3"].total_points) == (False, None, None)
    assert bronze.football_games(schedule(spark), 2024, week=2).count() == 1
    assert bronze.football_teams(schedule(spark), 2024).count() == 4


def test_football_players(spark, lookup):
    weeks = spark.createDataFrame(
        [
            ("p1", "P.M", " P. Mahomes ", "KC", 1, 20, 28, 291.0, 1, 24.0, 0, 0.0),
            ("p2", "J.H", "J. Hurts", None, 1, 20, 34, 278.0, 2, 33.0, 2, None),
        ],
        "player_id string, player_name string, player_display_name string, team string, "
        "week bigint, completions bigint, attempts bigint, passing_yards double, "
        "passing_tds bigint, rushing_yards double, rushing_tds bigint, receiving_yards double",
    )
    lines = bronze.football_players(weeks, 2024, extracted_at=F.lit(STAMP))
    rows = {r.player_id: r for r in silver.football_players(lines.union(lines), lookup).collect()}
    assert (rows["p1"].player_name, rows["p1"].team) == ("P. Mahomes", "Kansas City Chiefs")
    assert (rows["p1"].total_yards, rows["p1"].passing_attempts) == (315.0, 28)
    assert (rows["p2"].total_tds, rows["p2"].team, rows["p2"].targets) == (4, None, 0)


def test_soccer_matches(spark, lookup):
    contract = schemas.bronze("soccer/matches")
    kickoff = dt.datetime(2024, 9, 14)

    def match(home, away, hg, ag, stamp=STAMP):
        return (stamp, "2024-2025", "PL", kickoff, home, away, hg, ag, None, None, "V", None, None, None)

    later = STAMP + dt.timedelta(days=1)
    rows = [
        match("Arsenal", "Wolves", 1.0, 0.0),
        match("Arsenal", "wolverhampton wanderers", 2.0, 0.0, later),
        match("Leeds", "Hull", None, None),
        match("Hull", "Leeds", 1.0, 1.0),
    ]
    found = silver.soccer_matches(spark.createDataFrame(rows, contract), lookup).collect()
    by_home = {r.home_team: r for r in found}
    key = "2024-2025_2024-09-14 00:00:00_Arsenal_Wolverhampton Wanderers"
    assert by_home["Arsenal"].match_id == hashlib.md5(key.encode()).hexdigest()[:12]
    assert (by_home["Arsenal"].home_goals, by_home["Arsenal"].result) == (2, "H")
    assert (by_home["Leeds"].result, by_home["Hull"].result) == (None, "D")


def test_soccer_players_without_some_statistics(spark, lookup):
    texts = spark.createDataFrame(
        [("A. Player ", "90", "1", "n/a"), (None, "90", "0", "1")],
        "Player string, Min string, Gls string, SoT string",
    )
    lines = bronze.soccer_players(texts, "2024-2025", "PL", F.lit(STAMP))
    (row,) = silver.soccer_players(lines, lookup).collect()
    assert (row.player_name, row.minutes, row.goals, row.shots_on_target) == ("A. Player", 90, 1, 0)
    assert (row.match_id, row.key_passes, row.tackles, row.is_home) == ("", 0, 0, False)


def test_empty_input_keeps_its_schema(spark, lookup):
    for project, dataset, table in [
        (silver.basketball_games, "basketball/games", "nba_games"),
        (silver.basketball_players, "basketball/player_stats", "nba_player_games"),
        (silver.football_games, "football/games", "nfl_games"),
        (silver.football_players, "football/player_stats", "nfl_players"),
        (silver.soccer_matches, "soccer/matches", "soccer_matches"),
        (silver.soccer_players, "soccer/player_stats", "soccer_player_matches"),
    ]:
        empty = project(spark.createDataFrame([], schemas.bronze(dataset)), lookup)
        assert empty.count() == 0
        assert [(f.name, f.dataType) for f in empty.schema] == [
            (f.name, f.dataType) for f in schemas.gold(table)
        ]


def test_union_of_drifted_frames(spark):
    whole = spark.createDataFrame([(1, 5)], "id int, score int")
    broken = spark.createDataFrame([(2, 5.5, "x")], "id bigint, score double, extra string")
    contract = schemas.T.StructType.fromDDL("id bigint, score double, note string")
    union = projection.union_conformed([whole, broken], contract)
    assert sorted(map(tuple, union.collect())) == [(1, 5.0, None), (2, 5.5, None)]
    wide = projection.union_by_name([whole, broken])
    assert wide.columns == ["id", "score", "extra"]


def test_dates_overflow_and_times(spark):
    texts = ["2024-09-14", "2024-09-14 12:30:00", "Sep 14, 2024", "September 14, 2024", "09/14/2024", "20240914", "14 Sep 2024"]
    rows = spark.createDataFrame([(x,) for x in [*texts, "12:30", "TBD", None, "09/31/2024"]], "t string")
    found = [r[0] for r in rows.select(fn.coerce_date(F.col("t"))).collect()]
    assert [str(x) for x in found[:7]] == ["2024-09-14"] * 7 and found[7:] == [None] * 4
    numbers = spark.createDataFrame([(float("inf"),), (1e30,), (-2.9,), (None,)], "x double")
    assert [r[0] for r in numbers.select(fn.count_or_zero(F.col("x"))).collect()] == [0, 0, -2, 0]


def test_matches_with_one_id_both_stay(spark, monkeypatch):
    monkeypatch.setattr(silver, "hash_id", lambda *parts: F.lit("0" * 12))
    contract = schemas.bronze("soccer/matches")
    base = {f.name: None for f in contract} | {"season": "s", "away_team": "b"}
    rows = spark.createDataFrame([base | {"home_team": x} for x in ("a", "c", "a")], contract)
    lookup = aliases.alias_lookup(aliases.alias_entries(spark, {}))
    found = silver.soccer_matches(rows, lookup).collect()
    assert sorted((r.match_id, r.home_team) for r in found) == [("0" * 12, "a"), ("0" * 12, "c")]
