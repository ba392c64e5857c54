"""Standings, splits, form and records on hand-computed cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlake.operators import form, pairing, records, splits, standings
from matchlake.operators.top_n import deduplicate, top_n_per_group
from matchlake.sinks import writers

MATCH = (
    "match_id string, season string, league string, match_date date, home_team string, "
    "away_team string, home_goals bigint, away_goals bigint, home_xg double, away_xg double, "
    "result string, venue string"
)
GAME = (
    "game_id string, season string, game_date date, home_team_id bigint, home_team string, "
    "away_team_id bigint, away_team string, home_score bigint, away_score bigint, "
    "home_win boolean, total_points bigint"
)


def day(n):
    return dt.date(2024, 9, n)


@pytest.fixture(scope="module")
def soccer(spark):
    pl, season = "Premier League", "2024-2025"
    return spark.createDataFrame(
        [
            ("m1", season, pl, day(14), "Arsenal", "Wolves", 2, 0, 2.1, 0.5, "H", None),
            ("m2", season, pl, day(21), "Wolves", "Arsenal", 1, 1, 0.8, 1.3, "D", None),
            ("m3", season, pl, day(28), "Arsenal", "Man City", 0, 1, 1.0, None, "A", None),
        ],
        MATCH,
    )


@pytest.fixture(scope="module")
def games(spark):
    season = "2024-25"
    return spark.createDataFrame(
        [
            ("g1", season, day(22), 1, "Lakers", 2, "Celtics", 110, 105, True, 215),
            ("g2", season, day(24), 2, "Celtics", 1, "Lakers", 120, 100, True, 220),
            ("g3", season, day(26), 1, "Lakers", 3, "Warriors", 115, 108, True, 223),
        ],
        GAME,
    )


@pytest.fixture(scope="module")
def weeks(spark):
    rows = [
        (2024, day(5), "Ravens", "Chiefs", 20, 27),
        (2024, day(6), "Eagles", "Packers", 34, 29),
        (2024, day(15), "Bengals", "Chiefs", 25, 26),
        (2023, day(1), "Jets", "Bills", 10, 10),
        (2024, day(20), "Jets", "Bills", None, None),
    ]
    frame = spark.createDataFrame(
        rows,
        "season bigint, game_date date, home_team string, away_team string, "
        "home_score bigint, away_score bigint",
    )
    return frame.withColumn("home_win", F.col("home_score") > F.col("away_score"))


def by_team(df):
    return {row.team: row for row in df.collect()}


def test_league_standings(soccer):
    table = by_team(standings.league_standings(soccer))
    assert {t: (r.rank, r.points, r.goal_difference) for t, r in table.items()} == {
        "Arsenal": (1, 4, 1),
        "Man City": (2, 3, 1),
        "Wolves": (3, 1, -2),
    }
    arsenal = table["Arsenal"]
    assert (arsenal.wins, arsenal.draws, arsenal.losses) == (1, 1, 1)
    assert (arsenal.xg_for, arsenal.xg_against, arsenal.xg_difference) == (4.4, 1.3, 3.1)


def test_standings_skip_unplayed_and_split_ties_by_name(spark):
    rows = [
        ("a", "s", "l", day(1), "B", "A", 1, 1, 0.0, 0.0, "D", None),
        ("b", "s", "l", day(2), "C", "A", None, None, None, None, None, None),
    ]
    table = standings.league_standings(spark.createDataFrame(rows, MATCH)).orderBy("rank")
    assert [(r.team, r.matches_played) for r in table.collect()] == [("A", 1), ("B", 1)]


def test_winpct_standings(games):
    table = by_team(standings.winpct_standings(games))
    lakers = table["Lakers"]
    assert (lakers.rank, lakers.wins, lakers.losses, lakers.win_pct) == (1, 2, 1, 0.667)
    assert (lakers.home_wins, lakers.home_losses, lakers.away_wins, lakers.away_losses) == (2, 0, 0, 1)
    assert lakers.points_per_game == 108.3
    assert [table[t].rank for t in ("Celtics", "Warriors")] == [2, 3]


def test_winpct_standings_with_ties(weeks):
    table = {(r.season, r.team): r for r in standings.winpct_standings_ties(weeks).collect()}
    chiefs = table[2024, "Chiefs"]
    assert (chiefs.rank, chiefs.wins, chiefs.losses, chiefs.ties) == (1, 2, 0, 0)
    assert (chiefs.points_for, chiefs.points_against, chiefs.point_differential) == (53, 45, 8)
    assert (chiefs.home_wins, chiefs.away_wins) == (0, 2)
    assert table[2024, "Eagles"].rank == 2
    jets, bills = table[2023, "Jets"], table[2023, "Bills"]
    assert (jets.ties, jets.losses, jets.home_losses, jets.win_pct) == (1, 0, 0, 0.0)
    assert (bills.ties, bills.wins, bills.away_wins, bills.away_losses) == (1, 0, 0, 0)
    assert (2024, "Jets") not in table


def test_home_away_splits(soccer, games):
    arsenal = by_team(splits.home_away_splits(soccer))["Arsenal"]
    assert (arsenal.home_matches, arsenal.home_wins, arsenal.home_losses) == (2, 1, 1)
    assert (arsenal.away_matches, arsenal.away_draws) == (1, 1)
    table = by_team(splits.home_away_splits_avg(games))
    assert (table["Lakers"].home_wins, table["Lakers"].away_losses) == (2, 1)
    assert (table["Warriors"].home_games, table["Warriors"].home_avg_points_scored) == (0, 0.0)


def test_splits_equal_a_full_outer_join_even_for_null_keys(spark):
    """NULL keys never match in a join: such a team keeps two rows."""
    rows = [
        ("1", "s", None, day(1), "A", "B", 1, 0, 0.1, None, "H", None),
        ("2", "s", None, day(2), "B", "A", 1, 1, 0.1, 0.3, "D", None),
        ("3", "s", "l", day(3), "A", "B", 1, None, 0.1, 0.2, None, None),
        ("4", None, "l", day(4), None, "B", 1, 3, 0.1, 0.2, "A", None),
        ("5", "s", "l", day(5), "C", "A", None, 3, 0.1, 0.2, None, None),
    ]
    matches = spark.createDataFrame(rows, MATCH)
    played = matches.where("home_goals IS NOT NULL")

    def half(side, other, won, lost):
        return played.groupBy(F.col(f"{side}_team").alias("team"), "league", "season").agg(
            F.count("*").alias("n"),
            F.sum(F.when(F.col("result") == won, 1).otherwise(0)).alias("w"),
            F.sum(F.when(F.col("result") == lost, 1).otherwise(0)).alias("l"),
            F.sum(f"{side}_goals").alias("f"),
            F.sum(f"{other}_goals").alias("a"),
        )

    h, a = half("home", "away", "H", "A").alias("h"), half("away", "home", "A", "H").alias("a")
    keys = ["team", "league", "season"]
    condition = [F.col(f"h.{k}") == F.col(f"a.{k}") for k in keys]
    joined = h.join(a, condition, "full_outer").select(
        *[F.coalesce(f"h.{k}", f"a.{k}").alias(k) for k in keys],
        *[F.coalesce(f"{s}.{m}", F.lit(0)).alias(s + m) for s in "ha" for m in "nwlfa"],
    )
    ours = splits.home_away_splits(matches).select(
        *keys,
        *[
            f"{s}_{m}"
            for s in ("home", "away")
            for m in ("matches", "wins", "losses", "goals_for", "goals_against")
        ],
    )
    assert sorted(map(repr, map(tuple, joined.collect()))) == sorted(
        map(repr, map(tuple, ours.collect()))
    )


def test_home_summaries(soccer, games):
    arsenal = by_team(splits.home_form_summary(soccer))["Arsenal"]
    assert (arsenal.matches, arsenal.home_points, arsenal.goals_scored) == (2, 3, 2)
    lakers = by_team(splits.home_avg_summary(games))["Lakers"]
    assert (lakers.games, lakers.home_wins, lakers.avg_home_score) == (2, 2, 112.5)


def test_team_form(soccer):
    arsenal = by_team(form.team_form(soccer, n_matches=2))["Arsenal"]
    assert (arsenal.form_string, arsenal.points, arsenal.as_of_date) == ("LD", 1, day(28))
    assert arsenal.last_n_matches == 2
    assert by_team(form.team_form(soccer))["Arsenal"].form_string == "LDW"


def test_team_form_counts_unplayed_as_lost_unless_told_not_to(spark, soccer):
    later = spark.createDataFrame(
        [("m4", "2024-2025", "Premier League", day(30), "Wolves", "Leeds", *[None] * 6)], MATCH
    )
    matches = soccer.unionByName(later)
    assert by_team(form.team_form(matches))["Wolves"].form_string == "LDL"
    assert by_team(form.team_form(matches, completed_only=True))["Wolves"].form_string == "DL"


def test_team_form_avg(games):
    lakers = by_team(form.team_form_avg(games, n_games=2))["Lakers"]
    assert (lakers.wins, lakers.losses, lakers.avg_points_scored) == (1, 1, 107.5)
    warriors = by_team(form.team_form_avg(games))["Warriors"]
    assert (warriors.wins, warriors.losses, warriors.games_in_window) == (0, 10, 1)


def test_head_to_head(soccer):
    pairs = {(r.team_a, r.team_b): r for r in records.head_to_head(soccer).collect()}
    pair = pairs["Arsenal", "Wolves"]
    assert (pair.total_matches, pair.team_a_wins, pair.draws, pair.team_b_wins) == (2, 1, 1, 0)
    assert (pair.team_a_goals, pair.team_b_goals) == (3, 1)
    assert pairs["Arsenal", "Man City"].team_b_wins == 1


def test_team_season_totals(weeks):
    totals = {(r.season, r.team): r for r in records.team_season_totals(weeks).collect()}
    chiefs = totals[2024, "Chiefs"]
    assert (chiefs.games_played, chiefs.wins, chiefs.away_wins, chiefs.point_differential) == (2, 2, 2, 8)
    assert totals[2023, "Jets"].ties == 1
    assert (2024, "Jets") not in totals


def test_invariants(soccer, games):
    table = standings.winpct_standings(games).agg(F.sum("wins"), F.sum("losses")).first()
    assert table[0] == table[1]
    totals = standings.league_standings(soccer).agg(F.sum("goals_for"), F.sum("goals_against"))
    assert totals.first()[0] == totals.first()[1]


LOG = "game_id string, game_date string, team_id bigint, team_name string, matchup string, pts bigint"


def test_pairing_sides_gives_the_games_back(games):
    marked = games.withColumns(
        {
            "h": F.concat("home_team", F.lit(" vs. "), "away_team"),
            "a": F.concat("away_team", F.lit(" @ "), "home_team"),
        }
    )
    log = pairing.match_sides(
        marked,
        ["game_id", "game_date"],
        {
            "team_id": ("home_team_id", "away_team_id"),
            "team_name": ("home_team", "away_team"),
            "matchup": ("h", "a"),
            "pts": ("home_score", "away_score"),
        },
    )
    wanted = games.select(
        "game_id", "game_date", "home_team_id", "home_team", "home_score", "away_team_id",
        "away_team", "away_score",
    )
    assert sorted(pairing.pair_home_away(log).collect()) == sorted(wanted.collect())
    assert sorted(pairing.pair_latest(log, "game_date").collect()) == sorted(wanted.collect())


def test_pairing_drops_lone_rows_and_multiplies_copies(spark):
    log = spark.createDataFrame(
        [
            ("1", "2024-01-01", 1, "A", "A vs. B", 10),
            ("1", "2024-01-01", 2, "B", "B @ A", 9),
            ("1", "2024-01-02", 2, "B", "B @ A", 8),
            ("2", "2024-01-01", 3, "C", "C vs. D", 7),
        ],
        LOG,
    )
    assert pairing.pair_home_away(log).count() == 2
    (latest,) = pairing.pair_latest(log, "game_date").collect()
    assert (latest.home_score, latest.away_score) == (10, 8)


def test_deduplicate(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "d"), (None, None, "e")],
        "k string, t int, v string",
    )
    last = deduplicate(df, ["k"], ["t"])
    assert sorted(r.v for r in last.collect()) == ["c", "d"]
    assert sorted(r.v for r in deduplicate(last, ["k"], ["t"]).collect()) == ["c", "d"]
    assert sorted(r.v for r in deduplicate(df, ["k"], ["t"], "first").collect()) == ["a", "e"]
    with pytest.raises(ValueError):
        deduplicate(df, ["k"], ["t"], "any")


def test_top_n_beyond_the_optimizer_threshold(spark):
    """One group holds most rows; slicing must give the same rows as one window."""
    df = spark.range(5000).selectExpr("if(id % 10 > 0, 0, id) AS k", "id % 977 AS v", "id")
    order = [F.col("v").desc(), F.col("id")]
    small = top_n_per_group(df, ["k"], order, 700)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        sliced = top_n_per_group(df, ["k"], order, 700, slices=4)
        assert sorted(sliced.collect()) == sorted(small.collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, soccer, tmp_path):
    """One scan per query, no Generate, groups trimmed before the shuffle."""
    path = writers.write_dataset(soccer, str(tmp_path / "matches"))
    stored = spark.read.schema(MATCH).parquet(path)
    for query in (standings.league_standings, splits.home_away_splits, records.head_to_head):
        plan = plan_of(query(stored))
        assert plan.count("FileScan") == 1 and "Generate" not in plan, plan
    splits_plan = plan_of(splits.home_away_splits(stored))
    assert splits_plan.count("Exchange") == 1 and "Join" not in splits_plan
    form_plan = plan_of(form.team_form(stored))
    assert form_plan.count("Exchange") == 1
    assert "row_number(), 5, Partial" in form_plan
    assert "row_number(), 1, Partial" in plan_of(deduplicate(stored, ["match_id"], ["match_date"]))


def test_filters_on_a_result_reach_the_files(spark, soccer, games, weeks, tmp_path):
    """Season and league filters pass through ranks, sums and both sides."""

    def stored(df, name):
        return spark.read.schema(df.schema).parquet(writers.write_dataset(df, f"{tmp_path}/{name}"))

    matches, nba, nfl = stored(soccer, "m"), stored(games, "g"), stored(weeks, "w")
    season, league = "season = '2024-25'", "league = 'x'"
    for result, condition in [
        (standings.league_standings(matches), season),
        (standings.winpct_standings(nba), season),
        (standings.winpct_standings_ties(nfl), "season = 2024"),
        (splits.home_form_summary(matches), season),
        (splits.home_avg_summary(nba), season),
        (splits.home_away_splits(matches), season),
        (splits.home_away_splits_avg(nba), season),
        (form.team_form(matches), league),
        (records.head_to_head(matches), league),
        (records.team_season_totals(nfl), "season = 2024"),
    ]:
        plan = plan_of(result.where(condition))
        assert f"EqualTo({condition.split()[0]}," in plan, plan
