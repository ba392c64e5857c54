import datetime as dt

from pyspark.sql import functions as F

from matchlake.operators import bronze, records, standings


def test_tables_month_by_month(spark):
    rows = [
        ("L", "1", dt.date(2024, 1, 5), "A", "B", 2, 0, "H"), ("L", "1", dt.date(2024, 1, 9), "B", "C", 1, 1, "D"),
        ("L", "1", dt.date(2024, 2, 3), "B", "A", 3, 0, "H"), ("L", "1", dt.date(2024, 4, 1), "C", "D", 5, 0, "H"),
        ("L", "1", None, "D", "A", 9, 0, "H"), ("L", "1", dt.date(2024, 3, 1), "D", "A", None, None, None),
        ("L", "2", dt.date(2025, 1, 1), "A", "B", 0, 0, "D"),
    ]
    matches = spark.createDataFrame(rows, "league string, season string, match_date date, home_team string, away_team string, home_goals int, away_goals int, result string")
    found = standings.standings_by_month(matches).where("season = '1'").orderBy("as_of", "rank").collect()
    told = [(r["as_of"].month, r["rank"], r["team"], r["points"], r["goal_difference"], r["places_gained"]) for r in found]
    assert told == [
        (1, 1, "A", 3, 2, None), (1, 2, "C", 1, 0, None), (1, 3, "B", 1, -2, None),
        (2, 1, "B", 4, 1, 2), (2, 2, "A", 3, -1, -1), (2, 3, "C", 1, 0, -1),
        (4, 1, "C", 4, 5, 2), (4, 2, "B", 4, 1, -1), (4, 3, "A", 3, -1, -1), (4, 4, "D", 0, -5, None),
    ]
    assert standings.standings_by_month(matches.limit(0)).count() == 0


def test_last_month_is_the_final_table(spark):
    teams = ["A", "B", "C", "D", "E"]
    rows = [("L", "1", dt.date(2024, 1 + (i * 7 + j * 3) % 9, 1 + i), a, b, (i * 3 + j) % 4, (i + j * 5) % 3) for i, a in enumerate(teams) for j, b in enumerate(teams) if a != b]
    matches = spark.createDataFrame(rows, "league string, season string, match_date date, home_team string, away_team string, home_goals int, away_goals int")
    matches = matches.withColumn("result", F.expr("CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END")).withColumns({"home_xg": F.lit(None).cast("double"), "away_xg": F.lit(None).cast("double")})
    last = matches.agg(F.last_day(F.max("match_date"))).first()[0]
    final = standings.standings_by_month(matches).where(F.col("as_of") == last)
    same = ["league", "season", "rank", "team", "matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points"]
    assert sorted(map(tuple, final.select(same).collect())) == sorted(map(tuple, standings.league_standings(matches).select(same).collect()))


def test_one_shuffle_behind_the_sums(spark):
    matches = spark.createDataFrame([], "league string, season string, match_date date, home_team string, away_team string, home_goals int, away_goals int, result string")
    plan = standings.standings_by_month(matches)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_games_keep_one_row_beside_their_week(spark):
    games = spark.createDataFrame([(1, 2024, 1, "A", "B"), (2, 2024, 2, "B", "A"), (3, None, 1, "A", None)], "game_id int, season int, week int, home_team string, away_team string")
    weeks = spark.createDataFrame([(2024, 1, "A", 5), (2024, 1, "A", None), (2024, 1, "C", 1), (2024, 2, "A", 7), (None, 1, "A", 9)], "season int, week int, team string, yards int")
    rows = records.with_week_context(games, weeks, "yards").orderBy("game_id").collect()
    assert [(r["game_id"], r["home_players"], r["home_yards"], r["away_players"], r["away_yards"]) for r in rows] == [(1, 2, 5, 0, None), (2, 0, None, 1, 7), (3, 0, None, 0, None)]


def test_teams_go_by_their_latest_name(spark):
    log = spark.createDataFrame([("2023-01-01", 1, "Old", "OLD @ B"), ("2024-01-01", 1, "New", "NEW vs. B"), ("2024-01-02", None, "X", "X @ Y"), ("2024-01-02", 2, "B", None)], "GAME_DATE string, TEAM_ID long, TEAM_NAME string, MATCHUP string")
    assert sorted(tuple(r) for r in bronze.team_list(log).collect()) == [(1, "New", "NEW"), (2, "B", None)]
