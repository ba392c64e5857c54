"""Tables as of a date, weekly context, the remaining feeds, and runs of football, players and a sport of one's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators import bronze, quality, records, standings
from matchlake.plans import jobs
from matchlake.session import shared_folder
from matchlake.sources import scans
from matchlake.workloads import fixtures as fx
from matchlake.workloads import refine_queries as rq
from matchlake.workloads import storage_queries as sq


def _team_list(spark: SparkSession, d: str) -> DataFrame:
    """The teams of a landed game log."""
    root = shared_folder(spark, "teams")
    log = fx.team_log(spark, d).selectExpr(
        "CAST(game_id AS STRING) AS GAME_ID", "CAST(game_date AS STRING) AS GAME_DATE",
        "CAST(team_id AS BIGINT) AS TEAM_ID", "team_name AS TEAM_NAME", "matchup AS MATCHUP",
    )
    log.write.json(root)
    return bronze.team_list(scans.scan_landing(spark, root, "team_game_log"))


def _landing_team_metrics(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark, "metrics")
    rq._raw_metrics(spark, d).write.json(root)
    return bronze.basketball_teams(scans.scan_landing(spark, root, "team_metrics"), season="2024-25").drop("extract_timestamp")


def _landing_player_weeks(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark, "weeks")
    rq._raw_player_weeks(spark, d).write.option("header", True).csv(root)
    return bronze.football_players(scans.scan_landing(spark, root, "player_weeks", "csv"), season=2024).drop("extract_timestamp")


def _games_with_week_players(spark: SparkSession, d: str) -> DataFrame:
    """Games beside the weekly sums of the suppliers' nations, which stand for the players' teams."""
    weeks = spark.sql(
        """SELECT year(o_orderdate) AS season, weekofyear(o_orderdate) AS week, n_name AS team, l_quantity AS points
           FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
           JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey""",
        **{name: fx.table(spark, d, name) for name in ("lineitem", "orders", "supplier", "nation")},
    )
    found = records.with_week_context(fx.games(spark, d).where("week % 2 = 0 OR season > 1995"), weeks.where("week % 3 > 0"), "points")
    return found.select("game_id", "season", "week", "home_team", "away_team", "home_players", "home_points", "away_players", "away_points")


def _lake(spark: SparkSession, sport: str, season: str, formats: dict[str, str], **more) -> jobs.Lake:
    root = shared_folder(spark, "lake")
    return jobs.Lake(
        landing=f"{root}/landing", bronze=f"{root}/bronze", silver=f"{root}/silver", schema=sq._fresh_schema(spark),
        seasons={sport: [season]}, formats=formats, **more,
    )


def _medallion_football(spark: SparkSession, d: str) -> DataFrame:
    """From landed schedules and weekly player lines to the players of the gold layer."""
    lake = _lake(spark, "football", "2024", {"schedules": "csv"})
    schedule = rq._schedule(spark, d).drop("overtime")
    schedule.write.option("header", True).csv(f"{lake.landing}/football/schedules/season=2024")
    weeks = fx.table(spark, d, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"), F.min("l_suppkey").alias("s"))
    weeks = weeks.selectExpr(
        "CAST(l_partkey AS STRING) AS player_id", "'P.' || l_partkey AS player_name",
        "' Player ' || l_partkey AS player_display_name", "l_linenumber AS week",
        "CAST(q AS BIGINT) AS attempts", "4 * q AS passing_yards", "s % 4 AS passing_tds", "q / 2 AS rushing_yards",
    )
    weeks.write.json(f"{lake.landing}/football/player_weeks/season=2024", compression="gzip")
    jobs.run(spark, lake, sport="football")
    return spark.table(f"{lake.schema}.nfl_players").select(
        "player_id", "season", "week", "player_name", "passing_attempts", "passing_yards", "passing_tds", "rushing_yards", "total_yards", "total_tds"
    )


def _medallion_players(spark: SparkSession, d: str) -> DataFrame:
    """From a landed player log to sums over the player games of the gold layer."""
    lake = _lake(spark, "basketball", "all", {})
    rq._raw_player_log(spark, d).write.json(f"{lake.landing}/basketball/player_game_log/season=all", compression="gzip")
    jobs.run(spark, lake, sport="basketball")
    return spark.table(f"{lake.schema}.nba_player_games").groupBy("player_id", "player_name").agg(
        F.count("*").alias("games"), F.sum("points").alias("points"), F.sum("assists").alias("assists"), F.count_if("is_home").alias("home_games")
    )


def _source_plugin(spark: SparkSession, d: str) -> DataFrame:
    """A sport that the library does not know, one season per kind of event, refined by rules of its own."""
    events = fx.table(spark, d, "events").where("event_type IS NOT NULL")

    def build(spark: SparkSession, lake: jobs.Lake, season: str) -> DataFrame:
        own = fx.table(spark, d, "events").where(F.col("event_type") == season)
        return own.select(F.col("event_id").alias("game_id"), F.col("event_type").alias("season"), "user_id", "value")

    def project(snapshots: DataFrame, lookup: DataFrame) -> DataFrame:
        return snapshots.select("game_id", "season", "user_id", F.when(F.col("game_id") % 10 > 0, F.floor("value")).alias("score"))

    refined = jobs.Refinement(
        "esports", "games", "esports_games", project,
        T.StructType.fromDDL("game_id bigint, season string, user_id bigint, value double, date string"),
        T.StructType.fromDDL("game_id bigint, season string, user_id bigint, score bigint"), (quality.Rule("score", "not_null"),),
    )
    seasons = sorted(row[0] for row in events.select("event_type").distinct().collect())
    lake = _lake(spark, "esports", "", {}, sources=[jobs.Source("esports", "games", build)], refined=[refined], quarantine=shared_folder(spark, "aside"))
    lake.seasons = {"esports": seasons}
    jobs.ingest(spark, lake, "esports", parallel=4)
    jobs.refine(spark, lake)
    table = spark.table(f"{lake.schema}.esports_games")
    return table.groupBy("season").agg(F.count("*").alias("n"), F.sum("game_id").alias("ids"), F.sum("score").alias("score"))


QUERIES = {
    "standings_by_month": lambda spark, d: standings.standings_by_month(fx.matches(spark, d)),
    "team_list": _team_list,
    "landing_team_metrics": _landing_team_metrics,
    "landing_player_weeks": _landing_player_weeks,
    "games_with_week_players": _games_with_week_players,
    "medallion_football": _medallion_football,
    "medallion_players": _medallion_players,
    "source_plugin": _source_plugin,
}

ORACLES = {
    "standings_by_month": f"""WITH {fx.MATCHES_SQL},
        sides AS (
            SELECT league, season, match_date AS day, home_team AS team, home_goals AS f, away_goals AS a,
                   result = 'H' AS won, result = 'A' AS lost, result = 'D' AS drawn FROM fx_matches WHERE home_goals IS NOT NULL
            UNION ALL SELECT league, season, match_date, away_team, away_goals, home_goals, result = 'A', result = 'H', result = 'D'
            FROM fx_matches WHERE home_goals IS NOT NULL),
        months AS (SELECT DISTINCT league, season, last_day(day) AS as_of FROM sides),
        days AS (
            SELECT league, season, last_day(day) AS month, team, count(*) AS n, count(*) FILTER (won) AS w,
                   count(*) FILTER (drawn) AS d, count(*) FILTER (lost) AS l, sum(f) AS f, sum(a) AS a
            FROM sides GROUP BY ALL),
        sums AS (
            SELECT league, season, as_of, team, CAST(sum(n) AS BIGINT) AS matches_played, CAST(sum(w) AS BIGINT) AS wins,
                   CAST(sum(d) AS BIGINT) AS draws, CAST(sum(l) AS BIGINT) AS losses, CAST(sum(f) AS BIGINT) AS goals_for,
                   CAST(sum(a) AS BIGINT) AS goals_against
            FROM months JOIN days USING (league, season) WHERE month <= as_of GROUP BY ALL),
        ranked AS (
            SELECT *, goals_for - goals_against AS goal_difference, 3 * wins + draws AS points,
                   row_number() OVER (PARTITION BY league, season, as_of ORDER BY 3 * wins + draws DESC NULLS LAST,
                       goals_for - goals_against DESC NULLS LAST, goals_for DESC NULLS LAST, team) AS rank
            FROM sums)
        SELECT *, lag(rank) OVER (PARTITION BY league, season, team ORDER BY as_of) - rank AS places_gained FROM ranked""",
    "team_list": f"""WITH {fx.TEAM_LOG_SQL}
        SELECT DISTINCT CAST(team_id AS BIGINT) AS id, team_name AS full_name, team_name AS abbreviation FROM fx_team_log""",
    "landing_team_metrics": rq.ORACLES["proj_optional_cols"],
    "landing_player_weeks": rq.ORACLES["proj_player_week"],
    "games_with_week_players": f"""WITH {fx.GAMES_SQL},
        context AS (
            SELECT year(o_orderdate) AS season, week(o_orderdate) AS week, n_name AS team, count(*) AS players, sum(l_quantity) AS points
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
            WHERE week(o_orderdate) % 3 > 0 GROUP BY ALL)
        SELECT game_id, g.season, g.week, home_team, away_team, coalesce(h.players, 0) AS home_players, h.points AS home_points,
               coalesce(a.players, 0) AS away_players, a.points AS away_points
        FROM fx_games g
        LEFT JOIN context h ON h.season = g.season AND h.week = g.week AND h.team = home_team
        LEFT JOIN context a ON a.season = g.season AND a.week = g.week AND a.team = away_team
        WHERE g.week % 2 = 0 OR g.season > 1995""",
    "medallion_football": """
        WITH weeks AS (SELECT l_partkey AS p, l_linenumber AS week, sum(l_quantity) AS q, min(l_suppkey) % 4 AS tds FROM lineitem GROUP BY ALL)
        SELECT CAST(p AS VARCHAR) AS player_id, CAST(2024 AS BIGINT) AS season, CAST(week AS BIGINT) AS week, 'Player ' || p AS player_name,
               CAST(q AS BIGINT) AS passing_attempts, 4 * q AS passing_yards, tds AS passing_tds, q / 2 AS rushing_yards,
               4 * q + q / 2 AS total_yards, tds AS total_tds
        FROM weeks""",
    "medallion_players": """
        SELECT l_partkey AS player_id, 'Player ' || l_partkey AS player_name, count(*) AS games,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS points, CAST(sum(l_suppkey % 15) AS BIGINT) AS assists,
               count(*) FILTER (l_linestatus = 'F') AS home_games
        FROM lineitem GROUP BY ALL""",
    "source_plugin": """
        SELECT event_type AS season, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(floor(value)) AS BIGINT) AS score
        FROM events WHERE event_type IS NOT NULL AND event_id % 10 > 0 AND value IS NOT NULL GROUP BY event_type""",
}
