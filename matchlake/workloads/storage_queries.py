"""Sources, sinks, checks and whole runs.

Each query writes tables derived from the given ones to a fresh folder on the
shared storage and reads them back through the readers of the library.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.operators import bronze, quality, silver
from matchlake.plans import jobs
from matchlake.session import shared_folder
from matchlake.sinks import writers
from matchlake.sources import aliases, scans
from matchlake.streaming.incremental import refresh_silver
from matchlake.workloads import fixtures as fx
from matchlake.workloads import gold_queries as gq
from matchlake.workloads import page_queries as pq
from matchlake.workloads import refine_queries as rq

_ORDER_COLUMNS = """o_orderkey AS game_id, o_orderstatus AS status,
    CAST(year(o_orderdate) AS STRING) AS season, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
    o_totalprice AS total"""
_ORDERS_SQL = f"SELECT {_ORDER_COLUMNS} FROM orders"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    return spark.sql(f"SELECT {_ORDER_COLUMNS} FROM {{orders}}", orders=orders)


def _scan_single(spark, d):
    path = f"{shared_folder(spark, 'single')}/season=wrong/games"
    return scans.scan_file(spark, writers.write_dataset(_orders(spark, d), path))


def _scan_tree(spark, d):
    """Dated folders whose files hold the season themselves and differ in columns."""
    root = shared_folder(spark, "tree")
    orders = _orders(spark, d)
    old, new = orders.where("season < '1996'"), orders.where("season >= '1996'")
    writers.write_dataset(old.drop("total"), f"{root}/season=a/date=2024-01-01/games")
    writers.write_dataset(new, f"{root}/season=b/date=2024-01-02/games")
    return scans.scan_tree(spark, root, "part-*.parquet")


def _scan_partition_pruned(spark, d):
    root = shared_folder(spark, "pruned")
    contract = _orders(spark, d).withColumn("date", F.lit("")).schema
    writers.write_snapshot(_orders(spark, d), root, "basketball", "orders", "2024-01-01")
    return scans.scan_bronze(
        spark, root, "basketball", "orders", season="1997", date="2024-01-01", contract=contract
    )


_CSV_COLUMNS = (
    "game_id", "week", "gameday", "home_team", "away_team", "home_score", "away_score",
    "overtime", "game_type", "spread_line", "result",
)


def _landing_json(spark, d):
    path = f"{shared_folder(spark, 'landing')}/player_game_log"
    rq._raw_player_log(spark, d).write.json(path, compression="gzip")
    return scans.scan_landing(spark, path, "player_game_log", "json")


def _landing_csv(spark, d):
    path = f"{shared_folder(spark, 'landing')}/schedules"
    rq._schedule(spark, d).drop("overtime").write.option("header", True).csv(path)
    return scans.scan_landing(spark, path, "schedules", "csv").select(*_CSV_COLUMNS)


def _landing_csv_mixed(spark, d):
    """Files of one feed whose columns stand in different orders."""
    path = f"{shared_folder(spark, 'landing')}/schedules"
    rows = rq._schedule(spark, d).drop("overtime")
    even = F.col("game_id").cast("bigint") % 2 == 0
    rows.where(even).write.option("header", True).csv(path)
    turned = rows.where(~even).select(*reversed(rows.columns))
    turned.write.mode("append").option("header", True).csv(path)
    return scans.scan_landing(spark, path, "schedules", "csv").select(*_CSV_COLUMNS)


def _landing_json_floats(spark, d):
    """Whole numbers as a feed with gaps writes them: 110.0."""
    path = f"{shared_folder(spark, 'landing')}/player_game_log"
    log = rq._raw_player_log(spark, d)
    whole = {f.name: F.col(f.name).cast("double") for f in log.schema if f.dataType.typeName() == "long"}
    log.withColumns(whole).write.json(path, compression="gzip")
    return scans.scan_landing(spark, path, "player_game_log", "json")


def _one_player(spark, d):
    path = f"{shared_folder(spark, 'landing')}/player_game_log"
    rq._raw_player_log(spark, d).write.parquet(path)
    log = scans.scan_landing(spark, path, "player_game_log", "parquet")
    return scans.one_player(log, 7).select("GAME_ID", "PLAYER_ID", "PTS", "MATCHUP")


def _bronze_snapshot(spark, d):
    """Two days are written, then the first again with other rows."""
    root = shared_folder(spark, "bronze")
    orders = _orders(spark, d)
    contract = orders.withColumn("date", F.lit("")).schema
    writers.write_snapshot(orders, root, "basketball", "orders", "2024-01-01")
    writers.write_snapshot(orders, root, "basketball", "orders", "2024-01-02")
    again = orders.where("season = '1997'").withColumn("status", F.lit("again"))
    writers.write_snapshot(again, root, "basketball", "orders", "2024-01-01")
    return scans.scan_bronze(spark, root, "basketball", "orders", contract=contract)


def _fresh_schema(spark: SparkSession) -> str:
    """A catalog schema of its own, with its tables on the shared storage."""
    schema = f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_folder(spark, schema)}'")
    return schema


def _load_append(spark, d):
    """The second load lacks a column and has the others in another order."""
    schema, orders = _fresh_schema(spark), _orders(spark, d)
    writers.load_table(orders.where("season < '1996'"), "games", schema)
    later = orders.where("season >= '1996'").select("season", "day", "game_id", "status")
    writers.load_table(later, "games", schema)
    writers.load_table(orders.where("season = 'none'"), "games", schema)
    return writers.query(spark, f"SELECT * FROM {schema}.games")


def _load_replace(spark, d):
    schema, orders = _fresh_schema(spark), _orders(spark, d)
    writers.load_table(orders, "games", schema, "replace")
    writers.load_table(orders.where("season >= '1996'").drop("day"), "games", schema, "replace")
    writers.load_table(orders.where("season = 'none'"), "games", schema, "replace")
    return spark.table(f"{schema}.games")


def _load_counts(spark, d):
    schema, orders = _fresh_schema(spark), _orders(spark, d)
    writers.load_table(orders, "games", schema, "replace")
    writers.load_table(orders, "games", schema)
    writers.load_table(orders.where("status = 'F'"), "finished", schema)
    return writers.row_counts(spark, "games", "finished", schema=schema)


def _gold_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select(
        F.col("match_id").cast("string").alias("match_id"),
        F.col("season").cast("string").alias("season"), "league", "match_date", "home_team",
        "away_team", F.col("home_goals").cast("bigint").alias("home_goals"),
        F.col("away_goals").cast("bigint").alias("away_goals"), "home_xg", "away_xg", "result",
        "venue",
    )


def _catalog_view(spark, d):
    """The standings view of the catalog over a loaded base table."""
    schema = _fresh_schema(spark)
    writers.init_schema(spark, schema)
    writers.load_table(_gold_matches(spark, d), "soccer_matches", schema, "append")
    return writers.query(
        spark,
        f"""SELECT league, season, rank, team, points, goal_difference, matches_played
            FROM {schema}.v_soccer_league_standings ORDER BY league, season, rank""",
    )


def _check_rules(spark, d):
    rules = [
        quality.Rule("c_custkey", "type", "bigint"),
        quality.Rule("c_custkey", "not_null"),
        quality.Rule("c_acctbal", "at_least", 0),
        quality.Rule("c_name", "type", "int"),
        quality.Rule("c_phone", "present"),
    ]
    return quality.check_rules(fx.table(spark, d, "customer"), rules)


def _check_game_rules(spark, d):
    games = rq._bronze(spark, d, rq._GAME_COLUMNS).withColumn(
        "home_score", F.col("home_score") - 3
    )
    return quality.check_rules(games, quality.BASKETBALL_GAME_RULES)


def _quality_profile(spark, d):
    lines = fx.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_discount") > 0.05, F.lit(float("nan")))
        .otherwise(F.col("l_discount"))
        .alias("discount"),
    )
    return quality.quality_profile(lines, "lines")


def _medallion_refresh(spark, d):
    """A whole run from landing files to the standings view of the catalog."""
    root, schema = shared_folder(spark, "lake"), _fresh_schema(spark)
    log = fx.team_log(spark, d).selectExpr(
        "CAST(game_id AS STRING) AS GAME_ID", "CAST(game_date AS STRING) AS GAME_DATE",
        "CAST(team_id AS BIGINT) AS TEAM_ID", "' ' || lower(team_name) AS TEAM_NAME",
        "matchup AS MATCHUP", "CAST(pts AS BIGINT) AS PTS",
    )
    log.write.json(f"{root}/landing/basketball/team_game_log/season=all", compression="gzip")
    lake = jobs.Lake(
        landing=f"{root}/landing", bronze=f"{root}/bronze", silver=f"{root}/silver",
        schema=schema, seasons={"basketball": ["all"]},
    )
    jobs.run(spark, lake, sport="basketball")
    return spark.sql(
        f"SELECT rank, team, team_id, games_played, wins, losses, win_pct, points_per_game "
        f"FROM {schema}.v_nba_standings"
    )


def _medallion_soccer(spark, d):
    """From one schedule page per match to the standings view of the catalog."""
    root, schema = shared_folder(spark, "lake"), _fresh_schema(spark)
    pages = pq.match_pages(spark, d).withColumn("url", F.lit("u"))
    pages.write.parquet(f"{root}/landing/soccer/pages/season=all")
    lake = jobs.Lake(
        landing=f"{root}/landing", bronze=f"{root}/bronze", silver=f"{root}/silver",
        schema=schema, seasons={"soccer": ["all"]}, formats={"pages": "parquet"},
    )
    jobs.run(spark, lake, sport="soccer")
    return spark.sql(
        f"SELECT league, season, rank, team, matches_played, wins, draws, losses, goals_for, "
        f"goals_against, points, xg_for FROM {schema}.v_soccer_league_standings"
    )


def _gold_rollups(spark, d):
    """The materialised head-to-head table."""
    schema = _fresh_schema(spark)
    writers.load_table(_gold_matches(spark, d), "soccer_matches", schema, "replace")
    jobs.build_gold(spark, jobs.Lake("", "", "", schema=schema))
    return spark.table(f"{schema}.soccer_head_to_head")


def _catalog_object(name, table, rows):
    """A view or rollup of the catalog over a base table loaded from the fixtures."""

    def query(spark, d):
        schema = _fresh_schema(spark)
        writers.load_table(rows(spark, d), table, schema, "replace")
        jobs.build_gold(spark, jobs.Lake("", "", "", schema=schema))
        return spark.table(f"{schema}.{name}")

    return query


def _execute(spark, d):
    """A statement run for its effect on a loaded table."""
    schema, orders = _fresh_schema(spark), _orders(spark, d)
    writers.load_table(orders, "games", schema, "replace")
    statement = f"INSERT INTO {schema}.games BY NAME SELECT * FROM {schema}.games WHERE status = 'F'"
    writers.execute(spark, statement)
    return writers.query(spark, f"SELECT status, count(*) AS n FROM {schema}.games GROUP BY status")


def _incremental_refresh(spark, d):
    """Silver games after two rounds of snapshots; the second corrects the first."""
    root = shared_folder(spark, "incremental")
    games = bronze.project(
        rq._bronze(spark, d, rq._GAME_COLUMNS), schemas.bronze("basketball/games")
    )
    lookup = aliases.alias_lookup(rq.alias_entries(spark, d))
    early = F.col("extract_timestamp") < "1997-01-01"
    for date, rows in (("2024-01-01", games.where(early)), ("2024-01-02", games.where(~early))):
        writers.write_snapshot(rows, f"{root}/bronze", "basketball", "games", date)
        refresh_silver(
            spark,
            f"{root}/bronze",
            f"{root}/silver",
            "basketball",
            "games",
            lambda snapshots: silver.basketball_games(snapshots, lookup),
            f"{root}/progress",
            key=["game_id"],
        )
    return scans.scan_silver(
        spark, f"{root}/silver", "basketball", "games", schemas.gold("nba_games")
    )


# Key -> (view or rollup, base table, its rows), and the query with the same result.
_CATALOG = {
    "view_recent_form": (("v_soccer_recent_form", "soccer_matches", fx.matches), "home_form_summary"),
    "view_team_summary": (("v_nba_team_summary", "nba_games", fx.games), "home_avg_summary"),
    "view_nba_standings": (("v_nba_standings", "nba_games", fx.games), "winpct_standings"),
    "view_nfl_standings": (("v_nfl_standings", "nfl_games", fx.games), "winpct_standings_ties"),
    "view_soccer_splits": (
        ("v_soccer_home_away_splits", "soccer_matches", fx.matches), "home_away_splits",
    ),
    "view_nba_splits": (("v_nba_home_away_splits", "nba_games", fx.games), "home_away_splits_avg"),
    "rollup_form": (("soccer_team_form", "soccer_matches", fx.matches), "team_form"),
    "rollup_form_avg": (("nba_team_form", "nba_games", fx.games), "team_form_avg"),
}

QUERIES = {
    "scan_single": _scan_single,
    "scan_tree": _scan_tree,
    "scan_partition_pruned": _scan_partition_pruned,
    "landing_json": _landing_json,
    "landing_csv": _landing_csv,
    "one_player_log": _one_player,
    "bronze_snapshot": _bronze_snapshot,
    "load_append": _load_append,
    "load_replace": _load_replace,
    "load_counts": _load_counts,
    "catalog_view": _catalog_view,
    "gold_rollups": _gold_rollups,
    "check_rules": _check_rules,
    "check_game_rules": _check_game_rules,
    "check_unique": lambda spark, d: quality.check_unique(
        fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
    "quality_profile": _quality_profile,
    "medallion_refresh": _medallion_refresh,
    "medallion_soccer": _medallion_soccer,
    "incremental_refresh": _incremental_refresh,
    "landing_csv_mixed": _landing_csv_mixed,
    "landing_json_floats": _landing_json_floats,
    "execute": _execute,
    **{key: _catalog_object(*source) for key, (source, _) in _CATALOG.items()},
}

_GAME_BRONZE_SQL = rq._latest_sql(rq._GAME_COLUMNS, ["game_id"])

ORACLES = {
    "scan_single": _ORDERS_SQL,
    "scan_tree": f"""WITH o AS ({_ORDERS_SQL})
        SELECT * REPLACE (CASE WHEN season >= '1996' THEN total END AS total) FROM o""",
    "scan_partition_pruned": f"""WITH o AS ({_ORDERS_SQL})
        SELECT *, '2024-01-01' AS date FROM o WHERE season = '1997'""",
    "landing_json": """
        SELECT CAST(NULL AS VARCHAR) AS SEASON_ID, l_partkey AS PLAYER_ID,
               'Player ' || l_partkey AS PLAYER_NAME, l_suppkey AS TEAM_ID,
               CAST(NULL AS VARCHAR) AS TEAM_ABBREVIATION, 'Team ' || l_suppkey AS TEAM_NAME,
               CAST(l_orderkey AS VARCHAR) AS GAME_ID,
               strftime(l_shipdate, '%Y-%m-%d') AS GAME_DATE,
               CASE l_linestatus WHEN 'F' THEN 'LAL vs. BOS' ELSE 'BOS @ LAL' END AS MATCHUP,
               CAST(NULL AS VARCHAR) AS WL, l_quantity AS MIN, CAST(l_quantity AS BIGINT) AS PTS,
               l_partkey % 20 AS REB, l_suppkey % 15 AS AST, l_partkey % 5 AS STL,
               l_suppkey % 4 AS BLK, l_partkey % 6 AS TOV, l_suppkey % 9 AS FGM,
               l_suppkey % 19 AS FGA, l_partkey % 4 AS FG3M, l_partkey % 11 AS FG3A,
               l_suppkey % 5 AS FTM, l_suppkey % 8 AS FTA, l_quantity - 25 AS PLUS_MINUS
        FROM lineitem""",
    "landing_csv": f"""WITH {fx.GAMES_SQL}
        SELECT CAST(game_id AS VARCHAR) AS game_id, CAST(week AS BIGINT) AS week,
               CAST(game_date AS VARCHAR) AS gameday, home_team, away_team,
               CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score,
               CAST(NULL AS VARCHAR) AS overtime, 'REG' AS game_type,
               CAST(NULL AS DOUBLE) AS spread_line,
               CAST(home_score - away_score AS BIGINT) AS result
        FROM fx_games""",
    "one_player_log": """
        SELECT CAST(l_orderkey AS VARCHAR) AS GAME_ID, l_partkey AS PLAYER_ID,
               CAST(l_quantity AS BIGINT) AS PTS,
               CASE l_linestatus WHEN 'F' THEN 'LAL vs. BOS' ELSE 'BOS @ LAL' END AS MATCHUP
        FROM lineitem WHERE l_partkey = 7""",
    "bronze_snapshot": f"""WITH o AS ({_ORDERS_SQL})
        SELECT * REPLACE (CASE season WHEN '1997' THEN 'again' ELSE status END AS status),
               '2024-01-01' AS date FROM o
        UNION ALL SELECT *, '2024-01-02' AS date FROM o""",
    "load_append": f"""WITH o AS ({_ORDERS_SQL})
        SELECT * REPLACE (CASE WHEN season < '1996' THEN total END AS total) FROM o""",
    "load_replace": f"""WITH o AS ({_ORDERS_SQL})
        SELECT * EXCLUDE (day) FROM o WHERE season >= '1996'""",
    "load_counts": """
        SELECT 'games' AS "table", 2 * count(*) AS total_rows FROM orders
        UNION ALL SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'""",
    "check_rules": """
        SELECT 'c_custkey' AS "column", 'type bigint' AS rule, CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'c_custkey', 'not_null', count(*) FILTER (c_custkey IS NULL) FROM customer
        UNION ALL SELECT 'c_acctbal', 'at_least 0', count(*) FILTER (c_acctbal < 0) FROM customer
        UNION ALL SELECT 'c_name', 'type int',
            count(*) FILTER (TRY_CAST(c_name AS INT) IS NULL AND c_name IS NOT NULL) FROM customer
        UNION ALL SELECT 'c_phone', 'present', count(*) FROM customer""",
    "check_game_rules": f"""WITH {rq._LINES_SQL},
        g AS (SELECT {rq._GAME_COLUMNS["home_score"]} - 3 AS hs,
                     {rq._GAME_COLUMNS["away_score"]} AS vs FROM lines)
        SELECT 'home_score' AS "column", 'at_least 0' AS rule, count(*) FILTER (hs < 0) AS violations
        FROM g
        UNION ALL SELECT 'away_score', 'at_least 0', count(*) FILTER (vs < 0) FROM g
        UNION ALL SELECT c, r, CAST(0 AS BIGINT) FROM (VALUES
            ('game_id', 'type string'), ('game_id', 'not_null'),
            ('game_date', 'type timestamp'), ('game_date', 'not_null'),
            ('home_team_id', 'type bigint'), ('home_team_id', 'not_null'),
            ('away_team_id', 'type bigint'), ('away_team_id', 'not_null'),
            ('home_score', 'type bigint'), ('away_score', 'type bigint')) v(c, r)""",
    "check_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "quality_profile": """
        WITH lines AS (
            SELECT l_orderkey, l_returnflag, CASE WHEN l_tax > 0.02 THEN l_tax END AS tax,
                   CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END AS discount
            FROM lineitem),
        facts AS (
            SELECT 'rows' AS metric, NULL AS "column", count(*) AS value FROM lines
            UNION ALL SELECT 'columns', NULL, 4
            UNION ALL SELECT 'duplicates', NULL,
                count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lines)) FROM lines
            UNION ALL SELECT 'null_pct', 'l_orderkey', 0
            UNION ALL SELECT 'null_pct', 'l_returnflag', 0
            UNION ALL SELECT 'null_pct', 'tax', round(1 - count(tax) / count(*), 3) FROM lines
            UNION ALL SELECT 'null_pct', 'discount', round(1 - count(discount) / count(*), 3)
            FROM lines)
        SELECT 'lines' AS name, metric, "column", CAST(value AS DOUBLE) AS value FROM facts""",
    "catalog_view": f"""
        SELECT league, CAST(season AS VARCHAR) AS season, rank, team, points, goal_difference,
               matches_played
        FROM ({gq.ORACLES["league_standings"]})""",
    "gold_rollups": gq.ORACLES["head_to_head"],
    "medallion_refresh": f"""WITH {fx.GAMES_SQL},
        sides AS (
            SELECT home_team AS team, home_team_id AS id, home_score AS pts, home_win AS won
            FROM fx_games WHERE home_score IS NOT NULL
            UNION ALL SELECT away_team, away_team_id, away_score, NOT home_win
            FROM fx_games WHERE home_score IS NOT NULL),
        sums AS (
            SELECT lower(team) AS team, CAST(id AS BIGINT) AS team_id, count(*) AS n,
                   count(*) FILTER (won) AS w, avg(pts) AS pts
            FROM sides GROUP BY ALL)
        SELECT row_number() OVER (ORDER BY w / n DESC, team, team_id) AS rank, team, team_id,
               n AS games_played, w AS wins, n - w AS losses, round(w / n, 3) AS win_pct,
               round(pts, 1) AS points_per_game
        FROM sums""",
    "medallion_soccer": f"""WITH {fx.MATCHES_SQL},
        once AS (
            SELECT * FROM fx_matches WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL
            QUALIFY row_number() OVER (
                PARTITION BY match_date, home_team, away_team
                ORDER BY home_goals DESC, away_goals DESC) = 1),
        sides AS (
            SELECT league, home_team AS team, home_goals AS f, away_goals AS a FROM once
            UNION ALL SELECT league, away_team, away_goals, home_goals FROM once),
        sums AS (
            SELECT league, team, count(*) AS n, count(*) FILTER (f > a) AS w,
                   count(*) FILTER (f = a) AS d, count(*) FILTER (f < a) AS l,
                   CAST(sum(f) AS BIGINT) AS gf, CAST(sum(a) AS BIGINT) AS ga
            FROM sides GROUP BY ALL)
        SELECT league, 'all' AS season, row_number() OVER (
                   PARTITION BY league ORDER BY 3 * w + d DESC, gf - ga DESC, gf DESC, team) AS rank,
               team, n AS matches_played, w AS wins, d AS draws, l AS losses, gf AS goals_for,
               ga AS goals_against, 3 * w + d AS points, CAST(0 AS DOUBLE) AS xg_for
        FROM sums""",
    "incremental_refresh": f"""{_GAME_BRONZE_SQL}
        SELECT game_id, season, CAST(game_date AS DATE) AS game_date,
               CAST(home_team_id AS BIGINT) AS home_team_id,
               {rq._canonical("home_team_name")} AS home_team,
               CAST(away_team_id AS BIGINT) AS away_team_id,
               {rq._canonical("away_team_name")} AS away_team, home_score, away_score,
               home_score > away_score AS home_win, home_score + away_score AS total_points
        FROM latest""",
}

ORACLES |= {key: gq.ORACLES[same] for key, (_, same) in _CATALOG.items()}
ORACLES["landing_csv_mixed"] = ORACLES["landing_csv"]
ORACLES["landing_json_floats"] = ORACLES["landing_json"]
ORACLES["execute"] = f"""WITH o AS ({_ORDERS_SQL})
    SELECT status, count(*) * CASE status WHEN 'F' THEN 2 ELSE 1 END AS n
    FROM o GROUP BY status"""
