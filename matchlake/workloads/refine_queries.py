"""Names, typing, bronze and silver projections, and dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import functions as fn
from matchlake.operators import bronze, projection, silver
from matchlake.operators.pairing import is_home_game
from matchlake.operators.top_n import deduplicate
from matchlake.sources import aliases
from matchlake.workloads import fixtures as fx
from matchlake.workloads import gold_queries as gq

_NBSP = "\u00a0"
_BLANKS = f" \t{_NBSP}"


def _dressed(name: str, number: str, pick: str) -> str:
    """A team name as different sources write it; valid in both SQL dialects."""
    return (
        f"CASE {pick} % 4 WHEN 0 THEN {name} WHEN 1 THEN '  ' || lower({name}) || '{_NBSP}' "
        f"WHEN 2 THEN 'n' || {number} ELSE '\tUnlisted ' || {number} || ' ' END"
    )


def alias_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aliases per nation and sport; the canonical names are made up."""
    return fx.table(spark, sf_dir, "nation").selectExpr(
        "explode(array('soccer', 'basketball', 'football')) AS sport",
        "'Republic ' || n_nationkey AS canonical",
        "n_nationkey",
        "n_name",
    ).selectExpr(
        "sport",
        "canonical",
        """inline(array(
            struct('feed' AS source, n_name AS alias, 2L * n_nationkey AS position),
            struct('abbreviation' AS source, 'N' || n_nationkey AS alias,
                   2L * n_nationkey + 1 AS position)))""",
    )


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aliases.alias_lookup(alias_entries(spark, sf_dir))


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order and both nations: a game published many times."""
    nation = fx.table(spark, sf_dir, "nation")
    home = nation.selectExpr("n_nationkey AS home_id", "n_name AS home_name")
    away = nation.selectExpr("n_nationkey AS away_id", "n_name AS away_name")
    return (
        fx.table(spark, sf_dir, "lineitem")
        .join(fx.table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(fx.table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(fx.table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(home, F.expr("c_nationkey = home_id"))
        .join(away, F.expr("s_nationkey = away_id"))
    )


_LINES_SQL = """
lines AS (
    SELECT l.*, o.*, h.n_nationkey AS home_id, h.n_name AS home_name,
           a.n_nationkey AS away_id, a.n_name AS away_name
    FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation h ON c_nationkey = h.n_nationkey JOIN nation a ON s_nationkey = a.n_nationkey
),
alias_names AS (
    SELECT lower(n_name) AS spelling, 'Republic ' || n_nationkey AS canonical FROM nation
    UNION ALL SELECT 'n' || n_nationkey, 'Republic ' || n_nationkey FROM nation
    UNION ALL SELECT 'republic ' || n_nationkey, 'Republic ' || n_nationkey FROM nation
)"""


def _canonical(name: str) -> str:
    """DuckDB text of the canonical form of a name expression."""
    stripped = f"trim({name}, '{_BLANKS}')"
    return (
        f"coalesce((SELECT canonical FROM alias_names WHERE spelling = lower({stripped})), "
        f"{stripped})"
    )


# Columns of the derived bronze rows, valid in both SQL dialects.
_HOME = _dressed("home_name", "home_id", "l_linenumber")
_AWAY = _dressed("away_name", "away_id", "l_partkey")
_GAME_COLUMNS = {
    "extract_timestamp": "CAST(l_shipdate AS TIMESTAMP)",
    "season": "CAST(year(o_orderdate) AS STRING)",
    "game_id": "CAST(l_orderkey AS STRING)",
    "game_date": "CAST(o_orderdate AS TIMESTAMP)",
    "home_team_id": "home_id",
    "home_team_name": _HOME,
    "away_team_id": "away_id",
    "away_team_name": _AWAY,
    "home_score": "CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS BIGINT) END",
    "away_score": "CASE WHEN l_discount > 0 THEN l_partkey % 50 END",
    "status": "'Final'",
}
_WEEK_COLUMNS = {
    "extract_timestamp": "CAST(l_shipdate AS TIMESTAMP)",
    "season": "CAST(year(o_orderdate) AS BIGINT)",
    "week": "CAST(1 + day(o_orderdate) % 18 AS BIGINT)",
    "game_id": "CAST(l_orderkey AS STRING)",
    "gameday": "CAST(o_orderdate AS TIMESTAMP)",
    "home_team": _HOME,
    "away_team": _AWAY,
    "home_score": "CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS BIGINT) END",
    "away_score": "CASE WHEN l_discount > 0 THEN l_partkey % 50 END",
    "overtime": "CASE WHEN l_tax > 0.02 THEN l_returnflag = 'R' END",
    "game_type": "l_returnflag",
    "stadium": "'Arena ' || home_name",
}
_MATCH_COLUMNS = {
    "extract_timestamp": "CAST(l_shipdate AS TIMESTAMP)",
    "season": "CAST(year(o_orderdate) AS STRING)",
    "league": "o_orderpriority",
    "match_date": "CAST(o_orderdate AS TIMESTAMP)",
    "home_team": _HOME,
    "away_team": _AWAY,
    "home_goals": "CASE WHEN l_linenumber < 7 THEN CAST(CAST(l_quantity AS BIGINT) % 6 AS DOUBLE) END",
    "away_goals": "CASE WHEN l_discount > 0 THEN CAST(l_partkey % 6 AS DOUBLE) END",
    "home_xg": "l_discount * 10",
    "away_xg": "CASE WHEN l_tax > 0 THEN l_tax * 10 END",
    "venue": "'Arena ' || home_name",
}
_PLAYER_COLUMNS = {
    "season": "CAST(year(o_orderdate) AS STRING)",
    "game_id": "CAST(l_orderkey AS STRING)",
    "game_date": "CAST(o_orderdate AS TIMESTAMP)",
    "player_id": "l_partkey",
    "player_name": f"' Player ' || l_partkey || '{_NBSP}'",
    "team_id": "home_id",
    "team_name": _HOME,
    "is_home": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END",
    "minutes": "CASE WHEN l_tax > 0 THEN l_quantity END",
    "points": "CASE WHEN l_discount > 0 THEN CAST(l_quantity AS BIGINT) END",
    "rebounds": "CAST(l_linenumber AS BIGINT)",
    "assists": "CAST(NULL AS BIGINT)",
    "steals": "l_suppkey % 5",
    "blocks": "l_suppkey % 3",
    "turnovers": "l_partkey % 4",
    "field_goals_made": "CAST(l_linenumber AS BIGINT)",
    "field_goals_attempted": "CAST(l_quantity AS BIGINT) - 5",
    "three_pointers_made": "l_partkey % 3",
    "three_pointers_attempted": "CASE WHEN l_tax > 0 THEN l_partkey % 9 END",
    "free_throws_made": "l_suppkey % 3",
    "free_throws_attempted": "l_suppkey % 7",
    "plus_minus": "CASE WHEN l_tax > 0 THEN l_quantity - 25 END",
}
_PLAYER_WEEK_COLUMNS = {
    "extract_timestamp": "CAST(l_shipdate AS TIMESTAMP)",
    "season": "CAST(year(o_orderdate) AS BIGINT)",
    "week": "CAST(1 + day(o_orderdate) % 18 AS BIGINT)",
    "player_id": "CAST(l_partkey AS STRING)",
    "player_name": "'P.' || l_partkey",
    "player_display_name": f"' Player ' || l_partkey || '{_NBSP}'",
    "team": f"CASE WHEN l_suppkey % 10 > 0 THEN {_HOME} END",
    "position": "l_returnflag",
    "completions": "CAST(l_linenumber AS BIGINT)",
    "passing_attempts": "CAST(l_quantity AS BIGINT)",
    "passing_yards": "CASE WHEN l_tax > 0 THEN l_quantity * 4 END",
    "passing_tds": "CASE WHEN l_discount > 0 THEN l_partkey % 4 END",
    "rushing_yards": "l_quantity / 2",
    "rushing_tds": "l_suppkey % 3",
    "receiving_yards": "CASE WHEN l_discount > 0.05 THEN l_quantity END",
    "receiving_tds": "CAST(NULL AS BIGINT)",
    "fantasy_points": "l_extendedprice",
}


def _bronze(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return line_records(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def _latest_sql(columns: dict[str, str], keys: list[str]) -> str:
    """The derived bronze rows and the latest of them per key, as WITH entries."""
    ties = [c for c in columns if c not in keys and c != "extract_timestamp"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["extract_timestamp", *ties])
    return f"""WITH {_LINES_SQL},
        bronze AS (SELECT {", ".join(f"{e} AS {n}" for n, e in columns.items())} FROM lines),
        latest AS (
            SELECT * FROM bronze
            QUALIFY row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY {order}) = 1)"""


def _raw_player_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A player log with the column names of the feed."""
    return fx.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS GAME_ID", "date_format(l_shipdate, 'yyyy-MM-dd') AS GAME_DATE",
        "l_partkey AS PLAYER_ID", "'Player ' || l_partkey AS PLAYER_NAME",
        "l_suppkey AS TEAM_ID", "'Team ' || l_suppkey AS TEAM_NAME",
        "CASE l_linestatus WHEN 'F' THEN 'LAL vs. BOS' ELSE 'BOS @ LAL' END AS MATCHUP",
        "l_quantity AS MIN", "CAST(l_quantity AS BIGINT) AS PTS", "l_partkey % 20 AS REB",
        "l_suppkey % 15 AS AST", "l_partkey % 5 AS STL", "l_suppkey % 4 AS BLK",
        "l_partkey % 6 AS TOV", "l_suppkey % 9 AS FGM", "l_suppkey % 19 AS FGA",
        "l_partkey % 4 AS FG3M", "l_partkey % 11 AS FG3A", "l_suppkey % 5 AS FTM",
        "l_suppkey % 8 AS FTA", "l_quantity - 25 AS PLUS_MINUS",
    )


def _proj_player_log(spark, d):
    players = bronze.basketball_players(_raw_player_log(spark, d), season="2024-25")
    return players.drop("extract_timestamp").withColumn(
        "game_date", F.col("game_date").cast("date")
    )


def _raw_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season metrics of a feed without two of the four rating columns."""
    return fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS TEAM_ID", "c_name AS TEAM_NAME", "82 AS GP", "c_nationkey AS W",
        "82 - c_nationkey AS L", "c_acctbal AS E_OFF_RATING", "-c_acctbal AS E_PACE",
    )


def _proj_optional_cols(spark, d):
    return bronze.basketball_teams(_raw_metrics(spark, d), season="2024-25").drop("extract_timestamp")


def _schedule(spark, d):
    """A published schedule; part of it unplayed, overtime marked in various ways."""
    return fx.games(spark, d).selectExpr(
        "game_id", "week", "date_format(game_date, 'yyyy-MM-dd') AS gameday",
        "home_team", "away_team", "home_score", "away_score", "season AS year",
        """CASE game_id % 6 WHEN 0 THEN 'OT' WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN '1'
           WHEN 4 THEN 'false' END AS overtime""",
        "'REG' AS game_type", "home_score - away_score AS result",
    )


def _proj_games(spark, d):
    """Bronze games out of a team log with the column names of the feed."""
    log = fx.team_log(spark, d).selectExpr(
        "CAST(game_id AS STRING) AS GAME_ID", "CAST(game_date AS STRING) AS GAME_DATE",
        "team_id AS TEAM_ID", "team_name AS TEAM_NAME", "matchup AS MATCHUP", "pts AS PTS",
    )
    games = bronze.basketball_games(log, season="all")
    return games.drop("extract_timestamp").withColumn(
        "game_date", F.col("game_date").cast("date")
    )


def _proj_team_totals(spark, d):
    """Bronze season records out of a schedule that mixes seasons."""
    teams = bronze.football_teams(_schedule(spark, d), season=F.col("year"))
    return teams.drop("extract_timestamp")


def _proj_schedule(spark, d):
    games = bronze.football_games(_schedule(spark, d), season=F.col("year"))
    return games.drop("extract_timestamp").withColumn("gameday", F.col("gameday").cast("date"))


def _raw_player_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly player lines with the column names of the feed."""
    return fx.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_partkey AS STRING) AS player_id", "'P.' || l_partkey AS player_name",
        "'Player ' || l_partkey AS player_display_name", "1 + l_linenumber AS week",
        "CAST(l_quantity AS BIGINT) AS attempts", "l_extendedprice AS passing_yards",
        "l_suppkey % 4 AS passing_tds",
    )


def _proj_player_week(spark, d):
    return bronze.football_players(_raw_player_weeks(spark, d), season=2024).drop("extract_timestamp")


def _proj_team_season(spark, d):
    """Season table rows as the page has them: text, with gaps and dashes."""
    rows = fx.table(spark, d, "customer").selectExpr(
        "CASE WHEN c_custkey % 10 > 0 THEN c_name END AS Squad",
        "CAST(c_nationkey AS STRING) AS MP", "CASE WHEN c_nationkey > 5 THEN '7' ELSE '-' END AS W",
        "' 12 ' AS GF", "'+3' AS GD", "CAST(c_acctbal AS STRING) AS Pts", "'1.25' AS xG",
    )
    return bronze.soccer_teams(rows, season="2024-2025", league="Test League").drop(
        "extract_timestamp"
    )


_SCORE = """CASE match_id % 7 WHEN 0 THEN '(4) 1–1 (3)' WHEN 1 THEN 'postponed'
    WHEN 2 THEN CAST(home_goals AS STRING) || '–'
    ELSE ' ' || CAST(home_goals AS STRING) || ' – ' || CAST(away_goals AS STRING) END"""
_ATTENDANCE = """CASE match_id % 3 WHEN 0 THEN '60,' || CAST(100 + match_id % 900 AS STRING)
    WHEN 1 THEN CAST(match_id AS STRING) ELSE 'n/a' END"""


def _split_score(spark, d):
    rows = fx.matches(spark, d).selectExpr(
        f"{_SCORE} AS Score",
        "CASE WHEN match_id % 11 > 0 THEN date_format(match_date, 'yyyy-MM-dd') ELSE 'TBD' END AS Date",
        "home_team AS Home", "away_team AS Away", "CAST(home_xg AS STRING) AS xG",
        "CAST(away_xg AS STRING) AS `xG.1`", "venue AS Venue", f"{_ATTENDANCE} AS Attendance",
        "league AS page_league", "CAST(season AS STRING) AS page_season",
    )
    matches = bronze.soccer_matches(rows, season=F.col("page_season"), league=F.col("page_league"))
    return matches.withColumn("match_date", F.col("match_date").cast("date")).drop(
        "extract_timestamp"
    )


def _union_by_name(spark, d):
    customers = fx.table(spark, d, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = fx.table(spark, d, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "CAST(s_acctbal AS INT) AS balance",
        "s_nationkey AS nation",
    )
    return projection.union_by_name([customers, suppliers])


_NUMBER_TEXT = """CASE event_id % 10 WHEN 0 THEN '  12.50 ' WHEN 1 THEN '1.0f' WHEN 2 THEN ''
    WHEN 3 THEN 'n/a' WHEN 4 THEN '-3' WHEN 5 THEN '1e3' WHEN 6 THEN '7d' WHEN 7 THEN '+.5'
    WHEN 8 THEN props ELSE CAST(user_id AS STRING) END"""
_DATE_TEXT = """CASE event_id % 6 WHEN 0 THEN 'TBD' WHEN 1 THEN '' WHEN 2 THEN '2024-02-30'
    WHEN 3 THEN '2024-02-29' ELSE CAST(CAST(ts AS DATE) AS STRING) END"""


def _coerce_numeric(spark, d):
    return fx.table(spark, d, "events").selectExpr("event_id", f"{_NUMBER_TEXT} AS t").select(
        "event_id",
        fn.coerce_number(F.col("t")).alias("number"),
        fn.coerce_number(fn.without_thousands(F.concat(F.lit("1,0"), F.col("t")))).alias("figure"),
    )


def _fill_defaults(spark, d):
    value = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 5 != 1, F.col("value")
    )
    return fx.table(spark, d, "events").select(
        "event_id",
        fn.count_or_zero(value).alias("whole"),
        fn.number_or_zero(value).alias("figure"),
    )


def _player_counts(spark, d):
    """Event counts per user, standing in for a season's stat lines."""
    kinds = ["click", "view", "purchase", "signup", "error"]
    return fx.table(spark, d, "events").groupBy("user_id").agg(
        *[fn.count_where(F.col("event_type") == kind).alias(f"{kind}s") for kind in kinds]
    )


def _safe_ratio(spark, d):
    made, tries = F.col("purchases") % 7, F.col("views") % 9
    return _player_counts(spark, d).select("user_id", fn.safe_ratio(made, tries).alias("ratio"))


def _silver_player_defaults(spark, d):
    """Player lines from a source that lacks three of the statistics."""
    lines = line_records(spark, d).selectExpr(
        "CAST(year(o_orderdate) AS STRING) AS season", "o_orderpriority AS league",
        "CAST(o_orderdate AS TIMESTAMP) AS match_date",
        f"' Player ' || l_partkey || '{_NBSP}' AS player_name",
        f"{_HOME} AS team", f"{_AWAY} AS opponent",
        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_home",
        "CASE WHEN l_tax > 0 THEN l_quantity END AS minutes", "l_partkey % 3 AS goals",
        "CAST(NULL AS BIGINT) AS assists", "l_discount * 10 AS xg",
        "CASE WHEN l_tax > 0 THEN l_tax * 10 END AS xa", "l_suppkey % 6 AS shots",
        "CASE WHEN l_tax > 0 THEN 1.9D END AS shots_on_target",
    )
    return silver.soccer_players(lines, _lookup(spark, d))


def _normalize(spark, d):
    rows = line_records(spark, d).selectExpr("l_orderkey", "l_linenumber", f"{_HOME} AS raw_name")
    return aliases.normalize_names(rows, _lookup(spark, d), "football", {"raw_name": "team"})


def _reverse_alias(spark, d):
    rows = fx.table(spark, d, "orders").join(
        fx.table(spark, d, "customer"), F.expr("o_custkey = c_custkey")
    ).selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 9 > 0 THEN 'Republic ' || c_nationkey ELSE 'nobody' END AS team",
    )
    entries = alias_entries(spark, d)
    named = aliases.source_alias(rows, entries, "soccer", "feed", "team", "feed_name")
    return aliases.team_abbreviation(named, entries, "soccer", "team", "abbreviation")


def _dedupe(spark, d, keep):
    lines = fx.table(spark, d, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    return deduplicate(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], keep)


def _dedupe_sql(direction: str, nulls: str) -> str:
    ties = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    ]
    order = ", ".join(f"{c} {direction} NULLS {nulls}" for c in ties)
    return f"""SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


QUERIES = {
    "normalize_names": _normalize,
    "reverse_alias": _reverse_alias,
    "dedupe_latest": lambda spark, d: _dedupe(spark, d, "last"),
    "dedupe_first": lambda spark, d: _dedupe(spark, d, "first"),
    "proj_player_log": _proj_player_log,
    "proj_optional_cols": _proj_optional_cols,
    "proj_games": _proj_games,
    "proj_team_totals": _proj_team_totals,
    "proj_schedule": _proj_schedule,
    "proj_player_week": _proj_player_week,
    "proj_team_season": _proj_team_season,
    "split_score": _split_score,
    "union_by_name": _union_by_name,
    "drop_incomplete": lambda spark, d: projection.drop_incomplete(
        fx.games(spark, d).select("game_id", "season", "home_score", "away_score"),
        ["home_score", "away_score"],
    ),
    "silver_games": lambda spark, d: silver.basketball_games(
        _bronze(spark, d, _GAME_COLUMNS), _lookup(spark, d)
    ),
    "silver_games_week": lambda spark, d: silver.football_games(
        _bronze(spark, d, _WEEK_COLUMNS), _lookup(spark, d)
    ),
    "silver_matches": lambda spark, d: silver.soccer_matches(
        _bronze(spark, d, _MATCH_COLUMNS), _lookup(spark, d)
    ),
    "silver_player_ratios": lambda spark, d: silver.basketball_players(
        _bronze(spark, d, _PLAYER_COLUMNS), _lookup(spark, d)
    ),
    "silver_player_totals": lambda spark, d: silver.football_players(
        _bronze(spark, d, _PLAYER_WEEK_COLUMNS), _lookup(spark, d)
    ),
    "silver_player_defaults": _silver_player_defaults,
    "coerce_numeric": _coerce_numeric,
    "coerce_date": lambda spark, d: fx.table(spark, d, "events").select(
        "event_id", fn.coerce_date(F.expr(_DATE_TEXT)).alias("day")
    ),
    "fill_defaults": _fill_defaults,
    "safe_ratio": _safe_ratio,
    "slug": lambda spark, d: fx.table(spark, d, "part").select(
        "p_partkey", fn.slug(F.concat_ws(" ", "p_name", "p_type")).alias("slug")
    ),
    "hash_id": lambda spark, d: fx.table(spark, d, "orders").select(
        "o_orderkey",
        fn.hash_id(
            F.year("o_orderdate"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
            F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")),
            F.col("o_orderstatus"),
        ).alias("id"),
    ),
    "presence_flag": lambda spark, d: _schedule(spark, d).select(
        "game_id",
        fn.presence_flag(F.col("overtime")).alias("present"),
        fn.truth_flag(F.col("overtime")).alias("went_on"),
    ),
    "home_flag": lambda spark, d: fx.team_log(spark, d).select(
        "game_id", "team_id", is_home_game(F.col("matchup")).alias("is_home")
    ),
}

_REAL_NUMBER = (
    "CASE WHEN regexp_full_match({0}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
    "THEN CAST({0} AS DOUBLE) END"
)


def _number(text: str) -> str:
    return _REAL_NUMBER.format(f"trim({text}, '{_BLANKS}')")


ORACLES = {
    "normalize_names": f"""WITH {_LINES_SQL},
        named AS (SELECT l_orderkey, l_linenumber, {_HOME} AS raw_name FROM lines)
        SELECT l_orderkey, l_linenumber, raw_name, {_canonical("raw_name")} AS team FROM named""",
    "reverse_alias": """
        WITH rows AS (
            SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN 'Republic ' || c_nationkey
                                    ELSE 'nobody' END AS team, c_nationkey
            FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT o_orderkey, team,
               CASE WHEN team <> 'nobody' THEN n_name END AS feed_name,
               CASE WHEN team <> 'nobody' THEN 'N' || n_nationkey END AS abbreviation
        FROM rows JOIN nation ON c_nationkey = n_nationkey""",
    "dedupe_latest": _dedupe_sql("DESC", "LAST"),
    "dedupe_first": _dedupe_sql("ASC", "FIRST"),
    "proj_player_log": """
        SELECT '2024-25' AS season, CAST(l_orderkey AS VARCHAR) AS game_id,
               CAST(l_shipdate AS DATE) AS game_date, l_partkey AS player_id,
               'Player ' || l_partkey AS player_name, l_suppkey AS team_id,
               'Team ' || l_suppkey AS team_name, l_linestatus = 'F' AS is_home,
               l_quantity AS minutes, CAST(l_quantity AS BIGINT) AS points,
               l_partkey % 20 AS rebounds, l_suppkey % 15 AS assists, l_partkey % 5 AS steals,
               l_suppkey % 4 AS blocks, l_partkey % 6 AS turnovers,
               l_suppkey % 9 AS field_goals_made, l_suppkey % 19 AS field_goals_attempted,
               l_partkey % 4 AS three_pointers_made, l_partkey % 11 AS three_pointers_attempted,
               l_suppkey % 5 AS free_throws_made, l_suppkey % 8 AS free_throws_attempted,
               l_quantity - 25 AS plus_minus
        FROM lineitem""",
    "proj_optional_cols": """
        SELECT '2024-25' AS season, c_custkey AS team_id, c_name AS team_name,
               CAST(82 AS BIGINT) AS games_played, CAST(c_nationkey AS BIGINT) AS wins,
               CAST(82 - c_nationkey AS BIGINT) AS losses, c_acctbal AS offensive_rating,
               CAST(NULL AS DOUBLE) AS defensive_rating, CAST(NULL AS DOUBLE) AS net_rating,
               -c_acctbal AS pace
        FROM customer""",
    "proj_schedule": f"""WITH {fx.GAMES_SQL}
        SELECT CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week,
               CAST(game_id AS VARCHAR) AS game_id, game_date AS gameday,
               CAST(NULL AS VARCHAR) AS gametime, home_team, away_team,
               CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score,
               game_id % 6 IN (0, 3) AS overtime, 'REG' AS game_type,
               CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS stadium,
               CAST(NULL AS VARCHAR) AS roof, CAST(NULL AS VARCHAR) AS surface,
               CAST(NULL AS DOUBLE) AS spread_line, CAST(NULL AS DOUBLE) AS total_line,
               CAST(home_score - away_score AS BIGINT) AS result
        FROM fx_games""",
    "proj_games": f"""WITH {fx.GAMES_SQL}
        SELECT 'all' AS season, CAST(game_id AS VARCHAR) AS game_id, game_date,
               CAST(home_team_id AS BIGINT) AS home_team_id, home_team AS home_team_name,
               CAST(away_team_id AS BIGINT) AS away_team_id, away_team AS away_team_name,
               CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score,
               'Final' AS status
        FROM fx_games""",
    "proj_team_totals": gq.ORACLES["team_season_totals"].replace(
        "SELECT season, team, CAST", "SELECT CAST(season AS BIGINT) AS season, team, CAST"
    ),
    "proj_player_week": """
        SELECT CAST(2024 AS BIGINT) AS season, CAST(1 + l_linenumber AS BIGINT) AS week,
               CAST(l_partkey AS VARCHAR) AS player_id, 'P.' || l_partkey AS player_name,
               'Player ' || l_partkey AS player_display_name,
               CAST(NULL AS VARCHAR) AS team, CAST(NULL AS VARCHAR) AS position,
               CAST(NULL AS BIGINT) AS completions, CAST(l_quantity AS BIGINT) AS passing_attempts,
               l_extendedprice AS passing_yards, l_suppkey % 4 AS passing_tds,
               CAST(NULL AS BIGINT) AS interceptions, CAST(NULL AS BIGINT) AS sacks,
               CAST(NULL AS DOUBLE) AS passing_air_yards,
               CAST(NULL AS DOUBLE) AS passing_yards_after_catch,
               CAST(NULL AS BIGINT) AS passing_2pt_conversions, CAST(NULL AS BIGINT) AS carries,
               CAST(NULL AS DOUBLE) AS rushing_yards, CAST(NULL AS BIGINT) AS rushing_tds,
               CAST(NULL AS BIGINT) AS rushing_fumbles,
               CAST(NULL AS BIGINT) AS rushing_2pt_conversions,
               CAST(NULL AS BIGINT) AS receptions, CAST(NULL AS BIGINT) AS targets,
               CAST(NULL AS DOUBLE) AS receiving_yards, CAST(NULL AS BIGINT) AS receiving_tds,
               CAST(NULL AS DOUBLE) AS receiving_air_yards,
               CAST(NULL AS DOUBLE) AS receiving_yards_after_catch,
               CAST(NULL AS BIGINT) AS receiving_fumbles,
               CAST(NULL AS BIGINT) AS receiving_2pt_conversions,
               CAST(NULL AS DOUBLE) AS fantasy_points
        FROM lineitem""",
    "proj_team_season": """
        SELECT '2024-2025' AS season, 'Test League' AS league, c_name AS team,
               CAST(c_nationkey AS DOUBLE) AS matches_played,
               CASE WHEN c_nationkey > 5 THEN CAST(7 AS DOUBLE) END AS wins,
               CAST(0 AS DOUBLE) AS draws, CAST(0 AS DOUBLE) AS losses,
               CAST(12 AS DOUBLE) AS goals_for, CAST(0 AS DOUBLE) AS goals_against,
               CAST(3 AS DOUBLE) AS goal_difference, c_acctbal AS points,
               CAST(1.25 AS DOUBLE) AS xg_for, CAST(NULL AS DOUBLE) AS xg_against
        FROM customer WHERE c_custkey % 10 > 0""",
    "split_score": f"""WITH {fx.MATCHES_SQL},
        texts AS (SELECT *, {_SCORE} AS score, {_ATTENDANCE} AS crowd FROM fx_matches)
        SELECT CAST(season AS VARCHAR) AS season, league, match_date, home_team, away_team,
               {_number("split_part(score, '–', 1)")} AS home_goals,
               {_number("split_part(score, '–', 2)")} AS away_goals,
               home_xg, away_xg, venue, CAST(NULL AS VARCHAR) AS referee,
               {_number("replace(crowd, ',', '')")} AS attendance,
               CAST(NULL AS VARCHAR) AS match_url
        FROM texts WHERE contains(score, '–') AND match_id % 11 > 0""",
    "union_by_name": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
               CAST(NULL AS INT) AS nation FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, CAST(trunc(s_acctbal) AS DOUBLE), NULL, s_nationkey
        FROM supplier""",
    "drop_incomplete": f"""WITH {fx.GAMES_SQL}
        SELECT game_id, season, home_score, away_score FROM fx_games
        WHERE home_score IS NOT NULL AND away_score IS NOT NULL""",
    "silver_games": f"""{_latest_sql(_GAME_COLUMNS, ["game_id"])}
        SELECT game_id, season, CAST(game_date AS DATE) AS game_date,
               CAST(home_team_id AS BIGINT) AS home_team_id,
               {_canonical("home_team_name")} AS home_team,
               CAST(away_team_id AS BIGINT) AS away_team_id,
               {_canonical("away_team_name")} AS away_team, home_score, away_score,
               home_score > away_score AS home_win, home_score + away_score AS total_points
        FROM latest""",
    "silver_games_week": f"""{_latest_sql(_WEEK_COLUMNS, ["game_id"])}
        SELECT game_id, season, week, CAST(gameday AS DATE) AS game_date,
               {_canonical("home_team")} AS home_team, {_canonical("away_team")} AS away_team,
               home_score, away_score, coalesce(overtime, false) AS overtime, game_type, stadium,
               home_score > away_score AS home_win, home_score + away_score AS total_points
        FROM latest""",
    "silver_matches": f"""{_latest_sql(
        {
            "match_id": "substr(md5(concat(year(o_orderdate), '_', "
            "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '_', "
            f"{_canonical(_HOME)}, '_', {_canonical(_AWAY)})), 1, 12)",
            **_MATCH_COLUMNS,
            "canonical_home": _canonical(_HOME),
            "canonical_away": _canonical(_AWAY),
        },
        ["match_id"],
    )}
        SELECT match_id, season, league, CAST(match_date AS DATE) AS match_date,
               canonical_home AS home_team, canonical_away AS away_team,
               CAST(home_goals AS BIGINT) AS home_goals, CAST(away_goals AS BIGINT) AS away_goals,
               home_xg, away_xg,
               CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A'
                    WHEN home_goals = away_goals THEN 'D' END AS result, venue
        FROM latest""",
    "silver_player_ratios": f"""WITH {_LINES_SQL},
        bronze AS (SELECT {", ".join(f"{e} AS {n}" for n, e in _PLAYER_COLUMNS.items())}
                   FROM lines)
        SELECT game_id, season, CAST(game_date AS DATE) AS game_date, player_id,
               trim(player_name, '{_BLANKS}') AS player_name,
               CAST(team_id AS BIGINT) AS team_id, {_canonical("team_name")} AS team,
               coalesce(is_home, false) AS is_home, coalesce(minutes, 0) AS minutes,
               coalesce(points, 0) AS points, rebounds, CAST(0 AS BIGINT) AS assists, steals,
               blocks, turnovers,
               CASE WHEN field_goals_attempted > 0
                    THEN field_goals_made / field_goals_attempted END AS field_goal_pct,
               CASE WHEN three_pointers_attempted > 0
                    THEN three_pointers_made / three_pointers_attempted END AS three_point_pct,
               CASE WHEN free_throws_attempted > 0
                    THEN free_throws_made / free_throws_attempted END AS free_throw_pct,
               coalesce(plus_minus, 0) AS plus_minus
        FROM bronze""",
    "silver_player_totals": f"""{_latest_sql(
        _PLAYER_WEEK_COLUMNS, ["player_id", "season", "week"]
    )}
        SELECT player_id, season, week, trim(player_display_name, '{_BLANKS}') AS player_name,
               CASE WHEN team IS NOT NULL THEN {_canonical("team")} END AS team, position,
               completions, passing_attempts, coalesce(passing_yards, 0) AS passing_yards,
               coalesce(passing_tds, 0) AS passing_tds, CAST(0 AS BIGINT) AS interceptions,
               CAST(0 AS BIGINT) AS sacks, CAST(0 AS BIGINT) AS carries, rushing_yards,
               rushing_tds, CAST(0 AS BIGINT) AS rushing_fumbles, CAST(0 AS BIGINT) AS receptions,
               CAST(0 AS BIGINT) AS targets, coalesce(receiving_yards, 0) AS receiving_yards,
               CAST(0 AS BIGINT) AS receiving_tds, fantasy_points,
               coalesce(passing_yards, 0) + rushing_yards + coalesce(receiving_yards, 0)
                   AS total_yards,
               coalesce(passing_tds, 0) + rushing_tds AS total_tds
        FROM latest""",
    "silver_player_defaults": f"""WITH {_LINES_SQL}
        SELECT '' AS match_id, CAST(year(o_orderdate) AS VARCHAR) AS season,
               o_orderpriority AS league, CAST(o_orderdate AS DATE) AS match_date,
               'Player ' || l_partkey AS player_name, {_canonical(_HOME)} AS team,
               {_canonical(_AWAY)} AS opponent, l_returnflag = 'R' AS is_home,
               CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS minutes,
               l_partkey % 3 AS goals, CAST(0 AS BIGINT) AS assists, l_discount * 10 AS xg,
               CASE WHEN l_tax > 0 THEN l_tax * 10 ELSE 0 END AS xa, l_suppkey % 6 AS shots,
               CAST(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END AS BIGINT) AS shots_on_target,
               CAST(0 AS BIGINT) AS key_passes, CAST(0 AS BIGINT) AS tackles,
               CAST(0 AS BIGINT) AS interceptions
        FROM lines""",
    "coerce_numeric": f"""
        WITH texts AS (SELECT event_id, {_NUMBER_TEXT} AS t FROM events)
        SELECT event_id, {_number("t")} AS number,
               {_number("replace('1,0' || t, ',', '')")} AS figure
        FROM texts""",
    "coerce_date": f"""
        SELECT event_id, TRY_CAST({_DATE_TEXT} AS DATE) AS day FROM events""",
    "fill_defaults": """
        SELECT event_id,
               CASE WHEN event_id % 5 > 1 THEN CAST(trunc(coalesce(value, 0)) AS BIGINT)
                    ELSE 0 END AS whole,
               CASE WHEN event_id % 5 > 1 THEN coalesce(value, 0) ELSE 0 END AS figure
        FROM events""",
    "safe_ratio": """
        WITH counts AS (
            SELECT user_id, count(*) FILTER (event_type = 'purchase') % 7 AS made,
                   count(*) FILTER (event_type = 'view') % 9 AS tries
            FROM events GROUP BY user_id)
        SELECT user_id, made / nullif(tries, 0) AS ratio FROM counts""",
    "slug": """
        SELECT p_partkey, regexp_replace(lower(p_name || ' ' || p_type), ' ', '_', 'g') AS slug
        FROM part""",
    "hash_id": """
        SELECT o_orderkey, left(md5(concat(
                   year(o_orderdate), '_', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '_',
                   CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority ELSE '' END, '_',
                   o_orderstatus)), 12) AS id
        FROM orders""",
    "presence_flag": f"""WITH {fx.GAMES_SQL}
        SELECT game_id, game_id % 6 IN (0, 2, 3, 4) AS present, game_id % 6 IN (0, 3) AS went_on
        FROM fx_games""",
    "home_flag": f"""WITH {fx.GAMES_SQL}
        SELECT game_id, home_team_id AS team_id, true AS is_home FROM fx_games
        UNION ALL SELECT game_id, away_team_id, false FROM fx_games""",
}
