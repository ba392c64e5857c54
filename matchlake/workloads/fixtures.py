"""Match records derived from the star-schema tables.

Each fixture exists twice: as a Spark plan over the Parquet tables and as SQL
text (a ``WITH`` entry) for the engine that checks the results.  All of them
grow with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.pairing import match_sides
from matchlake.session import shared_folder


# Column types of the given tables; with them no job has to read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in tables})


# Rows of lineitem move once for the parts, once for the orders and, where they are many, once for the
# suppliers; they are cut to what a match needs before that, and names are added when they have arrived.
_MATCHES = """
WITH lines AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_discount * 10 AS home_xg, l_tax * 10 AS away_xg,
           CAST(conv(substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15), 16, 10) AS BIGINT) AS match_id,
           if(l_orderkey % 20 <> 0, CAST(l_quantity AS INT) % 6, NULL) AS home_goals
    FROM {lineitem}
),
sized AS (
    SELECT l_orderkey, l_suppkey, match_id, home_goals, home_xg, away_xg,
           if(l_orderkey % 20 <> 0 AND l_orderkey % 33 <> 0, p_size % 6, NULL) AS away_goals
    FROM lines JOIN {part} ON l_partkey = p_partkey
),
away_sides AS (
    SELECT l_orderkey, s_nationkey, match_id, home_goals, away_goals, home_xg, away_xg
    FROM sized JOIN {supplier} ON l_suppkey = s_suppkey
),
home_sides AS (
    SELECT o_orderkey, o_orderdate, c_nationkey FROM {orders} JOIN {customer} ON o_custkey = c_custkey
)
SELECT match_id, year(o_orderdate) AS season, r_name AS league,
       CAST(o_orderdate AS DATE) AS match_date,
       home.n_nationkey AS home_team_id, home.n_name AS home_team,
       away.n_nationkey AS away_team_id, away.n_name AS away_team,
       home_goals, away_goals, home_xg, away_xg,
       CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A'
            WHEN home_goals = away_goals THEN 'D' END AS result,
       concat_ws(' ', 'Stadium', home.n_name) AS venue
FROM away_sides
JOIN home_sides ON l_orderkey = o_orderkey
JOIN {nation} home ON c_nationkey = home.n_nationkey
JOIN {region} ON home.n_regionkey = r_regionkey
JOIN {nation} away ON s_nationkey = away.n_nationkey
WHERE home.n_name <> away.n_name
"""


#: Where :func:`store_matches` has put the matches of a folder of tables.
_STORED: dict[str, str] = {}


def store_matches(spark: SparkSession, sf_dir: str) -> None:
    """Write the matches once; from then on they are read, so that timings are of operators."""
    path = shared_folder(spark, "matches")
    matches(spark, sf_dir).repartition(8).write.parquet(path)
    _STORED[sf_dir] = path


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match per order line that joins two different nations; no team plays itself.

    The home side is the nation of the customer, the away side that of the
    supplier.  No join carries a hint: sizes come from the files and AQE, and so
    does the choice to broadcast.
    """
    if sf_dir in _STORED:
        return spark.read.parquet(_STORED[sf_dir])
    return _sql(
        spark, sf_dir, _MATCHES,
        "lineitem", "orders", "customer", "supplier", "part", "nation", "region",
    )


MATCHES_SQL = """
fx_scores AS (
    SELECT ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15))::BIGINT AS match_id, CAST(year(o_orderdate) AS INT) AS season, r_name AS league,
           CAST(o_orderdate AS DATE) AS match_date,
           hn.n_nationkey AS home_team_id, hn.n_name AS home_team,
           an.n_nationkey AS away_team_id, an.n_name AS away_team,
           CASE WHEN o_orderkey % 20 <> 0 THEN CAST(l_quantity AS INT) % 6 END AS home_goals,
           CASE WHEN o_orderkey % 20 <> 0 AND o_orderkey % 33 <> 0 THEN p_size % 6 END
               AS away_goals,
           l_discount * 10 AS home_xg, l_tax * 10 AS away_xg,
           'Stadium ' || hn.n_name AS venue
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN part ON l_partkey = p_partkey
    JOIN nation hn ON c_nationkey = hn.n_nationkey
    JOIN region ON hn.n_regionkey = r_regionkey
    JOIN nation an ON s_nationkey = an.n_nationkey
    WHERE hn.n_name <> an.n_name
),
fx_matches AS (
    SELECT *, CASE sign(home_goals - away_goals) WHEN 1 THEN 'H' WHEN -1 THEN 'A' WHEN 0 THEN 'D'
              END AS result
    FROM fx_scores
)"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fixtures as games with high scores, a week and a winner flag."""
    return matches(spark, sf_dir).selectExpr(
        "match_id AS game_id", "season", "weekofyear(match_date) AS week",
        "match_date AS game_date", "home_team_id", "home_team", "away_team_id", "away_team",
        "home_goals + 80 AS home_score", "away_goals + 80 AS away_score",
        "home_goals > away_goals AS home_win", "home_goals + away_goals + 160 AS total_points",
    )


GAMES_SQL = (
    MATCHES_SQL
    + """,
fx_games AS (
    SELECT match_id AS game_id, season, CAST(week(match_date) AS INT) AS week,
           match_date AS game_date, home_team_id, home_team, away_team_id, away_team,
           home_goals + 80 AS home_score, away_goals + 80 AS away_score,
           home_goals > away_goals AS home_win,
           home_goals + away_goals + 160 AS total_points
    FROM fx_matches
)"""
)


def team_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per game, as a league publishes its game log."""
    named = games(spark, sf_dir).withColumns(
        {
            "home_matchup": F.concat("home_team", F.lit(" vs. "), "away_team"),
            "away_matchup": F.concat("away_team", F.lit(" @ "), "home_team"),
        }
    )
    return match_sides(
        named,
        keep=["game_id", "game_date"],
        mirrored={
            "team_id": ("home_team_id", "away_team_id"),
            "team_name": ("home_team", "away_team"),
            "matchup": ("home_matchup", "away_matchup"),
            "pts": ("home_score", "away_score"),
        },
    ).drop("is_home")


TEAM_LOG_SQL = (
    GAMES_SQL
    + """,
fx_team_log AS (
    SELECT game_id, game_date, home_team_id AS team_id, home_team AS team_name,
           home_team || ' vs. ' || away_team AS matchup, home_score AS pts FROM fx_games
    UNION ALL
    SELECT game_id, game_date, away_team_id, away_team,
           away_team || ' @ ' || home_team, away_score FROM fx_games
)"""
)
