"""Standings, splits, form and records over the derived matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions import derive_result
from matchlake.operators import form, pairing, records, splits, standings
from matchlake.operators.top_n import top_n_per_group
from matchlake.workloads import fixtures as fx

QUERIES = {
    "league_standings": lambda spark, d: standings.league_standings(fx.matches(spark, d)),
    "winpct_standings": lambda spark, d: standings.winpct_standings(fx.games(spark, d)),
    "winpct_standings_ties": lambda spark, d: standings.winpct_standings_ties(fx.games(spark, d)),
    "home_form_summary": lambda spark, d: splits.home_form_summary(fx.matches(spark, d)),
    "home_avg_summary": lambda spark, d: splits.home_avg_summary(fx.games(spark, d)),
    "home_away_splits": lambda spark, d: splits.home_away_splits(fx.matches(spark, d)),
    "home_away_splits_avg": lambda spark, d: splits.home_away_splits_avg(fx.games(spark, d)),
    "team_form": lambda spark, d: form.team_form(fx.matches(spark, d), n_matches=5),
    "team_form_avg": lambda spark, d: form.team_form_avg(fx.games(spark, d), n_games=10),
    "head_to_head": lambda spark, d: records.head_to_head(fx.matches(spark, d)),
    "team_season_totals": lambda spark, d: records.team_season_totals(fx.games(spark, d)),
    "match_sides": lambda spark, d: pairing.match_sides(
        fx.matches(spark, d),
        keep=["match_id", "league", "season", "match_date"],
        mirrored={
            "team": ("home_team", "away_team"),
            "opponent": ("away_team", "home_team"),
            "scored": ("home_goals", "away_goals"),
            "conceded": ("away_goals", "home_goals"),
        },
    ),
    "top_n_per_group": lambda spark, d: top_n_per_group(
        fx.matches(spark, d).select("league", "home_team", "match_date", "match_id", "home_goals"),
        ["league", "home_team"],
        [F.col("match_date").desc_nulls_last(), F.col("match_id").desc_nulls_last()],
        3,
    ),
    "derive_result": lambda spark, d: fx.matches(spark, d).select(
        "match_id", derive_result(F.col("home_goals"), F.col("away_goals")).alias("result")
    ),
    "filter_week": lambda spark, d: fx.games(spark, d)
    .where(F.col("week") == 12)
    .select("game_id", "season", "week", "home_team", "away_team", "home_score", "away_score"),
    "pair_home_away": lambda spark, d: pairing.pair_home_away(fx.team_log(spark, d)),
    "pair_latest": lambda spark, d: pairing.pair_latest(
        _republished_log(spark, d), recency="published"
    ),
    "games_with_players": lambda spark, d: _games_with_players(spark, d),
}


def _republished_log(spark, sf_dir):
    """A home and an away row per order line: popular games are published often."""
    lines = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS game_id",
        "CAST(l_shipdate AS DATE) AS published",
        "CAST(l_shipdate AS DATE) AS game_date",
        "l_partkey AS home_id",
        "'P' || l_partkey AS home_name",
        "'a vs. b' AS home_matchup",
        "CAST(l_quantity AS BIGINT) AS home_pts",
        "l_suppkey AS away_id",
        "'S' || l_suppkey AS away_name",
        "'b @ a' AS away_matchup",
        "CAST(l_quantity AS BIGINT) + l_linenumber AS away_pts",
    )
    return pairing.match_sides(
        lines,
        keep=["game_id", "published", "game_date"],
        mirrored={
            "team_id": ("home_id", "away_id"),
            "team_name": ("home_name", "away_name"),
            "matchup": ("home_matchup", "away_matchup"),
            "pts": ("home_pts", "away_pts"),
        },
    )


def _games_with_players(spark, sf_dir):
    """Documented relationship: a game and its player rows share the game id."""
    orders = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS game_id", "CAST(o_orderdate AS DATE) AS game_date"
    )
    players = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS game_id", "l_partkey AS player_id", "CAST(l_quantity AS BIGINT) AS points"
    )
    joined = orders.join(players, "game_id", "inner")
    return joined.select("game_id", "game_date", "player_id", "points")


_WITH_MATCHES = f"WITH {fx.MATCHES_SQL}"
_WITH_GAMES = f"WITH {fx.GAMES_SQL}"

# One row per team and match, written as two scans.
_POINTS_SIDES_SQL = """,
team_rows AS (
    SELECT league, season, match_id, match_date, home_team AS team, away_team AS opponent,
           true AS at_home, home_goals AS f, away_goals AS a, home_xg AS xf, away_xg AS xa,
           CASE result WHEN 'H' THEN 3 WHEN 'D' THEN 1 WHEN 'A' THEN 0 END AS pts
    FROM fx_matches
    UNION ALL BY NAME
    SELECT league, season, match_id, match_date, away_team AS team, home_team AS opponent,
           false AS at_home, away_goals AS f, home_goals AS a, away_xg AS xf, home_xg AS xa,
           CASE result WHEN 'A' THEN 3 WHEN 'D' THEN 1 WHEN 'H' THEN 0 END AS pts
    FROM fx_matches
),
played_rows AS (
    SELECT t.* FROM team_rows t JOIN fx_matches m USING (match_id) WHERE m.home_goals IS NOT NULL
)"""

_GAME_SIDES_SQL = """,
team_rows AS (
    SELECT season, game_id, game_date, home_team AS team, home_team_id AS team_id,
           true AS at_home, home_score AS f, away_score AS a, coalesce(home_win, false) AS won,
           coalesce(home_score = away_score, false) AS tied
    FROM fx_games WHERE home_score IS NOT NULL
    UNION ALL BY NAME
    SELECT season, game_id, game_date, away_team AS team, away_team_id AS team_id,
           false AS at_home, away_score AS f, home_score AS a,
           coalesce(NOT home_win, false) AS won, coalesce(home_score = away_score, false) AS tied
    FROM fx_games WHERE home_score IS NOT NULL
)"""


def _difference(expression: str, digits: int) -> str:
    """A rounded difference without negative zero, which equals zero but prints apart."""
    rounded = f"round({expression}, {digits})"
    return f"CASE WHEN {rounded} = 0 THEN CAST(0 AS DOUBLE) ELSE {rounded} END"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


ORACLES = {
    "league_standings": f"""{_WITH_MATCHES} {_POINTS_SIDES_SQL},
        sums AS (
            SELECT league, season, team, count(*) AS n, count(*) FILTER (pts = 3) AS w,
                   count(*) FILTER (pts = 1) AS d, count(*) FILTER (pts = 0) AS l,
                   {_big("sum(f)")} AS gf, {_big("sum(a)")} AS ga, sum(xf) AS xf, sum(xa) AS xa
            FROM played_rows GROUP BY ALL)
        SELECT league, season, row_number() OVER (
                   PARTITION BY league, season
                   ORDER BY 3 * w + d DESC NULLS LAST, gf - ga DESC NULLS LAST,
                            gf DESC NULLS LAST, team) AS rank,
               team, n AS matches_played, w AS wins, d AS draws, l AS losses,
               gf AS goals_for, ga AS goals_against, gf - ga AS goal_difference,
               3 * w + d AS points, round(xf, 2) AS xg_for, round(xa, 2) AS xg_against,
               {_difference('xf - xa', 2)} AS xg_difference
        FROM sums""",
    "winpct_standings": f"""{_WITH_GAMES} {_GAME_SIDES_SQL},
        sums AS (
            SELECT season, team, team_id, count(*) AS n, count(*) FILTER (won) AS w,
                   count(*) FILTER (won AND at_home) AS hw,
                   count(*) FILTER (NOT won AND at_home) AS hl,
                   count(*) FILTER (won AND NOT at_home) AS aw,
                   count(*) FILTER (NOT won AND NOT at_home) AS al,
                   avg(f) AS f, avg(a) AS a
            FROM team_rows GROUP BY ALL)
        SELECT season, row_number() OVER (
                   PARTITION BY season ORDER BY w / n DESC NULLS LAST, team, team_id) AS rank,
               team, team_id, n AS games_played, w AS wins, n - w AS losses,
               round(w / n, 3) AS win_pct, hw AS home_wins, hl AS home_losses,
               aw AS away_wins, al AS away_losses, round(f, 1) AS points_per_game,
               round(a, 1) AS points_allowed_per_game,
               {_difference('f - a', 1)} AS point_differential
        FROM sums""",
    "winpct_standings_ties": f"""{_WITH_GAMES} {_GAME_SIDES_SQL},
        sums AS (
            SELECT season, team, count(*) AS n,
                   count(*) FILTER (won AND (at_home OR NOT tied)) AS w,
                   count(*) FILTER (tied) AS t,
                   count(*) FILTER (at_home AND won) AS hw,
                   count(*) FILTER (at_home AND NOT won AND NOT tied) AS hl,
                   count(*) FILTER (NOT at_home AND won AND NOT tied) AS aw,
                   count(*) FILTER (NOT at_home AND NOT won AND NOT tied) AS al,
                   {_big("sum(f)")} AS pf, {_big("sum(a)")} AS pa, avg(f) AS f, avg(a) AS a
            FROM team_rows
            GROUP BY ALL)
        SELECT season, row_number() OVER (
                   PARTITION BY season
                   ORDER BY w / n DESC NULLS LAST, pf - pa DESC NULLS LAST, team) AS rank,
               team, n AS games_played, w AS wins, n - w - t AS losses, t AS ties,
               round(w / n, 3) AS win_pct, hw AS home_wins, hl AS home_losses,
               aw AS away_wins, al AS away_losses, pf AS points_for, pa AS points_against,
               pf - pa AS point_differential, round(f, 1) AS points_per_game,
               round(a, 1) AS points_allowed_per_game
        FROM sums""",
    "home_form_summary": f"""{_WITH_MATCHES}
        SELECT home_team AS team, season, league, count(*) AS matches,
               {_big("sum(CASE result WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END)")}
                   AS home_points,
               {_big("sum(home_goals)")} AS goals_scored,
               {_big("sum(away_goals)")} AS goals_conceded
        FROM fx_matches GROUP BY ALL""",
    "home_avg_summary": f"""{_WITH_GAMES}
        SELECT home_team AS team, season, count(*) AS games,
               count(*) FILTER (home_win) AS home_wins,
               round(avg(home_score), 1) AS avg_home_score,
               round(avg(away_score), 1) AS avg_opponent_score
        FROM fx_games GROUP BY ALL""",
    "home_away_splits": f"""{_WITH_MATCHES} {_POINTS_SIDES_SQL},
        halves AS (
            SELECT at_home, team, league, season, count(*) AS n, count(*) FILTER (pts = 3) AS w,
                   count(*) FILTER (pts = 1) AS d, count(*) FILTER (pts = 0) AS l,
                   {_big("sum(f)")} AS gf, {_big("sum(a)")} AS ga,
                   round(sum(xf), 2) AS xf, round(sum(xa), 2) AS xa
            FROM played_rows GROUP BY ALL)
        SELECT coalesce(h.team, v.team) AS team, coalesce(h.league, v.league) AS league,
               coalesce(h.season, v.season) AS season,
               coalesce(h.n, 0) AS home_matches, coalesce(h.w, 0) AS home_wins,
               coalesce(h.d, 0) AS home_draws, coalesce(h.l, 0) AS home_losses,
               coalesce(h.gf, 0) AS home_goals_for, coalesce(h.ga, 0) AS home_goals_against,
               coalesce(h.xf, 0) AS home_xg_for, coalesce(h.xa, 0) AS home_xg_against,
               coalesce(v.n, 0) AS away_matches, coalesce(v.w, 0) AS away_wins,
               coalesce(v.d, 0) AS away_draws, coalesce(v.l, 0) AS away_losses,
               coalesce(v.gf, 0) AS away_goals_for, coalesce(v.ga, 0) AS away_goals_against,
               coalesce(v.xf, 0) AS away_xg_for, coalesce(v.xa, 0) AS away_xg_against
        FROM (FROM halves WHERE at_home) h FULL JOIN (FROM halves WHERE NOT at_home) v
          ON h.team = v.team AND h.league = v.league AND h.season = v.season""",
    "home_away_splits_avg": f"""{_WITH_GAMES} {_GAME_SIDES_SQL},
        halves AS (
            SELECT at_home, team, team_id, season, count(*) AS n, count(*) FILTER (won) AS w,
                   round(avg(f), 1) AS f, round(avg(a), 1) AS a
            FROM team_rows GROUP BY ALL)
        SELECT coalesce(h.team, v.team) AS team, coalesce(h.team_id, v.team_id) AS team_id,
               coalesce(h.season, v.season) AS season,
               coalesce(h.n, 0) AS home_games, coalesce(h.w, 0) AS home_wins,
               coalesce(h.n - h.w, 0) AS home_losses,
               coalesce(h.f, 0) AS home_avg_points_scored,
               coalesce(h.a, 0) AS home_avg_points_allowed,
               coalesce(v.n, 0) AS away_games, coalesce(v.w, 0) AS away_wins,
               coalesce(v.n - v.w, 0) AS away_losses,
               coalesce(v.f, 0) AS away_avg_points_scored,
               coalesce(v.a, 0) AS away_avg_points_allowed
        FROM (FROM halves WHERE at_home) h FULL JOIN (FROM halves WHERE NOT at_home) v
          ON h.team = v.team AND h.team_id = v.team_id AND h.season = v.season""",
    "team_form": f"""{_WITH_MATCHES} {_POINTS_SIDES_SQL},
        recent AS (
            SELECT *, CASE pts WHEN 3 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END AS outcome
            FROM team_rows
            QUALIFY row_number() OVER (
                PARTITION BY team, league
                ORDER BY match_date DESC NULLS LAST, match_id DESC) <= 5)
        SELECT team, league, max(match_date) AS as_of_date, 5 AS last_n_matches,
               count(*) FILTER (outcome = 'W') AS wins, count(*) FILTER (outcome = 'D') AS draws,
               count(*) FILTER (outcome = 'L') AS losses,
               {_big("sum(f)")} AS goals_scored, {_big("sum(a)")} AS goals_conceded,
               round(sum(xf), 2) AS xg_for, round(sum(xa), 2) AS xg_against,
               {_big("sum(coalesce(pts, 0))")} AS points,
               string_agg(outcome, '' ORDER BY match_date DESC NULLS LAST, match_id DESC)
                   AS form_string
        FROM recent GROUP BY team, league""",
    "team_form_avg": f"""{_WITH_GAMES} {_GAME_SIDES_SQL},
        recent AS (
            SELECT * FROM team_rows
            QUALIFY row_number() OVER (
                PARTITION BY team_id ORDER BY game_date DESC NULLS LAST, game_id DESC) <= 10)
        SELECT team, team_id, max(game_date) AS as_of_date, 10 AS last_n_games,
               count(*) FILTER (won) AS wins, 10 - count(*) FILTER (won) AS losses,
               round(avg(f), 1) AS avg_points_scored, round(avg(a), 1) AS avg_points_allowed,
               {_difference('avg(f - a)', 1)} AS avg_point_diff, count(*) AS games_in_window
        FROM recent GROUP BY team, team_id""",
    "head_to_head": f"""{_WITH_MATCHES},
        pairs AS (
            SELECT league, home_team < away_team AS a_home, result,
                   [home_team, away_team].list_sort() AS names,
                   home_goals AS hg, away_goals AS ag
            FROM fx_matches WHERE home_goals IS NOT NULL)
        SELECT names[1] AS team_a, names[2] AS team_b, league, count(*) AS total_matches,
               count(*) FILTER (result = CASE WHEN a_home THEN 'H' ELSE 'A' END) AS team_a_wins,
               count(*) FILTER (result = 'D') AS draws,
               count(*) FILTER (result = CASE WHEN a_home THEN 'A' ELSE 'H' END) AS team_b_wins,
               {_big("sum(CASE WHEN a_home THEN hg ELSE ag END)")} AS team_a_goals,
               {_big("sum(CASE WHEN a_home THEN ag ELSE hg END)")} AS team_b_goals
        FROM pairs GROUP BY names, league""",
    "team_season_totals": f"""{_WITH_GAMES} {_GAME_SIDES_SQL}
        SELECT season, team, {_big("sum(f - a)")} AS point_differential,
               count(*) AS games_played, count(*) FILTER (f > a) AS wins,
               count(*) FILTER (f < a) AS losses, count(*) FILTER (f = a) AS ties,
               {_big("sum(f)")} AS points_for, {_big("sum(a)")} AS points_against,
               count(*) FILTER (at_home AND f > a) AS home_wins,
               count(*) FILTER (at_home AND f < a) AS home_losses,
               count(*) FILTER (NOT at_home AND f > a) AS away_wins,
               count(*) FILTER (NOT at_home AND f < a) AS away_losses
        FROM team_rows WHERE f IS NOT NULL AND a IS NOT NULL GROUP BY season, team""",
    "match_sides": f"""{_WITH_MATCHES} {_POINTS_SIDES_SQL}
        SELECT match_id, league, season, match_date, team, opponent, f AS scored,
               a AS conceded, at_home AS is_home FROM team_rows""",
    "top_n_per_group": f"""{_WITH_MATCHES}
        SELECT league, home_team, match_date, match_id, home_goals FROM fx_matches
        QUALIFY row_number() OVER (
            PARTITION BY league, home_team
            ORDER BY match_date DESC NULLS LAST, match_id DESC) <= 3""",
    "derive_result": f"""{_WITH_MATCHES}
        SELECT match_id, CASE WHEN home_goals IS NULL OR away_goals IS NULL THEN NULL
                              WHEN home_goals = away_goals THEN 'D'
                              WHEN home_goals > away_goals THEN 'H' ELSE 'A' END AS result
        FROM fx_matches""",
    "filter_week": f"""{_WITH_GAMES}
        SELECT game_id, season, week, home_team, away_team, home_score, away_score
        FROM fx_games WHERE week = 12""",
    "pair_home_away": f"""WITH {fx.TEAM_LOG_SQL.replace("fx_team_log AS (", "fx_team_log AS MATERIALIZED (")}
        SELECT h.game_id, h.game_date, h.team_id AS home_team_id, h.team_name AS home_team_name,
               h.pts AS home_score, v.team_id AS away_team_id, v.team_name AS away_team_name,
               v.pts AS away_score
        FROM fx_team_log h JOIN fx_team_log v USING (game_id)
        WHERE position('vs.' IN h.matchup) > 0 AND position('vs.' IN v.matchup) = 0""",
    "pair_latest": """WITH latest_home AS (
            SELECT l_orderkey AS game_id, CAST(l_shipdate AS DATE) AS game_date,
                   l_partkey AS team_id, 'P' || l_partkey AS team_name,
                   CAST(l_quantity AS BIGINT) AS pts FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) = 1),
        latest_away AS (
            SELECT l_orderkey AS game_id, l_suppkey AS team_id, 'S' || l_suppkey AS team_name,
                   CAST(l_quantity AS BIGINT) + l_linenumber AS pts FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_shipdate DESC, l_suppkey DESC,
                         CAST(l_quantity AS BIGINT) + l_linenumber DESC) = 1)
        SELECT game_id, h.game_date, h.team_id AS home_team_id, h.team_name AS home_team_name,
               h.pts AS home_score, v.team_id AS away_team_id, v.team_name AS away_team_name,
               v.pts AS away_score
        FROM latest_home h JOIN latest_away v USING (game_id)""",
    "games_with_players": """
        SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
               l_partkey AS player_id, CAST(l_quantity AS BIGINT) AS points
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
}
