"""Season tables: each match seen from both sides, summed per team, then ranked.

The queries are SQL templates over ``{matches}`` so that one text serves both as
a DataFrame function and as a view in the catalog.  They nest subqueries rather
than naming them in a WITH list, through which a later filter on the season or
league would not move down to the files.

Every rank ends in the team name, which keeps ties in the same order on every
run.  Aggregation happens in each map task before the shuffle, so a team or
league with a third of all matches sends one row per task; the ranking window
sees one row per team.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchlake.operators.pairing import sides_sql


def _rounded(number: str, digits: int) -> str:
    """SQL form of ``round_to``."""
    return f"round(({number}) * 1e{digits}) / 1e{digits}"


_POINTS_SIDES = sides_sql(
    """(
        SELECT league, season, home_team, away_team, home_goals, away_goals,
               coalesce(home_xg, 0) AS home_chances, coalesce(away_xg, 0) AS away_chances,
               result = 'H' AS home_won, result = 'A' AS away_won, result = 'D' AS drawn
        FROM {matches} WHERE home_goals IS NOT NULL
    )""",
    keep=["league", "season", "drawn"],
    mirrored={
        "team": ("home_team", "away_team"),
        "won": ("home_won", "away_won"),
        "lost": ("away_won", "home_won"),
        "scored": ("home_goals", "away_goals"),
        "conceded": ("away_goals", "home_goals"),
        "chances_for": ("home_chances", "away_chances"),
        "chances_against": ("away_chances", "home_chances"),
    },
)

_LEAGUE_STANDINGS_SUMS = f"""
SELECT league, season, team,
       count(*) AS matches_played,
       count(*) FILTER (WHERE won) AS wins,
       count(*) FILTER (WHERE drawn) AS draws,
       count(*) FILTER (WHERE lost) AS losses,
       sum(scored) AS goals_for, sum(conceded) AS goals_against,
       sum(chances_for) AS chances_for, sum(chances_against) AS chances_against
FROM ({_POINTS_SIDES}) GROUP BY league, season, team
"""

LEAGUE_STANDINGS = f"""
SELECT league, season,
       CAST(row_number() OVER (
           PARTITION BY league, season
           ORDER BY points DESC NULLS LAST, goal_difference DESC NULLS LAST,
                    goals_for DESC NULLS LAST, team ASC NULLS LAST) AS BIGINT) AS rank,
       team, matches_played, wins, draws, losses, goals_for, goals_against,
       goal_difference, points,
       {_rounded("chances_for", 2)} AS xg_for,
       {_rounded("chances_against", 2)} AS xg_against,
       {_rounded("chances_for - chances_against", 2)} AS xg_difference
FROM (
    SELECT *, goals_for - goals_against AS goal_difference, 3 * wins + draws AS points
    FROM ({_LEAGUE_STANDINGS_SUMS})
)
"""

# A missing home_win counts as lost for both sides; so does a drawn game for the
# home side, while the away side is credited with it.
_GAME_SIDES = sides_sql(
    """(
        SELECT season, home_team, home_team_id, away_team, away_team_id,
               home_score, away_score,
               coalesce(home_win, false) AS home_won, coalesce(NOT home_win, false) AS away_won
        FROM {matches} WHERE home_score IS NOT NULL
    )""",
    keep=["season"],
    mirrored={
        "team": ("home_team", "away_team"),
        "team_id": ("home_team_id", "away_team_id"),
        "won": ("home_won", "away_won"),
        "scored": ("home_score", "away_score"),
        "allowed": ("away_score", "home_score"),
    },
)

_WINPCT_STANDINGS_SUMS = f"""
SELECT season, team, team_id,
       count(*) AS games_played, count(*) FILTER (WHERE won) AS wins,
       count(*) FILTER (WHERE is_home AND won) AS home_wins, count(*) FILTER (WHERE is_home AND NOT won) AS home_losses,
       count(*) FILTER (WHERE NOT is_home AND won) AS away_wins,
       count(*) FILTER (WHERE NOT is_home AND NOT won) AS away_losses,
       avg(scored) AS scored, avg(allowed) AS allowed
FROM ({_GAME_SIDES}) GROUP BY season, team, team_id
"""

WINPCT_STANDINGS = f"""
SELECT season,
       CAST(row_number() OVER (
           PARTITION BY season
           ORDER BY share DESC NULLS LAST, team ASC NULLS LAST,
                    team_id ASC NULLS LAST) AS BIGINT) AS rank,
       team, team_id, games_played, wins, games_played - wins AS losses,
       {_rounded("share", 3)} AS win_pct,
       home_wins, home_losses, away_wins, away_losses,
       {_rounded("scored", 1)} AS points_per_game,
       {_rounded("allowed", 1)} AS points_allowed_per_game,
       {_rounded("scored - allowed", 1)} AS point_differential
FROM (
    SELECT *, CAST(wins AS DOUBLE) / games_played AS share FROM ({_WINPCT_STANDINGS_SUMS})
)
"""

_TIED_SIDES = sides_sql(
    """(
        SELECT season, home_team, away_team, home_score, away_score,
               coalesce(home_score = away_score, false) AS tied,
               coalesce(home_win, false) AS home_won,
               coalesce(NOT home_win AND home_score <> away_score, false) AS away_won
        FROM {matches} WHERE home_score IS NOT NULL
    )""",
    keep=["season", "tied"],
    mirrored={
        "team": ("home_team", "away_team"),
        "won": ("home_won", "away_won"),
        "scored": ("home_score", "away_score"),
        "allowed": ("away_score", "home_score"),
    },
)

# Losses are what is left after wins and ties, so they go below zero only if a
# tied game is also marked as won.
_WINPCT_STANDINGS_TIES_SUMS = f"""
SELECT season, team,
       count(*) AS games_played, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE tied) AS ties,
       count(*) FILTER (WHERE is_home) AS home_games,
       count(*) FILTER (WHERE is_home AND won) AS home_wins, count(*) FILTER (WHERE is_home AND tied) AS home_ties,
       count(*) FILTER (WHERE NOT is_home) AS away_games,
       count(*) FILTER (WHERE NOT is_home AND won) AS away_wins,
       count(*) FILTER (WHERE NOT is_home AND tied) AS away_ties,
       sum(scored) AS points_for, sum(allowed) AS points_against,
       avg(scored) AS scored, avg(allowed) AS allowed
FROM ({_TIED_SIDES}) GROUP BY season, team
"""

WINPCT_STANDINGS_TIES = f"""
SELECT season,
       CAST(row_number() OVER (
           PARTITION BY season
           ORDER BY share DESC NULLS LAST, point_differential DESC NULLS LAST,
                    team ASC NULLS LAST) AS BIGINT) AS rank,
       team, games_played, wins, games_played - wins - ties AS losses, ties,
       {_rounded("share", 3)} AS win_pct,
       home_wins, home_games - home_wins - home_ties AS home_losses,
       away_wins, away_games - away_wins - away_ties AS away_losses,
       points_for, points_against, point_differential,
       {_rounded("scored", 1)} AS points_per_game,
       {_rounded("allowed", 1)} AS points_allowed_per_game
FROM (
    SELECT *, CAST(wins AS DOUBLE) / games_played AS share,
           points_for - points_against AS point_differential
    FROM ({_WINPCT_STANDINGS_TIES_SUMS})
)
"""


_MONTH_SIDES = sides_sql(
    """(
        SELECT league, season, last_day(match_date) AS month, home_team, away_team, home_goals, away_goals,
               result = 'H' AS home_won, result = 'A' AS away_won, result = 'D' AS drawn
        FROM {matches} WHERE home_goals IS NOT NULL AND match_date IS NOT NULL
    )""",
    keep=["league", "season", "month", "drawn"],
    mirrored={
        "team": ("home_team", "away_team"),
        "won": ("home_won", "away_won"),
        "lost": ("away_won", "home_won"),
        "scored": ("home_goals", "away_goals"),
        "conceded": ("away_goals", "home_goals"),
    },
)

_MONTH_SUMS = f"""
SELECT league, season, month, team,
       count(*) AS n, count(*) FILTER (WHERE won) AS w, count(*) FILTER (WHERE drawn) AS d,
       count(*) FILTER (WHERE lost) AS l, sum(scored) AS f, sum(conceded) AS a
FROM ({_MONTH_SIDES}) GROUP BY league, season, month, team
"""

# A row per team and month it played in holds until its next one; in between it is repeated
# for the months that others played in.  All windows run within a league and season, and
# so after one shuffle of a row per team and month.
STANDINGS_BY_MONTH = f"""
SELECT league, season, as_of, rank, team, matches_played, wins, draws, losses, goals_for, goals_against,
       goal_difference, points,
       lag(rank) OVER (PARTITION BY league, season, team ORDER BY as_of) - rank AS places_gained
FROM (
    SELECT *, CAST(row_number() OVER (
               PARTITION BY league, season, as_of
               ORDER BY points DESC NULLS LAST, goal_difference DESC NULLS LAST,
                        goals_for DESC NULLS LAST, team ASC NULLS LAST) AS BIGINT) AS rank
    FROM (
        SELECT league, season, explode(filter(months, m -> m >= month AND (until IS NULL OR m < until))) AS as_of, team,
               matches_played, wins, draws, losses, goals_for, goals_against,
               goals_for - goals_against AS goal_difference, 3 * wins + draws AS points
        FROM (
            SELECT league, season, month, team,
                   collect_set(month) OVER (PARTITION BY league, season) AS months,
                   lead(month) OVER so_far AS until,
                   sum(n) OVER so_far AS matches_played, sum(w) OVER so_far AS wins,
                   sum(d) OVER so_far AS draws, sum(l) OVER so_far AS losses,
                   sum(f) OVER so_far AS goals_for, sum(a) OVER so_far AS goals_against
            FROM ({_MONTH_SUMS})
            WINDOW so_far AS (PARTITION BY league, season, team ORDER BY month)
        )
    )
)
"""


def league_standings(matches: DataFrame) -> DataFrame:
    """Points table per league and season (3 for a win, 1 for a draw)."""
    return matches.sparkSession.sql(LEAGUE_STANDINGS, matches=matches)


def winpct_standings(games: DataFrame) -> DataFrame:
    """Win-percentage table per season, without ties."""
    return games.sparkSession.sql(WINPCT_STANDINGS, matches=games)


def winpct_standings_ties(games: DataFrame) -> DataFrame:
    """Win-percentage table per season that counts ties apart."""
    return games.sparkSession.sql(WINPCT_STANDINGS_TIES, matches=games)


def standings_by_month(matches: DataFrame) -> DataFrame:
    """Points table per league and season as of the end of each month that saw a match.

    A table lists the teams that have played by then; ``places_gained`` is what a team rose
    since its table before.  Matches without a date are left out.
    """
    return matches.sparkSession.sql(STANDINGS_BY_MONTH, matches=matches)
