"""Landing rows to bronze rows: rename, type, and stamp with the extract time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.functions import coerce_date, coerce_number, score_part, truth_flag, without_thousands
from matchlake.functions.columns import SCORE_DASH
from matchlake.operators.pairing import is_home_game, pair_home_away, pair_latest
from matchlake.operators.projection import computed_once, drop_incomplete, optional, project
from matchlake.operators.records import team_season_totals

# Bronze column <- landing column, where the names differ.
PLAYER_LOG_SOURCES = {
    "game_id": "GAME_ID",
    "player_id": "PLAYER_ID",
    "player_name": "PLAYER_NAME",
    "team_id": "TEAM_ID",
    "team_name": "TEAM_NAME",
    "minutes": "MIN",
    "points": "PTS",
    "rebounds": "REB",
    "assists": "AST",
    "steals": "STL",
    "blocks": "BLK",
    "turnovers": "TOV",
    "field_goals_made": "FGM",
    "field_goals_attempted": "FGA",
    "three_pointers_made": "FG3M",
    "three_pointers_attempted": "FG3A",
    "free_throws_made": "FTM",
    "free_throws_attempted": "FTA",
    "plus_minus": "PLUS_MINUS",
}
TEAM_METRIC_SOURCES = {
    "team_id": "TEAM_ID",
    "team_name": "TEAM_NAME",
    "games_played": "GP",
    "wins": "W",
    "losses": "L",
    "offensive_rating": "E_OFF_RATING",
    "defensive_rating": "E_DEF_RATING",
    "net_rating": "E_NET_RATING",
    "pace": "E_PACE",
}
TEAM_LOG_SOURCES = {
    "game_id": "GAME_ID",
    "game_date": "GAME_DATE",
    "team_id": "TEAM_ID",
    "team_name": "TEAM_NAME",
    "matchup": "MATCHUP",
    "pts": "PTS",
}
TEAM_TABLE_SOURCES = {
    "team": "Squad",
    "matches_played": "MP",
    "wins": "W",
    "draws": "D",
    "losses": "L",
    "goals_for": "GF",
    "goals_against": "GA",
    "goal_difference": "GD",
    "points": "Pts",
    "xg_for": "xG",
    "xg_against": "xGA",
}
PLAYER_TABLE_SOURCES = {
    "minutes": "Min",
    "goals": "Gls",
    "assists": "Ast",
    "shots": "Sh",
    "shots_on_target": "SoT",
    "xg": "xG",
    "xa": "xAG",
}
FINAL_STATUS = "Final"


def _stamp(extracted_at: Column | None) -> Column:
    return F.current_timestamp() if extracted_at is None else extracted_at


def basketball_games(
    team_log: DataFrame,
    season: str | Column,
    extracted_at: Column | None = None,
    recency: str = "GAME_DATE",
    every_copy: bool = False,
) -> DataFrame:
    """Pair the two log rows of each game.

    The latest row of each side by ``recency`` is paired: one shuffle, and a game that is in the
    log a million times still gives one row.  ``every_copy`` pairs each copy with
    each copy instead; silver keeps one of them, the same as here.
    """
    keep = [] if every_copy else [F.col(recency).alias("recency")]
    log = team_log.select(
        *keep, *[F.col(source).alias(name) for name, source in TEAM_LOG_SOURCES.items()]
    )
    games = pair_home_away(log) if every_copy else pair_latest(log, "recency")
    return project(
        games,
        schemas.bronze("basketball/games"),
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "status": F.lit(FINAL_STATUS),
        },
        required=["game_id", "game_date"],
    )


def basketball_players(
    player_log: DataFrame, season: str | Column, extracted_at: Column | None = None
) -> DataFrame:
    return project(
        player_log,
        schemas.bronze("basketball/player_stats"),
        sources=PLAYER_LOG_SOURCES,
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "game_date": F.col("GAME_DATE"),
            "is_home": is_home_game(F.col("MATCHUP")),
        },
        required=list(PLAYER_LOG_SOURCES),
    )


def basketball_teams(
    metrics: DataFrame, season: str | Column, extracted_at: Column | None = None
) -> DataFrame:
    """Season metrics; the four ratings may be missing from the source."""
    return project(
        metrics,
        schemas.bronze("basketball/team_stats"),
        sources=TEAM_METRIC_SOURCES,
        derived={"extract_timestamp": _stamp(extracted_at), "season": _literal(season)},
        required=["team_id", "team_name", "games_played", "wins", "losses"],
    )


def team_list(team_log: DataFrame) -> DataFrame:
    """The teams of a game log under their latest names; the short name is how their matchups begin."""
    named = F.struct("GAME_DATE", F.col("TEAM_NAME").alias("full_name"), F.regexp_extract("MATCHUP", r"^(.*?) (?:@|vs\.) ", 1).alias("abbreviation"))
    latest = team_log.where("TEAM_ID IS NOT NULL").groupBy(F.col("TEAM_ID").cast("bigint").alias("id")).agg(F.max(named).alias("latest"))
    return latest.select("id", "latest.full_name", "latest.abbreviation")


def football_games(
    schedule: DataFrame,
    season: int | Column,
    week: int | None = None,
    extracted_at: Column | None = None,
) -> DataFrame:
    """The schedule, all of it or one week."""
    return project(
        _one_week(schedule, week),
        schemas.bronze("football/games"),
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "overtime": truth_flag(optional(schedule, "overtime")),
        },
        required=["week", "game_id", "gameday", "home_team", "away_team"],
    )


def football_players(
    player_weeks: DataFrame,
    season: int | Column,
    week: int | None = None,
    extracted_at: Column | None = None,
) -> DataFrame:
    return project(
        _one_week(player_weeks, week),
        schemas.bronze("football/player_stats"),
        sources={"passing_attempts": "attempts"},
        derived={"extract_timestamp": _stamp(extracted_at), "season": _literal(season)},
        required=["week", "player_id", "player_name", "player_display_name"],
    )


def football_teams(
    schedule: DataFrame, season: int | Column, extracted_at: Column | None = None
) -> DataFrame:
    """Season records derived from the completed games of the schedule."""
    totals = team_season_totals(schedule.withColumn("season", _literal(season)))
    return project(
        totals,
        schemas.bronze("football/team_stats"),
        derived={"extract_timestamp": _stamp(extracted_at)},
    )


def soccer_matches(
    schedule_rows: DataFrame,
    season: str | Column,
    league: str | Column,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Completed rows of a schedule table, with the score split in two.

    ``schedule_rows`` has the text columns of the page table.  A score that is
    not two plain numbers (a shoot-out) leaves the goals NULL.
    """
    completed = schedule_rows.where(F.col("Score").contains(SCORE_DASH))
    matches = project(
        completed,
        schemas.bronze("soccer/matches"),
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "league": _literal(league),
            "match_date": coerce_date(optional(completed, "Date")),
            "home_team": optional(completed, "Home"),
            "away_team": optional(completed, "Away"),
            "home_goals": score_part(F.col("Score"), 1),
            "away_goals": score_part(F.col("Score"), 2),
            "home_xg": coerce_number(optional(completed, "xG")),
            "away_xg": coerce_number(optional(completed, "xG.1")),
            "venue": optional(completed, "Venue"),
            "referee": optional(completed, "Referee"),
            "attendance": coerce_number(without_thousands(optional(completed, "Attendance"))),
        },
    )
    # The date is costly to read; the filter is to see it as it has been read.
    return drop_incomplete(computed_once(matches, ["match_date"]), ["match_date", "home_team", "away_team"])


def soccer_teams(
    table_rows: DataFrame,
    season: str | Column,
    league: str | Column,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Season table rows; a count the table lacks is 0, an xG figure it lacks NULL."""
    contract = schemas.bronze("soccer/teams")
    counts = [f for f in TEAM_TABLE_SOURCES if f not in ("team", "xg_for", "xg_against")]
    teams = project(
        table_rows,
        contract,
        sources=TEAM_TABLE_SOURCES,
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "league": _literal(league),
            **{f: _figure(table_rows, TEAM_TABLE_SOURCES[f], 0.0) for f in counts},
            **{f: _figure(table_rows, TEAM_TABLE_SOURCES[f], None) for f in ("xg_for", "xg_against")},
        },
    )
    return drop_incomplete(teams, ["team"])


def soccer_players(
    table_rows: DataFrame,
    season: str | Column,
    league: str | Column,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Rows of the players' summary tables; team, opponent and date are not on them."""
    players = table_rows.where(optional(table_rows, "Player").isNotNull())
    return project(
        players,
        schemas.bronze("soccer/player_stats"),
        sources={"player_name": "Player"},
        derived={
            "extract_timestamp": _stamp(extracted_at),
            "season": _literal(season),
            "league": _literal(league),
            "match_date": F.lit(None),
            "team": F.lit(""),
            "opponent": F.lit(""),
            "is_home": F.lit(False),
            **{f: _figure(table_rows, source, 0.0) for f, source in PLAYER_TABLE_SOURCES.items()},
        },
    )


def _figure(df: DataFrame, column: str, absent: float | None) -> Column:
    """A figure of a page table; ``absent`` if the table has no such column."""
    if column in df.columns:
        return coerce_number(optional(df, column))
    return F.lit(absent).cast("double")


def _one_week(df: DataFrame, week: int | None) -> DataFrame:
    return df if week is None else df.where(F.col("week") == week)


def _literal(value: str | int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
