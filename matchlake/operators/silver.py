"""Bronze rows to silver rows: canonical names, derived fields, one row per key.

Rows are cut to the latest per key before names are looked up, except where the
key itself is made of the canonical names.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.functions import (
    coerce_date,
    count_or_zero,
    derive_result,
    hash_id,
    number_or_zero,
    safe_ratio,
    strip_text,
)
from matchlake.operators.projection import number, optional, project
from matchlake.operators.top_n import deduplicate
from matchlake.sources.aliases import normalize_names

RECENCY = ("extract_timestamp",)

# Counters and figures that are 0 where the source has none.
BASKETBALL_COUNTS = ["points", "rebounds", "assists", "steals", "blocks", "turnovers"]
FOOTBALL_COUNTS = [
    "completions", "passing_attempts", "passing_tds", "interceptions", "sacks", "carries",
    "rushing_tds", "rushing_fumbles", "receptions", "targets", "receiving_tds",
]
FOOTBALL_FIGURES = ["passing_yards", "rushing_yards", "receiving_yards", "fantasy_points"]
SOCCER_COUNTS = [
    "minutes", "goals", "assists", "shots", "shots_on_target", "key_passes", "tackles",
    "interceptions",
]
SOCCER_FIGURES = ["xg", "xa"]


def _counts(df: DataFrame, names: Collection[str]) -> dict[str, Column]:
    return {name: count_or_zero(number(df, name)) for name in names}


def _figures(df: DataFrame, names: Collection[str]) -> dict[str, Column]:
    return {name: number_or_zero(number(df, name)) for name in names}


def _needed(
    bronze: DataFrame, table: str, recency: Sequence[str], *sources: str
) -> DataFrame:
    """Only the columns that silver is made of, before rows are shuffled or sorted."""
    wanted = {*schemas.gold(table).names, *recency, *sources}
    return bronze.select(*[c for c in bronze.columns if c in wanted])


def _flag(column: Column) -> Column:
    return F.coalesce(column.try_cast("boolean"), F.lit(False))


def basketball_games(
    bronze: DataFrame, lookup: DataFrame, recency: Sequence[str] = RECENCY
) -> DataFrame:
    """One row per game with canonical names, winner and total points."""
    rows = _needed(bronze, "nba_games", recency, "home_team_name", "away_team_name")
    latest = deduplicate(rows, ["game_id"], recency)
    home, away = number(latest, "home_score"), number(latest, "away_score")
    return project(
        normalize_names(
            latest,
            lookup,
            "basketball",
            {"home_team_name": "home_team", "away_team_name": "away_team"},
        ),
        schemas.gold("nba_games"),
        derived={
            "game_date": coerce_date(F.col("game_date")),
            "home_score": home,
            "away_score": away,
            "home_win": home > away,
            "total_points": home + away,
        },
    )


def basketball_players(bronze: DataFrame, lookup: DataFrame) -> DataFrame:
    """Player lines with shooting ratios; NULL where nothing was attempted."""

    def ratio(made: str, attempted: str) -> Column:
        return safe_ratio(
            number_or_zero(number(bronze, made)), number_or_zero(number(bronze, attempted))
        )

    return project(
        normalize_names(bronze, lookup, "basketball", {"team_name": "team"}),
        schemas.gold("nba_player_games"),
        derived={
            "game_date": coerce_date(F.col("game_date")),
            "player_name": strip_text(F.col("player_name")),
            "is_home": _flag(F.col("is_home")),
            **_counts(bronze, BASKETBALL_COUNTS),
            **_figures(bronze, ["minutes", "plus_minus"]),
            "field_goal_pct": ratio("field_goals_made", "field_goals_attempted"),
            "three_point_pct": ratio("three_pointers_made", "three_pointers_attempted"),
            "free_throw_pct": ratio("free_throws_made", "free_throws_attempted"),
        },
    )


def football_games(
    bronze: DataFrame, lookup: DataFrame, recency: Sequence[str] = RECENCY
) -> DataFrame:
    """One row per game with week, overtime flag, winner and total points."""
    rows = _needed(bronze, "nfl_games", recency, "gameday")
    latest = deduplicate(rows, ["game_id"], recency)
    home, away = number(latest, "home_score"), number(latest, "away_score")
    names = normalize_names(
        latest, lookup, "football", {"home_team": "__home", "away_team": "__away"}
    )
    return project(
        names,
        schemas.gold("nfl_games"),
        derived={
            "game_date": coerce_date(F.col("gameday")),
            "home_team": F.col("__home"),
            "away_team": F.col("__away"),
            "home_score": home,
            "away_score": away,
            "overtime": _flag(F.col("overtime")),
            "home_win": home > away,
            "total_points": home + away,
        },
    )


def football_players(
    bronze: DataFrame, lookup: DataFrame, recency: Sequence[str] = RECENCY
) -> DataFrame:
    """One row per player, season and week with yards and touchdowns in total."""
    rows = _needed(bronze, "nfl_players", recency, "player_display_name")
    latest = deduplicate(rows, ["player_id", "season", "week"], recency)
    counts, figures = _counts(latest, FOOTBALL_COUNTS), _figures(latest, FOOTBALL_FIGURES)
    names = normalize_names(latest, lookup, "football", {"team": "__team"})
    return project(
        names,
        schemas.gold("nfl_players"),
        derived={
            "player_name": strip_text(F.col("player_display_name")),
            "team": F.col("__team"),
            **counts,
            **figures,
            "total_yards": (
                figures["passing_yards"] + figures["rushing_yards"] + figures["receiving_yards"]
            ),
            "total_tds": counts["passing_tds"] + counts["rushing_tds"] + counts["receiving_tds"],
        },
    )


def soccer_matches(
    bronze: DataFrame, lookup: DataFrame, recency: Sequence[str] = RECENCY
) -> DataFrame:
    """One row per season, time and canonical names.

    The id is the start of a hash of these four.  It is for show: rows are told
    apart by the four themselves, so two matches whose ids collide both stay.
    """
    bronze = _needed(bronze, "soccer_matches", recency)
    named = normalize_names(
        bronze, lookup, "soccer", {"home_team": "__home", "away_team": "__away"}
    )
    home, away = number(bronze, "home_goals"), number(bronze, "away_goals")
    # Fixed value: the time format inside the hashed text.
    kickoff = F.date_format("match_date", "yyyy-MM-dd HH:mm:ss")
    identified = named.withColumn(
        "match_id", hash_id(F.col("season"), kickoff, F.col("__home"), F.col("__away"))
    )
    return project(
        deduplicate(identified, ["season", "match_date", "__home", "__away"], recency),
        schemas.gold("soccer_matches"),
        derived={
            "match_date": coerce_date(F.col("match_date")),
            "home_team": F.col("__home"),
            "away_team": F.col("__away"),
            "home_goals": home,
            "away_goals": away,
            "home_xg": number(bronze, "home_xg"),
            "away_xg": number(bronze, "away_xg"),
            "result": derive_result(home, away),
            "venue": optional(bronze, "venue"),
        },
    )


def soccer_players(bronze: DataFrame, lookup: DataFrame) -> DataFrame:
    """Player lines; every statistic that the source lacks is 0."""
    named = normalize_names(
        bronze, lookup, "soccer", {"team": "__team", "opponent": "__opponent"}
    )
    return project(
        named,
        schemas.gold("soccer_player_matches"),
        derived={
            "match_id": optional(bronze, "match_id") if "match_id" in bronze.columns else F.lit(""),
            "match_date": coerce_date(F.col("match_date")),
            "player_name": strip_text(F.col("player_name")),
            "team": F.col("__team"),
            "opponent": F.col("__opponent"),
            "is_home": _flag(F.col("is_home")),
            **_counts(bronze, SOCCER_COUNTS),
            **_figures(bronze, SOCCER_FIGURES),
        },
    )
