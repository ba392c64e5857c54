"""Between one row per match and one row per team and match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a home game is written, as in "LAL vs. BOS".
HOME_MARK = "vs."


def sides_sql(source: str, keep: Sequence[str], mirrored: Mapping[str, tuple[str, str]]) -> str:
    """SQL that turns each match of ``source`` into a home and an away row.

    ``mirrored`` maps an output column to the pair of source columns it takes
    for the home and for the away row.  UNPIVOT plans as one Expand above one
    scan: the source is not read or computed twice as with UNION ALL, and
    columns that nobody asks for are still pruned.
    """
    targets = ", ".join(mirrored)
    home = ", ".join(pair[0] for pair in mirrored.values())
    away = ", ".join(pair[1] for pair in mirrored.values())
    kept = "".join(f"{name}, " for name in keep)
    return (
        f"SELECT {kept}{targets}, side = 'home' AS is_home FROM {source} "
        f"UNPIVOT INCLUDE NULLS (({targets}) FOR side IN (({home}) AS home, ({away}) AS away))"
    )


def match_sides(
    matches: DataFrame, keep: Sequence[str], mirrored: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """DataFrame form of :func:`sides_sql`."""
    needed = dict.fromkeys([*keep, *(c for pair in mirrored.values() for c in pair)])
    return matches.sparkSession.sql(
        sides_sql("{matches}", keep, mirrored), matches=matches.select(*needed)
    )


def is_home_game(matchup: Column) -> Column:
    return matchup.contains(HOME_MARK)


def pair_home_away(log: DataFrame) -> DataFrame:
    """Join the two team rows of a game; games with one side only drop out.

    A row repeated in the log pairs once per copy.  Both sides shuffle on
    ``game_id`` and AQE splits a skewed key.  Where copies are to be dropped in
    the end anyway use :func:`pair_latest`.
    """
    home = log.where(is_home_game(F.col("matchup"))).select(
        "game_id",
        "game_date",
        F.col("team_id").alias("home_team_id"),
        F.col("team_name").alias("home_team_name"),
        F.col("pts").alias("home_score"),
    )
    away = log.where(~is_home_game(F.col("matchup"))).select(
        "game_id",
        F.col("team_id").alias("away_team_id"),
        F.col("team_name").alias("away_team_name"),
        F.col("pts").alias("away_score"),
    )
    return home.join(away, "game_id", "inner")


def pair_latest(log: DataFrame, recency: str) -> DataFrame:
    """Pair the latest home row with the latest away row of each game.

    The same games as pairing all copies and then keeping the latest, but with
    one scan and one shuffle, and a game with a million copies never multiplies.
    The log needs an orderable ``recency`` column.
    """
    # The recency leads the struct, so max() of the struct is the latest row and
    # the remaining fields break ties.
    row = F.struct(
        F.col(recency).alias("recency"), "game_date", "team_id", "team_name", "pts"
    )
    home = is_home_game(F.col("matchup"))
    paired = log.groupBy("game_id").agg(
        F.max(F.when(home, row)).alias("h"), F.max(F.when(~home, row)).alias("a")
    )
    return paired.where(F.col("h").isNotNull() & F.col("a").isNotNull()).select(
        "game_id",
        F.col("h.game_date").alias("game_date"),
        F.col("h.team_id").alias("home_team_id"),
        F.col("h.team_name").alias("home_team_name"),
        F.col("h.pts").alias("home_score"),
        F.col("a.team_id").alias("away_team_id"),
        F.col("a.team_name").alias("away_team_name"),
        F.col("a.pts").alias("away_score"),
    )
