"""Gold tables kept up by folding the seasons that changed.

Each table has a state with one folder per season: the league table of the season, the
sums of each pair of teams, and the last matches of each team.  All three merge: league
tables stand side by side, sums add up, and the last N of all seasons are among the last N
of each.  A refresh replaces the folders of the touched seasons; a read folds states, which
have a row per team or pair and season, however many matches there were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import form, records, standings
from matchlake.session import drop_folder, path_exists

_SEASON = "season_folder"
# The columns of matches that the states are made of.
_NEEDED = (
    "match_id", "season", "league", "match_date", "home_team", "away_team", "home_goals", "away_goals",
    "home_xg", "away_xg", "result",
)


class GoldState:
    """The states below ``root``; ``n_matches`` is the longest form they can tell."""

    def __init__(self, spark: SparkSession, root: str, n_matches: int = 5) -> None:
        self.spark, self.root, self.n_matches = spark, root.rstrip("/"), n_matches

    def refresh(self, matches: DataFrame, emptied: Sequence[str] = ()) -> None:
        """Take over ``matches``, which must hold all matches of each season it has any of.

        ``emptied`` names seasons that have none any more.  A repeated refresh, after a
        failure for instance, gives the same states.
        """
        with self._stored(matches) as matches:
            sides = form.form_sides(matches, keep=["season"])
            states = {
                "standings": standings.league_standings(matches),
                "pairs": records.head_to_head(matches, by=["season"]),
                "form": form.last_sides(sides, self.n_matches, by=["season"]),
            }
            for name, state in states.items():
                folders = state.withColumn(_SEASON, F.col("season").cast("string"))
                folders = folders.hint("rebalance", _SEASON).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                folders.partitionBy(_SEASON).parquet(f"{self.root}/{name}")
                for season in emptied:
                    drop_folder(self.spark, f"{self.root}/{name}/{_SEASON}={season}")

    @contextmanager
    def _stored(self, matches: DataFrame) -> Iterator[DataFrame]:
        """What the states need of ``matches``, written once and read by each of them, so that joins and
        shuffles behind the matches run once a refresh."""
        path = f"{self.root}/_refresh-{uuid.uuid4().hex}"
        needed = matches.select(*[c for c in matches.columns if c in _NEEDED])
        try:
            needed.write.option("compression", "zstd").parquet(path)
            yield self.spark.read.schema(needed.schema).parquet(path)
        finally:
            drop_folder(self.spark, path)

    def _read(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            raise FileNotFoundError(f"no state at {path}; refresh first")
        return self.spark.read.parquet(path).drop(_SEASON)

    def league_standings(self) -> DataFrame:
        return self._read("standings")

    def head_to_head(self) -> DataFrame:
        keys = ["team_a", "team_b", "league"]
        pairs = self._read("pairs").drop("season")
        return pairs.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in pairs.columns if c not in keys])

    def team_form(self, n_matches: int | None = None) -> DataFrame:
        n = self.n_matches if n_matches is None else n_matches
        if n > self.n_matches:
            raise ValueError(f"the state holds the last {self.n_matches} matches of a season, not {n}")
        return form.form_of(self._read("form"), n)
