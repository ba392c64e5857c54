"""Bronze to silver as new snapshots arrive, instead of all history every day.

The silver dataset is partitioned by season.  A trigger looks at the snapshot
files that are new since the last one, finds the seasons they touch, and
rewrites just those from all their snapshots with the same projection that the
batch job uses.  Touched are the seasons of the new rows and those that hold an
older row of one of their keys: a game that moved to another season leaves the old
one.  Rewriting a season is idempotent: a batch that is replayed after a failure
gives the same files, and late rows win by the same keep-latest rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import drop_folder, path_exists
from matchlake.sinks.writers import SEASON, write_silver
from matchlake.sources.scans import (
    bronze_contract,
    bronze_path,
    scan_bronze,
    scan_silver,
    silver_path,
)


def refresh_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    sport: str,
    dataset: str,
    project: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    key: Sequence[str] = (),
) -> None:
    """Process every snapshot that has arrived since the last call, then stop.

    ``checkpoint`` is a folder on storage that all executors share; it remembers
    which files are done.  ``key`` names the columns that tell silver rows apart; it
    may be left out only where rows never change their season.
    """
    keys = list(key)

    def update(new_rows: DataFrame, _epoch: int) -> None:
        # Names of season folders, of which the driver holds a listing anyway.  As
        # literals they prune the folders that are read; a join would not.
        fresh = project(new_rows)
        seasons = fresh.select(SEASON)
        stored = None
        if keys and path_exists(spark, silver_path(silver_root, sport, dataset)):
            stored = scan_silver(spark, silver_root, sport, dataset, fresh.schema).select(*keys, SEASON)
            seasons = seasons.unionByName(_matching(stored, fresh, keys, "left_semi").select(SEASON))
        touched = [row[SEASON] for row in seasons.distinct().collect()]
        current = project(scan_bronze(spark, bronze_root, sport, dataset).where(_in(touched)))
        if stored is not None:
            # What silver holds in another season by now is an older copy here.
            current = _matching(current, stored.where(~_in(touched)), keys, "left_anti")
        write_silver(current, silver_root, sport, dataset, mode="dynamic")
        if stored is not None:
            left = {row[SEASON] for row in current.select(SEASON).distinct().collect()}
            for season in set(touched) - left:  # its only rows have moved away
                name = "__HIVE_DEFAULT_PARTITION__" if season is None else season
                drop_folder(spark, f"{silver_path(silver_root, sport, dataset)}/{SEASON}={name}")

    (
        spark.readStream.schema(bronze_contract(sport, dataset))
        .option("ignoreMissingFiles", True)
        .parquet(bronze_path(bronze_root, sport, dataset))
        .writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _in(seasons: list) -> Column:
    """Whether the season is one of these; NULL is a season."""
    known = F.coalesce(F.col(SEASON).isin([x for x in seasons if x is not None]), F.lit(False))
    return known | F.col(SEASON).isNull() if None in seasons else known


def _matching(rows: DataFrame, others: DataFrame, keys: list[str], how: str) -> DataFrame:
    names = [f"__{k}" for k in keys]
    other = others.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return rows.join(other, same, how)
