"""Writing datasets and loading catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.functions import slug
from matchlake.operators import splits, standings
from matchlake.session import drop_folder
from matchlake.sources.scans import bronze_path, partition_columns, silver_path

GOLD = "gold"
SEASON = "season"

# View name -> (base table, query).
VIEWS = {
    "v_soccer_recent_form": ("soccer_matches", splits.HOME_FORM_SUMMARY),
    "v_nba_team_summary": ("nba_games", splits.HOME_AVG_SUMMARY),
    "v_soccer_league_standings": ("soccer_matches", standings.LEAGUE_STANDINGS),
    "v_nba_standings": ("nba_games", standings.WINPCT_STANDINGS),
    "v_soccer_home_away_splits": ("soccer_matches", splits.HOME_AWAY_SPLITS),
    "v_nba_home_away_splits": ("nba_games", splits.HOME_AWAY_SPLITS_AVG),
    "v_nfl_standings": ("nfl_games", standings.WINPCT_STANDINGS_TIES),
}


def write_dataset(df: DataFrame, path: str) -> str:
    """Write Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_silver(df: DataFrame, root: str, sport: str, dataset: str, mode: str = "static", arranged: bool = False) -> str:
    """Write a silver dataset with one folder per season.

    ``static`` replaces the dataset, ``dynamic`` only the seasons in ``df``.  The
    rows are rebalanced by season first: AQE splits a season that is larger than
    the advisory partition size and merges small ones, so that neither one task
    gets a whole hot season nor every task writes to every folder.  Rows that are read
    season by season already (``arranged``) stay where they are.
    """
    path = silver_path(root, sport, dataset)
    rows = df if arranged else df.hint("rebalance", SEASON)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(SEASON)
        .option("compression", "zstd")
        .parquet(path)
    )
    return path


def write_snapshot(df: DataFrame, root: str, sport: str, dataset: str, date: str, one_folder: bool = False) -> int:
    """Write the day's snapshot of a bronze dataset; returns the number of rows.

    Only the seasons (and leagues) in ``df`` and only this day are replaced, so a
    second run on the same day takes the place of the first.  No rows, no change.
    Rows are rebalanced by folder first, as in :func:`write_silver`, unless all of them go
    to ``one_folder``: then each task writes its rows there, and none is moved.
    """
    counted = Observation()
    levels = partition_columns(sport)
    snapshot = df.withColumn("date", F.lit(date))
    if "league_slug" in levels:
        snapshot = snapshot.withColumn("league_slug", slug(F.col("league")))
    (
        (snapshot if one_folder else snapshot.hint("rebalance", *levels))
        .observe(counted, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels)
        .option("compression", "zstd")
        .parquet(bronze_path(root, sport, dataset))
    )
    return counted.get["rows"]


def load_table(df: DataFrame, table: str, schema: str = GOLD, mode: str = "append") -> int:
    """Load rows into ``schema.table`` and return how many were loaded.

    ``append`` matches columns by name, fills absent ones with their defaults,
    and creates the table if there is none.  ``replace`` writes the new rows to a
    folder of their own and points the table to it when they are complete, so a
    failed job leaves the old rows and a reader always finds a table.  Only where
    the columns change is the table itself made anew.  An empty frame changes nothing.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be 'append' or 'replace', not {mode!r}")
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    target, incoming = f"{schema}.{table}", f"{schema}.{table}__incoming"
    counted = Observation()
    rows = df.observe(counted, F.count("*").alias("rows"))
    exists = spark.catalog.tableExists(target)
    if mode == "append" and exists:
        spark.sql(f"INSERT INTO {target} BY NAME SELECT * FROM {{rows}}", rows=rows)
        return counted.get["rows"]
    if exists and _same_columns(spark.table(target), rows):
        return _write_beside(spark, target, rows, counted)
    spark.sql(f"DROP TABLE IF EXISTS {incoming}")
    rows.write.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(incoming)
    if counted.get["rows"] == 0:
        spark.sql(f"DROP TABLE {incoming}")
        return 0
    if exists:
        spark.sql(f"DROP TABLE {target}")
    spark.sql(f"ALTER TABLE {incoming} RENAME TO {target}")
    return counted.get["rows"]


def _same_columns(a: DataFrame, b: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def _write_beside(spark: SparkSession, target: str, rows: DataFrame, counted: Observation) -> int:
    """Write the rows beside a table's files and make them the table's files."""
    new = f"{location(spark, target).split('__rows_')[0]}__rows_{uuid.uuid4().hex[:12]}"
    rows.write.option("compression", "zstd").parquet(new)
    if counted.get["rows"] == 0:
        drop_folder(spark, new)
        return 0
    point_to(spark, target, new)
    return counted.get["rows"]


def point_to(spark: SparkSession, target: str, folder: str) -> None:
    """Make the files in a folder those of a table; its declaration stays, its old files go."""
    old = location(spark, target)
    spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(target)
    drop_folder(spark, old)


def location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def row_counts(spark: SparkSession, *tables: str, schema: str = GOLD) -> DataFrame:
    """``(table, total_rows)`` of catalog tables, from the file footers alone."""
    counts = [
        spark.table(f"{schema}.{name}").agg(F.count("*").alias("total_rows")).select(
            F.lit(name).alias("table"), "total_rows"
        )
        for name in tables
    ]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionAll(part)
    return whole


def init_schema(spark: SparkSession, schema: str = GOLD) -> None:
    """Create the gold base tables that are missing, then all views."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table in schemas.gold_tables():
        mandatory = {
            *schemas.GOLD_MANDATORY.get(table, []),
            *filter(None, [schemas.GOLD_KEYS.get(table)]),
        }
        zero = schemas.GOLD_ZERO_DEFAULTS.get(table, [])
        columns = ", ".join(
            f"{field.name} {field.dataType.simpleString()}"
            + (" NOT NULL" if field.name in mandatory else "")
            + (" DEFAULT 0" if field.name in zero else "")
            for field in schemas.gold(table)
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{table} ({columns}) USING parquet")
    refresh_views(spark, schema)


def refresh_views(spark: SparkSession, schema: str = GOLD) -> list[str]:
    """(Re)create every view whose base table exists; returns their names."""
    created = []
    for view, (table, query) in VIEWS.items():
        source = f"{schema}.{table}"
        if spark.catalog.tableExists(source):
            text = query.format(matches=source)
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view} AS {text}")
            created.append(view)
    return created


def query(spark: SparkSession, text: str) -> DataFrame:
    """Any SQL over the catalog."""
    return spark.sql(text)


def execute(spark: SparkSession, statement: str) -> None:
    """Run a statement for its effect."""
    spark.sql(statement)
