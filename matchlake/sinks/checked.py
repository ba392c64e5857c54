"""Loads that keep a table's rules: keys once, mandatory columns filled, all rows or none.

Spark stores such rules but does not enforce them on Parquet tables.  Here a batch is
written beside the table first.  Its keys, and only those, are counted and looked up in
the table; if no row breaks a rule the written files become visible, otherwise the
offending rows are kept in a folder of their own and the table stays as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.operators.projection import named
from matchlake.session import drop_folder
from matchlake.sinks.writers import GOLD, location, point_to

REASONS = "reasons"
REPEATED, EXISTING = "key repeated in batch", "key already in table"


class Refused(ValueError):
    """A batch broke a rule.  ``counts`` has the rows by reason, ``path`` holds the offending rows."""

    def __init__(self, table: str, counts: dict[str, int], path: str) -> None:
        super().__init__(f"{table}: nothing loaded; " + ", ".join(f"{n} rows: {reason}" for reason, n in sorted(counts.items())))
        self.table, self.counts, self.path = table, counts, path

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def load_checked(
    df: DataFrame,
    table: str,
    schema: str = GOLD,
    mode: str = "append",
    key: Sequence[str] | None = None,
    mandatory: Sequence[str] | None = None,
    prune: str | None = None,
) -> int:
    """Load rows into an existing ``schema.table`` if none breaks its rules; returns their number.

    Key and mandatory columns default to those of the gold base tables.  Columns are
    matched by name and cast to the table's types; absent ones get their defaults, and the
    table keeps its declaration also on ``replace``.  ``append`` compares with the keys in
    the table, column-pruned; where a key cannot change its season, ``prune="season"``
    reads only the seasons of the batch.  Raises :class:`Refused`.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be 'append' or 'replace', not {mode!r}")
    spark, target = df.sparkSession, f"{schema}.{table}"
    key = list(key or filter(None, [schemas.GOLD_KEYS.get(table)]))
    mandatory = list(dict.fromkeys([*key, *(schemas.GOLD_MANDATORY.get(table, []) if mandatory is None else mandatory)]))
    known = spark.table(target)
    staging = f"{location(spark, target).split('__rows_')[0]}__rows_{uuid.uuid4().hex[:12]}"
    counted = Observation()
    batch = _declared(df, known, schemas.GOLD_ZERO_DEFAULTS.get(table, []))
    batch.observe(counted, F.count("*").alias("rows")).write.parquet(staging)
    staged = spark.read.schema(batch.schema).parquet(staging)
    if counted.get["rows"] == 0:
        drop_folder(spark, staging)
        return 0
    offending = _offending(staged, known if mode == "append" else None, key, mandatory, prune)
    refused, found = f"{staging}__refused", Observation()
    offending.observe(found, F.count("*").alias("rows")).write.parquet(refused)
    if found.get["rows"]:
        reasons = spark.read.parquet(refused).select(F.explode(REASONS).alias("reason")).groupBy("reason").count()
        counts = {row["reason"]: row["count"] for row in reasons.collect()}
        drop_folder(spark, staging)
        raise Refused(target, counts, refused)
    drop_folder(spark, refused)
    if mode == "replace":
        point_to(spark, target, staging)
    else:
        spark.sql(f"INSERT INTO {target} BY NAME SELECT * FROM {{staged}}", staged=staged)
        drop_folder(spark, staging)
    return counted.get["rows"]


def _declared(df: DataFrame, known: DataFrame, zero: Sequence[str]) -> DataFrame:
    """The batch in the columns and types of the table."""
    if extra := set(df.columns) - set(known.columns):
        raise ValueError(f"the table has no columns {sorted(extra)}")

    def column(field) -> F.Column:
        default = F.lit(0 if field.name in zero else None)
        return (named(field.name) if field.name in df.columns else default).cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in known.schema])


def _offending(staged: DataFrame, known: DataFrame | None, key: list[str], mandatory: list[str], prune: str | None) -> DataFrame:
    """Rows that break a rule, with all their reasons.

    Keys are folded per map task before they are shuffled, so one that fills the batch is
    one row per task; only keys that break a rule are joined back.
    """
    empty = F.array_compact(F.array(*[F.when(named(c).isNull(), F.lit(f"{c} is NULL")) for c in mandatory], F.lit(None).cast("string")))
    if not key:
        return staged.withColumn(REASONS, empty).where(F.size(REASONS) > 0)
    names = [named(c) for c in key]
    own = staged.dropna(subset=key).groupBy(*names).agg(F.count("*").alias("n"))
    broken = own.where("n > 1").select(*names, F.lit(REPEATED).alias("reason"))
    if known is not None:
        if prune is not None:
            seasons = [row[0] for row in staged.select(prune).distinct().collect()]
            known = known.where(named(prune).isin(seasons) | named(prune).isNull())
        there = own.select(*names).join(known.select(*names), key, "left_semi")
        broken = broken.unionByName(there.select(*names, F.lit(EXISTING).alias("reason")))
    broken = broken.groupBy(*names).agg(F.sort_array(F.collect_set("reason")).alias("broken"))
    joined = staged.join(broken, key, "left")
    reasons = F.concat(empty, F.coalesce("broken", F.array().cast("array<string>")))
    return joined.withColumn(REASONS, reasons).where(F.size(REASONS) > 0).select(*staged.columns, REASONS)
