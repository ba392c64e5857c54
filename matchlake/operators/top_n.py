"""Top-N and keep-one per group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
_RANK = "__rank"
_SLICE = "__slice"
_NEAR = "__near"


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    slices: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group under ``order``.

    Up to the optimizer's threshold Spark trims every group to ``n`` rows in
    each map task (WindowGroupLimit), so a group with a third of all rows sends
    only ``n`` rows per task to the shuffle.  Beyond the threshold that rule is
    off; each group is then cut into hash slices (as many as there are shuffle
    partitions) that are trimmed separately.  A row among the first n of its
    group is among the first n of its slice, so both ways give the same rows.
    """
    conf = df.sparkSession.conf
    threshold = int(conf.get(_LIMIT_CONF, "1000"))
    if n > threshold:
        # The partition id keeps full copies of one row from sharing a slice.
        row_hash = F.xxhash64(*_orderable(df)) + F.spark_partition_id()
        count = slices or int(conf.get("spark.sql.shuffle.partitions"))
        sliced = df.withColumn(_SLICE, F.pmod(row_hash, F.lit(count)))
        df = _first_rows(sliced, [*keys, _SLICE], order, n).drop(_SLICE)
    return _first_rows(df, keys, order, n)


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
    keep: str = "last",
) -> DataFrame:
    """Keep the latest (or earliest) row per key; NULL keys equal each other.

    Rows have no arrival order in Spark, so ``recency`` names the columns that
    say which row is newer, oldest value first; NULL is oldest.  All other
    columns break ties, which makes the pick the same on every run.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    seen = {*keys, *recency}
    names = [*recency, *(c for c in _orderable(df) if c not in seen)]
    if not names:
        return df.dropDuplicates(list(keys))
    if keep == "last":
        order = [F.col(c).desc_nulls_last() for c in names]
    else:
        order = [F.col(c).asc_nulls_first() for c in names]
    return _first_rows(df, keys, order, 1)


def deduplicate_in_order(df: DataFrame, keys: Sequence[str], position: str, keep: str = "last") -> DataFrame:
    """Keep the last (or first) row per key in input order; NULL keys equal each other.

    ``position`` is the column in which a reader has put where each row stood
    (``with_position``); no two rows share one, so nothing else decides.  It is dropped.
    """
    flat, places = _flat(df, position)
    return deduplicate(_near(flat, keys), keys, places, keep).drop(*places)


def _flat(df: DataFrame, position: str) -> tuple[DataFrame, list[str]]:
    """The parts of a position as columns, which take less room in a sorted row than the struct."""
    kind = df.schema[position].dataType
    if not isinstance(kind, T.StructType):
        return df, [position]
    places = [f"__place_{number}" for number in range(len(kind))]
    parts = {place: F.col(position)[name] for place, name in zip(places, kind.names, strict=True)}
    return df.withColumns(parts).drop(position), places


def _near(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows in partitions of about the advisory size, those of a key together.

    A task that reads files has as many rows as its split of packed files holds, and a trim
    there sorts all of them.  AQE merges small partitions and splits that of a hot key.
    Rebalanced is by a hash, so that the trim still comes before the rows of a key must meet.
    """
    if not keys:
        return df
    return df.withColumn(_NEAR, F.hash(*keys)).hint("rebalance", _NEAR).drop(_NEAR)


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)


def _orderable(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if not _has_map(field.dataType)]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    return False
