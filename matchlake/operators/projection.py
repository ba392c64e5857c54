"""Projecting frames to a column contract."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions import coerce_number


def named(name: str) -> Column:
    """A column whose name may hold dots, such as a repeated page header."""
    return F.col("`" + name.replace("`", "``") + "`")


def optional(df: DataFrame, name: str, kind: str | T.DataType = "string") -> Column:
    """The column if the frame has it, else a typed NULL."""
    return named(name) if name in df.columns else F.lit(None).cast(kind)


def number(df: DataFrame, name: str) -> Column:
    """A column as double: parsed leniently from text, NaN as NULL, absent as NULL."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    if isinstance(df.schema[name].dataType, T.StringType):
        return coerce_number(named(name))
    return F.nanvl(named(name).cast("double"), F.lit(None).cast("double"))


def project(
    df: DataFrame,
    contract: T.StructType,
    sources: Mapping[str, str] | None = None,
    derived: Mapping[str, Column] | None = None,
    required: Collection[str] = (),
) -> DataFrame:
    """Select exactly the columns of the contract, in its order and types.

    ``sources`` names the source column of a field where it differs, ``derived``
    gives an expression instead.  A source column that is not there yields
    NULLs unless the field is ``required``.
    """
    sources, derived = sources or {}, derived or {}
    missing = [f for f in required if sources.get(f, f) not in df.columns]
    if missing:
        raise ValueError(f"source columns missing for {', '.join(missing)}")

    def expression(field: T.StructField) -> Column:
        if field.name in derived:
            column = derived[field.name]
        else:
            column = optional(df, sources.get(field.name, field.name), field.dataType)
        return column.try_cast(field.dataType.simpleString()).alias(field.name)

    return df.select(*[expression(field) for field in contract])


def computed_once(df: DataFrame, names: Collection[str]) -> DataFrame:
    """The same rows; filters and columns above do not make Spark compute the named columns again.

    Spark moves a filter below a projection by putting the columns' expressions into it, once
    for each time it names them.  It does not do so with what an exploded array gives.
    """
    if not names:
        return df
    others = [named(name) for name in df.columns if name not in names]
    row = F.struct(*[named(name) for name in df.columns if name in names])
    return df.select(*others, F.inline(F.array(row))).select(*map(named, df.columns))


def union_conformed(frames: Collection[DataFrame], contract: T.StructType) -> DataFrame:
    """Stack frames whose columns and types have drifted apart.

    Each is cast to the contract first, so a column that is whole-numbered in
    one frame and fractional in the next meets in the contract's type.
    """
    return reduce(DataFrame.unionByName, [project(frame, contract) for frame in frames])


def union_by_name(frames: Collection[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns that a frame lacks are NULL in it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_incomplete(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """Leave out rows that lack any of the columns."""
    return df.dropna(subset=list(columns))
