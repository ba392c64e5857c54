"""The alias dimension: which names mean which team.

Entries are rows ``(sport, canonical, source, alias, position)``; positions only
need an order.  No join here carries a broadcast hint.  A dimension of the usual size (some hundred rows) is
broadcast because Catalyst or AQE sees that it is below
``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined by shuffle,
where AQE splits the partition of a name that holds a third of all rows.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.functions import strip_text
from matchlake.operators.top_n import deduplicate

ENTRY_SCHEMA = "sport string, canonical string, source string, alias string, position bigint"
_NESTED = "map<string,map<string,map<string,string>>>"


def alias_entries(
    spark: SparkSession, aliases: Mapping[str, Mapping[str, Mapping[str, str]]]
) -> DataFrame:
    """Entries of a nested mapping sport -> canonical -> source -> alias.

    They go to Spark as an Arrow table, which becomes a relation of known size: the
    planner then broadcasts a lookup made of it if, and only if, it is below the
    threshold.  Rows given as a list would have no size before they run, and every
    row to be named would be shuffled on its name.
    """
    rows = [
        (sport, canonical, source, alias)
        for sport, teams in aliases.items()
        for canonical, sources in teams.items()
        for source, alias in [(None, None), *sources.items()]
    ]
    columns = list(zip(*[(*row, position) for position, row in enumerate(rows)])) or [[]] * 5
    kinds = [pa.string()] * 4 + [pa.int64()]
    names = ["sport", "canonical", "source", "alias", "position"]
    table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    return spark.createDataFrame(table, ENTRY_SCHEMA)


def read_alias_json(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON file with the same nesting; one document per file."""
    document = spark.read.text(path, wholetext=True).select(
        F.from_json("value", _NESTED).alias("sports")
    )
    teams = document.select(F.posexplode("sports").alias("p1", "sport", "teams")).select(
        "p1", "sport", F.posexplode("teams").alias("p2", "canonical", "sources")
    )
    sources = teams.select(
        "p1", "p2", "sport", "canonical",
        F.posexplode_outer("sources").alias("p3", "source", "alias"),
    )
    # A struct orders by its fields, whatever the number of teams and sources.
    position = F.struct("p1", "p2", F.coalesce("p3", F.lit(0)).alias("p3"))
    return sources.select("sport", "canonical", "source", "alias", position.alias("position"))


#: A quoted name, and a line of a block mapping: indent, name, value; a comment may follow.
_QUOTED = "'(?:[^']++|'')*+'" + "|" + r'"(?:[^"\\]++|\\.)*+"'
_YAML_LINE = (
    rf"""^( *+)({_QUOTED}|[^\s'"#:\[{{&*|>-][^:#]*?) *:"""
    rf"""(?:\s+({_QUOTED}|[^\s'"#\[{{&*|>-][^#]*?))? *(?:\s#.*)?$"""
)


def read_alias_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Entries of YAML files of block mappings: sport, then canonical name, then source: alias.

    One document per file, indented by blanks.  A line's sport and canonical name are the
    last ones above it with less indent, and positions keep the order of the lines.  Names
    may be plain or quoted.  Any other YAML (lists, flow mappings, anchors, deeper levels)
    is an error that names the line.
    """
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    lines = text.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "raw"))
    lines = lines.where(~F.col("raw").rlike(r"^\s*(#.*)?$|^---\s*$"))

    def part(number: int) -> Column:
        return F.regexp_extract("raw", _YAML_LINE, number)

    parsed = lines.select(
        "file", "line", F.col("raw").rlike(_YAML_LINE).alias("good"), F.length(part(1)).alias("indent"),
        _unquoted(part(2)).alias("name"), F.nullif(part(3), F.lit("")).alias("value"),
    )
    level = F.dense_rank().over(Window.partitionBy("file").orderBy("indent"))
    above = Window.partitionBy("file").orderBy("line")
    leveled = parsed.withColumn("level", level)
    leveled = leveled.withColumn("sport", F.last(F.when(F.col("level") == 1, F.col("name")), True).over(above))
    leveled = leveled.withColumn("canonical", F.last(F.when(F.col("level") == 2, F.col("name")), True).over(above))
    good = F.col("good") & (F.col("level") <= 3) & (F.col("value").isNull() | (F.col("level") == 3))
    wrong = F.raise_error(F.concat(F.lit("no block mapping of names: "), "file", F.lit(", line "), F.col("line") + 1))
    source = F.when(F.col("level") == 3, F.col("name")).alias("source")
    alias = F.when(~F.col("value").isin("~", "null"), _unquoted(F.col("value")))
    position = F.struct("file", "line").alias("position")
    return leveled.where(F.when(good, F.col("level") > 1).otherwise(wrong.cast("boolean"))).select("sport", "canonical", source, alias.alias("alias"), position)


def _unquoted(text: Column) -> Column:
    inner = F.substr(text, F.lit(2), F.length(text) - 2)
    single, double = F.replace(inner, F.lit("''"), F.lit("'")), F.regexp_replace(inner, r"\\(.)", "$1")
    return F.when(text.rlike("^'.*'$"), single).when(text.rlike('^".*"$'), double).otherwise(text)


def alias_lookup(entries: DataFrame) -> DataFrame:
    """``(sport, alias_lower, canonical)`` with one row per sport and alias.

    Every canonical name also stands for itself.  Where two teams claim an
    alias, the later entry has it.
    """
    given = entries.where(F.col("alias").isNotNull()).select(
        "sport", F.lower("alias").alias("alias_lower"), "canonical", "position", F.lit(0).alias("own")
    )
    own = (
        entries.groupBy("sport", "canonical")
        .agg(F.max("position").alias("position"))
        .select(
            "sport",
            F.lower("canonical").alias("alias_lower"),
            "canonical",
            "position",
            F.lit(1).alias("own"),
        )
    )
    latest = deduplicate(given.unionByName(own), ["sport", "alias_lower"], ["position", "own"])
    return latest.select("sport", "alias_lower", "canonical")


def normalize_names(
    df: DataFrame, lookup: DataFrame, sport: str, columns: Mapping[str, str]
) -> DataFrame:
    """Add the canonical form of each name column.

    ``columns`` maps a source column to the column that receives the result.
    Names without an entry are only stripped; NULL stays NULL.
    """
    names = lookup.where(F.col("sport") == sport)
    for number, (source, target) in enumerate(columns.items()):
        key, hit = f"__alias_{number}", f"__canonical_{number}"
        renamed = names.select(F.col("alias_lower").alias(key), F.col("canonical").alias(hit))
        stripped = strip_text(F.col(source))
        joined = df.join(renamed, F.lower(stripped) == F.col(key), "left")
        df = joined.withColumn(target, F.coalesce(F.col(hit), stripped)).drop(key, hit)
    return df


def source_alias(
    df: DataFrame, entries: DataFrame, sport: str, source: str, column: str | Column, target: str
) -> DataFrame:
    """Add the name that one source uses for a canonical team, or NULL."""
    wanted = entries.where(
        (F.col("sport") == sport) & (F.col("source") == source) & F.col("alias").isNotNull()
    )
    names = deduplicate(wanted, ["canonical"], ["position"]).select(
        F.col("canonical").alias("__canonical"), F.col("alias").alias(target)
    )
    name = F.col(column) if isinstance(column, str) else column
    return df.join(names, name == F.col("__canonical"), "left").drop("__canonical")


def team_abbreviation(
    df: DataFrame, entries: DataFrame, sport: str, column: str | Column, target: str
) -> DataFrame:
    """Add the abbreviation of a canonical team, or NULL."""
    return source_alias(df, entries, sport, "abbreviation", column, target)
