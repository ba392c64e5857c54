"""Reading datasets.

A reader with a schema starts no job of its own; without one Spark reads the
footers first.  Filters and column choices reach the files either way.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import schemas
from matchlake.session import any_file, folder_names, path_exists

SOURCE_FILE = "source_file"
#: Where a row stood: the number of its file in order of the paths, then its place there.  Orders rows as if all
#: files were read one after another by path.
POSITION = "position"
_FILE = "__file"
_PATH = "__path"


def scan_file(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One Parquet file or dataset; ``key=value`` folders above it add no columns."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no Parquet data at {path}")
    return _reader(spark, schema).option("recursiveFileLookup", True).parquet(path)


def scan_tree(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.parquet",
    schema: T.StructType | None = None,
    with_source: bool = False,
    with_position: bool = False,
) -> DataFrame:
    """All Parquet files below a folder whose name matches the pattern.

    Columns in the files win over ``key=value`` folder names.  Without a schema
    the columns of all files are merged; where files disagree on a column's type it
    gets the narrowest type that holds all of them (:func:`widest`).  ``with_source`` adds
    the file's path, by which a later dedupe can tell newer snapshots from older ones,
    ``with_position`` the file's number and the row's place in the file (:data:`POSITION`).
    """
    if not any_file(spark, folder, pattern):
        raise FileNotFoundError(f"no file {pattern} below {folder}")
    extra = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if with_source else []
    if with_position:
        extra.append(F.struct("_metadata.file_path", "_metadata.row_index").alias(POSITION))
    rows = _tree_rows(spark, folder, pattern, schema, extra)
    return _numbered(rows, _listed(spark, pattern).load(folder)) if with_position else rows


def _tree_rows(spark: SparkSession, folder: str, pattern: str, schema: T.StructType | None, extra: list[Column]) -> DataFrame:
    reader = _reader(spark, schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if schema is not None:
        return _with(reader.parquet(folder), extra)
    try:
        return _with(reader.option("mergeSchema", True).parquet(folder), extra)
    except (Py4JJavaError, PySparkException) as error:
        if not _types_clash(error):
            raise
    files = sorted(row["path"] for row in _listed(spark, pattern).load(folder).select("path").collect())
    groups = [spark.read.schema(kinds).parquet(*paths) for kinds, paths in _files_by_schema(spark, files)]
    return _union_widened([_with(group, extra) for group in groups])


def _listed(spark: SparkSession, pattern: str) -> DataFrameReader:
    """One row per file below a folder; what is in the files is only read if asked for."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def _numbered(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Positions with the file's number in order of the paths in place of its path.

    A sort holds the position of every row, and a path is longer than most rows.  The
    list of paths, which the driver has to read the files, is one small relation.
    """
    paths = files.agg(F.sort_array(F.collect_list("_metadata.file_path")).alias("paths"))
    numbers = paths.select(F.posexplode("paths").alias(_FILE, _PATH))
    path = F.col(f"{POSITION}.file_path")
    unlisted = F.raise_error(F.concat(F.lit("a file came after the files were listed: "), path)).cast("int")
    places = [F.col(f"{POSITION}.{name}") for name in rows.schema[POSITION].dataType.names if name != "file_path"]
    position = F.struct(F.coalesce(_FILE, unlisted).alias("file"), *places)
    return rows.join(numbers, path == F.col(_PATH), "left").withColumn(POSITION, position).drop(_FILE, _PATH)


def _types_clash(error: Exception) -> bool:
    return any(name in str(error) for name in ("[CANNOT_MERGE_SCHEMAS]", "[CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE]"))


def _with(found: DataFrame, extra: list[Column]) -> DataFrame:
    return found.select("*", *extra) if extra else found


def _files_by_schema(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files in groups whose columns can be merged.

    Spark merges the footers of a group in one job.  A group that cannot be merged is cut
    in two; as schemas drift with time, and paths are dated, that takes some jobs for
    each change, not for each file.  Neighbours that merge again are put together.
    """
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*files).schema, files)]
    except (Py4JJavaError, PySparkException) as error:
        if not _types_clash(error) or len(files) == 1:
            raise
    middle = len(files) // 2
    found = _files_by_schema(spark, files[:middle]) + _files_by_schema(spark, files[middle:])
    merged: dict[str, tuple[T.StructType, list[str]]] = {}
    for kinds, paths in found:
        merged.setdefault(kinds.json(), (kinds, []))[1].extend(paths)
    return list(merged.values())


_WHOLE = ("byte", "short", "integer", "long")


def widest(kinds: list[T.DataType]) -> T.DataType:
    """The type that columns of several types become when they are put together.

    Whole numbers widen to the longest of them and, with any other number, to double;
    dates with timestamps become timestamps; all else becomes text.
    """
    names = {kind.typeName() for kind in kinds} - {"void"}
    if len({kind.json() for kind in kinds if kind.typeName() != "void"}) == 1:
        return next(kind for kind in kinds if kind.typeName() != "void")
    if not names:
        return kinds[0]
    if names <= {*_WHOLE}:
        return max((k for k in kinds if k.typeName() in _WHOLE), key=lambda k: _WHOLE.index(k.typeName()))
    if names <= {*_WHOLE, "float", "double", "decimal"}:
        return T.DoubleType()
    if names <= {"date", "timestamp", "timestamp_ntz"}:
        return T.TimestampType() if "timestamp" in names else T.TimestampNTZType()
    return T.StringType()


def _union_widened(parts: list[DataFrame]) -> DataFrame:
    """All rows, in the columns of all parts and the types that hold them."""
    kinds: dict[str, list[T.DataType]] = {}
    for part in parts:
        for field in part.schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    types = {name: widest(found) for name, found in kinds.items()}

    def column(part: DataFrame, name: str) -> Column:
        return (F.col(f"`{name}`") if name in part.columns else F.lit(None)).cast(types[name]).alias(name)

    whole = parts[0].select(*[column(parts[0], name) for name in types])
    for part in parts[1:]:
        whole = whole.unionAll(part.select(*[column(part, name) for name in types]))
    return whole


def scan_bronze(
    spark: SparkSession,
    root: str,
    sport: str,
    dataset: str,
    season: str | int | None = None,
    date: str | None = None,
    contract: T.StructType | None = None,
) -> DataFrame:
    """Dated snapshots of a bronze dataset.

    League, season and date are folder names, so a filter on them prunes folders
    before any file is opened.
    """
    path = bronze_path(root, sport, dataset)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no bronze data at {path}")
    found = spark.read.schema(contract or bronze_contract(sport, dataset)).parquet(path)
    if season is not None:
        found = found.where(F.col("season") == season)
    return found if date is None else found.where(F.col("date") == date)


def bronze_seasons(spark: SparkSession, root: str, sport: str, dataset: str) -> set[str]:
    """The seasons of a bronze dataset, from its folder names alone."""
    levels = partition_columns(sport)
    folders = "/".join(f"{level}=*" for level in levels[: levels.index("season") + 1])
    return {path.rsplit("season=", 1)[1] for path in folder_names(spark, f"{bronze_path(root, sport, dataset)}/{folders}")}


LANDED = "landed"
_BROKEN = "_broken_line"


def scan_landing(
    spark: SparkSession, path: str, dataset: str, format: str = "json", with_landed: bool = False, with_position: bool = False
) -> DataFrame:
    """Files as a feed delivers them, in JSON lines, CSV with a header, or Parquet.

    A column that the files lack is NULL.  CSV columns are matched by name, file by
    file.  Values of JSON and CSV are read as text and typed afterwards, so a whole
    number written as ``110.0`` is one.  JSON lines that do not parse are left out;
    :func:`broken_lines` counts them.  ``with_landed`` adds ``landed``, the time and
    name of the file, by which later rows can be told from earlier ones, ``with_position``
    the file's number and the line's place in it (:data:`POSITION`).
    """
    schema = schemas.raw(dataset)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no landing files at {path}")
    extra = [_landed()] if with_landed else []
    if with_position:
        extra.append(_place(format))
    rows = _landing_rows(spark, path, schema, format, extra)
    return _numbered(rows, spark.read.format("binaryFile").load(path)) if with_position else rows


def _landing_rows(spark: SparkSession, path: str, schema: T.StructType, format: str, extra: list[Column]) -> DataFrame:
    if format == "csv":
        parts = [
            _typed(spark.read.option("header", True).csv(files), schema, extra)
            for files in _files_by_header(spark, path)
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole
    if format == "json":
        lines = _json_lines(spark, path, schema).where(F.col(_BROKEN).isNull())
        return _typed(lines, schema, extra)
    found = spark.read.schema(schema).format(format).load(path)
    return found.select(*schema.names, *extra)


def broken_lines(spark: SparkSession, path: str) -> int:
    """How many JSON lines below the path do not parse."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.where(F.try_parse_json("value").isNull()).count()


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(texts.add(_BROKEN, T.StringType()))
    return reader.option("columnNameOfCorruptRecord", _BROKEN).json(path)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Groups of CSV files with one header; the first line of each file is all that counts."""
    groups = _first_lines(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    found = [row["files"] for row in groups.orderBy("header").collect()]
    return found if len(found) > 1 else [[path]]


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """The first line of each file.

    The places of the first lines are folded by hash, as numbers; to fold the lines
    themselves would sort all lines of all files.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    placed = lines.where("file_block_start = 0").withColumn("i", F.monotonically_increasing_id())
    starts = [row["i"] for row in placed.groupBy("file_path").agg(F.min("i").alias("i")).collect()]
    return placed.where(F.col("i").isin(starts)).select("file_path", F.col("value").alias("header"))


def _landed() -> Column:
    return F.struct("_metadata.file_modification_time", "_metadata.file_path").alias(LANDED)


def _place(format: str) -> Column:
    """Text has no row numbers: a line's place is its block of the file, then its turn in the task that read it."""
    if format == "parquet":
        return F.struct("_metadata.file_path", "_metadata.row_index").alias(POSITION)
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("turn")).alias(POSITION)


def _typed(texts: DataFrame, schema: T.StructType, extra: list[Column]) -> DataFrame:
    known = {name.lower(): name for name in texts.columns}

    def value(field: T.StructField) -> Column:
        if field.name.lower() not in known:
            return F.lit(None).cast(field.dataType)
        text = F.col(f"`{known[field.name.lower()]}`")
        if not isinstance(field.dataType, T.IntegralType):
            return text.try_cast(field.dataType)
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(field.dataType))
        # A text with a point is never cast as it stands, and a failed cast costs an exception per cell.
        return F.coalesce(F.when(~text.contains("."), text.try_cast(field.dataType)), whole)

    columns = [value(field).alias(field.name) for field in schema]
    return texts.select(*columns, *extra)


def one_player(log: DataFrame, player_id: int) -> DataFrame:
    """The log of one player; the filter reaches the files."""
    return log.where(F.col("PLAYER_ID") == player_id)


def bronze_path(root: str, sport: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{sport}/{dataset}"


def silver_path(root: str, sport: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{sport}/{dataset}"


def scan_silver(
    spark: SparkSession,
    root: str,
    sport: str,
    dataset: str,
    contract: T.StructType,
    season: str | int | None = None,
) -> DataFrame:
    """A silver dataset, all of it or the folder of one season."""
    path = silver_path(root, sport, dataset)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no silver data at {path}")
    found = spark.read.schema(contract).parquet(path).select(*contract.names)
    return found if season is None else found.where(F.col("season") == season)


def partition_columns(sport: str) -> list[str]:
    """Folder levels of a bronze dataset; soccer keeps its leagues apart."""
    return ["league_slug", "season", "date"] if sport == "soccer" else ["season", "date"]


def bronze_contract(sport: str, dataset: str) -> T.StructType:
    """Columns of a bronze dataset together with its folder levels."""
    contract = schemas.bronze(f"{sport}/{dataset}")
    extra = [c for c in partition_columns(sport) if c not in contract.names]
    return T.StructType([*contract, *(T.StructField(c, T.StringType()) for c in extra)])


def _reader(spark: SparkSession, schema: T.StructType | None):
    return spark.read if schema is None else spark.read.schema(schema)
