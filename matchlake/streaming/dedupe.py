"""Exactly-once rows from a feed that delivers rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_stream(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    schema: T.StructType | str,
    keys: Sequence[str],
    time: str,
    delay: str,
    files_per_batch: int | None = None,
) -> list[dict[str, int]]:
    """Append each key of the Parquet files that have arrived in ``source`` once to ``target``.

    Keys seen are kept in the state store for as long as a copy may come, ``delay`` behind
    the latest ``time``, then evicted; a row that comes later than that is dropped, as its
    key may have been written long ago.  Run it again, also after a crash: ``progress``
    holds the files read and the state, and the sink writes each batch once.  Returns for
    each batch its rows, the keys in state, those evicted, and the late rows dropped.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a watermark needs a timestamp with a zone; the row keeps its own column
    arrived = reader.parquet(source).withColumn("__time", F.col(time).cast("timestamp"))
    once = arrived.withWatermark("__time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("__time")
    writer = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return [_told(batch) for batch in query.recentProgress]


def _told(batch) -> dict[str, int]:
    state = batch["stateOperators"][0] if batch["stateOperators"] else {}
    names = {"state": "numRowsTotal", "evicted": "numRowsRemoved", "late": "numRowsDroppedByWatermark"}
    return {"rows": batch["numInputRows"]} | {key: state.get(name, 0) for key, name in names.items()}
