"""Integer vectors in packed blocks, and blocks that meet as streams.

Searches over vectors compare blocks of rows: a block is one row of a table with its ids
and its vectors as bytes, so a task compares two blocks by one matrix product.  In
``meet`` a held block stays in a task while others pass by, sorted behind it, one at a
time; a task holds two blocks however many pass.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def whole_numbers(frame: DataFrame, column: str, scale: int) -> DataFrame:
    """Replaces a vector's components x by floor(scale * x), x as double.

    Rows whose vector or any component is NULL, NaN or infinite are left out.
    """
    x = F.col(column)
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(F.nanvl(c, F.lit(float("inf")))) < float("inf")))
    return frame.where(F.coalesce(good, F.lit(False))).withColumn(column, F.transform(x, lambda c: F.floor(c.cast("double") * scale)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """One row per vector, shorter ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def packed(**arrays: np.ndarray) -> bytes:
    """Whole numbers under their names, each array in the narrowest type that holds it."""
    sink = io.BytesIO()
    np.savez(sink, **{name: _narrow(np.asarray(x, np.int64)) for name, x in arrays.items()})
    return sink.getvalue()


def _narrow(x: np.ndarray) -> np.ndarray:
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {name: found[name].astype(np.int64) for name in found.files}


def dealt(blocks: int | F.Column) -> F.Column:
    """A block number for each row, independent of its values, so that copies are spread."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks) if isinstance(blocks, int) else blocks)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both; beyond 64 bits they stay at the limit.

    No partial sum exceeds the product of the norms, so floats that hold all whole
    numbers up to there give exact sums in any order.
    """
    a, b = same_width(a, b)
    bound = norms(a).max(initial=0) * norms(b).max(initial=0)
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(exact, LOWEST + 1, HIGHEST).astype(np.int64)


def leading(scores: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Of the masked entries those among the ``k`` highest of their row, ties included."""
    if scores.shape[1] <= k or np.count_nonzero(mask) <= 4 * k * len(scores):
        return mask
    shown = np.where(mask, scores, LOWEST)
    return mask & (scores >= np.partition(shown, -k, axis=1)[:, -k, None])


class Best:
    """The ``k`` best entries of each of some groups: higher scores first, ties by smaller id.

    Entries that do not beat a group's ``floor`` (score and id) never come in.
    """

    def __init__(self, groups: int, k: int, floor: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        score, number = floor or (np.full(groups, LOWEST, np.int64), np.full(groups, HIGHEST, np.int64))
        self.floor = score[:, None], number[:, None]
        self.scores, self.ids = np.repeat(score[:, None], k, 1), np.repeat(number[:, None], k, 1)

    def offer(self, group: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        worst = self.scores[group, -1]
        wins = (scores > worst) | ((scores == worst) & (ids < self.ids[group, -1]))
        group, scores, ids = group[wins], scores[wins], ids[wins]
        if not len(group):
            return
        touched, k = np.unique(group), self.scores.shape[1]
        group = np.concatenate([group, np.repeat(touched, k)])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, ~scores, group))
        group = group[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        order, group, place = order[place < k], group[place < k], place[place < k]
        self.scores[group, place], self.ids[group, place] = scores[order], ids[order]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, score and id of what came in."""
        group, place = np.nonzero((self.scores != self.floor[0]) | (self.ids != self.floor[1]))
        return group, self.scores[group, place], self.ids[group, place]


def meet(
    held: DataFrame, passing: DataFrame, stripes: int, tasks: int, run: Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Calls ``run`` for each held block with an iterator of the blocks that pass it.

    Both have the columns ``key`` (of the held block), ``block`` (their own number),
    ``payload`` and ``extra`` (binary).  The passing blocks of a key are dealt to
    ``stripes`` tasks by a hash of their number, and each of these gets the held block.
    Passing blocks whose key no held block has meet nobody.
    """
    columns = ["key", "stripe", "kind", "block", "payload", "extra"]
    stay = held.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).withColumn("kind", F.lit(0))
    move = passing.withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int")).withColumn("kind", F.lit(1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for number in range(batch.num_rows):
                yield batch.slice(number, 1).to_pylist()[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches), key=lambda row: (row["key"], row["stripe"])):
            first = next(group)
            if first["kind"] == 0:
                yield from run(first, group)

    both = stay.select(columns).unionByName(move.select(columns))
    return both.repartition(tasks, "key", "stripe").sortWithinPartitions("key", "stripe", "kind", "block").mapInArrow(scan, schema)
