"""Words, ids and scratch tables shared by the corpus operators.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``; this is
what ``bytes.split()`` gives, so other Unicode spaces stay inside words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import shared_folder, short_lived_shuffles

#: The word pattern in Java's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def remainder(modulus: int, column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo; a NULL id gives NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_GAPS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def count_words(texts: pa.Array) -> int:
    """The number of words of all texts."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    total = 0
    for begin in range(int(offsets[0]), int(offsets[-1]), _PIECE):
        # a word begins after a gap or at the start of its text
        end = min(begin + _PIECE, int(offsets[-1]))
        inside = ~_GAPS[np.frombuffer(texts.buffers()[2], np.uint8, end - begin, begin)]
        after = np.zeros(len(inside), bool)
        after[1:] = inside[:-1]
        if begin > offsets[0]:
            after[0] = last
        starts = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)]
        after[starts - begin] = False
        total += int(np.count_nonzero(inside & ~after))
        last = inside[-1]
    return total


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words seen most recently."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_PIECE = 1 << 18
#: Longer words are hashed by xxhash: words of some hundred bytes can be made that no polynomial modulo 2^64 tells apart.
_LONG = 256
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(keys: np.ndarray) -> np.ndarray:
    """The keys with their bits stirred, one to one."""
    keys = keys ^ (keys >> np.uint64(32))
    keys = keys * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(29))


def byte_values(inside: list[bool], same: dict[int, int] | None = None) -> np.ndarray:
    """For each byte a random odd number, or 0 if it is no part of a word; ``same`` maps bytes to others they equal."""
    drawn = np.random.default_rng(2024).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    for byte, other in (same or {}).items():
        drawn[byte] = drawn[other]
    return np.where(inside, drawn, np.uint64(0))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Scanner:
    """Hashes of the words of texts, straight from Arrow's buffers.

    With powers of an odd base a word's polynomial hash is a difference of two running
    sums times an inverse power, all modulo 2^64, so no word becomes a Python object but
    the rare long one.
    """

    def __init__(self, values: np.ndarray, prepare: Callable[[pa.Array], pa.Array] | None = None) -> None:
        """``values``: of each byte, 0 for those between words; ``prepare`` is applied to the texts first."""
        self.values, self.prepare = values, prepare
        # bytes of equal values are the same to long words as well
        self.alike = bytes(int(np.flatnonzero(values == x)[0]) for x in values)
        self.powers, self.inverses = _powers(_BASE, _PIECE), _powers(_INVERSE, _PIECE)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes, end to end, and the number of words of each text."""
        texts = pc.fill_null(texts, "")
        if self.prepare:
            texts = self.prepare(texts)
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        hashes, lengths, at = [], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PIECE, side="right")) - 1)
            own, n = self._piece(data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at])
            hashes.append(own)
            lengths.append(n)
            at = stop
        return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate(lengths)

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n > len(self.powers):
            self.powers, self.inverses = _powers(_BASE, n), _powers(_INVERSE, n)
        values = self.values[data]
        inside = values != 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        bounds = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
        begins[bounds] = inside[bounds]  # a text's first word is not the last one's end
        ends[bounds - 1] = inside[bounds - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=sums[1:])
        hashes = mixed((sums[ends] - sums[begins]) * self.inverses[begins])
        for i in np.flatnonzero(ends - begins > _LONG):
            hashes[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]].tobytes().translate(self.alike))
        return hashes, np.diff(np.searchsorted(begins, offsets))


class Scratch:
    """Tables of one operator call, below the folder that all executors share.

    Writing a table cuts the lineage: executors may be lost later without losing
    it.  ``drop`` deletes what no later step reads.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.folder = spark, shared_folder(spark, purpose)

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        with short_lived_shuffles(self.spark):
            frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        # Spark's cleaner frees plans, broadcasts and shuffles of finished steps only when the driver collects its garbage
        jvm.System.gc()
