"""Counting keys of a whole corpus in packed form.

Some operators must know, for every window or n-gram of every document, how often it
occurs in the corpus: a shuffle with a row per word would be many times the corpus.
Here documents are first packed into chunks of a few megabytes, written once to the
shared folder.  A chunk then sends each bucket (a share of all keys) one row with its
distinct keys, bit-packed; a bucket answers each of these rows with one row of equal
order; and the chunk, opened again, reads off the answers.

* A key sends at most one entry per chunk, whatever its frequency, and buckets are
  dealt by hash, so no key makes a bucket large.
* Memory of a task: one chunk or one bucket.  ``bucket_keys`` sets how many keys a
  bucket holds; the number of buckets grows with the corpus.
* For a corpus of many terabytes raise ``chunk_bytes`` and ``bucket_keys`` together
  (for instance 128 MB and 20 million), so that rows stay long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.text import Scratch, WordHashes, count_words, mixed

CHUNK = "chunk_id long, n_words long, documents binary"
SENT = "bucket int, chunk_id long, keys binary, extra binary"
REPLY = "chunk_id long, bucket int, reply binary"


@dataclass(frozen=True)
class Layout:
    """level: of the chunks' compression; 3 takes a quarter of the time of 9 and a tenth more room."""

    chunk_bytes: int = 4_000_000
    bucket_keys: int = 500_000
    min_buckets: int = 64
    level: int = 9


def write_chunks(docs: DataFrame, scratch: Scratch, layout: Layout) -> tuple[DataFrame, int]:
    """The table of chunks of (doc_id, text, ...) and the number of buckets for its words."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        codec = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=layout.level))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) + 16)
            at = 0
            while at < batch.num_rows:
                limit = (ends[at - 1] if at else 0) + layout.chunk_bytes
                stop = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
                part = batch.slice(at, stop - at)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=codec) as out:
                    out.write_batch(part)
                words = count_words(texts.slice(at, stop - at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([serial], pa.int64()), pa.array([words], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["chunk_id", "n_words", "documents"],
                )
                serial += 1
                at = stop

    chunks = scratch.write("chunks", docs.mapInArrow(pack, CHUNK))
    words = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    return chunks, max(layout.min_buckets, -(-words // layout.bucket_keys))


def opened(documents: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(documents.as_buffer()).read_all()


class Words:
    """The words of a chunk's documents, end to end."""

    def __init__(self, texts: list[bytes], hashes: WordHashes) -> None:
        self.lists = [x.split() for x in texts]
        self.lengths = np.fromiter(map(len, self.lists), np.int64, len(self.lists))
        total = int(self.lengths.sum())
        self.ends = np.cumsum(self.lengths)
        self.hashes = np.fromiter(map(hashes.__getitem__, chain.from_iterable(self.lists)), np.uint64, total)

    def starts(self, size: int) -> np.ndarray:
        """Whether a window of so many words starts at each place and ends in the same document."""
        places = np.arange(max(0, len(self.hashes) - size + 1))
        return np.repeat(self.ends, self.lengths)[: len(places)] - places >= size

    def spread(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Whether each word is in a window of so many words with a true start."""
        edges = np.zeros(len(self.hashes) + 1, np.int32)
        edges[: len(starts)] += starts
        edges[size : size + len(starts)] -= starts
        return np.cumsum(edges[:-1]) > 0


def windows(hashes: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit key of each run of so many hashes, put together from runs of powers of two."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    run, length, out, done = hashes, 1, None, 0
    while True:
        factor = np.uint64(pow(base, length, 1 << 64))
        if size & length:
            if out is None:
                out = run
            else:
                n = len(hashes) - done - length + 1
                out = out[:n] * factor + run[done : done + n]
            done += length
        if done == size:
            return mixed(out)
        run = run[: len(run) - length] * factor + run[length:]
        length *= 2


class Dealt:
    """Distinct sorted keys dealt to buckets; within a bucket the order of the keys stays."""

    def __init__(self, keys: np.ndarray, buckets: int) -> None:
        places = ((keys & np.uint64(0xFFFFFF)) * np.uint64(buckets)) >> np.uint64(24)
        self.order = np.argsort(places.astype(np.uint16 if buckets < 1 << 16 else np.uint32), kind="stable")
        self.bounds = np.searchsorted(places[self.order], np.arange(buckets + 1))

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each bucket that has keys, with their indices."""
        for bucket in np.flatnonzero(np.diff(self.bounds)):
            yield int(bucket), self.order[self.bounds[bucket] : self.bounds[bucket + 1]]

    def rows(self, keys: np.ndarray, extra: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """What to send each bucket: its keys and what goes with them."""
        narrowed, extra, bounds = narrow(keys[self.order]), extra[self.order], self.bounds.tolist()
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            begin, end = bounds[bucket], bounds[bucket + 1]
            yield bucket, narrowed[NARROW * begin : NARROW * end], packed(extra[begin:end])

    def gathered(self, replies: pa.Table, dtype: type, size: int) -> np.ndarray:
        """One value per key from the replies to this chunk."""
        out = np.zeros(size, dtype)
        for bucket, reply in zip(replies["bucket"].to_pylist(), replies["reply"].to_pylist(), strict=True):
            out[self.order[self.bounds[bucket] : self.bounds[bucket + 1]]] = unpacked(reply, dtype)
        return out


@cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Of this process; to make one anew for each of many short rows takes longer than the rows."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Compressed byte by byte place, so that small numbers cost little more than their low bytes."""
    size, data = values.itemsize, np.ascontiguousarray(values).view(np.uint8)
    return _codec()[0].compress(b"".join(data[place::size].tobytes() for place in range(size)))


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    places = np.frombuffer(_codec()[1].decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    out = np.empty(places.size, np.uint8)
    for place, values in enumerate(places):
        out[place :: len(places)] = values
    return out.view(dtype)


#: Bytes of a key that are sent.
NARROW = 5


def narrow(keys: np.ndarray, size: int = NARROW) -> bytes:
    """The upper 8 * size bits of each key; the bucket adds up to 24 of the lower ones."""
    upper = np.ascontiguousarray(keys >> np.uint64(64 - 8 * size))
    return np.ndarray(len(upper), f"V{size}", upper, strides=(8,)).tobytes()


def widened(data: bytes, size: int = NARROW) -> np.ndarray:
    out = np.zeros(len(data) // size, np.uint64)
    np.ndarray(len(out), f"V{size}", out, strides=(8,))[:] = np.frombuffer(data, f"V{size}")
    return out


def send(chunks: DataFrame, emit: Callable[[pa.Table, WordHashes], Iterator[tuple[int, bytes, bytes]]]) -> DataFrame:
    """Rows (bucket, chunk_id, keys, extra) from what ``emit`` gives for a chunk's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for chunk, documents in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                yield _sent(chunk, emit(opened(documents), hashes))

    return chunks.select("chunk_id", "n_words", "documents").mapInArrow(run, SENT)


def _sent(chunk: int, rows: Iterator[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[0] for x in rows], pa.int32()),
            pa.array([chunk] * len(rows), pa.int64()),
            pa.array([x[1] for x in rows], pa.binary()),
            pa.array([x[2] for x in rows], pa.binary()),
        ],
        names=["bucket", "chunk_id", "keys", "extra"],
    )


def send_again(chunks: DataFrame, replies: DataFrame, emit: Callable[[pa.Table, pa.Table, WordHashes], Iterator[tuple[int, bytes, bytes]]]) -> DataFrame:
    """Like ``send``, for chunks that already have replies."""
    return with_replies(chunks, replies, lambda chunk, table, found, hashes: pa.Table.from_batches([_sent(chunk, emit(table, found, hashes))]), SENT)


def answer(sent: DataFrame, reduce: Callable[[list[bytes], list[bytes]], list[bytes]]) -> DataFrame:
    """Replies (chunk_id, bucket, reply); ``reduce`` sees all rows of a bucket at once."""

    def run(table: pa.Table) -> pa.Table:
        replies = reduce(table["keys"].to_pylist(), table["extra"].to_pylist())
        return pa.table({"chunk_id": table["chunk_id"], "bucket": table["bucket"], "reply": pa.array(replies, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, REPLY)


def with_replies(chunks: DataFrame, replies: DataFrame, finish: Callable[[int, pa.Table, pa.Table, WordHashes], pa.Table], schema: str) -> DataFrame:
    """Each chunk's documents together with its replies."""
    kept = WordHashes()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("replies to a chunk that is not there")
        return finish(left["chunk_id"][0].as_py(), opened(left["documents"][0]), right, kept)

    return chunks.groupBy("chunk_id").cogroup(replies.groupBy("chunk_id")).applyInArrow(run, schema)
