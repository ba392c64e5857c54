"""Removal of passages that repeat anywhere in the corpus, through block anchors.

A passage of ``window`` words that occurs twice holds, in one of its occurrences, a
whole block of ``block`` words from a grid of non-overlapping blocks, block being at
most (window + 1) / 2.  So

1. every document's grid blocks are indexed, and every rolling window of ``block``
   words probes the index: hits are windows equal to a block found elsewhere;
2. around the hits, and only there, repeats are extended to full length: a window of
   ``window`` words with a hit in each position it must have one is compared by its
   128-bit key with all other such windows; equal ones are repeats, and unions of
   overlapping ones are the maximal repeats, however long and however frequent.

No pairs are formed: a passage with a million occurrences is a million equal keys,
of which each chunk sends one (see chunks.py).  Step 1 may let through a window too
many by chance (40 and more key bits), which step 2 settles.

Defined results: NULL and empty texts have no words; documents shorter than a window
lose nothing; repeated rows repeat each other's words; only doc_id and text are read,
so further columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import chunks as C
from matchlake.llm.text import Scratch, WordHashes, documents, text_bytes


@dataclass(frozen=True)
class Settings:
    window: int = 35
    layout: C.Layout = field(default_factory=C.Layout)

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


_ANCHOR, _TWICE = 1, 2


def _distinct(keys: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, flags (anchored, seen twice), and the place of each key in them."""
    distinct, places, counts = np.unique(keys, return_inverse=True, return_counts=True)
    flags = (counts > 1).astype(np.uint8) * _TWICE
    flags[places[anchors]] |= _ANCHOR
    return distinct, flags, places


def _probes(words: C.Words, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all rolling windows, their keys, and which of them are blocks of the grid."""
    starts = np.flatnonzero(words.starts(settings.block))
    keys = C.windows(words.hashes, settings.block)[starts]
    begins = np.repeat(words.ends - words.lengths, words.lengths)
    return starts, keys, (starts - begins[starts]) % settings.block == 0


def _candidates(words: C.Words, hit_starts: np.ndarray, settings: Settings) -> np.ndarray:
    """Starts of the windows that hold a hit."""
    size, block = settings.window, settings.block
    valid = words.starts(size)
    edges = np.zeros(len(words.hashes) + 1, np.int32)
    np.add.at(edges, np.maximum(0, hit_starts - (size - block)), 1)
    np.add.at(edges, hit_starts + 1, -1)
    return np.flatnonzero(valid & (np.cumsum(edges)[: len(valid)] > 0))


def _long_keys(words: C.Words, starts: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 128-bit keys (two halves, sorted), whether each occurs twice, and each start's place among them."""
    low = C.windows(words.hashes, settings.window)[starts]
    high = C.windows(C.mixed(words.hashes), settings.window, 0xC2B2AE3D27D4EB4F)[starts]
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.ones(len(order), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    group = np.cumsum(new) - 1
    places = np.empty(len(order), np.int64)
    places[order] = group
    return low[new], high[new], np.bincount(group, minlength=int(new.sum())) > 1, places


def find_repeats(docs: DataFrame, scratch: Scratch, settings: Settings) -> tuple[DataFrame, int, DataFrame, DataFrame]:
    """Chunks, the number of buckets, hits of the anchors, and verdicts on the windows around them."""
    chunks, buckets = C.write_chunks(docs, scratch, settings.layout)

    def probe(table: pa.Table, hashes: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        words = C.Words(text_bytes(table["text"]), hashes)
        _, keys, anchors = _probes(words, settings)
        distinct, flags, _ = _distinct(keys, anchors)
        for bucket, index in C.Dealt(distinct, buckets):
            yield bucket, C.narrow(distinct[index]), C.packed(flags[index])

    def match(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
        parts = [C.widened(x) for x in keys]
        flags = np.concatenate([C.unpacked(x, np.uint8) for x in extra])
        distinct, places = np.unique(np.concatenate(parts), return_inverse=True)
        seen = np.bincount(places, weights=1 + (flags & _TWICE > 0), minlength=len(distinct))
        anchored = np.bincount(places, weights=flags & _ANCHOR, minlength=len(distinct))
        hits = ((seen > 1) & (anchored > 0))[places]
        return [C.packed(np.packbits(x)) for x in np.split(hits, np.cumsum([len(x) for x in parts])[:-1])]

    hits = scratch.write("hits", C.answer(C.send(chunks, probe), match))

    def extend(table: pa.Table, replies: pa.Table, hashes: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        words = C.Words(text_bytes(table["text"]), hashes)
        low, high, twice, _ = _long_keys(words, _hit_windows(words, replies, settings, buckets), settings)
        for bucket, index in C.Dealt(low, buckets):
            yield bucket, np.stack([low[index], high[index]]).tobytes(), C.packed(twice[index])

    def compare(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
        parts = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in keys]
        low, high = np.concatenate(parts, axis=1)
        twice = np.concatenate([C.unpacked(x, np.bool_) for x in extra])
        order = np.lexsort((high, low))
        same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
        repeated = np.zeros(len(order) + 1, bool)
        repeated[1:-1] = same
        out = np.empty(len(order), bool)
        out[order] = repeated[:-1] | repeated[1:]
        return [C.packed(np.packbits(x)) for x in np.split(out | twice, np.cumsum([x.shape[1] for x in parts])[:-1])]

    verdicts = scratch.write("verdicts", C.answer(C.send_again(chunks, hits, extend), compare))
    return chunks, buckets, hits, verdicts


def _bits(dealt: C.Dealt, replies: pa.Table, size: int) -> np.ndarray:
    out = np.zeros(size, bool)
    for bucket, reply in zip(replies["bucket"].to_pylist(), replies["reply"].to_pylist(), strict=True):
        index = dealt.order[dealt.bounds[bucket] : dealt.bounds[bucket + 1]]
        out[index] = np.unpackbits(C.unpacked(reply, np.uint8), count=len(index)).astype(bool)
    return out


def _hit_windows(words: C.Words, replies: pa.Table, settings: Settings, buckets: int) -> np.ndarray:
    starts, keys, anchors = _probes(words, settings)
    distinct, _, places = _distinct(keys, anchors)
    hit = _bits(C.Dealt(distinct, buckets), replies, len(distinct))
    return _candidates(words, starts[hit[places]], settings)


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row; with ``with_text`` also the kept words as ``kept_text``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks, buckets, hits, verdicts = find_repeats(docs.select("doc_id", "text"), scratch, settings)
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def finish(_: int, table: pa.Table, replies: pa.Table, hashes: WordHashes) -> pa.Table:
        step = replies["step"].to_numpy()
        words = C.Words(text_bytes(table["text"]), hashes)
        starts = _hit_windows(words, replies.filter(pa.array(step == 1)), settings, buckets)
        low, _, _, places = _long_keys(words, starts, settings)
        repeated = _bits(C.Dealt(low, buckets), replies.filter(pa.array(step == 2)), len(low))
        flags = np.zeros(max(0, len(words.hashes) - settings.window + 1), bool)
        flags[starts] = repeated[places]
        gone = words.spread(flags, settings.window)
        removed, digests, texts, begin = [], [], [], 0
        for own, end in zip(words.lists, words.ends.tolist(), strict=True):
            cut = gone[begin:end]
            n = int(cut.sum())
            kept = own if not n else [w for w, x in zip(own, cut.tolist(), strict=True) if not x]
            text = b" ".join(kept)
            removed.append(n)
            digests.append(hashlib.sha256(text).hexdigest())
            if with_text:
                texts.append(text.decode())
            begin = end
        columns = {"doc_id": table["doc_id"], "n_words": pa.array(words.lengths), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(columns | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    replies = hits.withColumn("step", F.lit(1)).unionByName(verdicts.withColumn("step", F.lit(2)))
    out = scratch.write("result", C.with_replies(chunks, replies, finish, schema))
    scratch.drop("chunks", "hits", "verdicts")
    return out


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
