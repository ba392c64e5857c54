"""Periodic runs of words in whole texts, found with a dictionary of basic factors.

The dictionary names, for each power of two, the factors of that many words: two places
have one name if and only if the same words start there.  A name of the next level is a
pair of names, so a level costs one pass over the places whose factor recurs, and levels
end when none does.  Where the successor occurrence of a factor is at most twice the
factor's length away, and the next one as far again, these occurrences are an arithmetic
progression whose step is proposed as a period.  A run with period q and 4 q words shows
such a progression at the first level of at least q words, so none is missed.  Proposals
are extended to both sides by descending through the levels, and equal stretches are
kept once, with their smallest period.

Documents are taken about a megabyte at a time, so that the levels are built over many
short texts at once; a name includes the document, so nothing crosses from one text to
the next.  Memory: 4 bytes a word and level for one such piece or one longer text.
Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.text import WORD, documents

RUN = "struct<start:long,length:long,period:long>"


@dataclass(frozen=True)
class Settings:
    """A run has at least ``min_words`` words and ``min_periods`` (4 or more) times its period."""

    min_words: int = 6
    min_periods: int = 4
    piece_bytes: int = 1_000_000


class Factors:
    """Names of the factors of 1, 2, 4, ... words; -1 where a factor occurs once."""

    def __init__(self, words: np.ndarray, owner: np.ndarray) -> None:
        self.size, self.levels = len(words), []
        places = np.arange(self.size)
        keys = owner.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        while len(places):
            names = pa.array(keys).dictionary_encode().indices.to_numpy()
            recurs = np.bincount(names)[names] > 1
            places, names = places[recurs], names[recurs]
            if not len(places):
                break
            level = np.full(self.size, -1, np.int32)
            level[places] = names
            width = 1 << len(self.levels)
            self.levels.append(level)
            places = places[places + width < self.size]
            places = places[level[places + width] >= 0]
            keys = (level[places].astype(np.int64) << 32) | level[places + width]

    def steps(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and steps of the progressions of a level, one of each row of neighbours with one step."""
        level, reach = self.levels[number], 2 << number
        places = np.flatnonzero(level >= 0)
        places = places[np.argsort(level[places], kind="stable")]
        near = (level[places[1:]] == level[places[:-1]]) & (places[1:] - places[:-1] <= reach)
        step = np.zeros(self.size, np.int32)
        step[places[:-1][near]] = (places[1:] - places[:-1])[near]
        found = np.flatnonzero(step)
        found = found[step[found + step[found]] == step[found]]
        if len(found):
            first = np.ones(len(found), bool)
            first[1:] = (np.diff(found) > 1) | (np.diff(step[found]) != 0)
            found = found[first]
        return found, step[found].astype(np.int64)

    def equal_after(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words are equal from both places on."""
        done = np.zeros(len(left), np.int64)
        for number in reversed(range(len(self.levels))):
            level, width = self.levels[number], 1 << number
            a, b = left + done, right + done
            inside = b < self.size
            own = level[np.where(inside, a, 0)]
            done += width * (inside & (own >= 0) & (own == level[np.where(inside, b, 0)]))
        return done

    def equal_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words are equal before both places."""
        done = np.zeros(len(left), np.int64)
        for number in reversed(range(len(self.levels))):
            level, width = self.levels[number], 1 << number
            a, b = left - done - width, right - done - width
            inside = a >= 0
            own = level[np.where(inside, a, 0)]
            done += width * (inside & (own >= 0) & (own == level[np.where(inside, b, 0)]))
        return done


def runs_of(words: np.ndarray, owner: np.ndarray, settings: Settings) -> np.ndarray:
    """Rows (start, length, period) of all runs of the texts laid end to end, by start, then period."""
    factors, found = Factors(words, owner), [np.zeros((0, 3), np.int64)]
    for number in range(len(factors.levels)):
        places, steps = factors.steps(number)
        start = places - factors.equal_before(places, places + steps)
        end = places + steps + factors.equal_after(places, places + steps)
        long = end - start >= np.maximum(settings.min_words, settings.min_periods * steps)
        found.append(np.stack([start, end - start, steps], 1)[long])
    found = np.concatenate(found)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        smallest = np.ones(len(found), bool)
        smallest[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)
        found = found[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _piece(ids: pa.Array, texts: pa.Array, settings: Settings) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    owner, words = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # the ends of a text with blanks there
    owner, words = owner[real.to_numpy(zero_copy_only=False)], words.filter(real)
    bounds = np.searchsorted(owner, np.arange(len(lists) + 1))
    found = runs_of(words.dictionary_encode().indices.to_numpy(), owner, settings)
    start, length, period = found.T
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    shares = np.searchsorted(start, bounds).astype(np.int32)
    begins = bounds[owner[start]] if len(start) else start
    runs = pa.StructArray.from_arrays([pa.array(start - begins), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    left = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)])[bounds]), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(shares), runs), collapsed], names=["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All runs of each text and the text with every run cut to one period.

    Returns one row per input row: doc_id (of any type), runs (array of start, length and
    period, counted in words, by start, then period) and collapsed, the words that no run
    holds after its first period, joined by single spaces.

    NULL and empty texts and texts of blanks have no runs and collapse to the empty text;
    so does nothing else.  NULL and repeated ids and repeated rows stay as they are, each
    row on its own; other columns are left out; an empty table gives no rows.  Runs may
    overlap; of equal stretches only the smallest period counts.
    """
    if settings.min_periods < 4:
        raise ValueError("progressions show every run only from four periods on")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                limit = (ends[at - 1] if at else 0) + settings.piece_bytes
                stop = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
                yield _piece(ids.slice(at, stop - at), texts.slice(at, stop - at), settings)
                at = stop

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts the query is asked about: a tenth of the documents, by a hash of the id, go round and round.

    In these, from word ``a`` on the first ``p`` words repeat to the end.  All others, and
    those without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")

    def laid(words: F.Column) -> F.Column:
        n = F.size(words)
        a = g % n
        return F.struct(words.alias("words"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))

    def around(of: F.Column) -> F.Column:
        return F.array_join(
            F.transform(of["words"], lambda w, i: F.when(i < of["a"], w).otherwise(F.element_at(of["words"], (of["a"] + (i - of["a"]) % of["p"]).cast("int") + 1))), " "
        )

    chosen = F.coalesce((h % 10 == 0) & F.col("text").rlike(WORD), F.lit(False))
    return docs.select("doc_id", F.when(chosen, F.transform(F.transform(F.array(words), laid), around)[0]).otherwise(F.col("text")).alias("text"))


def op11_find_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with the digests asked for."""
    found = find_runs(with_planted_runs(documents(spark, sf_dir)))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS back, -r.period AS short)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.short")).alias("period"),
        F.expr("1000 * longest.length div -longest.short").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
