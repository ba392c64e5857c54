"""N-gram language model in Elias-Fano tries, and the scores of all texts under it.

The model interpolates trigrams, bigrams and single words: with c for counts in the
training texts, N for all of them and V for distinct words,

    P1(w)       = (c(w) + a) / (N + a (V + 1))
    P2(w | v)   = c(v w) / (c(v) + s2) + s2 / (c(v) + s2) P1(w)
    P3(w | u v) = c(u v w) / (c(u v) + s3) + s3 / (c(u v) + s3) P2(w | v)

Every text begins after a start mark and ends in an end mark.  The first terms are the
smoothed probabilities that the trie stores, quantised to steps of ``_STEP`` of log10.

The model is as large as the corpus, so it is never in one place.  It is a trie for
each bucket of contexts (see chunks.py for how chunks and buckets talk), one order
after the other: a bucket gets the distinct n-grams of each chunk with their training
counts, builds its trie from those that training has, and looks up all of them, seen or
not, for the chunks' scores.  Contexts that fill more than their share of a bucket are
spread by the next word.  Trigrams whose first two words stand together in no other
chunk are counted where they are; the others travel.

A trie's levels are monotone sequences in Elias-Fano form in a memory-mapped file that
vanishes with the task: pointers from each context to its words, and the words as ranks,
made monotone by their context's number.  Lookups are successor searches among the
words of their context, in the order of the trie.

Words are told apart by 64-bit hashes; within a bucket contexts are by 40 bits, and the
words of a context by 32.  Defined results: NULL and empty texts are just the end mark; a NULL doc_id
is not held out; without training texts N = V = 0 and every probability is 1; repeated
rows count as often as they occur; further columns are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import chunks as C
from matchlake.llm.text import Scanner, Scratch, WordHashes, byte_values, documents, mixed, remainder

#: Words are what stands between blanks, A-Z as a-z.
_VALUES = byte_values([i not in (9, 10, 11, 12, 13, 32) for i in range(256)], {i: i + 32 for i in range(65, 91)})
_START, _END = np.uint64(0x5157A27), np.uint64(0xE2D0F7E)
_STEP, _LOWEST = 1 / 4096, 12.0


@dataclass(frozen=True)
class Settings:
    """added: a.  strength: s2 and s3."""

    added: float = 0.1
    strength: tuple[float, float] = (60.0, 8.0)
    layout: C.Layout = field(default_factory=C.Layout)


class EliasFano:
    """A non-decreasing sequence below a bound: low bytes as they are, the rest in unary."""

    SAMPLE = 512

    def __init__(self, values: np.ndarray, bound: int, file) -> None:
        self.size = len(values)
        bits = max(0, (max(1, bound) // max(1, self.size)).bit_length())
        self.width = -(-bits // 8)
        low = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : self.width]
        ones = (values >> np.uint64(8 * self.width)).astype(np.int64) + np.arange(self.size) if self.width < 8 else np.arange(self.size)
        unary = np.zeros(int(ones[-1]) + 1 if self.size else 0, np.uint8)
        unary[ones] = 1
        self.low = mapped(low.tobytes(), file)
        self.high = mapped(np.packbits(unary, bitorder="little").tobytes(), file)
        self.samples = mapped(ones[:: self.SAMPLE].astype(np.int64).tobytes(), file)

    def slice(self, first: int, last: int) -> np.ndarray:
        """Values first..last-1."""
        if last <= first:
            return np.zeros(0, np.uint64)
        places = self.samples.view(np.int64)
        block = first // self.SAMPLE
        begin = int(places[block])
        after = -(-last // self.SAMPLE)
        end = int(places[after]) if after < len(places) else 8 * len(self.high)
        unary = np.unpackbits(self.high[begin // 8 : -(-end // 8)], bitorder="little")
        ones = np.flatnonzero(unary[begin % 8 :]) + begin
        skip = first - block * self.SAMPLE
        high = (ones[skip : skip + last - first] - np.arange(first, last)).astype(np.uint64)
        out = np.zeros((last - first, 8), np.uint8)
        out[:, : self.width] = self.low.reshape(-1, self.width)[first:last] if self.width else 0
        low = out.view("<u8").ravel()
        return low | (high << np.uint64(8 * self.width)) if self.width < 8 else low


def mapped(data: bytes, file) -> np.ndarray:
    """The bytes at the end of a file, mapped into memory."""
    if not data:
        return np.zeros(0, np.uint8)
    at = file.seek(0, 2)
    file.write(data)
    file.flush()
    return np.memmap(file, np.uint8, "r", at, (len(data),))


class Level:
    """Children of the nodes above, each with a code."""

    BLOCK = 1_000_000

    def __init__(self, parents: np.ndarray, words: np.ndarray, codes: np.ndarray, above: int, file) -> None:
        """Sorted by parent and word."""
        self.vocabulary = np.unique(words)
        ranks = np.searchsorted(self.vocabulary, words).astype(np.uint64)
        n = np.uint64(max(1, len(self.vocabulary)))
        self.children = EliasFano(parents.astype(np.uint64) * n + ranks, above * int(n), file)
        pointers = np.searchsorted(parents, np.arange(above + 1)).astype(np.uint64)
        self.pointers = EliasFano(pointers, len(words) + 1, file)
        self.codes = mapped(codes.astype("<u2").tobytes(), file).view("<u2")

    def find(self, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The place of each (parent, word), or -1; the queries are sorted by parent."""
        out = np.full(len(parents), -1, np.int64)
        if not len(self.codes):
            return out
        ranks = np.searchsorted(self.vocabulary, words)
        known = ranks < len(self.vocabulary)
        known[known] = self.vocabulary[ranks[known]] == words[known]
        n = np.uint64(len(self.vocabulary))
        asked = np.flatnonzero(known)
        at = 0
        while at < len(asked):
            stop = min(len(asked), at + self.BLOCK)
            part = asked[at:stop]
            first, last = int(parents[part[0]]), int(parents[part[-1]])
            begin, end = int(self.pointers.slice(first, first + 1)[0]), int(self.pointers.slice(last + 1, last + 2)[0])
            values = self.children.slice(begin, end)
            sought = parents[part].astype(np.uint64) * n + ranks[part].astype(np.uint64)
            places = np.searchsorted(values, sought)
            hit = places < len(values)
            hit[hit] = values[places[hit]] == sought[hit]
            out[part[hit]] = places[hit] + begin
            at = stop
        return out


def code(probability: np.ndarray) -> np.ndarray:
    """0 for none, else a step of log10."""
    logs = np.log10(np.maximum(probability, 10.0**-_LOWEST))
    return np.where(probability > 0, np.rint((logs + _LOWEST) / _STEP) + 1, 0).astype(np.uint16)


def decoded(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) * _STEP - _LOWEST), 0.0)


class Tokens:
    """A chunk's token sequence with start and end marks."""

    def __init__(self, table: pa.Table) -> None:
        hashes, counts = Scanner(_VALUES).words(table["text"].combine_chunks())
        self.n_tokens = counts + 1
        lengths = counts + 2
        ends = np.cumsum(lengths)
        self.sequence = np.empty(int(lengths.sum()), np.uint64)
        inner = np.ones(len(self.sequence), bool)
        inner[ends - 1] = inner[ends - lengths] = False
        self.sequence[inner] = hashes
        self.sequence[ends - lengths], self.sequence[ends - 1] = _START, _END
        self.training = np.repeat(~table["held_out"].to_numpy().astype(bool), lengths)
        self.scored = np.ones(len(self.sequence), bool)
        self.scored[ends - lengths] = False
        self.distinct, self.ids = np.unique(self.sequence, return_inverse=True)

    def counted(self) -> np.ndarray:
        """Training counts of the distinct tokens; a start mark counts like the end mark that it stands for."""
        return np.bincount(self.ids[self.training], minlength=len(self.distinct))


class Grams:
    """Distinct (context, word) of a chunk, dealt to buckets by context; those of contexts not ``sent`` come last."""

    def __init__(self, tokens: Tokens, contexts: np.ndarray, places: np.ndarray, hashes: np.ndarray, counts: np.ndarray, sent: np.ndarray, total: int, buckets: int) -> None:
        """``contexts``: the context before the token at each of ``places``; ``hashes``, ``counts``, ``sent``: by context."""
        size = np.uint64(len(tokens.distinct))
        keys, of = np.unique(contexts.astype(np.uint64) * size + tokens.ids[places].astype(np.uint64), return_inverse=True)
        context, word = (keys // size).astype(np.int64), (keys % size).astype(np.int64)
        spread = np.maximum(1, -(-counts[context] * 4 * buckets // max(1, total))).astype(np.uint64)
        stirred = mixed(hashes[context] + mixed(tokens.distinct[word]) % spread * np.uint64(0x9E3779B97F4A7C15))
        bucket = (stirred >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
        bucket[~sent[context]] = buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.of, self.context, self.word = rank[of], context[order], word[order]
        self.bounds = np.searchsorted(bucket[order], np.arange(buckets + 2))
        self.counts = np.bincount(self.of, weights=tokens.training[places], minlength=len(order)).astype(np.uint64)
        self.hashes, self.context_counts, self.words = hashes, counts, tokens.distinct

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        for bucket in np.flatnonzero(np.diff(self.bounds[:-1])):
            a, b = self.bounds[bucket : bucket + 2]
            new = np.flatnonzero(np.diff(self.context[a:b], prepend=-1))
            heads = self.context[a:b][new]
            keys = C.narrow(self.hashes[heads]) + C.narrow(self.words[self.word[a:b]], 4)
            extra = [self.context_counts[heads].astype(np.uint32), np.diff(new, append=b - a).astype(np.uint32), self.counts[a:b].astype(np.uint32)]
            yield int(bucket), keys, C.packed(np.concatenate([np.array([len(heads), b - a], np.uint32), *extra]))

    def codes(self, replies: pa.Table, strength: float) -> tuple[np.ndarray, np.ndarray]:
        """Of each n-gram its code and whether another chunk has it."""
        codes, several = np.zeros(len(self.context), np.uint16), np.zeros(len(self.context), bool)
        for bucket, reply in zip(replies["bucket"].to_pylist(), replies["reply"].to_pylist(), strict=True):
            a, b = self.bounds[bucket : bucket + 2]
            data = C.unpacked(reply, np.uint8)
            codes[a:b] = data[: 2 * (b - a)].view(np.uint16)
            several[a:b] = np.unpackbits(data[2 * (b - a) :], count=b - a)
        own = slice(self.bounds[-2], self.bounds[-1])
        codes[own] = code(self.counts[own] / (self.context_counts[self.context[own]] + strength))
        return codes, several


def answers(keys: list[bytes], extra: list[bytes], strength: float) -> list[bytes]:
    """Builds a bucket's trie and looks up each chunk's n-grams: their codes, and one bit whether several chunks have them."""
    heads, degrees, contexts, words, counts, sizes = [], [], [], [], [], []
    for key, more in zip(keys, extra, strict=True):
        numbers = C.unpacked(more, np.uint32)
        n, m = numbers[:2].tolist()
        sizes.append(m)
        heads.append(C.widened(key[: 5 * n]))
        words.append(C.widened(key[5 * n :], 4))
        for into, part in zip((contexts, degrees, counts), np.split(numbers[2:], [n, 2 * n]), strict=True):
            into.append(part)
    distinct, numbers = np.unique(np.concatenate(heads), return_inverse=True)
    context = np.zeros(len(distinct))
    context[numbers] = np.concatenate(contexts)
    grams, of = np.unique(np.repeat(numbers, np.concatenate(degrees)).astype(np.uint64) << np.uint64(32) | np.concatenate(words), return_inverse=True)
    count = np.bincount(of, weights=np.concatenate(counts), minlength=len(grams))
    several = np.bincount(of, minlength=len(grams)) > 1
    parent, word = (grams >> np.uint64(32)).astype(np.int64), grams & np.uint64((1 << 32) - 1)
    held = count > 0
    with tempfile.TemporaryFile() as file:
        trie = Level(parent[held], word[held], code(count[held] / (context[parent[held]] + strength)), len(distinct), file)
        place = trie.find(parent, word)
        found = np.zeros(len(grams), np.uint16)
        found[place >= 0] = trie.codes[place[place >= 0]]
    cuts = np.cumsum(sizes)[:-1]
    return [C.packed(np.concatenate([x.view(np.uint8), np.packbits(y)])) for x, y in zip(np.split(found[of], cuts), np.split(several[of], cuts), strict=True)]


class Model:
    """What a chunk knows after each exchange."""

    def __init__(self, table: pa.Table, replies: pa.Table, totals: tuple[int, int], buckets: int, settings: Settings) -> None:
        step = replies["step"].to_numpy()
        self.replies = [replies.filter(pa.array(step == i)) for i in range(4)]
        self.total, self.buckets, self.strength = totals[0], buckets, settings.strength
        self.tokens = Tokens(table)
        dealt = C.Dealt(self.tokens.distinct, buckets)
        self.counts = dealt.gathered(self.replies[1], np.uint64, len(self.tokens.distinct)).astype(np.int64)

    def pairs(self) -> Grams:
        """Bigrams, in the order of all scored tokens."""
        tokens = self.tokens
        places = np.flatnonzero(tokens.scored)
        return Grams(tokens, tokens.ids[places - 1], places, tokens.distinct, self.counts, np.ones(len(self.counts), bool), self.total, self.buckets)

    def triples(self, pairs: Grams) -> tuple[np.ndarray, np.ndarray, Grams]:
        """Bigram codes, trigrams in the order of ``follows``, the scored tokens that are not the first of their text."""
        tokens = self.tokens
        codes, several = pairs.codes(self.replies[2], self.strength[0])
        places = np.flatnonzero(tokens.scored)
        follows = np.flatnonzero(tokens.scored[places - 1])
        counts = np.rint(decoded(codes) * (self.counts[pairs.context] + self.strength[0])).astype(np.int64)
        hashes = mixed(tokens.distinct[pairs.context] * np.uint64(0xC2B2AE3D27D4EB4F) + mixed(tokens.distinct[pairs.word]))
        # a count read off its code would differ between here and elsewhere only for pairs of one chunk
        counts = np.where(several, counts, pairs.counts.astype(np.int64))
        return codes, follows, Grams(tokens, pairs.of[follows - 1], places[follows], hashes, counts, several, self.total, self.buckets)


def score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for rows of (doc_id, text, held_out)."""
    scratch = Scratch(docs.sparkSession, "ngrams")
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks, buckets = C.write_chunks(docs.select("doc_id", "text", "held_out"), scratch, settings.layout)

    def count(table: pa.Table, hashes: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        tokens = Tokens(table)
        counts = tokens.counted()
        for bucket, index in C.Dealt(tokens.distinct, buckets):
            yield bucket, tokens.distinct[index].tobytes(), C.packed(counts[index].astype(np.uint64))

    def add(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
        parts = [np.frombuffer(x, np.uint64) for x in keys]
        distinct, places = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(places, weights=np.concatenate([C.unpacked(x, np.uint64) for x in extra]), minlength=len(distinct)).astype(np.uint64)
        own = counts[distinct != _START]
        totals = np.array([own.sum(), np.count_nonzero(own)], np.uint64)
        split = np.split(counts[places], np.cumsum([len(x) for x in parts])[:-1])
        # the totals go with the first row, before its counts
        return [(b"\1" + totals.tobytes() if i == 0 else b"\0") + C.packed(x) for i, x in enumerate(split)]

    raw = scratch.write("counts-raw", C.answer(C.send(chunks, count), add))
    first = F.expr("substring(reply, 1, 1) = X'01'")
    totals = raw.where(first).select(F.substring("reply", 2, 16).alias("t")).toLocalIterator()
    summed = np.sum([np.frombuffer(bytes(r["t"]), np.uint64) for r in totals] or [np.zeros(2, np.uint64)], axis=0)
    n, v = int(summed[0]), int(summed[1])
    counts = raw.withColumn("reply", F.expr("substring(reply, CASE WHEN substring(reply, 1, 1) = X'01' THEN 18 ELSE 2 END, length(reply))")).withColumn("step", F.lit(1))
    s2, s3 = settings.strength

    def send_pairs(table: pa.Table, found: pa.Table, hashes: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        yield from Model(table, found, (n, v), buckets, settings).pairs().rows()

    codes2 = scratch.write("codes-2", C.answer(C.send_again(chunks, counts, send_pairs), lambda keys, extra: answers(keys, extra, s2)))
    known = counts.unionByName(codes2.withColumn("step", F.lit(2)))

    def send_triples(table: pa.Table, found: pa.Table, hashes: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        model = Model(table, found, (n, v), buckets, settings)
        yield from model.triples(model.pairs())[2].rows()

    codes3 = scratch.write("codes-3", C.answer(C.send_again(chunks, known, send_triples), lambda keys, extra: answers(keys, extra, s3)))
    known = known.unionByName(codes3.withColumn("step", F.lit(3)))

    def finish(_: int, table: pa.Table, found: pa.Table, hashes: WordHashes) -> pa.Table:
        model = Model(table, found, (n, v), buckets, settings)
        tokens, pairs = model.tokens, model.pairs()
        pair_codes, follows, triples = model.triples(pairs)
        single = model.counts[tokens.ids[tokens.scored]]
        base = np.log10((single + settings.added) / (n + settings.added * (v + 1))) if n else np.zeros(len(single))
        before = model.counts[pairs.context[pairs.of]]
        p = decoded(pair_codes)[pairs.of] + s2 / (before + s2) * 10.0**base
        both = triples.context[triples.of]
        p[follows] = decoded(triples.codes(model.replies[3], s3)[0])[triples.of] + s3 / (triples.context_counts[both] + s3) * p[follows]
        starts = np.cumsum(tokens.n_tokens) - tokens.n_tokens
        if n == 0:
            p = np.ones(len(p))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": table["held_out"],
                "n_tokens": pa.array(tokens.n_tokens),
                "n_known": pa.array(np.add.reduceat((single > 0).astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(starts), n, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(np.add.reduceat(np.log10(p), starts)),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = scratch.write("result", C.with_replies(chunks, known, finish, schema))
    scratch.drop("chunks", "counts-raw", "codes-2", "codes-3")
    return out


def op4_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.coalesce(remainder(10) == 0, F.lit(False)).alias("held_out"))
    return score(docs)
