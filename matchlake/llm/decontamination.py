"""Benchmark decontamination by latent semantic retrieval.

1. All words of all documents are counted; a word weighs log(tokens / its count).  Words
   of the benchmark have weights of their own, others share 2^18 slots, which only
   enter the lengths of vectors.
2. Benchmark items are cut into passages of ``2 * cell`` words.  A randomised SVD of
   their weighted word vectors, whose products are summed over Spark's tasks, gives a
   basis of ``rank`` directions, and passages of which these keep less than
   ``min_kept`` of the length add their own, so that no item is out of reach.
3. Every document is cut into windows of two cells, one cell apart.  A window's cosine
   with each passage is the product of their coordinates over the window's whole
   length; windows whose share of benchmark words bounds it below ``min_cosine`` are
   left out first, which is exact.
4. For each candidate around which enough of the item's words occur, the longest common subsequence of the item's words and the words
   around the window decides: a share of ``copy_share`` is a copy, ``paraphrase_share``
   a paraphrase if the answer is there as well: the words of a column ``answer``, or
   the last words of the item.  A document that holds only a passage of an item copies
   it too: ``passage_words`` of any two cells of the item, in order.

Items come to the driver in blocks of at most ``block_bytes`` of text, and a block's
model is as large as its vocabulary times the rank; each block makes one pass over the
documents, without a shuffle.  The word counts are 2 MB at any size of the corpus.

Words are maximal runs of letters, digits and non-ASCII characters, in lower case, known
by 64-bit hashes that are computed on whole Arrow buffers.
Defined results: NULL and empty texts are clean, NULL or wordless items find nothing, an
empty benchmark leaves everything clean; repeated items and rows are reported each;
equal cosines keep the earliest window.  Other columns are kept by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from matchlake.llm import chunks as C
from matchlake.llm.text import Scanner, byte_values, documents, short_lived_shuffles

_SLOTS = 1 << 18
_BLOCKS = 64
#: Letters, digits and non-ASCII bytes make words.
_VALUES = byte_values([i >= 128 or chr(i).isalnum() for i in range(256)])


@dataclass(frozen=True)
class Settings:
    cell: int = 16
    rank: int = 192
    min_kept: float = 0.8
    min_cosine: float = 0.3
    copy_share: float = 0.8
    paraphrase_share: float = 0.6
    answer_words: int = 3
    passage_words: int = 30
    block_bytes: int = 250_000
    seed: int = 7


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)


class Numbers:
    """A number for each word: benchmark words from _SLOTS on, in the order given; others their slot."""

    def __init__(self, known: np.ndarray) -> None:
        """``known``: sorted hashes."""
        self.known = known
        self.first = np.full(_SLOTS, -1, np.int32)
        slots = _slots(known)
        self.first[slots] = np.arange(len(known))
        crowded = np.bincount(slots, minlength=_SLOTS) > 1
        self.crowded = crowded if crowded.any() else None

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = _slots(hashes)
        row = self.first[out]
        asked = np.flatnonzero(row >= 0)
        row, own = row[asked], hashes[asked]
        if self.crowded is not None:
            several = np.flatnonzero(self.crowded[out[asked]])
            row[several] = np.minimum(np.searchsorted(self.known, own[several]), len(self.known) - 1)
        same = self.known[row] == own
        out[asked[same]] = row[same] + _SLOTS
        return out


def _added(rows: DataFrame, dtype: type) -> dict[int, np.ndarray]:
    """Sums of packed arrays by block, as rows (block, data)."""

    def run(table: pa.Table) -> pa.Table:
        total = sum(C.unpacked(x, dtype) for x in table["data"].to_pylist())
        return pa.table({"block": table["block"].slice(0, 1), "data": pa.array([C.packed(total)], pa.binary())})

    with short_lived_shuffles(rows.sparkSession):
        found = rows.groupBy("block").applyInArrow(run, "block int, data binary").collect()
    return {r["block"]: C.unpacked(bytes(r["data"]), dtype) for r in found}


def _parts(arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(arrays)), pa.int32()), pa.array([C.packed(x) for x in arrays], pa.binary())], names=["block", "data"])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences in all documents by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, total = Scanner(_VALUES, pc.utf8_lower), np.zeros(_SLOTS, np.int64)
        for batch in batches:
            for part in _slices(batch):
                total += np.bincount(_slots(scanner.words(part.column(0))[0]), minlength=_SLOTS)
        yield _parts(np.split(total, _BLOCKS))

    sums = _added(docs.select("text").mapInArrow(run, "block int, data binary"), np.int64)
    return np.concatenate([sums.get(i, np.zeros(_SLOTS // _BLOCKS, np.int64)) for i in range(_BLOCKS)])


@dataclass(frozen=True)
class Model:
    """One block of items: their words, sorted known words, weights of all numbers, directions, and passages."""

    item_ids: list
    items: list[np.ndarray]
    answers: list[np.ndarray]
    known: np.ndarray
    weights: np.ndarray
    basis: np.ndarray
    passages: np.ndarray
    passage_item: np.ndarray
    passage_begin: np.ndarray


def _passages(words: int, cell: int) -> list[tuple[int, int]]:
    return [(a, min(words, a + 2 * cell)) for a in range(0, max(1, words - cell), cell)]


def _rows(numbers: np.ndarray, cuts: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weighted word vectors of unit length, as (columns, values)."""
    out = []
    for a, b in cuts:
        own, counts = np.unique(numbers[a:b] - _SLOTS, return_counts=True)
        values = counts * weights[own + _SLOTS]
        out.append((own, values / (np.linalg.norm(values) or 1.0)))
    return out


def _split(hashes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    return np.split(hashes, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _product(benchmark: DataFrame, known: np.ndarray, weights: np.ndarray, right: np.ndarray, settings: Settings) -> np.ndarray:
    """A' A times ``right`` for the matrix A of all passages, summed over tasks."""
    size = right.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, numbers, total = Scanner(_VALUES, pc.utf8_lower), Numbers(known), np.zeros(size)
        for batch in batches:
            for words in _split(*scanner.words(batch.column(0))):
                if len(words):
                    for own, values in _rows(numbers.of(words), _passages(len(words), settings.cell), weights):
                        total[own] += np.outer(values, values @ right[own])
        yield _parts(np.array_split(total.ravel(), _BLOCKS))

    sums = _added(benchmark.mapInArrow(run, "block int, data binary"), np.float64)
    return np.concatenate([sums[i] for i in range(_BLOCKS)]).reshape(size)


def fit(benchmark: DataFrame, rows: list, counts: np.ndarray, settings: Settings) -> Model | None:
    """The model of one block; ``rows`` are its (item_id, text, answer), ``benchmark`` the same as a frame of texts."""
    scanner = Scanner(_VALUES, pc.utf8_lower)
    items, answers = (_split(*scanner.words(pa.array([row[i] for row in rows], pa.string()))) for i in (1, 2))
    answers = [answer if len(answer) else words[-settings.answer_words :] for answer, words in zip(answers, items, strict=True)]
    known = np.unique(np.concatenate(items))
    if not len(known):
        return None
    total = int(counts.sum())
    weights = np.log((total + 2) / (np.concatenate([counts, counts[_slots(known)]]) + 1)).astype(np.float32)
    cuts = [(i, cut) for i, words in enumerate(items) if len(words) for cut in _passages(len(words), settings.cell)]
    rank = min(settings.rank, len(cuts), len(known))
    start = np.random.default_rng(settings.seed).standard_normal((len(known), min(rank + 16, len(known))))
    q, _ = np.linalg.qr(_product(benchmark, known, weights, start, settings))
    basis = np.linalg.svd(_product(benchmark, known, weights, q, settings), full_matrices=False)[0][:, :rank].astype(np.float32)
    numbers = Numbers(known)
    vectors = [_rows(numbers.of(items[i]), [cut], weights)[0] for i, cut in cuts]
    passages = np.array([values @ basis[own] for own, values in vectors], np.float32)
    # a passage that the basis hardly keeps gets a direction of its own
    lost = np.flatnonzero(np.linalg.norm(passages, axis=1) < settings.min_kept)
    if len(lost):
        rest = np.zeros((len(known), len(lost)))
        for column, row in enumerate(lost):
            own, values = vectors[row]
            rest[own, column] = values
            rest[:, column] -= basis @ passages[row]
        basis = np.linalg.qr(np.hstack([basis, rest]))[0].astype(np.float32)
        passages = np.array([values @ basis[own] for own, values in vectors], np.float32)
    return Model([r[0] for r in rows], items, answers, known, weights, basis, passages, np.array([i for i, _ in cuts]), np.array([a for _, (a, _) in cuts]))


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of one side as bits."""
    full = (1 << size) - 1
    state = full
    for word in words:
        hit = state & masks.get(word, 0)
        state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, word in enumerate(words.tolist()):
        out[word] = out.get(word, 0) | 1 << i
    return out


class Searcher:
    """Finds the items of a model in documents."""

    def __init__(self, model: Model, settings: Settings) -> None:
        self.model, self.settings = model, settings
        self.scanner, self.numbers = Scanner(_VALUES, pc.utf8_lower), Numbers(model.known)
        self.weighted = np.vstack([model.basis * model.weights[_SLOTS:, None], np.zeros((1, model.basis.shape[1]), np.float32)])
        self.squares = model.weights.astype(np.float64) ** 2
        self.sizes = np.array([len(x) for x in model.items])
        self.longest = int(self.sizes.max())
        self.rows = np.full((len(model.items), self.longest), len(model.known), np.int32)
        for i, words in enumerate(model.items):
            self.rows[i, : len(words)] = np.searchsorted(model.known, words)
        # the words of each passage and a cell on either side
        cell = settings.cell
        self.beside = np.full((len(model.passage_item), 4 * cell), len(model.known), np.int32)
        for i, (item, at) in enumerate(zip(model.passage_item.tolist(), model.passage_begin.tolist(), strict=True)):
            words = self.rows[item, : self.sizes[item]][max(0, at - cell) : at + 3 * cell]
            self.beside[i, : len(words)] = words
        self.parts: dict[tuple[int, int], list[dict[int, int]]] = {}
        self.masks = [_masks(x) for x in model.items]
        self.answer_masks = [_masks(x) for x in model.answers]

    def windows(self, hashes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(document, place of the first word, item, place of the passage in it, cosine) of the candidates."""
        cell, model = self.settings.cell, self.model
        if not len(hashes):
            return
        numbers = self.numbers.of(hashes)
        cells = -(-lengths // cell)
        first_word, first_cell = np.cumsum(lengths) - lengths, np.cumsum(cells) - cells
        n = int(cells.sum())
        document = np.repeat(np.arange(len(lengths)), cells)
        begins = first_word[document] + (np.arange(n) - first_cell[document]) * cell
        # a window is a cell and the next one of its document
        follow = np.arange(1, n + 1)
        paired = np.zeros(n, bool)
        paired[:-1] = document[1:] == document[:-1]
        follow[~paired] = n

        def by_window(mass: np.ndarray) -> np.ndarray:
            of_cell = np.append(np.add.reduceat(mass, begins), 0)
            return np.sqrt(of_cell[:-1] + of_cell[follow])

        mass = self.squares[numbers]
        length = by_window(mass)
        inside = numbers >= _SLOTS
        bound = by_window(mass * inside)
        asked = np.flatnonzero((bound >= self.settings.min_cosine * length) & (length > 0) & (paired | (cells[document] == 1)))
        cell_of = np.repeat(np.arange(n), np.diff(begins, append=len(numbers)))
        rows = np.full((n, cell), len(model.known), np.int32)
        rows[cell_of[inside], (np.arange(len(numbers)) - begins[cell_of])[inside]] = numbers[inside] - _SLOTS
        sums = np.zeros((n + 1, self.weighted.shape[1]), np.float32)
        for at in range(0, n, 32):
            np.add.reduce(self.weighted[rows[at : at + 32]], axis=1, out=sums[at : min(n, at + 32)])
        for at in range(0, len(asked), 4096):
            part = asked[at : at + 4096]
            products = (sums[part] + sums[follow[part]]) @ model.passages.T
            enough = products >= (self.settings.min_cosine * length[part]).astype(np.float32)[:, None]
            for i in np.flatnonzero(enough.any(axis=1)).tolist():
                d = int(document[part[i]])
                found = np.flatnonzero(enough[i])
                items, cosines = model.passage_item[found], products[i, found] / length[part[i]]
                # the item's words that occur around the window bound its subsequence
                first, last = int(first_word[d]), int(first_word[d] + lengths[d])
                begin = int(begins[part[i]])
                near = numbers[max(first, begin - self.longest) : min(last, begin + 2 * cell + self.longest)]
                present = np.zeros(len(model.known) + 1, bool)
                present[near[near >= _SLOTS] - _SLOTS] = True
                able = present[self.rows[items]].sum(axis=1) >= self.settings.paraphrase_share * self.sizes[items]
                able |= present[self.beside[found]].sum(axis=1) >= self.settings.passage_words
                at = model.passage_begin[found]
                yield from ((d, begin, int(x), int(a), float(y)) for x, a, y in zip(items[able], at[able], cosines[able], strict=True))

    def holds_passage(self, item: int, at: int, words: list[int]) -> bool:
        """Whether passage_words of two cells of the item that begin within a cell of the place are there, in order."""
        least, size = self.settings.passage_words, 2 * self.settings.cell
        if self.sizes[item] < least:
            return False
        if (parts := self.parts.get((item, at))) is None:
            # so close that a run of passage_words lies in one of them
            last = max(0, int(self.sizes[item]) - size)
            step = max(1, size - least + 1)
            begins = {min(last, x) for x in range(max(0, at - self.settings.cell), at + self.settings.cell + step, step)}
            parts = self.parts[item, at] = [_masks(self.model.items[item][x : x + size]) for x in sorted(begins)]
        return any(common_subsequence(x, size, words) >= least for x in parts)

    def find(self, texts: pa.Array) -> dict[tuple[int, int], tuple[float, float, bool, str]]:
        """(document, item) to cosine, share of the item, whether the answer is there, and verdict, for what is contaminated."""
        out: dict[tuple[int, int], tuple[float, float, bool, str]] = {}
        settings = self.settings
        hashes, lengths = self.scanner.words(texts)
        ends = np.cumsum(lengths)
        for d, begin, item, at, cosine in self.windows(hashes, lengths):
            size, first, last = int(self.sizes[item]), int(ends[d] - lengths[d]), int(ends[d])
            around = hashes[max(first, begin - size) : min(last, begin + 2 * settings.cell + size)].tolist()
            share = common_subsequence(self.masks[item], size, around) / size
            answered = common_subsequence(self.answer_masks[item], len(self.model.answers[item]), around) == len(self.model.answers[item])
            near = hashes[max(first, begin - 2 * settings.cell) : min(last, begin + 4 * settings.cell)].tolist()
            copied = share >= settings.copy_share or self.holds_passage(item, at, near)
            verdict = "copy" if copied else "paraphrase" if share >= settings.paraphrase_share and answered else ""
            known = out.get((d, item))
            if verdict and (known is None or (copied, share, cosine) > (known[3] == "copy", known[1], known[0])):
                out[d, item] = (cosine, share, answered, verdict)
        return out


def models(benchmark: DataFrame, counts: np.ndarray, settings: Settings) -> Iterator[Model]:
    """One model for each block of items, in order of item_id."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select("item_id", "text", answer.alias("answer")).orderBy("item_id", "text")
    block, held = [], 0

    def fitted() -> Model | None:
        frame = benchmark.sparkSession.createDataFrame([(r[1],) for r in block], "text string").repartition(8)
        return fit(frame, block, counts, settings)

    for row in rows.toLocalIterator():
        if held and held + len(row["text"] or "") > settings.block_bytes:
            if (model := fitted()) is not None:
                yield model
            block, held = [], 0
        block.append(tuple(row))
        held += len(row["text"] or "")
    if block and (model := fitted()) is not None:
        yield model


def _slices(batch: pa.RecordBatch, size: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def find_contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_found, verdict for each document and item found in it."""
    kinds = [x.schema[name].dataType.simpleString() for x, name in ((docs, "doc_id"), (benchmark, "item_id"))]
    item_kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, cosine double, lcs_share double, answer_found boolean, verdict string"
    narrow = docs.select("doc_id", "text")
    out = None
    for model in models(benchmark, word_counts(docs), settings):
        part = narrow.mapInArrow(_finder(model, settings, item_kind), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _finder(model: Model, settings: Settings, item_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(model, settings)
        for batch in batches:
            for part in _slices(batch):
                found = searcher.find(part.column(1))
                columns = list(zip(*found.values(), strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array([d for d, _ in found], pa.int64())),
                        pa.array([model.item_ids[i] for _, i in found], item_kind),
                        *(pa.array(x, kind) for x, kind in zip(columns, (pa.float64(), pa.float64(), pa.bool_(), pa.string()), strict=True)),
                    ],
                    names=["doc_id", "item_id", "cosine", "lcs_share", "answer_found", "verdict"],
                )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The clean rows with all their columns."""
    out = docs
    for model in models(benchmark, word_counts(docs), settings):
        out = out.mapInArrow(_keeper(model, settings), docs.schema)
    return out


def _keeper(model: Model, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(model, settings)
        for batch in batches:
            for part in _slices(batch):
                found = searcher.find(part.column(part.schema.get_field_index("text")))
                clean = np.ones(part.num_rows, bool)
                clean[[d for d, _ in found]] = False
                yield part.filter(pa.array(clean))

    return run


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return find_contamination(documents(spark, sf_dir), benchmark)
