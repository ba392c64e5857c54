"""Jaccard join of documents on word n-grams, by a prefix tree over ordered sets.

1. A count over the corpus (see chunks.py) tells for each shingle about how many
   documents have it.  A document of which less than the threshold's share of shingles
   occurs elsewhere links with nothing, and is done.  The counts also give the global
   order of shingles: rare first, then by hash.
2. Equal sets become one.  Two sets can only link if they share a shingle of their
   prefixes, the first n - ceil(t n) + 1 of each; components of this relation, formed
   by stars around one set for each shingle, are clusters no link can leave.
3. A cluster's sets go into a tree of common prefixes.  Each set walks the tree with
   its overlap so far, shared by all sets below a node, and leaves a subtree when the
   shingles that remain on either side cannot reach the overlap needed, when its sets
   are too short or too long or share too little with any other, or when all of them are
   known to be in the walker's component.  Sets in the middle of a cluster walk first,
   and the children of a node are looked at together, so a cluster of near copies costs
   about one path for each set.

A cluster larger than ``unit_shingles`` is cut by hash into blocks.  Each block is
joined within itself first; then only blocks of different components meet, those of
the cluster's largest component being apart from the rest.  A task never holds more
than two blocks, and nothing ever lists the pairs of a group.

Defined results: a document with fewer words than a shingle is one shingle, without a
word or text it has none and links with nothing; a NULL doc_id stays NULL and is
never a component's id unless the component has no other; repeated rows and ids link
by their texts; only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import chunks as C
from matchlake.llm.components import components
from matchlake.llm.text import Scanner, Scratch, WordHashes, byte_values, documents

#: Of the bytes of words, A-Z like a-z.
_VALUES = byte_values([i not in (9, 10, 11, 12, 13, 32) for i in range(256)], {i: i + 32 for i in range(65, 91)})


@dataclass(frozen=True)
class Settings:
    """words: of a shingle.  percent: sets link when 100 * intersection >= percent * union.
    unit_shingles: most shingles of a block of sets in one task."""

    words: int = 5
    percent: int = 80
    unit_shingles: int = 6_000_000
    layout: C.Layout = field(default_factory=lambda: C.Layout(level=3))


@cache
def _scanner() -> Scanner:
    return Scanner(_VALUES)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, A-Z taken as a-z."""
    hashes, lengths = _scanner().words(texts)
    keys = C.windows(hashes, size)
    sets, begin = [], 0
    for length, end in zip(lengths.tolist(), np.cumsum(lengths).tolist(), strict=True):
        if length >= size:
            sets.append(_distinct(keys[begin : end - size + 1]))
        elif length:
            sets.append(C.windows(hashes[begin:end] ^ np.uint64(length), length))
        else:
            sets.append(np.zeros(0, np.uint64))
        begin = end
    return sets


def _frequency_class(counts: np.ndarray) -> np.ndarray:
    """0 for one document, more for more: quarter powers of two."""
    return np.minimum(255, np.floor(4 * np.log2(counts))).astype(np.uint8)


_SETS = "n_shingles long, set_key binary, shingles binary"


def document_sets(docs: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, and for documents that may link their set's key and, once a chunk, its shingles in global order."""
    chunks, buckets = C.write_chunks(docs.select("doc_id", "text"), scratch, settings.layout)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(table: pa.Table, _: WordHashes) -> Iterator[tuple[int, bytes, bytes]]:
        sets = shingle_sets(table["text"].combine_chunks(), settings.words)
        distinct, counts = np.unique(np.concatenate(sets), return_counts=True)
        return C.Dealt(distinct, buckets).rows(distinct, counts.astype(np.uint32))

    def add(keys: list[bytes], extra: list[bytes]) -> list[bytes]:
        distinct, places = np.unique(C.widened(b"".join(keys)), return_inverse=True)
        counts = np.bincount(places, weights=np.concatenate([C.unpacked(x, np.uint32) for x in extra]), minlength=len(distinct))
        classes = _frequency_class(counts)[places]
        ends = np.cumsum([len(x) // C.NARROW for x in keys]).tolist()
        return [C.packed(classes[begin:end]) for begin, end in zip([0, *ends], ends)]

    def select(_: int, table: pa.Table, replies: pa.Table, hashes: WordHashes) -> pa.Table:
        sets = shingle_sets(table["text"].combine_chunks(), settings.words)
        distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
        classes = C.Dealt(distinct, buckets).gathered(replies, np.uint8, len(distinct))[places]
        keys: list[bytes | None] = []
        shingles: list[bytes | None] = []
        seen, at = set(), 0
        for own in sets:
            rank = classes[at : at + len(own)]
            at += len(own)
            key = ordered = None
            if len(own) and 100 * np.count_nonzero(rank) >= settings.percent * len(own):
                key = xxhash.xxh3_128_digest(own.tobytes())
                if key not in seen:
                    seen.add(key)
                    ordered = np.sort((rank.astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))).tobytes()
            keys.append(key)
            shingles.append(ordered)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "shingles": pa.array(shingles, pa.binary()),
            }
        )

    replies = scratch.write("classes", C.answer(C.send(chunks, count), add))
    out = scratch.write("sets", C.with_replies(chunks, replies, select, f"doc_id {kind}, {_SETS}"))
    scratch.drop("chunks", "classes")
    return out


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _clusters(sets: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """(node, root) of the sets that share a prefix shingle with another."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(data, np.int64)
                own = own[: _prefix_length(len(own), settings.percent)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(own), pa.binary()), pa.array(own)], names=["node", "shingle"])

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in prefixes(batches):
            held.append(batch)
            if len(held) == 500:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    postings = scratch.write("postings", sets.select("set_key", "shingles").mapInArrow(batched, "node binary, shingle long"))
    hubs = postings.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("shingle", "hub")
    stars = postings.join(hubs, "shingle").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).dropDuplicates()
    out = components(stars, scratch, "clusters")
    scratch.drop("postings")
    return out


class Forest:
    """Components of numbered sets, as far as known: ``label`` has each set's."""

    def __init__(self, labels: list[int]) -> None:
        self.label = np.array(labels, np.int64)
        self.members: dict[int, list[int]] = {}
        for i, label in enumerate(labels):
            self.members.setdefault(label, []).append(i)

    def join(self, i: int, j: int) -> bool:
        """Whether the two sets were in different components until now."""
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.label[moved] = a
        self.members[a] += moved
        return True


class Node:
    """Sets first..last-1 of the sorted order, all of which go on with ``edge``."""

    __slots__ = ("edge", "first", "last", "children", "firsts", "lasts", "waiting", "shortest", "longest", "most", "one")

    def __init__(self, edge: np.ndarray, first: int, last: int) -> None:
        self.edge, self.first, self.last, self.children = edge, first, last, []

    def close(self, sizes: np.ndarray, common: np.ndarray) -> None:
        """What is known of the children: their sets, those that did not walk yet, sizes, most common shingles of a set, and whether all are one component."""
        self.firsts, self.lasts = np.array([x.first for x in self.children]), np.array([x.last for x in self.children])
        at = self.firsts - self.first
        self.waiting, below = self.lasts - self.firsts, slice(self.first, self.last)
        self.shortest, self.longest = np.minimum.reduceat(sizes[below], at), np.maximum.reduceat(sizes[below], at)
        self.most = np.maximum.reduceat(common[below], at)
        self.one = np.array([not x.children for x in self.children])

    def walked(self, i: int) -> None:
        """A set below has met all others."""
        node = self
        while node.children:
            place = int(np.searchsorted(node.firsts, i, side="right")) - 1
            node.waiting[place] -= 1
            node = node.children[place]


def _shared(a: np.ndarray, b: np.ndarray, start: int) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[start:n] != b[start:n])
    return start + int(differ[0]) if len(differ) else n


class Shared:
    """The shingles that several sets have, each with its sets."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        flat = np.concatenate(sets)
        order = np.argsort(flat)
        flat = flat[order]
        several = np.zeros(len(flat), bool)
        several[1:] = flat[1:] == flat[:-1]
        several[:-1] |= several[1:]
        self.sizes, self.shingles = sizes, flat[several]
        self.sets = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order[several]]
        #: Of each set, how many it has; no overlap is larger.
        self.common = np.bincount(self.sets, minlength=len(sets))

    def linked_before(self, own: np.ndarray, percent: int) -> np.ndarray:
        """How many sets that link with one come before each place of the sorted order."""
        begins = np.searchsorted(self.shingles, own)
        lengths = np.searchsorted(self.shingles, own, side="right") - begins
        places = np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        overlaps = np.bincount(self.sets[places], minlength=len(self.sizes))
        linked = (100 + percent) * overlaps >= percent * (len(own) + self.sizes)
        return np.concatenate([[0], np.cumsum(linked)])


def build(sets: list[np.ndarray], sizes: np.ndarray, common: np.ndarray) -> Node:
    """The tree of lexicographically sorted distinct sets."""
    root = Node(sets[0][:0], 0, len(sets))
    work, inner = [(root, 0)], []
    while work:
        node, depth = work.pop()
        inner.append(node)
        at = node.first
        while at < node.last:
            if len(sets[at]) == depth:  # ends here
                node.children.append(Node(sets[at][:0], at, at + 1))
                at += 1
                continue
            token, low, high = sets[at][depth], at + 1, node.last
            while low < high:
                middle = (low + high) // 2
                if sets[middle][depth] == token:
                    low = middle + 1
                else:
                    high = middle
            end = len(sets[at]) if low - at == 1 else _shared(sets[at], sets[low - 1], depth)
            child = Node(sets[at][depth:end], at, low)
            node.children.append(child)
            if low - at > 1:
                work.append((child, end))
            at = low
    for node in inner:
        node.close(sizes, common)
    return root


#: With more children to look at, all overlaps are counted at once.
_MANY = 16


def tree_join(sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that together join all linked sets not yet in one component; sets are sorted and distinct.

    Sets with the fewest shingles of their own walk first: they are the middle of a cluster
    of copies, so that the others find themselves in their component already.  The children
    of a node are looked at together, one by one only those that may hold a link.
    """
    sizes = np.array([len(x) for x in sets])
    shared = Shared(sets, sizes)
    root, forest, links = build(sets, sizes, shared.common), Forest(labels), []
    over, label = 100 + percent, forest.label

    for i in np.argsort(sizes - shared.common, kind="stable").tolist():
        own, n, most = sets[i], int(sizes[i]), int(shared.common[i])
        root.walked(i)
        work = [(root, 0, 0)]
        visited, before = [], None
        while work:
            node, so_far, start = work.pop()
            may = (100 * node.longest >= percent * n) & (percent * node.shortest <= 100 * n)
            may &= over * np.minimum(node.most, most) >= percent * (n + node.shortest)
            may &= ~(node.one & (label[node.firsts] == label[i])) & (node.waiting > 0)
            places = np.flatnonzero(may)
            if len(places) > _MANY and before is None:
                before = shared.linked_before(own, percent)
            if before is not None:
                places = places[before[node.lasts[places]] > before[node.firsts[places]]]
            for place in places.tolist():
                child = node.children[place]
                if node.one[place] and label[child.first] == label[i]:
                    continue
                shortest, longest, overlap, depth = int(node.shortest[place]), int(node.longest[place]), so_far, start
                edge = child.edge
                if len(edge):
                    at = np.searchsorted(own, edge)
                    overlap += int(np.count_nonzero(own[np.minimum(at, n - 1)] == edge))
                    depth += len(edge)
                    ahead = n - int(np.searchsorted(own, edge[-1], side="right"))
                    if over * (overlap + ahead) < percent * (n + shortest):
                        continue
                    if over * (overlap + longest - depth) < percent * (n + longest):
                        continue
                if child.children:
                    visited.append((node, place, child))
                    work.append((child, overlap, depth))
                elif over * overlap >= percent * (n + shortest) and forest.join(i, child.first):
                    links.append((i, child.first))
        for node, place, child in reversed(visited):
            node.one[place] = child.one.all() and (label[child.firsts] == label[child.first]).all()
    return links


_UNIT = "unit string, label binary, set_key binary, shingles binary"


def _links(units: DataFrame, settings: Settings) -> DataFrame:
    """Edges (a, b) of linked sets within each unit."""

    def run(table: pa.Table) -> pa.Table:
        rows = [(np.frombuffer(x, np.uint64), key, label) for x, key, label in zip(*(table[c].to_pylist() for c in ("shingles", "set_key", "label")), strict=True)]
        rows.sort(key=lambda row: row[0].astype(">u8").tobytes())
        numbers: dict[bytes, int] = {}
        labels = [numbers.setdefault(label, len(numbers)) for _, _, label in rows]
        links = tree_join([row[0] for row in rows], labels, settings.percent)
        return pa.table({"a": pa.array([rows[i][1] for i, _ in links], pa.binary()), "b": pa.array([rows[j][1] for _, j in links], pa.binary())})

    return units.select("unit", "label", "set_key", "shingles").groupBy("unit").applyInArrow(run, "a binary, b binary")


def set_components(sets: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """(node, root) of the sets (set_key, shingles) that link with another."""
    clusters = _clusters(sets, scratch, settings)
    members = sets.join(clusters.withColumnRenamed("node", "set_key"), "set_key")
    sizes = members.groupBy("root").agg(F.sum(F.length("shingles") / 8).alias("total"))
    sizes = sizes.select("root", F.ceil(F.col("total") / settings.unit_shingles).cast("int").alias("blocks"))
    members = scratch.write("members", members.join(sizes, "root"))
    part = F.pmod(F.xxhash64("set_key"), F.col("blocks"))
    name = F.concat_ws("-", F.hex("root"), part)
    within = members.select(name.alias("unit"), F.col("set_key").alias("label"), "set_key", "shingles")
    links = scratch.write("links", _links(within, settings))
    large = members.where("blocks > 1")
    if large.head(1):
        across = _across(large, components(links, scratch, "within"), scratch, settings)
        links = links.unionByName(scratch.write("links-across", _links(across, settings)))
    out = components(links, scratch, "linked")
    scratch.drop("members")
    return out


def _across(large: DataFrame, labels: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """Units of two blocks each, for sets of large clusters that are not yet in one component."""
    known = large.join(labels.withColumnRenamed("root", "label").withColumnRenamed("node", "set_key"), "set_key", "left")
    known = known.withColumn("label", F.coalesce("label", "set_key"))
    largest = known.groupBy("root", "label").agg(F.count("*").alias("n")).groupBy("root")
    largest = largest.agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    known = known.join(largest.select("root", F.col("most.label").alias("main")), "root")
    known = known.withColumn("side", F.when(F.col("label") == F.col("main"), 0).otherwise(1))
    sides = known.groupBy("root", "side").agg(F.sum(F.length("shingles") / 8).alias("total"))
    sides = sides.groupBy("root").pivot("side", [0, 1]).agg(F.ceil(F.first("total") / settings.unit_shingles).cast("int"))
    known = known.join(sides.toDF("root", "mains", "others"), "root")
    own = F.pmod(F.xxhash64("set_key"), F.when(F.col("side") == 0, F.col("mains")).otherwise(F.col("others")))
    known = known.withColumn("own", own)
    # a block of the main component meets each other block; other blocks also meet one another
    against_others = F.sequence(F.lit(0), F.col("others") - 1)
    with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda x: F.concat_ws("-", F.lit("m"), x, F.col("own")))
    with_other = F.transform(against_others, lambda x: F.concat_ws("-", F.lit("o"), F.least(x.cast("long"), F.col("own")), F.greatest(x.cast("long"), F.col("own"))))
    meets = F.when(F.col("side") == 0, F.transform(against_others, lambda x: F.concat_ws("-", F.lit("m"), F.col("own"), x))).otherwise(F.concat(with_main, with_other))
    return known.select(F.explode(meets).alias("pair"), "root", "label", "set_key", "shingles").withColumn("unit", F.concat_ws("-", F.hex("root"), "pair"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles and component_id for every row."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = document_sets(docs, scratch, settings)
    distinct = scratch.write("distinct", sets.where("shingles IS NOT NULL").select("set_key", "shingles").dropDuplicates(["set_key"]))
    roots = set_components(distinct, scratch, settings).withColumnRenamed("node", "set_key")
    linked = sets.where("set_key IS NOT NULL").select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    linked = scratch.write("linked-documents", linked.select("doc_id", "n_shingles", F.coalesce("root", "set_key").alias("root")))
    # written first, so that the join has a shuffle of its own on either side and Spark can split a hot component
    smallest = scratch.write("smallest", linked.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    together = linked.join(smallest, "root").select("doc_id", "n_shingles", "component_id")
    alone = sets.where("set_key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = scratch.write("result", alone.unionByName(together))
    scratch.drop("sets", "distinct", "linked-documents", "smallest", "links", "links-across")
    return out


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
