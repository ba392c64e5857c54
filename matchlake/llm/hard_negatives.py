"""Hard negatives by slots between the scores of an anchor's positives.

For each positive one wants the best negatives that do not score above it.  These
windows overlap, so collecting each on its own would keep a row up to once per positive.
Instead the positives' scores, as upper limits, cut the scores of an anchor into
disjoint slots.  A row falls into one slot; a task keeps the best ``k`` of each slot,
whatever it reads; and a window is answered by the first ``k`` of its own slot and the
lower ones: descending merges over suffixes of slots serve all windows.

Anchors are a stated query set and meet all rows in packed blocks (``vectors.meet``),
twice: for the positives, then, as these set the slots, for the negatives.  A task holds
one block of anchors with its best entries and one block of rows.  Blocks are dealt
without regard to label or vector, so a hot label or a group of copies is no hot task;
what is shuffled behind the combiners is ``k`` entries per anchor, slot and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.llm.text import Scratch
from matchlake.llm.vectors import LOWEST, Best, dealt, embeddings, leading, matrix, meet, packed, products, unpacked, whole_numbers

FOUND = "anchor long, anchor_id long, slot int, score long, vec_id long"
#: An anchor's own number: its block, then its place among so many.
PLACES = 1 << 20


@dataclass(frozen=True)
class Settings:
    """How many positives and negatives, the least percentage of a positive's score, and sizes of blocks."""

    positives: int = 5
    negatives: int = 5
    percent: int = 80
    anchor_rows: int = 1024
    block_rows: int = 4096
    blocks_per_task: int = 4
    tasks: int = 20_000


def _pack(table: pa.Table) -> pa.Table:
    table = table.sort_by([("vec_id", "ascending"), ("label", "ascending")])
    arrays = {"ids": table["vec_id"].to_numpy(), "labels": table["label"].to_numpy(), "vectors": matrix(table["vector"])}
    return pa.table({"block": table["block"].slice(0, 1), "payload": pa.array([packed(**arrays)], pa.binary())})


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    return rows.withColumn("block", dealt(count)).groupBy("block").applyInArrow(_pack, "block long, payload binary")


def _batch(block: int, ids: np.ndarray, slot: int, best: Best) -> pa.RecordBatch:
    group, scores, found = best.entries()
    columns = [block * PLACES + group, ids[group], np.full(len(group), slot, np.int32), scores, found]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "anchor_id", "slot", "score", "vec_id"])


def _pieces(n: int, size: int = 256) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))


def _offer(best: Best, piece: slice, scores: np.ndarray, mask: np.ndarray, ids: np.ndarray) -> None:
    mask = leading(scores, mask & (scores >= best.scores[piece, -1:]), best.scores.shape[1])
    anchor, row = np.nonzero(mask)
    best.offer(anchor + piece.start, scores[anchor, row], ids[row])


def _merged(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(frame: DataFrame, anchors: F.Column, scale: int, settings: Settings = Settings()) -> DataFrame:
    """The best negatives below each positive of each anchor.

    ``frame`` has vec_id and label (whole numbers) and embedding; scores are inner products
    of floor(scale * x).  ``anchors`` says which rows are anchors.  An anchor's positives
    are its first ``positives`` rows of the same label; a positive's negatives are the first
    ``negatives`` rows of another label that score at most as high as it and at least
    ``percent`` of that.  First means higher scores, then smaller vec_id.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; windows without a negative, such as below a negative score, give no row.

    Rows with a NULL vec_id or label or a NULL, NaN or infinite component take no part.  A
    shorter vector counts as filled up with zeros; a score beyond 64 bits stays at the
    limit.  Rows with the anchor's vec_id are not among its positives or negatives; other
    repeated rows count each, and a repeated anchor is answered each time.  Other columns
    are left out; an empty table gives no rows.  Two tables of blocks and the positives stay
    in the shared folder until the session's folder is cleared.
    """
    scratch = Scratch(frame.sparkSession, "hard-negatives")
    rows = frame.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").alias("vector"), anchors.alias("is_anchor"))
    rows = whole_numbers(rows.where("vec_id IS NOT NULL AND label IS NOT NULL"), "vector", scale)
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    n_blocks, n_held = max(1, -(-n_rows // settings.block_rows)), max(1, -(-n_anchors // settings.anchor_rows))
    blocks = scratch.write("rows", _blocks(rows.drop("is_anchor"), n_blocks))
    held = scratch.write("anchors", _blocks(rows.where("is_anchor").drop("is_anchor"), n_held))
    stripes = -(-n_blocks // settings.blocks_per_task)
    tasks = min(settings.tasks, stripes * n_held)
    none = F.lit(None).cast("binary").alias("extra")
    passing = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_held - 1).cast("long"))).alias("key"), "block", "payload", none)

    def positives(row: dict, others: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        own = unpacked(row["payload"])
        best = Best(len(own["ids"]), settings.positives)
        for other in others:
            block = unpacked(other["payload"])
            for piece in _pieces(len(own["ids"])):
                scores = products(own["vectors"][piece], block["vectors"])
                mask = (own["labels"][piece, None] == block["labels"]) & (own["ids"][piece, None] != block["ids"])
                _offer(best, piece, scores, mask, block["ids"])
        yield _batch(row["block"], own["ids"], 0, best)

    found = meet(held.select(F.col("block").alias("key"), "block", "payload", none), passing, stripes, tasks, positives, FOUND)
    found = scratch.write("positives", _merged(found, settings.positives).drop("slot", "place"))

    def limits(table: pa.Table) -> pa.Table:
        """Distinct positive scores of each anchor, highest first; no window lies below a negative one."""
        place, score = table["anchor"].to_numpy() % PLACES, table["score"].to_numpy()
        seen = np.unique(np.stack([place, ~score], 1)[score >= 0], axis=0)
        return pa.table({"block": table["block"].slice(0, 1), "extra": pa.array([packed(place=seen[:, 0], score=~seen[:, 1])], pa.binary())})

    upper = found.withColumn("block", F.floor(F.col("anchor") / PLACES)).select("block", "anchor", "score")
    upper = upper.groupBy("block").applyInArrow(limits, "block long, extra binary")

    def negatives(row: dict, others: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        own, given = unpacked(row["payload"]), unpacked(row["extra"])
        n, slots = len(own["ids"]), settings.positives
        tops = np.full((n, slots + 1), LOWEST, np.int64)
        slot = np.arange(len(given["place"])) - np.searchsorted(given["place"], given["place"])
        tops[given["place"], slot] = given["score"]
        # below the lowest window of an anchor nothing is kept
        last = np.where(tops == LOWEST, np.iinfo(np.int64).max, tops).min(1)
        lowest = last - (last // 100) * (100 - settings.percent) - (last % 100) * (100 - settings.percent) // 100
        best = [Best(n, settings.negatives) for _ in range(slots)]
        for other in others:
            block = unpacked(other["payload"])
            for piece in _pieces(n):
                scores = products(own["vectors"][piece], block["vectors"])
                mask = (own["labels"][piece, None] != block["labels"]) & (own["ids"][piece, None] != block["ids"])
                mask &= (scores >= lowest[piece, None]) & (scores <= tops[piece, :1])
                for number in range(slots if mask.any() else 0):
                    inside = mask & (scores <= tops[piece, number : number + 1]) & (scores > tops[piece, number + 1 : number + 2])
                    _offer(best[number], piece, scores, inside, block["ids"])
        for number in range(slots):
            yield _batch(row["block"], own["ids"], number, best[number])

    slotted = meet(held.join(upper, "block").select(F.col("block").alias("key"), "block", "payload", "extra"), passing, stripes, tasks, negatives, FOUND)
    entry = F.struct("slot", (-F.col("score")).alias("below"), "vec_id")
    merged = _merged(slotted, settings.negatives).groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    suffix = F.slice(F.filter("entries", lambda e: -e["below"] <= F.col("positive_score")), 1, settings.negatives)
    least = F.expr(f"positive_score - (positive_score div 100) * {100 - settings.percent} - (positive_score % 100) * {100 - settings.percent} div 100")
    asked = found.select("anchor", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    answered = asked.join(merged, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(F.filter(suffix, lambda e: -e["below"] >= least)))
    return answered.select(
        "anchor_id",
        "positive_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.vec_id").alias("negative_id"),
        "positive_score",
        (-F.col("col.below")).alias("negative_score"),
    )


def op12_mine_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with some labels turned wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings(spark, sf_dir).withColumn("label", label), F.col("vec_id") % 100 == 0, 256)


OP12_SQL = """
WITH good AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
           list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT alike
    AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
