"""Exact top-k inner products by a dual-tree search over cover trees.

Queries and data are indexed together.  A bounded sample gives the centres of the top
level, farthest points first; every row goes to the cell of its nearest centre, and a
cell, cut into blocks of bounded size, grows a cover tree in each block, again farthest
points first: the points farther apart than half, a quarter, ... of the first gap are
the nodes of a level, each under the nearest node above.  A node knows its covering
radius (the distance to its farthest row) and its smallest id.  The queries of a cell
form trees of their own in the same way.

For rows q and r below nodes with centres c, d and radii s, t::

    <q, r>  <=  <c, d> + s |d| + t |c| + s t

A pair of nodes is dropped when this bound cannot beat the worst k-th score of the query
node, ties by id included; levels of both trees go down together, all pairs of a level
at once.  What is left at the leaves is scored by matrix products, best bounds first, so
that thresholds rise early.  The search has three steps: each group of queries searches
a block of its own cell, which sets its thresholds; pairs of cells are pruned by their
radii; the rest of the groups, as packed rows with their thresholds, pass the blocks they
may find something in (``vectors.meet``).

The only things at the driver are the sample and one row per cell, both bounded by
parameters.  The sample decides where cells lie, never what is found: results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.llm.text import Scratch
from matchlake.llm.vectors import HIGHEST, LOWEST, Best, dealt, embeddings, leading, matrix, meet, norms, packed, products, same_width, unpacked, whole_numbers

FOUND = "query long, query_id long, score long, vec_id long"
#: A query's own number: its group, then its place among so many; a block's: its cell, then its number.
PLACES = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Sizes of the parts of the index; ``sample_rows`` and ``max_cells`` bound what the driver holds."""

    sample_rows: int = 2048
    max_cells: int = 512
    block_rows: int = 4096
    query_rows: int = 256
    leaf_rows: int = 16
    groups_per_task: int = 64
    tasks: int = 20_000


def farthest_first(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``count`` centres, each farthest from those before; their gaps; each point's nearest centre."""
    points = points.astype(np.float64)
    centres, gaps, nearest = [0], [np.inf], np.zeros(len(points), np.int64)
    distance = ((points - points[0]) ** 2).sum(1)
    while len(centres) < count:
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        own = ((points - points[far]) ** 2).sum(1)
        closer = own < distance
        nearest[closer], distance[closer] = len(centres), own[closer]
        centres.append(far)
        gaps.append(np.sqrt(own[centres[:-1]].min()))
    return np.array(centres), np.array(gaps), nearest


class Tree:
    """A cover tree over rows that are ordered by leaf; levels from the root down."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int) -> None:
        centres, gaps, leaf = farthest_first(points, max(1, -(-len(ids) // leaf_rows)))
        self.centres = points[centres]
        order = np.argsort(leaf, kind="stable")
        self.ids, self.points, leaf = ids[order], points[order], leaf[order]
        self.ends = np.searchsorted(leaf, np.arange(len(centres) + 1))
        # the nodes of a level are the first centres, down to half the gap of the level above
        sizes, gap = [1], gaps[1] if len(gaps) > 1 else 0
        while sizes[-1] < len(centres):
            gap = min(gap, gaps[sizes[-1]]) / 2
            sizes.append(int(np.count_nonzero(gaps > gap)))
        self.parents, self.members = [np.zeros(1, np.int64)], [leaf]
        for size, above in zip(sizes[:0:-1], sizes[-2::-1], strict=True):
            up = np.arange(size)
            apart = ((self.centres[above:size, None].astype(np.float64) - self.centres[None, :above]) ** 2).sum(2) if size > above else np.zeros((0, above))
            up[above:] = apart.argmin(1) if size > above else up[above:]
            self.parents.insert(1, up)
            self.members.insert(0, up[self.members[0]])
        self.radii, self.least = [], []
        for size, member in zip(sizes, self.members, strict=True):
            distance = np.sqrt(((self.points - self.centres[member]).astype(np.float64) ** 2).sum(1))
            radius, least = np.zeros(size), np.full(size, HIGHEST, np.int64)
            np.maximum.at(radius, member, distance)
            np.minimum.at(least, member, self.ids)
            self.radii.append(radius)
            self.least.append(least)
        self.norms = norms(self.centres)

    def level(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Parents, members, radii and least ids; below the leaves each node is its own child."""
        if number < len(self.radii):
            return self.parents[number], self.members[number], self.radii[number], self.least[number]
        return np.arange(len(self.radii[-1])), self.members[-1], self.radii[-1], self.least[-1]

    def rows(self, leaves: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.ends[x], self.ends[x + 1]) for x in leaves])


def _bounds(inner: np.ndarray, radii: tuple[np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The highest whole score below each pair of nodes, rounding errors allowed for."""
    (s, t), (c, d) = radii, sizes
    top = inner + s[:, None] * d + c[:, None] * t + s[:, None] * t
    return np.floor(top + 1e-9 * ((c + s)[:, None] * (d + t)) + 1e-3)


def _hopeful(bounds: np.ndarray, least: np.ndarray, worst: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    score, number = worst
    return (bounds > score[:, None]) | ((bounds == score[:, None]) & (least < number[:, None]))


def _worst(best: Best, member: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the queries of each node, the lowest k-th score and the highest id that goes with it."""
    score, number = np.full(nodes, HIGHEST, np.int64), np.full(nodes, LOWEST, np.int64)
    np.minimum.at(score, member, best.scores[:, -1])
    same = best.scores[:, -1] == score[member]
    np.maximum.at(number, member[same], best.ids[same, -1])
    return score.astype(np.float64), number


def search(queries: Tree, data: Tree, best: Best, leaves_at_once: int = 32) -> int:
    """Offers ``best`` (its groups are the queries in the tree's order) what the data holds; counts scores taken."""
    a, b = same_width(queries.centres, data.centres)
    inner = a.astype(np.float64) @ b.astype(np.float64).T
    alive = np.ones((1, 1), bool)
    for number in range(max(len(queries.radii), len(data.radii))):
        (up, member, s, _), (down, _, t, least) = queries.level(number), data.level(number)
        alive = alive[np.ix_(up, down)]
        bounds = _bounds(inner[: len(s), : len(t)], (s, t), (queries.norms[: len(s)], data.norms[: len(t)]))
        alive &= _hopeful(bounds, least, _worst(best, member, len(s)))
        if not alive.any():
            return 0
    taken, tops = 0, np.where(alive, bounds, -np.inf).max(0)
    leaves = np.argsort(-tops, kind="stable")[: np.count_nonzero(alive.any(0))]
    for at in range(0, len(leaves), leaves_at_once):
        now = leaves[at : at + leaves_at_once]
        open_ = alive[:, now] & _hopeful(bounds[:, now], least[now], _worst(best, member, len(s)))
        # leaves that the same query leaves ask for are scored together
        patterns, which = np.unique(open_, axis=1, return_inverse=True)
        for number, pattern in enumerate(patterns.T):
            if not pattern.any():
                continue
            asking, rows = np.flatnonzero(pattern[member]), data.rows(now[which.ravel() == number])
            for begin in range(0, len(rows), 4096):
                part = rows[begin : begin + 4096]
                scores = products(queries.points[asking], data.points[part])
                mask = (scores >= best.scores[asking, -1:]) & (queries.ids[asking, None] != data.ids[part])
                query, row = np.nonzero(leading(scores, mask, best.scores.shape[1]))
                best.offer(asking[query], scores[query, row], data.ids[part][row])
                taken += scores.size
    return taken


def _entries(group: int, tree: Tree, best: Best) -> pa.RecordBatch:
    query, scores, found = best.entries()
    columns = [group * PLACES + query, tree.ids[query], scores, found]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "query_id", "score", "vec_id"])


def _blocks(assigned: DataFrame, counts: DataFrame, rows: str, size: int) -> DataFrame:
    """(block, cell, payload) of blocks of about so many rows of a cell; ``rows`` names the column with their number."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending")])
        payload = packed(ids=table["vec_id"].to_numpy(), points=matrix(table["vector"]))
        return pa.table({"block": table["block"].slice(0, 1), "payload": pa.array([payload], pa.binary())})

    shares = F.ceil(F.col(rows) / size)
    blocks = assigned.join(counts.select("cell", rows), "cell").withColumn("block", F.col("cell") * PLACES + dealt(shares))
    blocks = blocks.select("block", "vec_id", "vector").groupBy("block").applyInArrow(pack, "block long, payload binary")
    return blocks.withColumn("cell", F.floor(F.col("block") / PLACES))


def top_k(frame: DataFrame, queries: F.Column, scale: int, k: int = 10, settings: Settings = Settings()) -> DataFrame:
    """The ``k`` rows with the highest inner products with each query.

    ``frame`` has vec_id (whole numbers) and embedding; scores are inner products of
    floor(scale * x).  ``queries`` says which rows are queries.  Returns query_id, rank
    (from 1), vec_id and score; ties go to the smaller vec_id.

    Rows with a NULL vec_id or with a NULL, NaN or infinite component take no part.  A
    shorter vector counts as filled up with zeros; a score beyond 64 bits stays at the
    limit.  Rows with the query's vec_id are not found by it; other repeated rows count
    each, and a repeated query is answered each time.  Other columns are left out; an empty
    table gives no rows.  The blocks stay in the shared folder until it is cleared.
    """
    spark, scratch = frame.sparkSession, Scratch(frame.sparkSession, "cover-search")
    rows = frame.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    rows = whole_numbers(rows.where("vec_id IS NOT NULL"), "vector", scale)
    n_rows = rows.count()
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample_rows).toArrow()
    cells = min(settings.max_cells, max(1, -(-n_rows // settings.block_rows)))
    points = matrix(sample["vector"]) if sample.num_rows else np.zeros((1, 0), np.int64)
    centres = points[farthest_first(points, cells)[0]]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, near = same_width(matrix(batch.column("vector")), centres)
            own, near = own.astype(np.float64), near.astype(np.float64)
            cell = ((near**2).sum(1) - 2 * own @ near.T).argmin(1) if batch.num_rows else np.zeros(0, np.int64)
            radius = np.sqrt(((own - near[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(radius)], names=["vec_id", "vector", "is_query", "cell", "radius"])

    assigned = scratch.write("cells", rows.mapInArrow(assign, "vec_id long, vector array<long>, is_query boolean, cell long, radius double"))
    counts = assigned.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.count_if("is_query").alias("n_queries"),
        F.max("radius").alias("radius"),
        F.max(F.when(F.col("is_query"), F.col("radius"))).alias("query_radius"),
        F.min("vec_id").alias("least"),
    )
    counts = scratch.write("counts", counts)
    data = scratch.write("data", _blocks(assigned, counts, "n", settings.block_rows))
    groups = scratch.write("queries", _blocks(assigned.where("is_query"), counts, "n_queries", settings.query_rows))
    scratch.drop("cells")

    def run(row: dict, others: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held = unpacked(row["payload"])
        tree = Tree(held["ids"], held["points"], settings.leaf_rows)
        for other in others:
            block = unpacked(other["payload"])
            asked = Tree(block["ids"], block["points"], settings.leaf_rows)
            floor = None
            if other["extra"] is not None:
                given = unpacked(other["extra"])
                floor = np.full(len(asked.ids), LOWEST, np.int64), np.full(len(asked.ids), HIGHEST, np.int64)
                floor[0][given["place"]], floor[1][given["place"]] = given["score"], given["vec_id"]
            best = Best(len(asked.ids), k, floor)
            search(asked, tree, best)
            yield _entries(other["block"], asked, best)

    none = F.lit(None).cast("binary").alias("extra")
    held = data.select(F.col("block").alias("key"), "block", "payload", none)
    n_blocks, n_groups = data.count(), groups.count()
    home = F.col("cell") * PLACES + F.pmod(F.col("block"), F.ceil(F.col("n") / settings.block_rows))
    own = groups.join(counts.select("cell", "n"), "cell").withColumn("key", home)
    # a hash may leave a block of the cell empty: the group then meets the first there is
    first = data.groupBy("cell").agg(F.min("block").alias("first"))
    own = own.join(data.select(F.col("block").alias("there")), F.col("key") == F.col("there"), "left").join(first, "cell")
    own = own.withColumn("key", F.when(F.col("there").isNull(), F.col("first")).otherwise(F.col("key"))).select("key", "block", "payload", none)
    own = scratch.write("home", own)
    found = scratch.write("found", meet(held, own, 1, min(settings.tasks, max(1, n_blocks)), run, FOUND))

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    kth = kth.select(F.floor(F.col("query") / PLACES).alias("block"), (F.col("query") % PLACES).alias("place"), "score", "vec_id")

    def thresholds(table: pa.Table) -> pa.Table:
        return pa.table({"block": table["block"].slice(0, 1), "extra": pa.array([packed(**{x: table[x].to_numpy() for x in ("place", "score", "vec_id")})], pa.binary())})

    extra = scratch.write("thresholds", kth.groupBy("block").applyInArrow(thresholds, "block long, extra binary"))
    lowest = kth.groupBy(F.floor(F.col("block") / PLACES).alias("cell")).agg(F.min("score").alias("score"), F.count("*").alias("settled"))
    pairs = _cell_pairs(spark, counts.join(lowest, "cell", "left"), centres)
    pairs = pairs.join(groups.select(F.col("cell").alias("query_cell"), "block"), "query_cell")
    pairs = pairs.join(data.select(F.col("cell").alias("data_cell"), F.col("block").alias("key")), "data_cell")
    pairs = pairs.join(own.select("key", "block"), ["key", "block"], "left_anti").select("key", "block")
    passing = pairs.join(groups.select("block", "payload"), "block").join(extra, "block", "left").select("key", "block", "payload", "extra")
    stripes = max(1, -(-n_groups // settings.groups_per_task))
    more = meet(held, passing, stripes, min(settings.tasks, max(1, n_blocks * stripes)), run, FOUND)
    ranked = found.unionByName(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _cell_pairs(spark: SparkSession, cells: DataFrame, centres: np.ndarray) -> DataFrame:
    """Pairs (query_cell, data_cell) that the covering radii of the cells leave; at most max_cells squared."""
    known = cells.toPandas()
    asked = known[known["n_queries"] > 0]
    at, to = asked["cell"].to_numpy(np.int64), known["cell"].to_numpy(np.int64)
    size, near = norms(centres), centres.astype(np.float64)
    radii = asked["query_radius"].to_numpy(np.float64), known["radius"].to_numpy(np.float64)
    bounds = _bounds(near[at] @ near[to].T, radii, (size[at], size[to]))
    settled = asked["settled"].fillna(0).to_numpy() == asked["n_queries"].to_numpy()
    # scores beyond what doubles hold exactly are lowered a little, so nothing is lost
    score = np.where(settled, asked["score"].fillna(0).to_numpy(np.float64), -np.inf)
    query, row = np.nonzero(bounds >= (score - np.abs(score) * 1e-12 if len(score) else score)[:, None])
    return spark.createDataFrame(pa.table({"query_cell": pa.array(at[query], pa.int64()), "data_cell": pa.array(to[row], pa.int64())}))


def op13_search_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows most like every hundredth vector."""
    return top_k(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0, 1024)


OP13_SQL = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 10
"""
