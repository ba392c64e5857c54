import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import cover_search as op
from matchlake.llm.vectors import Best

COLUMNS = "vec_id long, embedding array<float>, score string, rank string"
SMALL = op.Settings(sample_rows=40, max_cells=5, block_rows=12, query_rows=3, leaf_rows=3, groups_per_task=2)


def brute(rows, asked, scale, k):
    good = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if asked(q):
            scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i) for i, w in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def searched(spark, rows, asked, scale, k=4, settings=SMALL):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS).coalesce(3)
    return sorted(tuple(r) for r in op.top_k(frame, asked, scale, k, settings).collect())


def clustered(draw, n, groups=6, width=5):
    middles = draw.normal(0, 3, (groups, width))
    return (middles[draw.integers(0, groups, n)] + draw.normal(0, 0.1, (n, width))).astype(np.float32)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_in_many_blocks(spark, seed):
    vectors = clustered(np.random.default_rng(seed), 130)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    assert searched(spark, rows, F.col("vec_id") % 5 == 0, 16) == brute(rows, lambda i: i % 5 == 0, 16, 4)


def test_copies_ties_and_short_results(spark):
    rows = [(i, [1.0, 0.5]) for i in range(60)] + [(i, [0.0, 0.0]) for i in range(60, 80)] + [(i, [-1.0, 2.0]) for i in range(80, 90)]
    assert searched(spark, rows, F.col("vec_id") % 7 == 0, 10) == brute(rows, lambda i: i % 7 == 0, 10, 4)
    few = [(1, [1.0]), (2, [2.0]), (3, [0.5])]
    assert searched(spark, few, F.col("vec_id") > 0, 10) == brute(few, lambda i: True, 10, 4)


def test_rows_that_take_no_part_and_ragged_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, None), (2, [None, 1.0]), (3, [nan]), (4, [-inf, 1.0]), (None, [5.0]), (5, [2.0]), (6, []), (7, [0.5, 0.25, 9.0])]
    got = searched(spark, rows, F.col("vec_id").isin(0, 7), 8)
    assert got == brute(rows, lambda i: i in (0, 7), 8, 4) and {r[2] for r in got} == {0, 5, 6, 7}


def test_empty_tables_and_repeated_queries(spark):
    assert searched(spark, [], F.col("vec_id") == 0, 10) == []
    assert searched(spark, [(1, [1.0])], F.col("vec_id") == 0, 10) == []
    assert searched(spark, [(0, [1.0])], F.col("vec_id") == 0, 10) == []
    assert searched(spark, [(0, [1.0]), (0, [1.0]), (1, [1.0])], F.col("vec_id") == 0, 10) == [(0, 1, 1, 100)] * 2


def test_trees_cover_their_rows():
    points = clustered(np.random.default_rng(3), 300).astype(np.int64)
    tree = op.Tree(np.arange(300), points, 4)
    for number, radius in enumerate(tree.radii):
        parents, members, _, least = tree.level(number)
        distance = np.sqrt(((tree.points - tree.centres[members]) ** 2).sum(1))
        assert (distance <= radius[members]).all() and (tree.ids >= least[members]).all()
        if number:
            assert (tree.members[number - 1] == parents[members]).all()
            assert (parents[: len(tree.radii[number - 1])] == np.arange(len(tree.radii[number - 1]))).all()


def test_most_pairs_of_far_clusters_are_pruned():
    draw = np.random.default_rng(4)
    points = (clustered(draw, 2000, 40, 6) * 100).astype(np.int64)
    data, queries = op.Tree(np.arange(2000), points, 16), op.Tree(np.arange(2000, 2020), points[:20], 1)
    best = Best(20, 10)
    assert op.search(queries, data, best, 4) < 2000 * 20 / 3
    exact = np.sort(queries.points @ data.points.T, axis=1)[:, -10:][:, ::-1]
    assert (best.scores == exact).all()


def test_query_equals_brute_force(spark, sample):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sample}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op.op13_search_vectors(spark, sample).collect())
    assert got == brute(rows, lambda i: i % 100 == 0, 1024, 10)
