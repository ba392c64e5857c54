import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import hard_negatives as op
from matchlake.llm import vectors

COLUMNS = "vec_id long, embedding array<float>, label int, score string, block string"
SMALL = op.Settings(anchor_rows=3, block_rows=7, blocks_per_task=2)


def brute(rows, anchors, scale, k=5):
    good = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in good:
        if not anchors(a):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, lab) for i, lab, w in good if i != a]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:k]:
            below = sorted((s, i) for s, i, lab in scored if lab != label and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(below[:k])]
    return sorted(out)


def mined(spark, rows, anchors, scale, settings=SMALL):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS).coalesce(3)
    return sorted(tuple(r) for r in op.mine(frame, anchors, scale, settings).collect())


def test_equals_brute_force_in_many_blocks(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(0.3, 1, 4).astype(np.float32)], int(draw.integers(0, 3))) for i in range(90)]
    got = mined(spark, rows, F.col("vec_id") % 6 == 0, 8)
    assert got == brute(rows, lambda i: i % 6 == 0, 8) and len(got) > 50


def test_ties_copies_and_negative_scores(spark):
    rows = [(i, [1.0, 0.0], i % 2) for i in range(40)] + [(i, [-1.0, 0.5], i % 3) for i in range(40, 60)] + [(i, [0.0, 0.0], i % 2) for i in range(60, 70)]
    assert mined(spark, rows, F.col("vec_id") % 5 == 0, 10) == brute(rows, lambda i: i % 5 == 0, 10)


def test_rows_that_take_no_part_and_ragged_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 0.75], 1), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [1.0, inf], 1)]
    rows += [(None, [1.0, 1.0], 1), (7, [1.0, 1.0], None), (8, [2.0], 1), (9, [], 1)]
    got = mined(spark, rows, F.col("vec_id") == 0, 10)
    assert got == brute(rows, lambda i: i == 0, 10)
    assert {r[3] for r in got} == {2, 8}


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, [], F.col("vec_id") == 0, 10) == []
    assert mined(spark, [(1, [1.0], 0)], F.col("vec_id") == 0, 10) == []
    assert mined(spark, [(0, [1.0], 0)], F.col("vec_id") == 0, 10) == []


def test_repeated_anchor_is_answered_each_time(spark):
    rows = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 0), (2, [0.875], 1)]
    assert mined(spark, rows, F.col("vec_id") == 0, 10) == [(0, 1, 1, 2, 100, 80)] * 2


def test_products_are_exact_whatever_the_size():
    draw = np.random.default_rng(1)
    for top in (100, 1 << 20, 1 << 40):
        a, b = draw.integers(-top, top, (5, 9)), draw.integers(-top, top, (7, 9))
        exact = [[max(min(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), vectors.HIGHEST), vectors.LOWEST + 1) for s in b] for r in a]
        assert vectors.products(a, b).tolist() == exact


@pytest.mark.parametrize("k", [1, 3])
def test_best_keeps_what_sorting_keeps(k):
    draw = np.random.default_rng(k)
    best, seen = vectors.Best(4, k), []
    for _ in range(20):
        group, scores = draw.integers(0, 4, 30), draw.integers(-3, 3, 30)
        ids = draw.permutation(1000)[:30] + 1000 * len(seen)
        best.offer(group, scores, ids)
        seen += zip(group.tolist(), (-scores).tolist(), ids.tolist(), strict=True)
    wanted = sorted(x for g in range(4) for x in sorted(y for y in seen if y[0] == g)[:k])
    assert sorted((int(g), -int(s), int(i)) for g, s, i in zip(*best.entries(), strict=True)) == wanted


def test_query_equals_brute_force(spark, sample):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sample}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op.op12_mine_negatives(spark, sample).collect())
    assert got == brute(rows, lambda i: i % 100 == 0, 256) and got
