import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from matchlake.llm import chunks as C
from matchlake.llm.components import components
from matchlake.llm.jaccard_join import Settings, near_duplicates, shingle_sets, tree_join
from matchlake.llm.text import Scratch, WordHashes, count_words


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def smallest_reachable(sets, ids):
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    return [min(ids[j] for j in range(len(sets)) if find(j) == find(i)) for i in range(len(sets))]


def texts():
    draw = random.Random(3)
    out = [None, "", "one", "One", "one two", "a b c d e", "a b c d e"]
    for _ in range(8):
        base = [draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 3) for _ in range(draw.randint(30, 200))]
        for _ in range(draw.randint(1, 14)):
            copy = list(base)
            for _ in range(draw.randint(0, len(base) // 40)):
                copy[draw.randrange(len(copy))] = str(draw.random())
            out.append(" ".join(copy[draw.randint(0, 3) :]))
            if draw.random() < 0.3:
                base = copy
    return out


@pytest.mark.parametrize("unit", [6_000_000, 300])
def test_equals_brute_force(docs, unit):
    """Chains of ever more changed copies; with small units clusters are cut into blocks."""
    rows = texts()
    settings = Settings(unit_shingles=unit, layout=C.Layout(chunk_bytes=3000, bucket_keys=200, min_buckets=5))
    found = near_duplicates(docs(*enumerate(rows)), settings).orderBy("doc_id").collect()
    sets = [shingles(x) for x in rows]
    assert [r["n_shingles"] for r in found] == [len(x) for x in sets]
    assert [r["component_id"] for r in found] == smallest_reachable(sets, list(range(len(rows))))


def odd_texts():
    draw = random.Random(8)
    words = ["Ä", "ä", "A", "a", "\u2003", "x\u00a0y", "W" * 300, "w" * 300, "word", "w0rd", "\0"]
    gaps = [" ", "\n", "\t\v", " \f\r ", "  "]
    long = "".join(draw.choice(words) + draw.choice(gaps) for _ in range(90_000))
    short = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 30))) for _ in range(60)]
    return [None, "", " ", "\n one", *short, long, None, "A b C d E f", " a B c D e F "]


def test_sets_of_odd_texts(monkeypatch):
    """Straight from Arrow's buffers: no word is looked up as a Python object."""
    monkeypatch.setattr(WordHashes, "__missing__", None)
    texts, sets = odd_texts(), []
    for part in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        sets = shingle_sets(part, 5)
        assert [len(x) for x in sets] == [len(shingles(x)) for x in texts]
        assert count_words(part) == sum(len((x or "").encode().split()) for x in texts)
    for i, j in combinations(range(len(texts)), 2):
        assert len(np.intersect1d(sets[i], sets[j])) == len(shingles(texts[i]) & shingles(texts[j])) or len(texts[i] or "") + len(texts[j] or "") > 99_999
    assert all((np.diff(x.astype(object)) > 0).all() for x in sets)


def test_rows_for_buckets():
    draw = np.random.default_rng(2)
    keys, counts = np.unique(draw.integers(0, 1 << 60, 5000, np.uint64) << np.uint64(3), return_counts=True)
    dealt = C.Dealt(keys, 9)
    rows = list(dealt.rows(keys, counts.astype(np.uint32)))
    assert rows == [(bucket, C.narrow(keys[index]), C.packed(counts[index].astype(np.uint32))) for bucket, index in dealt]
    assert [C.unpacked(x[2], np.uint32).tolist() for x in rows] == [counts[index].tolist() for _, index in dealt]


def test_null_and_repeated_ids(docs):
    text = "w1 w2 w3 w4 w5 w6"
    rows = near_duplicates(docs((None, text), (None, None), (7, text), (7, text), (7, "other words"))).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in rows) == [(0, 0, 0), (0, 2, 7), (7, 1, 7), (7, 2, 7), (7, 2, 7)]
    assert near_duplicates(docs((1, "a")).limit(0)).count() == 0


def test_tree_join_links_what_is_similar():
    draw = np.random.default_rng(5)
    sets = sorted((np.sort(draw.choice(60, draw.integers(8, 20), replace=False)).astype(np.uint64) for _ in range(60)), key=lambda x: x.tolist())
    sets = [x for i, x in enumerate(sets) if i == 0 or x.tolist() != sets[i - 1].tolist()]
    percent = 40
    links = tree_join(sets, list(range(len(sets))), percent)
    as_sets = [set(x.tolist()) for x in sets]

    def parts(edges):
        label = list(range(len(sets)))
        for i, j in edges:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
        return [label.index(x) for x in label]

    true = [(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * len(as_sets[i] & as_sets[j]) >= percent * len(as_sets[i] | as_sets[j])]
    assert true and set(links) <= set(true) and parts(links) == parts(true)


def test_sets_of_a_large_cluster_do_not_meet_one_by_one(monkeypatch):
    """Copies of one set with ever more changes, and sets that share a rare shingle only: few comparisons for each set."""
    draw = np.random.default_rng(4)

    def fresh(n):
        return draw.integers(1 << 20, 1 << 60, n).astype(np.uint64)

    base = np.unique(fresh(60))
    copies = [np.unique(np.concatenate([base[draw.permutation(60)[: 60 - k % 12]], fresh(k % 12)])) for k in range(400)]
    hub = np.arange(3, dtype=np.uint64)
    pairs = [np.unique(np.concatenate([hub[: 1 + k % 3], fresh(60)])) for k in range(200)]
    pairs += [np.unique(np.concatenate([x[:-4], fresh(4)])) for x in pairs]
    for sets in (copies, pairs):
        sets = sorted(sets, key=lambda x: x.tolist())
        seen = 0

        def counted(*given, count=np.count_nonzero):
            nonlocal seen
            seen += 1
            return count(*given)

        with monkeypatch.context() as patched:
            patched.setattr(np, "count_nonzero", counted)
            links = tree_join(sets, list(range(len(sets))), 80)
        assert seen < 30 * len(sets)
        found = list(range(len(sets)))
        for i, j in links:
            a, b = found[i], found[j]
            found = [a if x == b else x for x in found]
        as_sets = [frozenset(x.tolist()) for x in sets]
        expected = smallest_reachable(as_sets, list(range(len(sets))))
        assert [found.index(x) for x in found] == expected and len(set(expected)) > 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 201), (201, 200), (5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in components(frame, Scratch(spark, "test"), "x").collect()}
    assert found == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200, 201: 200}
