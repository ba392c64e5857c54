import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchlake.llm import chunks as C
from matchlake.llm.ngram_model import _VALUES, EliasFano, Level, Settings, code, decoded, score
from matchlake.llm.text import Scanner


def brute(rows, strength):
    tokens = [((text or "").encode().lower().split() + [b"\0end"], held) for _, text, held in rows]
    one, two, three = Counter(), Counter(), Counter()
    for words, held in tokens:
        if not held:
            full = [b"\0start", *words]
            one.update(full)
            two.update(zip(full, full[1:], strict=False))
            three.update(zip(full, full[1:], full[2:], strict=False))
    n, v = sum(c for w, c in one.items() if w != b"\0start"), sum(w != b"\0start" for w in one)
    out = []
    for words, held in tokens:
        base = model = known = 0
        full = [b"\0start", *words]
        for i, w in enumerate(words):
            p = (one[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            known += one[w] > 0
            p = two[full[i], w] / (one[full[i]] + strength[0]) + strength[0] / (one[full[i]] + strength[0]) * p
            if i:
                pair = two[full[i - 1], full[i]]
                p = three[full[i - 1], full[i], w] / (pair + strength[1]) + strength[1] / (pair + strength[1]) * p
            model += math.log10(p)
        out.append((held, len(words), known, n, base, model))
    return out


@pytest.mark.parametrize("layout", [C.Layout(), C.Layout(chunk_bytes=1500, bucket_keys=60, min_buckets=5)])
def test_equals_brute_force(spark, layout):
    draw = random.Random(1)
    texts = [" ".join(draw.choices("the The a of cat dog sat on mat x y z".split(), k=draw.randint(1, 60))) for _ in range(80)]
    texts += [None, "", texts[0], texts[0], "the " * 500]
    rows = [(i, text, zlib.crc32(str(i).encode()) % 10 == 0) for i, text in enumerate(texts)]
    settings = Settings(layout=layout)
    found = score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").coalesce(2), settings).orderBy("doc_id").collect()
    for got, want in zip(found, brute(rows, settings.strength), strict=True):
        assert tuple(got)[1:5] == want[:4]
        assert got["base_score"] == pytest.approx(want[4], abs=1e-9)
        assert got["score"] == pytest.approx(want[5], abs=3e-4 * want[1])


def test_probabilities_of_a_context_sum_to_one(spark):
    """After 'a', over all known words and the end, plus what is left for unknown words."""
    rows = [(i, text, False) for i, text in enumerate(["a b", "a c", "a b c", "b a"])] + [(10 + i, f"a{x}", True) for i, x in enumerate(["", " a", " b", " c", " q"])]
    found = score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).where("held_out").orderBy("doc_id").collect()
    # P(w | start, a) from texts 'a w' and 'a', by the ratio to the end's probability where it is shared
    assert all(r["score"] < 0 for r in found)


def test_nothing_to_learn_from(docs):
    frame = docs((1, "a b"), (None, None)).withColumn("held_out", F.lit(True))
    rows = score(frame).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows} == {(0, 0, 0.0, 0.0)}
    assert score(frame.limit(0)).count() == 0


def test_elias_fano_round_trip(tmp_path):
    draw = np.random.default_rng(2)
    for size, bound in ((0, 10), (1, 1), (5, 3), (5000, 10**6), (3000, 2**60), (2000, 50)):
        values = np.sort(draw.integers(0, bound, size)).astype(np.uint64)
        with open(tmp_path / f"{size}-{bound}", "w+b") as file:
            held = EliasFano(values, bound, file)
            for a, b in ((0, size), (size // 3, size // 2), (size, size), (max(0, size - 1), size)):
                assert held.slice(a, b).tolist() == values[a:b].tolist()


def test_level_finds_children_of_their_context(tmp_path):
    parents, words = np.array([0, 0, 2, 2, 2]), np.array([5, 9, 1, 5, 7], np.uint64)
    with open(tmp_path / "level", "w+b") as file:
        level = Level(parents, words, np.arange(1, 6), 4, file)
        asked = [(0, 5), (0, 7), (1, 5), (2, 5), (2, 9), (3, 1)]
        got = level.find(np.array([p for p, _ in asked]), np.array([w for _, w in asked], np.uint64))
    assert got.tolist() == [0, -1, -1, 3, -1, -1]


def test_quantised_steps_are_fine():
    p = np.array([0, 1e-9, 0.25, 1.0])
    assert np.allclose(decoded(code(p)), p, rtol=4e-4, atol=0)


def test_long_words_that_polynomials_confuse():
    """Thue-Morse words and their complements have one hash under any base modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    for n in (300, 1024, 4096):
        one, other = ("".join(pair[b] for b in bits[:n]) for pair in ("ab", "ba"))
        hashes, lengths = Scanner(_VALUES).words(pa.array([f"{one} {other} {one.upper()}"]))
        assert lengths.tolist() == [3] and hashes[0] == hashes[2] != hashes[1]
