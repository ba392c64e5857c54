import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from matchlake.llm.decontamination import _VALUES, Scanner, Settings, _masks, common_subsequence, drop_contaminated, find_contamination, op6_decontaminate

ITEM = "A zebra quietly painted seventeen crooked fences beside the frozen harbour while nobody watched the lighthouse burn"


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "Quantum turnips rarely sing before Thursday unless the copper moon agrees twice"), (4, "Quantum turnips rarely sing before Thursday unless the copper moon agrees twice")], "item_id long, text string")


def filler(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(3, 7))) for _ in range(n))


def test_copies_and_paraphrases(docs, benchmark):
    words = ITEM.split()
    changed = " ".join("something" if i in (1, 5, 9, 13) else w for i, w in enumerate(words))
    no_answer = " ".join("something" if i in (1, 5, 9, 16) else w for i, w in enumerate(words))
    texts = [filler(200, 1), filler(150, 2) + " " + ITEM.upper() + "!! " + filler(90, 3), ITEM, filler(40, 4) + " " + changed + " " + filler(40, 5), filler(40, 6) + " " + no_answer, None, "", "the harbour lighthouse"]
    found = find_contamination(docs(*enumerate(texts)), benchmark)
    rows = sorted((r["doc_id"], r["item_id"], r["verdict"]) for r in found.collect())
    assert rows == [(1, 1, "copy"), (2, 1, "copy"), (3, 1, "paraphrase")]
    clean = drop_contaminated(docs(*enumerate(texts)), benchmark)
    assert clean.columns == docs((1, "")).columns and sorted(r["doc_id"] for r in clean.collect()) == [0, 4, 5, 6, 7]


def test_blocks_of_items_give_the_same(docs, benchmark):
    texts = [ITEM + " " + filler(30, 1), "x Quantum turnips rarely sing before Thursday unless the copper moon agrees twice", filler(50, 2)]
    small = Settings(block_bytes=60)
    pairs = [sorted((r["doc_id"], r["item_id"]) for r in find_contamination(docs(*enumerate(texts)), benchmark, s).collect()) for s in (Settings(), small)]
    assert pairs[0] == pairs[1] == [(0, 1), (1, 4), (1, 4)]
    assert [r["doc_id"] for r in drop_contaminated(docs(*enumerate(texts)), benchmark, small).collect()] == [2]


def test_empty_tables(docs, benchmark):
    assert find_contamination(docs((1, ITEM)), benchmark.limit(0)).count() == 0
    assert find_contamination(docs((1, ITEM)).limit(0), benchmark).count() == 0
    assert drop_contaminated(docs((1, ITEM)), benchmark.where("item_id = 2")).count() == 1


def test_finds_every_planted_item(spark):
    """Recall against exact containment is 1, and nothing else is found."""
    sample = "/root/testdata/sf0.01"
    plain = lambda x: " " + " ".join(re.sub(r"[\x00-\x2f:-@\[-`{-\x7f]", " ", (x or "").lower()).split()) + " "
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sample}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{sample}/benchmark.parquet'").fetchall()
    planted = {(d, i) for d, x in texts for i, y in items if plain(y) in plain(x)}
    assert planted and {(r["doc_id"], r["item_id"]) for r in op6_decontaminate(spark, sample).collect()} == planted


def test_scanner_hashes_words_alike():
    texts = ["Ab, cd", "", "CD-ab é", None, "É", "ab", "x" * 300_000 + " ab"]
    hashes, lengths = Scanner(_VALUES, pc.utf8_lower).words(pa.array(texts, pa.string()))
    assert lengths.tolist() == [2, 0, 3, 0, 1, 1, 2]
    ab, cd, cd2, ab2, e, e2, ab3, _, ab4 = hashes.tolist()
    assert ab == ab2 == ab3 == ab4 and cd == cd2 and e == e2 and len({ab, cd, e}) == 3


def test_common_subsequence():
    def plain(a, b):
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        return best[-1, -1]

    draw = random.Random(9)
    for _ in range(50):
        a, b = ([draw.randrange(6) for _ in range(draw.randint(1, 80))] for _ in range(2))
        assert common_subsequence(_masks(np.array(a)), len(a), b) == plain(a, b)


def test_passages_of_longer_items_are_copies(docs, spark):
    items = [filler(200, 21), filler(60, 22), filler(40, 23)]
    words = [x.split() for x in items]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    around = lambda part, seed: f"{filler(70, seed)} {' '.join(part)} {filler(50, seed + 1)}"
    texts = [around(words[0][37:137], 31), around(words[0][150:], 33), around(words[1][:45], 35), around(words[1][13:58], 37), around(words[0][60:72], 39), around(words[1][20:35], 41), around(words[2], 43)]
    rows = sorted((r["doc_id"], r["item_id"], r["verdict"]) for r in find_contamination(docs(*enumerate(texts)), bench).collect())
    assert rows == [(0, 0, "copy"), (1, 0, "copy"), (2, 1, "copy"), (3, 1, "copy"), (6, 2, "copy")]
    assert sorted(r["doc_id"] for r in drop_contaminated(docs(*enumerate(texts)), bench).collect()) == [4, 5]


def test_ids_of_any_type(docs, benchmark):
    named = benchmark.withColumn("item_id", F.concat(F.lit("item "), "item_id"))
    texts = [f"{filler(30, 91)} {benchmark.first()['text']} {filler(30, 92)}"]
    rows = find_contamination(docs(*enumerate(texts)), named).collect()
    assert [r["item_id"] for r in rows] == [f"item {benchmark.first()['item_id']}"]


def changed(words, kind, share, draw):
    """The words, all but the last three of them replaced, left out, or put further apart by the share given."""
    at = set(draw.sample(range(len(words) - 3), round(share * len(words))))
    if kind == "replaced":
        return ["something" if i in at else w for i, w in enumerate(words)]
    if kind == "left out":
        return [w for i, w in enumerate(words) if i not in at]
    return [x for i, w in enumerate(words) for x in (["something", w] if i in at else [w])]


def recall_by_kind(spark, kinds):
    """The share of the benchmark's items found in texts that hold them changed, and the texts found without one."""
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(r["item_id"], r["text"].split()) for r in bench.orderBy("item_id").collect() if len((r["text"] or "").split()) >= 12]
    draw, rows, planted = random.Random(5), [], {}
    for kind, share in kinds:
        for item, words in items:
            planted[len(rows)] = (kind, share, item)
            rows.append((len(rows), f"{filler(60, len(rows))} {' '.join(changed(words, kind, share, draw))} {filler(60, -len(rows) - 1)}"))
    clean = [(len(rows) + i, filler(150, 10**6 + i)) for i in range(200)]
    texts = spark.createDataFrame(rows + clean, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(texts, bench).collect()}
    recall = {k: sum((d, x[2]) in found for d, x in planted.items() if x[:2] == k) / len(items) for k in kinds}
    return recall, sorted({d for d, _ in found if d not in planted})


def test_recall_of_paraphrases(spark):
    recall, false = recall_by_kind(spark, [(k, s) for k in ("replaced", "left out", "apart") for s in (0.1, 0.2, 0.3)])
    assert not false and min(recall.values()) >= 0.9
