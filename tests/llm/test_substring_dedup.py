import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest

from matchlake.llm import chunks as C
from matchlake.llm.substring_dedup import Settings, remove_repeats


def brute(texts, window):
    words = [(x or "").encode().split() for x in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window", [5, 8, 35])
def test_equals_brute_force(docs, window):
    """Few words and shared passages at all offsets, in many small chunks."""
    draw = random.Random(window)
    passages = [" ".join(draw.choices("abcdefgh", k=draw.randint(window - 2, 3 * window))) for _ in range(6)]
    texts = [" ".join(draw.choice([draw.choice(passages), " ".join(draw.choices("ijklmnopqrstuvwxyz", k=draw.randint(1, window)))]) for _ in range(6)) for _ in range(40)]
    texts += [None, "", "a", "a b " * (2 * window), texts[0], texts[0], "x y " * window]
    settings = Settings(window=window, layout=C.Layout(chunk_bytes=2000, bucket_keys=50, min_buckets=7))
    rows = remove_repeats(docs(*enumerate(texts)), settings, with_text=True).orderBy("doc_id").collect()
    assert [tuple(r)[1:4] for r in rows] == brute(texts, window)
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in rows)


def test_empty_table_and_null_ids(docs):
    assert remove_repeats(docs((1, "a")).limit(0)).count() == 0
    text = " ".join(map(str, range(40)))
    rows = remove_repeats(docs((None, text), (None, text), (1, "a b"))).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 40, 40]


def test_scratch_holds_only_the_result(docs, spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(base.glob("matchlake/repeats-*"))
    remove_repeats(docs((1, "a b c"))).count()
    (new,) = set(base.glob("matchlake/repeats-*")) - before
    assert [x.name for x in new.iterdir() if not x.name.startswith(".")] == ["result"]
