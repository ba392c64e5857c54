import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import periodic_runs as op

EMPTY = hashlib.sha256(b"").hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    """Every maximal stretch of every period, then of equal stretches the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    runs = sorted((s, q, n) for (s, n), q in best.items())
    gone = {x for s, q, n in runs for x in range(s + q, s + n)}
    return [(s, n, q) for s, q, n in runs], " ".join(str(w) for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words, h = words_of(text), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def answer(doc_id, text):
    runs, collapsed = brute(planted(doc_id, text))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def found(frame):
    return {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in frame.collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=5))
def test_runs_equal_all_periods_tried_in_turn(texts):
    import numpy as np

    words = np.array([w for t in texts for w in t], np.int32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    at, wanted = 0, []
    for t in texts:
        wanted += [(s + at, n, q) for s, n, q in brute(t)[0]]
        at += len(t)
    assert [tuple(map(int, r)) for r in op.runs_of(words, owner, op.Settings())] == wanted


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=9), st.integers(1, 12)), max_size=6))
def test_nested_and_neighbouring_repeats(parts):
    import numpy as np

    words = [w for unit, times in parts for w in unit * times]
    got = op.runs_of(np.array(words, np.int32), np.zeros(len(words), np.int64), op.Settings())
    assert [tuple(map(int, r)) for r in got] == brute(words)[0]


def test_edge_cases(docs):
    rows = found(op.find_runs(docs((1, None), (2, ""), (3, " \n\t "), (4, " a" * 6), (5, "a b " * 4 + "c"), (6, "a " * 5), (None, "x " * 7), (8, "           "))))
    assert rows[1] == rows[2] == rows[3] == ([], "")
    assert rows[4] == ([(0, 6, 1)], "a")
    assert rows[5] == ([(0, 8, 2)], "a b c")
    assert rows[6] == ([], "a a a a a")
    assert rows[None] == ([(0, 7, 1)], "x")
    assert rows[8] == ([(0, 6, 1)], " ")


def test_runs_do_not_cross_texts_and_rows_repeat(docs):
    frame = docs((1, "a a a"), (2, "a a a"), (3, "a b " * 5), (3, "a b " * 5)).coalesce(1)
    rows = op.find_runs(frame).collect()
    assert sorted((r.doc_id, len(r.runs)) for r in rows) == [(1, 0), (2, 0), (3, 1), (3, 1)]


def test_empty_table_and_other_ids(spark, docs):
    assert op.find_runs(docs((1, "x")).where("false")).collect() == []
    named = spark.createDataFrame([("u", "k " * 9)], "doc_id string, text string")
    assert found(op.find_runs(named)) == {"u": ([(0, 9, 1)], "k")}
    with pytest.raises(ValueError):
        op.find_runs(named, op.Settings(min_periods=2))


def test_long_texts_and_small_pieces(docs):
    text = "one two three " * 100_000
    rows = found(op.find_runs(docs((1, text), (2, "w" * 1_000_000), (3, " ".join(map(str, range(200_000))))), op.Settings(piece_bytes=10)))
    assert rows[1] == ([(0, 300_000, 3)], "one two three")
    assert rows[2][0] == rows[3][0] == []


def test_query_equals_brute_force(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    short = docs.where("length(text) < 20000 OR text IS NULL").select("doc_id", "text").collect()
    wanted = {r.doc_id: answer(r.doc_id, r.text) for r in short}
    rows = {r.doc_id: tuple(r) for r in op.op11_find_runs(spark, sample).collect()}
    assert len(rows) == docs.count()
    assert {k: rows[k] for k in wanted} == wanted
    assert any(r[1] for r in rows.values())
