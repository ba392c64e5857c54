from collections import defaultdict

import duckdb
import pytest

from matchlake.llm.mixing import OP5_SQL, Settings, mix


def seats(votes, total):
    """Highest averages, one seat at a time; ties to the first party."""
    got = dict.fromkeys(votes, 0)
    for _ in range(total):
        got[max(votes, key=lambda p: (votes[p] / (2 * got[p] + 1), -p))] += 1
    return got


@pytest.mark.parametrize("settings", [Settings(), Settings(block_words=7, shard_words=40)])
def test_shares_and_bounds(docs, settings):
    sizes = [3, 50, 0, 17, 120, 9, 64, 33, 5, 1] * 6
    frame = docs(*[(i, "w " * n if n else None, None, ["b", "a", None, "c", "z"][i % 5]) for i, n in enumerate(sizes)])
    rows = [r.asDict() for r in mix(frame, settings).collect()]
    assert sorted((r["doc_id"], r["size"]) for r in rows) == list(enumerate(sizes))
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["target"], r["source_size"]].append(r["taken"])
    assert sum(t for t, _ in by) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * n and abs(sum(x) - t) <= settings.block_words for (t, n), x in by.items())
    assert [r.asDict() for r in mix(frame, settings).collect()] == rows or sorted(map(str, rows)) == sorted(str(r.asDict()) for r in mix(frame, settings).collect())


def test_source_quotas_are_sainte_lague(docs):
    settings = Settings(block_words=10)
    sizes = {"a": 1000, "b": 900, "c": 800, "d": 50}
    rows = mix(docs(*[(i, "w " * n, None, s) for i, (s, n) in enumerate(sizes.items())]), settings).orderBy("doc_id").collect()
    votes = {i: r["target"] for i, r in enumerate(rows)}
    quota = seats(votes, int(1.5 * 2750 / 10 + 0.5))
    assert [r["taken"] for r in rows] == [min(10 * quota[i], 2 * r["size"]) for i, r in enumerate(rows)]


def test_empty_tables_and_texts(docs):
    assert mix(docs((1, "a")).limit(0)).count() == 0
    rows = mix(docs((1, None), (None, ""), (2, None, None, "s"))).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 3


def test_sql_gives_the_same(spark):
    sample = "/root/testdata/sf0.01"
    names = ["doc_id", "size", "source_size", "target", "taken"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sample}/documents.parquet'")
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({OP5_SQL})").fetchall())
    got = sorted(tuple(r[n] for n in names) for r in mix(spark.read.parquet(f"{sample}/documents.parquet")).collect())
    assert got == want
