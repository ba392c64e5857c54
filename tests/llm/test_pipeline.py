"""The pipeline against its stages done by hand on a small fixture."""

import re

import corpus_pipeline
from test_jaccard_join import shingles, smallest_reachable

from matchlake.llm import language


def test_stage_by_stage(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sample}/benchmark.parquet").collect()]
    at = docs
    dictionaries = language.learn(docs.select("text", "lang"))
    judged = {r["doc_id"]: r["rejected"] for r in language.identify(docs, dictionaries).collect()}
    want = [i for i in rows if not judged[i]]
    for (name, stage), check in zip(corpus_pipeline.STAGES, ("language", "near", "leaks", "pii", "mix"), strict=True):
        after = stage(spark, at, sample)
        found = {r["doc_id"]: r for r in after.collect()}
        if check == "near":
            ids = sorted(want)
            first = smallest_reachable([shingles(rows[i]["text"]) for i in ids], ids)
            want = [i for i, j in zip(ids, first, strict=True) if i == j]
        if check == "leaks":
            plain = lambda x: " " + " ".join(re.sub(r"[\x00-\x2f:-@\[-`{-\x7f]", " ", (x or "").lower()).split()) + " "
            want = [i for i in want if not any(plain(x) in plain(rows[i]["text"]) for x in items)]
        assert sorted(found) == sorted(want), name
        if check == "pii":
            changed = [i for i in want if found[i]["text"] != rows[i]["text"]]
            assert all(re.search(r"\d|@", rows[i]["text"]) for i in changed)
            assert all(found[i]["n_chars"] == len(found[i]["text"]) for i in want)
            assert not any(re.search(r"@mail\d", r["text"]) for r in found.values())
        if check != "mix":
            assert after.columns == docs.columns, name
        at = after
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sample).collect()) == sorted(want)


def test_odd_rows(docs, spark, sample):
    text = "one two three four five six seven eight"
    frame = docs((1, text), (1, text), (2, text), (3, None), (3, None), (None, text + " nine ten"), (4, "")).drop("score")
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, sample)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, text + " nine ten"), (1, text), (3, ""), (3, ""), (4, "")]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), sample).count() == 0
