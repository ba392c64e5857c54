import math
import re
import string
import zlib

import pyarrow.parquet as pq
import xxhash
import zstandard

from matchlake.llm import language as L


def test_predicts_held_out_documents(spark, sample):
    rows = {r["doc_id"]: r for r in L.op1_identify_language(spark, "/root/testdata/sf0.01").collect()}
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    assert len(rows) == len(table)
    held = [r for r in table if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {k for k, r in rows.items() if r["held_out"]}
    assert sum(rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_odd_rows(docs):
    frame = docs((1, None), (2, ""), (3, "12 $$ 34"), (4, "the cat sat there"), (4, "the cat sat there"), (None, "der hund"), (5, "the cat and the dog " * 30_000))
    dictionaries = L.learn(docs((1, "the cat and the dog sat there", "en"), (2, "der hund und die katze sind hier", "de"), (3, None, "fr"), (4, "99", "es")).select("text", "lang"))
    assert set(dictionaries) == {"en", "de"}
    rows = L.identify(frame, dictionaries).collect()
    assert len(rows) == 7 and rows[0].__fields__.count("score") == 1
    assert {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {(i, "und", True) for i in (1, 2, 3)}
    assert [r["lang_pred"] for r in rows if r["doc_id"] in (4, 5)] == ["en"] * 3
    assert [r["lang_pred"] for r in rows if r["doc_id"] is None] == ["de"]


def test_narrow_margins_reject(docs):
    same = {"a": b"one two three four five six seven", "b": b"one two three four five six seven"}
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    (row,) = L.identify(docs((1, text)), same).collect()
    assert row["rejected"] and row["score"] == 0


def test_nothing_learned_or_nothing_there(docs):
    assert L.learn(docs((1, "text")).select("text", "lang")) == {}
    (row,) = L.identify(docs((1, "text")), {}).collect()
    assert row["lang_pred"] == "und"
    assert L.identify(docs((1, "text")).limit(0), {"en": b"the cat"}).count() == 0


def test_copies_leave_the_sample_whole(docs):
    """Copies that hold nearly all rows of a language take the place of one text."""
    rows = [("alpha beta", "xx")] * 3000 + [(f"omega{chr(97 + i)} rho{chr(97 + i)}", "xx") for i in range(20)]
    few = L.Settings(sample_texts=10)
    (content,) = L.learn(docs(*((i, *r) for i, r in enumerate(rows))).select("text", "lang"), few).values()
    assert len(content.split(b"\n")) == 10


def test_few_texts_share_the_whole_dictionary(docs):
    word = lambda i: "".join(chr(97 + int(x)) for x in f"{i:06d}")
    long = " ".join(word(i) for i in range(3000))
    short = " ".join(word(i) for i in range(5000, 5100))
    learned = L.learn(docs((1, long, "xx"), (2, short, "xx"), (3, " ".join(word(i) for i in range(9000, 30000)), "yy")).select("text", "lang"))
    assert sorted(learned["xx"].split(b"\n")) == sorted([long.encode(), short.encode()])
    assert len(learned["yy"]) == L.Settings().dictionary_bytes


def distinct_words(text):
    blanks = string.punctuation + string.digits + "".join(map(chr, range(33))) + chr(127)
    plain = text.translate(str.maketrans(blanks + string.ascii_uppercase, " " * len(blanks) + string.ascii_lowercase))
    return " ".join(dict.fromkeys(x for x in plain.split(" ") if x)).encode()


def test_equals_dictionaries_and_sizes_worked_out_one_by_one(spark, sample):
    """The sample of a language is its distinct texts of the smallest hashes; the verdict compares encoded sizes."""
    settings = L.Settings(sample_texts=5, dictionary_bytes=100_000)
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text", "lang")
    table = docs.collect()
    letter = [r for r in table if r["text"] and re.search(r"[^\W\d_]", r["text"])]
    dictionaries = {}
    for lang in {r["lang"] for r in letter} - {None}:
        hashes = {xxhash.xxh64_intdigest(r["text"].encode(), 42) >> 1: r["text"] for r in letter if r["lang"] == lang}
        dictionaries[lang] = b"\n".join(distinct_words(hashes[h]) for h in sorted(hashes)[:5])
        assert len(dictionaries[lang]) < settings.dictionary_bytes
    learned = L.learn(docs.select("text", "lang"), settings)
    assert learned == dictionaries

    def size(lang, text, level):
        held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False).compress(text))

    want = {}
    for r in table:
        want[r["doc_id"]] = ("und", 0.0, True)
    for r in letter:
        text = distinct_words(r["text"])
        for level in (settings.level, settings.tie_level):
            ranked = sorted((size(lang, text, level), i, lang) for i, lang in enumerate(learned))
            (best, _, lang), (second, _, _) = ranked[:2]
            if best != second:
                break
        share = (second - best) / second
        want[r["doc_id"]] = (lang, math.sqrt(share), len(text) >= settings.evidence_bytes and share <= settings.min_margin)
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in L.identify(docs, learned, settings).collect()}
    assert got == want
