"""Language identification by compression with one dictionary per language.

``learn`` takes a bounded sample of labelled texts per language as the raw-content
dictionary of a zstandard compressor.  ``identify`` encodes every whole text with
each dictionary; the language whose dictionary gives the fewest bytes wins, and a
narrow margin to the runner-up rejects the text.

Defined results: a NULL or empty text, or one without a letter, is ``und`` with
score 0 and rejected; sizes that are equal at both levels of the encoder go to the
language with the most labelled texts; a label without a letter in any of its texts
is not learned; rows keep all their columns, repeated rows are judged alike; without any labelled text everything is
``und``.  An input column named like a result column is replaced by it.

Texts and dictionaries are encoded as the distinct ASCII-lower-cased words in
order of first occurrence, with ASCII marks and digits as blanks: a long text's
repetitions of itself then say nothing about its language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchlake.llm.text import documents, remainder

UNDETERMINED = "und"
RESULT = ("lang_pred", "score", "margin_bytes", "rejected")


@dataclass(frozen=True)
class Settings:
    """sample_texts, dictionary_bytes: most texts, and bytes, of a language that are learned from.
    level: zstandard's level.  tie_level: the level that decides between equal sizes.
    min_margin: a text is rejected unless the runner-up needs more bytes by a larger share;
    not so texts of fewer than evidence_bytes, in which no margin can show."""

    sample_texts: int = 400
    dictionary_bytes: int = 110_000
    level: int = 6
    tie_level: int = 19
    min_margin: float = 0.005
    evidence_bytes: int = 48


#: ASCII marks, digits and control characters as blanks, capitals in lower case.
_PLAIN = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256)).lower()


def plain_words(text: bytes) -> bytes:
    return b" ".join(dict.fromkeys(text.translate(_PLAIN).split()))


def learn(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """One dictionary per language from (text, lang), the language with most texts first.

    Rows without a letter or language are left out.  The sample holds the distinct texts
    with the smallest hashes: a first pass counts labels and, nearly, distinct texts and
    so sets a hash limit for each language that lets about four samples through.  The
    sampled texts share the dictionary; what short ones leave goes to longer ones.
    """
    letter = F.col("text").rlike(r"\p{L}")
    known = labelled.where(F.col("lang").isNotNull()).select("lang", "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h"))
    totals = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(F.when(letter, F.col("h")), 0.02).alias("distinct")).collect()
    counts, distinct = {r["lang"]: r["n"] for r in totals}, {r["lang"]: r["distinct"] for r in totals}
    limit = F.lit(0.0)
    for lang, n in distinct.items():
        limit = F.when(F.col("lang") == lang, min(1.0, 4 * settings.sample_texts / max(1, n)) * 2.0**63).otherwise(limit)
    near = known.where(letter & (F.col("h") <= limit)).dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h")
    sample = near.withColumn("i", F.row_number().over(order)).where(F.col("i") <= settings.sample_texts)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [plain_words(x)[: settings.dictionary_bytes] for x in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["lang", "i", "words"])

    def shared(table: pa.Table) -> pa.Table:
        texts = [x for _, x in sorted(zip(table["i"].to_pylist(), table["words"].to_pylist(), strict=True))]
        room = _level([len(x) + 1 for x in texts], settings.dictionary_bytes + 1) - 1
        content = b"\n".join(x[:room] for x in texts)[: settings.dictionary_bytes]
        return pa.table({"lang": table["lang"].slice(0, 1), "content": pa.array([content], pa.binary())})

    packed = sample.select("lang", "i", "text").mapInArrow(words, "lang string, i int, words binary").groupBy("lang").applyInArrow(shared, "lang string, content binary")
    found = {r["lang"]: bytes(r["content"]) for r in packed.collect()}
    return {lang: found[lang] for lang in sorted(found, key=lambda x: (-counts[x], x))}


def _level(lengths: list[int], room: int) -> int:
    """The most that each may have of the room, so that those shorter leave theirs to the others."""
    for i, length in enumerate(sorted(lengths)):
        if length * (len(lengths) - i) > room:
            return room // (len(lengths) - i)
        room -= length
    return max(lengths)


class _Coder:
    """Encoded sizes by language, in the order of the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes], level: int) -> None:
        self.coders = []
        for content in dictionaries.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False))

    def sizes(self, text: bytes) -> list[int]:
        return [len(x.compress(text)) for x in self.coders]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings()) -> DataFrame:
    """All rows with ``lang_pred, score, margin_bytes, rejected``; only the text is looked at.

    ``score`` is the square root of the margin's share of the runner-up's size.
    """
    kept = docs.drop(*RESULT)
    result = T.StructType().add("lang_pred", "string").add("score", "double").add("margin_bytes", "long").add("rejected", "boolean")
    names = list(dictionaries)

    def judge(text: bytes, coder: _Coder, finer: _Coder) -> tuple[str, float, int, bool]:
        words = plain_words(text)
        sizes = coder.sizes(words)
        if len(sizes) == 1:
            return names[0], 1.0, sizes[0], False
        best, second = sorted(sizes)[:2]
        if best == second:
            sizes = finer.sizes(words)
            best, second = sorted(sizes)[:2]
        share = (second - best) / second
        return names[sizes.index(best)], math.sqrt(share), second - best, len(words) >= settings.evidence_bytes and share <= settings.min_margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, finer = _Coder(dictionaries, settings.level), _Coder(dictionaries, settings.tie_level)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            letters = pc.match_substring_regex(texts, r"\p{L}").to_pylist()
            rows = [
                judge(text, coder, finer) if letter and names else (UNDETERMINED, 0.0, 0, True)
                for text, letter in zip(texts.cast(pa.binary()).to_pylist(), letters, strict=True)
            ]
            columns = [pa.array([x[i] for x in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *RESULT])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *result.fields]))


def op1_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    dictionaries = learn(docs.where(~held_out).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
