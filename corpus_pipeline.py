"""From raw documents to a mix of training text, in five stages.

Each stage gets all that the one before kept, as a Parquet dataset.  The first four
return rows with the columns of ``documents``; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import decontamination, jaccard_join, language, mixing, pseudonyms
from matchlake.llm.text import Scratch, documents

#: No SQL expresses compression sizes, the retrieval or the permutations; the tests hold a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told; fills in languages that are missing."""
    found = language.identify(docs, language.learn(docs.select("text", "lang")))
    kept = found.where(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component; a repeated row stays once.

    A document is its id and text, so rows that share an id but not their text are not
    mixed up.  Documents without a word link with nothing and all stay.
    """
    key = F.struct("doc_id", F.md5("text").alias("digest"))
    found = jaccard_join.near_duplicates(docs.select(key.alias("doc_id"), "text"))
    found = found.select("doc_id.doc_id", "doc_id.digest", (F.col("doc_id") == F.col("component_id")).alias("first"), "n_shingles")
    marked = docs.withColumn("own_digest", F.md5("text"))
    losers = found.where("NOT first").select(F.col("doc_id").alias("lost"), F.col("digest").alias("lost_digest")).dropDuplicates()
    kept = marked.join(losers, marked["doc_id"].eqNullSafe(losers["lost"]) & (marked["own_digest"] == losers["lost_digest"]), "left_anti")
    repeated = found.where("first AND n_shingles > 0").groupBy("doc_id", "digest").count().where("count > 1")
    if repeated.head(1):
        has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        kept = kept.where(has_words).dropDuplicates(["doc_id", "own_digest"]).unionByName(kept.where(~has_words))
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; n_chars follows the text."""
    out = pseudonyms.pseudonymise(docs, pseudonyms.QUERY_SETTINGS, counts=False)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(name, stage(spark, docs, sf_dir))
        if number:
            scratch.drop(STAGES[number - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
