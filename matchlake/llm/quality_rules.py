"""Quality rules whose cutoffs are controlled for false rejections.

Every text gets plain counts (``text_counts``), which fail it outright if it has too
few words or repeats itself too much.  Further rules reject a text if a ratio exceeds a
cutoff.  Cutoffs are chosen by stratum on labelled texts that the plain counts passed:
a rule's cutoffs are tried from the laxest on, each by an exact binomial test of
"more than ``alpha`` / rules of the good texts would be rejected" (the test holds exactly
when the Clopper-Pearson upper bound is below that share), and the rule takes the last
one before the first failure.

Guarantee: with probability 1 - ``delta``, in every stratum at most ``alpha`` of the good
texts are rejected by the rules.  The tests of one rule form a fixed sequence, which needs
no correction; strata and rules share delta equally (Bonferroni), and the rules of a
stratum share alpha.  A stratum with too few labels passes no test, so nothing is rejected.

Defined results: NULL and empty texts have zero counts and fail for too few words; a
text is good if all its labels with a quality are 1 (repeated labels count once), others
are not good and decide nothing; a NULL stratum is a stratum of its own; repeated rows
are judged alike; other columns, also clashing ones, are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import chunks as C
from matchlake.llm.text import Scratch, WordHashes, documents, text_bytes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose ``ratio`` (SQL over the counts) is above the cutoff; cutoffs from lax to strict."""

    name: str
    ratio: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / word_chars", (0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02)),
    Rule("repeated_lines", "n_dup_lines / n_lines", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeated_words", "n_repeat_words / n_words", (0.18, 0.15, 0.12, 0.1, 0.08, 0.06)),
    Rule("long_words", "word_chars / n_words", (30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0)),
)


@dataclass(frozen=True)
class Settings:
    """alpha: share of a stratum's good texts that rules may reject.  delta: chance that this fails anywhere."""

    alpha: float = 0.02
    delta: float = 0.05
    min_words: int = 10
    max_repeat_percent: int = 20
    rules: tuple[Rule, ...] = RULES


def text_counts(texts: list[bytes], hashes: WordHashes) -> dict[str, list[int]]:
    """The counts of each text; whole texts, words as in text.py."""
    words = C.Words(texts, hashes)
    keys = C.windows(words.hashes, 5)
    out: dict[str, list[int]] = {name: [] for name in COUNTS}
    begin = 0
    for text, own, end in zip(texts, words.lists, words.ends.tolist(), strict=True):
        lines = [x for x in text.split(b"\n") if x.strip()]
        n = end - begin
        repeated = 0
        if n > 5:
            _, places, counts = np.unique(keys[begin : end - 4], return_inverse=True, return_counts=True)
            again = np.flatnonzero(counts[places] > 1)
            if len(again):
                edges = np.zeros(n + 1, np.int32)
                np.add.at(edges, again, 1)
                np.add.at(edges, again + 5, -1)
                repeated = int(np.count_nonzero(np.cumsum(edges)))
        begin = end
        out["n_words"].append(n)
        out["word_chars"].append(len(b"".join(own).decode()))
        out["n_symbols"].append(len(text) - len(text.translate(None, _SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(repeated)
        out["n_lines"].append(len(lines))
    return out


def measure(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, stratum, the counts, and base_failed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts = text_counts(text_bytes(part.column(2)), hashes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(counts[x], pa.int64()) for x in COUNTS)], names=["doc_id", "stratum", *COUNTS])

    kinds = {x.name: x.dataType.simpleString() for x in docs.schema}
    schema = f"doc_id {kinds['doc_id']}, stratum {kinds['stratum']}, " + ", ".join(f"{x} long" for x in COUNTS)
    counted = docs.select("doc_id", "stratum", "text").mapInArrow(run, schema)
    failed = (F.col("n_words") < settings.min_words) | (100 * F.col("n_repeat_words") > settings.max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def binomial_cdf(k: float, n: float, p: float) -> float:
    """P(X <= k) of n trials, as a continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    a, b, x = k + 1.0, n - k, p
    front = math.exp(math.lgamma(n + 1) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x >= (a + 1) / (n + 3):
        return front * _fraction(b, a, 1 - x) / b
    return 1 - front * _fraction(a, b, x) / a


def _fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + step * d or 1e-300)
            c = 1 + step / c or 1e-300
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return h


def cutoffs(measured: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(stratum, rule, cutoff) of the rules that hold, from labels (doc_id, quality).

    Labels are folded to counts by stratum, rule and cutoff before the tests, so
    the tests see a few numbers for each stratum.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    held = measured.where("NOT base_failed").join(good.select("doc_id"), "doc_id")
    tests = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.lit(i).alias("step"), F.lit(cut).alias("cutoff"), F.expr(f"coalesce({rule.ratio} > {cut}D, false)").alias("over"))
            for rule in settings.rules
            for i, cut in enumerate(rule.cutoffs)
        ]
    )
    counted = held.select("stratum", F.explode(tests).alias("t")).groupBy("stratum", "t.rule", "t.step", "t.cutoff")
    counted = counted.agg(F.count("*").alias("n"), F.count_if("t.over").alias("k"))
    share, rules = settings.alpha / len(settings.rules), len(settings.rules)

    @F.pandas_udf("double")
    def chance(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_cdf(float(a), float(b), share) for a, b in zip(k, n, strict=True)])

    strata = counted.select("stratum").distinct().agg(F.count("*")).scalar()
    tested = counted.withColumn("holds", chance("k", "n") <= F.lit(settings.delta) / (strata * rules))
    by_rule = tested.groupBy("stratum", "rule").agg(F.min(F.when(~F.col("holds"), F.col("step"))).alias("failed"), F.collect_list(F.struct("step", "cutoff")).alias("steps"))
    last = F.array_max(F.filter("steps", lambda x: F.col("failed").isNull() | (x["step"] < F.col("failed"))))
    return by_rule.select("stratum", "rule", last["cutoff"].alias("cutoff")).where("cutoff IS NOT NULL")


def judge(measured: DataFrame, chosen: DataFrame, settings: Settings) -> DataFrame:
    """The measured rows with ``kept`` and ``rejected_by``, the names of the rules that reject."""
    by_stratum = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    joined = measured.join(by_stratum.withColumnRenamed("stratum", "own"), F.col("stratum").eqNullSafe(F.col("own")), "left").drop("own")
    hits = [F.expr(f"CASE WHEN {rule.ratio} > cuts['{rule.name}'] THEN '{rule.name}' END") for rule in settings.rules]
    rejected = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*hits)))
    return joined.withColumn("rejected_by", rejected).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("cuts")


def filter_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts and verdict for rows of (doc_id, stratum, text).  Texts are read once; the counts go to a scratch table."""
    measured = Scratch(docs.sparkSession, "quality").write("counts", measure(docs, settings))
    return judge(measured, cutoffs(measured, labels, settings), settings)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("stratum"), "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    out = filter_quality(docs, labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"))
