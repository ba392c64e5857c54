import re
from collections import Counter
from math import comb

import pyarrow.parquet as pq
import pytest

from matchlake.llm.quality_rules import RULES, Rule, Settings, binomial_cdf, filter_quality, op8_quality_rules


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.02), (7, 300, 0.05), (40, 50, 0.5), (5, 5, 0.3), (0, 5000, 0.005)):
        assert binomial_cdf(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_counts_equal_brute_force(spark, sample):
    rows = {r["doc_id"]: r for r in op8_quality_rules(spark, sample).collect()}
    for row in pq.read_table(f"{sample}/documents.parquet").to_pylist():
        text = row["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeated = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        got = rows[row["doc_id"]]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == want
        assert got["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (got["kept"] and got["base_failed"])


def prose(i, symbols=0):
    return " ".join(f"w{i}x{j}" + "$" * symbols for j in range(12))


def test_cutoffs_keep_the_good(spark, docs):
    """Symbols mark bad texts; enough labels in one stratum, too few in the other."""
    rows = [(i, prose(i), "en") for i in range(1000)] + [(1000 + i, prose(i, 4), "en") for i in range(100)] + [(2000, prose(1, 4), "de"), (2001, prose(2), None), (2002, None, "en")]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i in range(1100)] + [(5, 1), (6, 0), (None, 1), (7, None), (9999, 1)], "doc_id long, quality int")
    settings = Settings(alpha=0.02, rules=(RULES[0],))
    found = {r["doc_id"]: r for r in filter_quality(docs(*rows).withColumnRenamed("lang", "stratum"), labels, settings).collect()}
    assert all(found[i]["kept"] for i in range(1000)) and found[2000]["kept"] and found[2001]["kept"]
    assert not any(found[1000 + i]["kept"] for i in range(100)) and found[1000]["rejected_by"] == ["symbols"]
    assert found[2002]["base_failed"] and not found[2002]["kept"]


def test_cutoffs_stop_at_the_first_failure(spark, docs):
    """A cutoff that would reject 5 % of the good texts is not taken, nor any stricter one."""
    rows = [(i, prose(i, 1 if i % 20 == 0 else 0), "en") for i in range(2000)]
    labels = spark.createDataFrame([(i, 1) for i in range(2000)], "doc_id long, quality int")
    rule = Rule("symbols", "n_symbols / word_chars", (0.5, 0.1, 0.01))
    found = filter_quality(docs(*rows).withColumnRenamed("lang", "stratum"), labels, Settings(rules=(rule,)))
    assert found.where("NOT kept").count() == 0


def test_no_labels_no_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    frame = docs((1, prose(1, 9), "en")).withColumnRenamed("lang", "stratum")
    assert [r["kept"] for r in filter_quality(frame, labels).collect()] == [True]
    assert filter_quality(frame.limit(0), labels).count() == 0
