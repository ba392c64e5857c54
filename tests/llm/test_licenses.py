import math

import pytest
import regex

from matchlake.llm.licenses import NONE, NOTICES, UNKNOWN, scan_licences, train

END = (".", "!", "?", ":", ";")
MARK = regex.compile(r"[ \t]*([#*/;%>-]+[ \t]+)?")


@pytest.fixture(scope="module")
def classifier(spark):
    return train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_families(docs, classifier):
    texts = [
        "Some prose.\nReleased under the MIT License.",
        "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.!!\nx\nLicensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "x\nAll rights reserved.",
        "word " * 200 + ". Redistribution and use in source and binary forms, with or without modification, are permitted. " + "word " * 200,
        "plain prose without any such word",
        "This thing comes under the Foo Bar Community License, edition nine.",
        None,
        "",
    ]
    rows = scan_licences(docs(*enumerate(texts)), classifier).orderBy("doc_id").collect()
    assert [r["licences"] for r in rows] == [["mit"], ["apache", "cc-by-nc"], ["gpl"], ["reserved"], ["bsd"], [], [], [], []]
    assert [r["licence"] for r in rows][5:] == [NONE, UNKNOWN, NONE, NONE]
    assert all(r["probability"] > 0.5 for r in rows[:5]) and rows[5]["probability"] == 0


def test_finds_the_notices_of_the_corpus(spark, classifier):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {"mit": "mit license", "apache": "apache license", "gpl": "gnu general public", "cc-by-nc": "cc by-nc", "reserved": "all rights reserved"}
    want = {r["doc_id"]: sorted(k for k, x in marks.items() if x in (r["text"] or "").lower()) for r in docs.collect()}
    assert {r["doc_id"]: list(r["licences"]) for r in scan_licences(docs, classifier).collect()} == want


def test_short_forms(docs, classifier):
    texts = {
        "Distributed under GPLv3.": "gpl",
        "This file is released under LGPLv2.1 or later": "lgpl",
        "Released under AGPLv3+": "agpl",
        "Apache-2.0": "apache",
        "under the MPL 2.0": "mpl",
        "She studied law at MIT for 3 years.": NONE,
        "The council gave the church permission to use the hall.": NONE,
        "Licensed under the European Union Public Licence version 1.2": UNKNOWN,
    }
    rows = scan_licences(docs(*enumerate(texts)), classifier).orderBy("doc_id").collect()
    assert [r["licence"] for r in rows] == list(texts.values())


def test_wrapped_notices(docs, classifier):
    texts = [
        "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public\n# License as published by the Free Software Foundation",
        " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0",
    ]
    rows = scan_licences(docs(*enumerate(texts)), classifier).orderBy("doc_id").collect()
    assert [r["licences"] for r in rows] == [["agpl"], ["lgpl"], ["apache", "mit"]] and [r["n_candidates"] for r in rows] == [1, 1, 2]


def words_of(text):
    return [x for x in regex.split(r"[^\p{L}\p{N}]+|(?<=\p{L})(?=v?\p{N})", text.lower(), flags=regex.V1) if x]


def grams_of(words):
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def paragraphs_of(text, settings):
    lines = text.split("\n")
    joined = [lines[0]]
    for before, line in zip(lines, lines[1:], strict=False):
        rest = line[MARK.match(line).end() :] or line.lstrip(" \t")
        mark_cut = MARK.match(line).end() if line[MARK.match(line).end() :].strip() else 0
        goes_on = bool(rest.strip()) and not rest[0].isspace()
        if before.rstrip(" \t\r") and not before.rstrip(" \t\r").endswith(END) and goes_on and (regex.match(r"\p{Ll}", rest) or len(before) >= 40):
            joined[-1] = joined[-1].rstrip(" \t\r") + " " + (line[mark_cut:] if mark_cut else line.lstrip(" \t"))
        else:
            joined.append(line)
    out = []
    for p in joined:
        for sentence in regex.split(r"(?<=[.!?;])\s+", p) if len(p.split(" ")) > settings.window_words else [p]:
            w = words_of(sentence)
            if len(w) <= settings.window_words:
                out.append(w)
            else:
                steps = math.ceil((len(w) - settings.window_words) / settings.window_step)
                out += [w[k * settings.window_step :][: settings.window_words] for k in range(steps + 1)]
    return [w for w in out if w]


def test_equals_scoring_every_paragraph_by_hand(spark, classifier):
    """Without passing over any paragraph, and with the softmax written out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    place = {g: i for i, g in enumerate(classifier.vocabulary)}
    weights, bias = classifier.model.coefficientMatrix.toArray(), classifier.model.interceptVector.toArray()
    known = {family: [grams_of(words_of(x)) for x in texts] for family, texts in NOTICES.items()}
    want = {}
    for r in docs.collect():
        found = []
        for words in paragraphs_of(r["text"] or "", classifier.settings):
            grams = grams_of(words)
            scores = bias + weights[:, [place[g] for g in grams if g in place]].sum(axis=1)
            p = [math.exp(x - max(scores)) for x in scores]
            p = [x / sum(p) for x in p]
            if 1 - p[0] > classifier.levels[NONE]:
                best = max(range(1, len(p)), key=lambda i: (p[i], -i))
                family = classifier.families[best]
                agreed = max(len(grams & n) / min(len(grams), len(n)) for n in known[family])
                sure = p[best] >= classifier.levels[family] and agreed >= classifier.settings.template_share
                found.append((not sure, -p[best], family if sure else UNKNOWN))
        lead = min(found, default=(False, 0.0, NONE))
        want[r["doc_id"]] = (lead[2], round(-lead[1], 6), sorted({x[2] for x in found} - {UNKNOWN}), len(found))
    got = {r["doc_id"]: (r["licence"], round(r["probability"], 6), list(r["licences"]), r["n_candidates"]) for r in scan_licences(docs, classifier).collect()}
    assert got == want


def test_a_long_text_without_marks(docs, classifier):
    words = "word " * 30_000
    (row,) = scan_licences(docs((1, words + "Released under the MIT License " + words)), classifier).collect()
    assert row["licences"] == ["mit"]


def test_repeated_rows_null_ids_and_no_rows(docs, classifier):
    rows = scan_licences(docs((None, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "x")), classifier).collect()
    assert sorted(r["licence"] for r in rows) == ["mit", "mit", "mit", "none"]
    assert scan_licences(docs((1, "x")).limit(0), classifier).count() == 0


def test_no_python_in_the_plan(spark, classifier):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "Python" not in scan_licences(docs, classifier)._jdf.queryExecution().toString()
