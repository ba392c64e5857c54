"""Licence scans with a trained paragraph classifier, in DataFrame functions alone.

1. Every line of a text is a paragraph, together with the lines wrapped off it: those after 40 and more
   characters without an end mark, or that go on in lower case; comment marks at a line's start are left out.
   A paragraph of over ``window_words`` words is cut into its sentences, and a sentence that
   is still longer into overlapping windows.  Every paragraph of every text is classified.
2. A multinomial logistic regression with an L1 penalty over word n-grams (one to three words) gives a paragraph
   the probabilities of the licence families and of ``none``.  Its vocabulary is that of the notices
   below, so other words can neither speak for nor against a family.  It learns from runs of words
   of the notices, alone and behind other paragraphs, from sentences that use their words
   otherwise, and from ``sample_paragraphs`` paragraphs of the corpus that agree with no notice.
3. In ``folds`` fits, each without a share of the notices and of the other rows, whole notices are held out.
   A paragraph counts as a licence above the probability (0.5 at least, as for families) that all but ``false_share`` of the held-out ``none``
   rows stay below; it is of a family above the one that all but ``false_share`` of the held-out rows of
   families with another name stay below.
4. Texts and paragraphs without a word that could make the classifier decide otherwise, as its weights
   prove, are ``none`` without being scored.  A family is confirmed if ``template_share`` of the n-grams of one of its notices, or of the paragraph's
   own, agree; a licence whose family is unsure or not confirmed is ``unknown``.

Defined results: NULL and empty texts are ``none``; several families in a text are all
listed, by name, and the most probable one leads (equal: first by name); repeated rows
get the same result; only doc_id and text are read, so other columns cannot clash; an
empty table gives an empty result, and the classifier then learns without corpus rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake.llm.text import Scratch, documents

NONE, UNKNOWN = "none", "unknown"

#: The usual short notices of each family, as their authors recommend them.
NOTICES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "Released under AGPLv3.",
        "AGPL-3.0",
        "GNU AGPL version 3 or later",
    ),
    "apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Apache-2.0",
        "Apache 2.0 license",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD 3-Clause License",
        "BSD-2-Clause",
        "Released under the BSD license.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "CC BY 4.0",
        "Creative Commons Attribution 4.0 International",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International",
    ),
    "cc0": (
        "To the extent possible under law, the author has dedicated all copyright to this work to the public domain under the CC0 1.0 Public Domain Dedication.",
        "Released into the public domain under CC0 1.0.",
        "CC0 1.0 Universal",
        "CC0 1.0",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under GPLv3.",
        "GPLv2 or later",
        "GPL-3.0",
        "GNU GPL version 3",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Distributed under LGPLv2.1 or later.",
        "LGPLv3",
        "LGPL-3.0",
        "GNU LGPL version 2.1",
    ),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.',
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "Licensed under MIT.",
        "License: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License 2.0.",
        "MPL 2.0",
        "MPL-2.0",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright (c) 2020 by the authors. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the copyright holder.",
    ),
}

#: The cue words in sentences that are no licence.
OTHERWISE = (
    "She lost her driving license on the way to the station.",
    "The license plate of the car was hard to read.",
    "He asked for permission to leave the room early.",
    "The restaurant could not get a license to sell wine.",
    "The new law changes copyright for libraries and schools.",
    "They talked about how a license fee pays for public radio.",
    "The engine comes with a warranty of five years.",
    "Nobody had warranted that the bridge would hold.",
    "The council will redistribute the land among farmers.",
    "A fishing license costs twelve euros a year.",
    "The old songs have long been in the public domain.",
    "We need a licence from the city to build here.",
    "Her film was shown without the permission of the estate.",
    "A lawyer explained what copyright means for painters.",
    "The pilot renewed his licence last week.",
    "The table is reserved and all rights of way are closed.",
    "She studied physics at MIT and later taught in Boston.",
    "The Apache helicopters landed at 2 in the morning.",
    "The foundation published the terms of the general agreement.",
    "The public library is free for any later visit of the same kind.",
    "The software of the bank was under attack for 3 days.",
    "By 4 the work was done, and version 2 of the plan was on the table.",
    "The creative director left the commons and the public park.",
    "The source of the river is in this form hard to find without a guide.",
)

#: A line break within a paragraph, with the comment mark of the line that goes on.
_WRAP = r"(?<![.!?:;\s])[ \t\r]*\n(?:(?=[ \t]*(?:[#*/;%>-]+[ \t]+)?\p{Ll})|(?<=[^\n]{40}\n))[ \t]*(?:[#*/;%>-]+[ \t]+)?(?=\S)"
#: Between words; numbers, and a v before them, are words of their own: GPLv3 is gpl, v, 3.
_BETWEEN = r"[^\p{L}\p{N}]+|(?<=\p{L})(?=v?\p{N})"


@dataclass(frozen=True)
class Settings:
    """window_words, window_step: the length of the windows of sentences that are longer, and their distance.
    sample_paragraphs: most paragraphs of the corpus that are learned from.  folds: the parts held out in turn.
    mixed_rows: times that each notice is learned from behind other paragraphs."""

    iterations: int = 50
    sample_paragraphs: int = 2000
    window_words: int = 80
    window_step: int = 50
    penalty: float = 0.0005
    folds: int = 3
    mixed_rows: int = 4
    false_share: float = 0.01
    template_share: float = 0.6


def _words(text: str) -> str:
    return f"filter(split(lower({text}), r'{_BETWEEN}'), w -> w <> '')"


def _grams(words: str) -> str:
    """The distinct runs of one to three words."""
    two = f"transform({words}, (x, i) -> concat_ws(' ', x, get({words}, i + 1)))"
    three = f"transform({words}, (x, i) -> concat_ws(' ', x, get({words}, i + 1), get({words}, i + 2)))"
    return f"array_distinct(concat({words}, {two}, {three}))"


def _paragraphs(settings: Settings) -> str:
    """The paragraphs of a text as arrays of words, none empty and none longer than a window."""
    width, step = settings.window_words, settings.window_step
    lines = rf"split(regexp_replace(text, r'{_WRAP}', ' '), r'\n')"
    sentences = rf"flatten(transform({lines}, p -> CASE WHEN size(split(p, ' ')) > {width} THEN split(p, r'(?<=[.!?;])\s+') ELSE array(p) END))"
    windows = f"CASE WHEN size(w) <= {width} THEN array(w) ELSE transform(sequence(0, CAST(ceil((size(w) - {width}) / {step}) AS INT)), k -> slice(w, k * {step} + 1, {width})) END"
    return f"filter(flatten(transform(transform({sentences}, p -> {_words('p')}), w -> {windows})), w -> size(w) > 0)"


def notices(spark: SparkSession) -> DataFrame:
    """(family, number, notice, words), one row for each notice; numbers count within a family."""
    rows = ", ".join(f"({_quoted(family)}, {i}, {_quoted(text)})" for family, texts in NOTICES.items() for i, text in enumerate(texts))
    return spark.sql(f"SELECT family, number, notice, {_words('notice')} AS words FROM VALUES {rows} AS t(family, number, notice)")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def corpus_sample(docs: DataFrame, settings: Settings) -> DataFrame:
    """(words) of at most ``sample_paragraphs`` different paragraphs that agree with no notice, those of the smallest hashes."""
    share = min(1.0, 2 * settings.sample_paragraphs / max(1, docs.count()))
    near = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    different = near.select(F.explode(F.expr(_paragraphs(settings))).alias("words")).where("exists(words, w -> w RLIKE r'\\p{L}')").distinct()
    some = different.select("words", F.xxhash64("words").alias("h")).orderBy("h").limit(2 * settings.sample_paragraphs)
    own = some.select("h", F.explode(F.expr(_grams("words"))).alias("gram"))
    marks = notices(docs.sparkSession).select("notice", F.expr(_grams("words")).alias("grams")).select("notice", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    agree = own.join(marks, "gram").groupBy("h", "notice", "n").count().where(F.col("count") >= settings.template_share * F.col("n")).select("h").distinct()
    return some.join(agree, "h", "left_anti").orderBy("h").limit(settings.sample_paragraphs).select("words")


def training_rows(docs: DataFrame, settings: Settings) -> DataFrame:
    """(family, words, weight, fold): runs of 6, 10, 16 and all words of every notice, whole ones behind corpus paragraphs, the other sentences, and corpus paragraphs.

    Every notice weighs alike, however long; so do the two kinds of ``none``.
    """
    spark = docs.sparkSession
    known = notices(spark)
    corpus = Scratch(spark, "licences").write("corpus", corpus_sample(docs, settings))
    cuts = known.selectExpr("family", "notice", "number", "words", "explode(array_distinct(transform(array(6, 10, 16, 1000), n -> least(n, size(words))))) AS n").selectExpr("*", "explode(sequence(1, size(words) - n + 1)) AS a")
    fold = F.pmod("number", F.lit(settings.folds)).cast("long").alias("fold")
    runs = cuts.select("family", F.expr("slice(words, a, n)").alias("words"), F.when(F.expr("n = size(words)"), 1.0).otherwise(F.lit(1.0) / F.count("*").over(Window.partitionBy("notice"))).alias("weight"), fold)
    n_notices = sum(map(len, NOTICES.values()))
    # each of the first corpus paragraphs goes before one notice, in turn
    front = corpus.select(F.col("words").alias("front"), F.row_number().over(Window.orderBy(F.xxhash64("words"))).alias("r")).where(F.col("r") <= settings.mixed_rows * n_notices)
    turn = known.withColumn("turn", F.row_number().over(Window.orderBy("family", "number")) - 1)
    behind = turn.join(front, F.col("turn") == F.pmod("r", F.lit(n_notices))).select("family", F.concat("front", "words").alias("words"), F.lit(1.0 / settings.mixed_rows).alias("weight"), fold)
    half = 3.0 * n_notices  # the two kinds together outweigh the families two to one
    other = ", ".join(f"({_quoted(x)})" for x in OTHERWISE)
    sentences = spark.sql(f"SELECT {_words('paragraph')} AS words, {half / len(OTHERWISE)}D AS weight FROM VALUES {other} AS t(paragraph)")
    plain = sentences.unionByName(corpus.select("words", F.lit(half / settings.sample_paragraphs).alias("weight")))
    negative = plain.select(F.lit(NONE).alias("family"), "words", "weight", F.pmod(F.xxhash64("words"), F.lit(settings.folds)).alias("fold"))
    return runs.unionByName(behind).unionByName(negative)


@dataclass(frozen=True)
class Classifier:
    """``levels`` are the least probabilities: for ``none`` that of being a licence at all, else that of the family.
    ``common`` counts the ``none`` rows with a word of the vocabulary."""

    model: LogisticRegressionModel
    vocabulary: list[str]
    families: tuple[str, ...]
    levels: dict[str, float]
    common: dict[str, int]
    settings: Settings

    def probabilities(self, paragraphs: DataFrame) -> DataFrame:
        """The rows with ``p``, the probabilities in the order of the families."""
        known = _features(self.vocabulary, paragraphs)
        return self.model.transform(known).withColumn("p", vector_to_array("probability")).drop("grams", "features", "rawPrediction", "probability", "prediction")

    def telling_words(self) -> list[str]:
        """Words without any of which a paragraph is ``none``, whatever else it holds; from the weights alone.

        Each n-gram is put down to its word that is rarest in the corpus sample, without which it cannot
        occur.  The other words, common ones of little weight first, are such that all their n-grams
        could occur at once and leave ``none`` the most probable.
        """
        weights, bias = self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray()
        bound = bias[1:] - bias[0]
        gains = np.maximum(weights[1:] - weights[0], 0.0)
        by_word: dict[str, np.ndarray] = {}
        for i, gram in enumerate(self.vocabulary):
            word = min(gram.split(" "), key=lambda x: (self.common.get(x, 0), -len(x), x))
            by_word[word] = by_word.get(word, 0.0) + gains[:, i]
        telling = []
        for word in sorted(by_word, key=lambda x: (by_word[x].max() / (1 + self.common.get(x, 0)), x)):
            if np.exp(bound + by_word[word]).sum() < 1.0:
                bound = bound + by_word[word]
            else:
                telling.append(word)
        return telling if np.exp(bound).sum() < 1.0 else sorted(by_word)


def _features(vocabulary: list[str], paragraphs: DataFrame) -> DataFrame:
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    return counter.transform(paragraphs.withColumn("grams", F.expr(_grams("words"))))


def train(docs: DataFrame, settings: Settings = Settings()) -> Classifier:
    """Calibrates on rows held out in turn, then fits on all."""
    spark = docs.sparkSession
    families = (NONE, *sorted(NOTICES))
    grams = notices(spark).select(F.explode(F.expr(_grams("words"))).alias("gram")).distinct()
    vocabulary = sorted(r["gram"] for r in grams.collect())
    numbers = F.create_map(*[F.lit(x) for i, family in enumerate(families) for x in (family, float(i))])
    rows = Scratch(spark, "licences").write("training", training_rows(docs, settings).withColumn("label", numbers[F.col("family")])).coalesce(4)
    regression = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=settings.penalty, maxIter=settings.iterations, standardization=False, weightCol="weight")

    seen = rows.where("label = 0").select(F.explode(F.array_distinct("words")).alias("gram")).join(grams, "gram").groupBy("gram").count()
    common = {r["gram"]: r["count"] for r in seen.collect()}

    def fit(part: DataFrame) -> Classifier:
        return Classifier(regression.fit(_features(vocabulary, part)), vocabulary, families, {}, common, settings)

    held = [fit(rows.where(F.col("fold") != k)).probabilities(rows.where(F.col("fold") == k)) for k in range(settings.folds)]
    judged = reduce(DataFrame.unionByName, held).select("label", F.posexplode("p").alias("class", "p"))
    licence = judged.where("class = 0 AND label = 0").select(F.lit(0).alias("class"), (1 - F.col("p")).alias("p"))
    family = judged.where("class > 0 AND label <> class").select("class", "p")
    levels = licence.unionByName(family).groupBy("class").agg(F.percentile("p", 1 - settings.false_share).alias("level")).collect()
    return Classifier(fit(rows).model, vocabulary, families, {families[r["class"]]: max(0.5, r["level"]) for r in levels}, common, settings)


def scan_licences(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, licence, probability, licences, n_candidates for every row."""
    settings, families = classifier.settings, classifier.families
    rows = docs.select("doc_id", "text", F.md5("text").alias("digest"))
    telling = F.array(*map(F.lit, classifier.telling_words()))
    # the words of a text are those of its paragraphs, so whole texts can be passed over as well
    worth = rows.where(F.arrays_overlap(F.expr(_words("text")), telling))
    paragraphs = worth.select("doc_id", "digest", F.posexplode(F.expr(_paragraphs(settings))).alias("place", "words"))
    scored = classifier.probabilities(paragraphs.where(F.arrays_overlap("words", telling))).where(1 - F.col("p")[0] > classifier.levels.get(NONE, 0.5))
    candidates = scored.dropDuplicates(["doc_id", "digest", "place"]).withColumn("grams", F.expr(_grams("words")))
    entries = F.array(*[F.struct(F.col("p")[i].alias("p"), F.lit(-i).alias("order"), F.lit(family).alias("family"), F.lit(classifier.levels.get(family, 0.5)).alias("level")) for i, family in enumerate(families) if i])
    best = candidates.withColumn("best", F.array_max(entries))
    # as many rows as there are families
    marks = F.broadcast(notices(docs.sparkSession).groupBy("family").agg(F.collect_list(F.expr(_grams("words"))).alias("notices")))
    compared = best.join(marks.withColumnRenamed("family", "of"), F.col("best.family") == F.col("of"), "left")
    shared = "aggregate(notices, 0.0D, (m, n) -> greatest(m, size(array_intersect(grams, n)) / least(size(grams), size(n))))"
    sure = (F.col("best.p") >= F.col("best.level")) & (F.expr(shared) >= settings.template_share)
    judged = compared.select("doc_id", "digest", F.when(sure, F.col("best.family")).otherwise(UNKNOWN).alias("family"), F.col("best.p").alias("p"))
    lead = F.min(F.struct((F.col("family") == UNKNOWN).alias("unknown"), (-F.col("p")).alias("minus_p"), F.col("family"), F.col("p")))
    by_text = judged.groupBy("doc_id", "digest").agg(
        lead.alias("lead"), F.array_sort(F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))).alias("licences"), F.count("*").alias("n_candidates")
    )
    by_text = by_text.select(F.col("doc_id").alias("own"), F.col("digest").alias("own_digest"), "lead", "licences", "n_candidates")
    found = rows.select("doc_id", "digest").join(by_text, F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest")), "left")
    return found.select(
        "doc_id",
        F.coalesce("lead.family", F.lit(NONE)).alias("licence"),
        F.coalesce("lead.p", F.lit(0.0)).alias("probability"),
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
    )


def op9_scan_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = scan_licences(docs, train(docs))
    return out.select("doc_id", "licence", F.round("probability", 6).alias("probability"), F.concat_ws(",", "licences").alias("licences"), "n_candidates")
