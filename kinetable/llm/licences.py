"""Licence families of paragraphs, by a trained classifier over sparse word n-grams.

A multinomial logistic regression is trained on notices of each family (fixed values below,
in whole and with words left out or changed around them) against sentences about rights that
name no licence.  Its vocabulary are the words and word pairs of the notices that are not
mere function words.  A paragraph without any of them has no feature, so the classifier
could only call it unknown; such paragraphs are not scored.  The probability below which a
family counts as unknown is calibrated on variants kept from training.  A family is
confirmed if the paragraph also contains enough word pairs of one of its notices.

Paragraphs are lines with hard wraps joined and comment marks at line starts left out.  A
line of up to 200 characters goes on in the next line if that begins in lower case or with
a digit, or if no sentence ends between them; never over a blank line, a list item, an SPDX
tag, a copyright line or between two lines that name a licence each.

Everything runs in the JVM, in one pass without a shuffle.  Null and empty texts have no
paragraphs.  Ids are carried along: null, repeated or tied ones give rows as any other.
Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# How notices of common licences are worded.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license, see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this "
        "program.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser "
        "General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with "
        "this library.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Released under the 2-Clause BSD license.",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
}
NO_LICENCE = (
    "All rights reserved.",
    "The driving license of the driver was not valid.",
    "Copyright is a form of intellectual property.",
    "You need a license from the city to open a shop.",
    "The public version of the work is free to use.",
    "Permission to enter was granted by the general.",
    "The source of the river has following conditions.",
    "Version 2.0 of the program was released in May.",
    "The foundation published a work on software.",
    "Public works are subject to the terms of the city.",
    "Use of the source code of the program is a matter of taste.",
    "The above list of conditions was found in the documentation.",
    "Unless agreed to in writing, the law is applied in either form.",
    "You should have received a copy of the letter along with this note.",
)
# Function words make no feature on their own, and neither do pairs of them.
FUNCTION_WORDS = tuple(
    "a an and any are as at be by can charge for forms from has in is it may met no not of on or "
    "see that the this to under use was with you file files person copy free".split()
)
_PAIR = " "
_MARKS = r"(?md)^[ \t]*(?:(?://+|/\*+|\*+/|<!--|(?:\*+|#+|;+|%+|--+|>+|REM|dnl)(?=[ \t\r]|$))[ \t]*)?"
# Lines that name a licence by themselves.  What stands after the first "under" includes what
# stands after others, so they are not tried: that keeps long lines linear.
_NAMING = (
    r"(?>[^\n]*?(?i:under ))[^\n]*?(?i:\bMIT\b|Apache Lic|Public Lic|\bBSD\b|\bCC[ -]BY|Attribution)[^\n]*"
)
_APART = r"[ \t\r]*(?:\n|\z|(?i:SPDX-|copyright\b)|[-*\u2022][ \t]|\w{1,2}[.)][ \t])"
_WRAP = (
    rf"(?md)^(?!(?i:SPDX-))(?!{_NAMING}\n{_NAMING}$)([^\n]{{0,199}}[^\n\s])[ \t\r]*\n(?!{_APART})"
    r"(?:(?=[a-z0-9])|(?<![.!?][ \t\r]{0,3}\n))"
)


@dataclass(frozen=True)
class Settings:
    iterations: int = 60
    ridge: float = 0.001
    # Share of kept variants that the calibrated probability must let through.
    passed: float = 0.99
    least_similarity: float = 0.6


def word_list(text: Column) -> Column:
    """Lower-case words; points and hyphens stay inside words."""
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9.\-]+", " ")
    words = F.split(F.trim(F.regexp_replace(plain, r"[.\-]+(?= |$)", "")), " +")
    return F.filter(words, lambda word: word != "")


def unwrapped(text: Column) -> Column:
    """The text with comment marks left out and hard-wrapped lines joined."""
    return F.regexp_replace(F.regexp_replace(text, _MARKS, ""), _WRAP, "$1 ")


def _pairs(words: Column) -> Column:
    following = F.slice(words, 2, 1_000_000_000)
    both = F.zip_with(words, following, lambda one, two: F.concat_ws(_PAIR, one, two))
    # The last word has no partner.
    return F.slice(both, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def plain_pairs(notice: str) -> list[str]:
    """The distinct word pairs of a notice, as ``word_list`` and ``_pairs`` make them."""
    words = re.sub(r"[^a-z0-9.\-]+", " ", notice.lower())
    words = re.sub(r"[.\-]+(?= |$)", "", words).split()
    return sorted({one + _PAIR + two for one, two in zip(words, words[1:])})


def grams(words: Column) -> Column:
    function = F.array(*map(F.lit, FUNCTION_WORDS))
    single = F.filter(words, lambda word: ~F.array_contains(function, word))
    pairs = F.filter(
        _pairs(words),
        lambda pair: ~F.forall(
            F.split(pair, _PAIR), lambda word: F.array_contains(function, word)
        ),
    )
    return F.array_distinct(F.concat(single, pairs))


def _variants(spark: SparkSession) -> DataFrame:
    """``family, text, kept_back``: notices and sentences, whole and with words left out."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    rows += [(UNKNOWN, text) for text in NO_LICENCE]
    base = spark.createDataFrame(rows, "family string, text string").coalesce(1)
    tried = base.select("family", "text", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("turn"))
    word = F.split("text", " ")
    thinned = F.filter(
        word,
        lambda one, place: (F.col("turn") < 3)
        | (F.pmod(F.xxhash64("text", "turn", place), F.lit(12)) != 0),
    )
    framed = F.concat_ws(
        " ",
        F.when(F.col("turn") % 3 == 1, F.lit("Note for all readers:")),
        F.concat_ws(" ", thinned),
        F.when(F.col("turn") % 3 == 2, F.lit("More is said on the last page.")),
    )
    return tried.select("family", framed.alias("text"), (F.col("turn") % 5 == 4).alias("kept_back"))


@dataclass(frozen=True)
class Classifier:
    vectors: object
    model: object
    families: list[str]
    least_probability: float

    def scored(self, rows: DataFrame) -> DataFrame:
        """With ``family`` and ``probability`` from a column ``grams``."""
        applied = self.model.transform(self.vectors.transform(rows))
        shares = vector_to_array("probability")
        names = F.array(*map(F.lit, self.families))
        best = applied.withColumn("probability", F.array_max(shares)).withColumn(
            "family", F.get(names, F.col("prediction").cast("int"))
        )
        return best.drop("features", "rawPrediction", "prediction")


def train(spark: SparkSession, settings: Settings) -> Classifier:
    variants = _variants(spark).withColumn("grams", grams(word_list(F.col("text"))))
    families = sorted([*NOTICES, UNKNOWN])
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    variants = variants.withColumn("label", number.cast("double"))
    fitting = variants.where(~F.col("kept_back"))
    # The vocabulary comes from notices only, so paragraphs without their words are empty.
    notices = fitting.where((F.col("family") != UNKNOWN)).orderBy("family", "text")
    vectors = CountVectorizer(
        inputCol="grams", outputCol="features", binary=True, minDF=3.0
    ).fit(notices)
    model = LogisticRegression(
        family="multinomial", maxIter=settings.iterations, regParam=settings.ridge
    ).fit(vectors.transform(fitting).orderBy("family", "text"))
    plain = Classifier(vectors, model, families, 0.0)
    known = variants.where("kept_back").withColumnRenamed("family", "true_family")
    right = plain.scored(known).where(
        (F.col("family") == F.col("true_family")) & (F.col("family") != UNKNOWN)
    )
    level = right.agg(F.expr(f"percentile(probability, {1 - settings.passed})")).first()[0]
    return Classifier(vectors, model, families, min(0.9, max(0.5, (level or 0.5) * 0.9)))


def _gate(vocabulary: list[str]) -> str:
    """A pattern that every paragraph with a feature matches: one of its telling words."""
    words = sorted({word for gram in vocabulary for word in gram.split(_PAIR)})
    telling = [word for word in words if word not in FUNCTION_WORDS]
    return "(?i)(?<![a-z0-9])(" + "|".join(word.replace(".", "[.]") for word in telling) + ")(?![a-z0-9])"


def licence_paragraphs(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row for each paragraph with a feature: family, probability, similarity, confirmed.

    Paragraphs are numbered from 0 in their text, blank ones included.
    """
    settings = settings or Settings()
    classifier = train(docs.sparkSession, settings)
    gate = _gate(classifier.vectors.vocabulary)
    lines = F.split(unwrapped(F.col("text")), "\n")
    paragraphs = docs.where(F.col("text").rlike(gate)).select(
        "doc_id", F.posexplode(lines).alias("place", "line")
    )
    passed = paragraphs.where(F.col("line").rlike(gate))
    words = passed.withColumn("words", word_list(F.col("line"))).withColumn(
        "grams", grams(F.col("words"))
    )
    scored = classifier.scored(words)
    sure = F.col("probability") >= classifier.least_probability
    family = F.when(sure, F.col("family")).otherwise(UNKNOWN)
    known = scored.withColumn("family", family).withColumn("pairs", _pairs(F.col("words")))

    def similarity(notice: str) -> Column:
        wanted = F.array(*map(F.lit, plain_pairs(notice)))
        return F.size(F.array_intersect("pairs", wanted)) / len(plain_pairs(notice))

    closest = F.lit(0.0)
    for name, notices in NOTICES.items():
        best = [similarity(notice) for notice in notices]
        closest = F.when(F.col("family") == name, F.greatest(*best, F.lit(0.0))).otherwise(closest)
    compared = known.withColumn("similarity", closest)
    return compared.select(
        "doc_id",
        F.col("place").cast("long").alias("paragraph"),
        "family",
        F.round("probability", 6).alias("probability"),
        F.round("similarity", 6).alias("similarity"),
        (F.col("similarity") >= settings.least_similarity).alias("confirmed"),
    )
