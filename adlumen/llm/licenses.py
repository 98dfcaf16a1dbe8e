"""Licence notices: a trained n-gram classifier, confirmed by templates. SQL functions only."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.llm.common import sql_text, stored

#: Families with their names and the openings of their texts.
FAMILIES = {
    "MIT": [["MIT License", "MIT licence", "Expat license"],
            ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction"]],
    "Apache": [["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache License"],
               ["you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                "apache.org/licenses/LICENSE-2.0"]],
    "GPL": [["GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL v3", "GPL-3.0", "GPL-2.0"],
            ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation"]],
    "LGPL": [["GNU Lesser General Public License", "LGPL-2.1", "LGPL-3.0"],
             ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
              "General Public License as published by the Free Software Foundation"]],
    "BSD": [["BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "BSD-3-Clause"],
            ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met"]],
    "MPL": [["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
            ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"]],
    "CC-BY": [["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License"],
              ["This work is licensed under a Creative Commons Attribution 4.0 International License"]],
    "CC-BY-SA": [["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
                 ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"]],
    "CC-BY-NC": [["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
                 ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"]],
    "public domain": [["CC0 1.0", "the public domain", "the Unlicense"],
                      ["This is free and unencumbered software released into the public domain"]],
}
#: Licences outside the families, to learn the class of unknown ones and to
#: calibrate with, and how notices begin.
FOREIGN = ["Eclipse Public License 2.0", "Artistic License", "Boost Software License", "Open Data Commons License",
           "commercial licence agreement", "end user license agreement", "Example Software License", "terms of this licence"]
HELD_BACK = ["European Union Public Licence", "zlib license", "Microsoft Reference Source License", "our proprietary license",
             "Academic Free License", "license of the authors"]
OPENINGS = ["{0}", "Licensed under {0}.", "Licensed under the {0}.", "Released under {0}.", "Released under the {0}.",
            "This work is licensed under the {0}.", "This work is licensed under {0}.", "Distributed under the {0}.",
            "SPDX-License-Identifier: {0}", "Code is available under the {0}, see LICENSE.", "Published under {0}"]
#: Words of notices that are not names, and families whose versions vary.
WORDS = [r"licen[sc]", "copyright", "permission is hereby", "redistribution and use", "without warranty", "spdx",
         r"\bcc[ -]by", r"\bcc0\b", "free software", "unencumbered software", r"\b[al]?gpl", r"\bgnu\b"]
#: Paragraphs (lines) without any of these words and without a name of a family are no notices.
CUE = "(?i)" + "|".join([*WORDS, *sorted({re.escape(n).replace("\\ ", " ").replace("\\-", "-") for names, _ in FAMILIES.values()
                                         for n in names if not re.search("|".join(WORDS), n, re.I)})])
NONE, UNKNOWN = "none", "unknown"
#: The sample that stands for ordinary text: so many documents at most, so many characters
#: of each and so many lines without a cue in all. Only the fit uses it.
NEGATIVE_DOCS, NEGATIVE_CHARS, NEGATIVE_ROWS = 200, 10_000, 1_000
VOCABULARY = 1 << 12
#: A paragraph with a cue is ordinary text only if that has so much probability.
ORDINARY = 0.5
#: Share of a template's n-grams that a paragraph must hold to confirm the family.
CONFIRMED = 0.6


def grams(text: str) -> str:
    """Distinct words and word pairs of a text column, in lower case, as an SQL expression."""
    words = (f"filter(transform(split(lower({text}), '{sql_text(r'[^\p{L}\p{N}.+-]+')}'), "
             f"w -> regexp_replace(w, '{sql_text(r'^[.+-]+|[.+-]+$')}', '')), w -> w <> '')")
    return (f"array_distinct(concat({words}, zip_with(slice({words}, 1, greatest(size({words}) - 1, 0)), "
            f"slice({words}, 2, greatest(size({words}) - 1, 0)), (a, b) -> concat(a, ' ', b))))")


def templates() -> list[tuple[str, str, str]]:
    """(family, name, text): the names and opening texts of all families."""
    return [(family, text[:40], text) for family, (names, texts) in FAMILIES.items() for text in [*names, *texts]]


@dataclass
class Model:
    classes: list[str]
    weights: list[tuple]      # (gram, weight of each class)
    intercepts: list[float]
    threshold: float = 0.0


def examples() -> list[tuple[str, str]]:
    """(class, text): every name behind every opening, and the opening texts."""
    rows = [(f, o.format(n)) for f, (names, _) in FAMILIES.items() for n in names for o in OPENINGS]
    rows += [(f, t) for f, (_, texts) in FAMILIES.items() for t in texts for _ in range(3)]
    return rows + [(UNKNOWN, o.format(n)) for n in FOREIGN for o in OPENINGS]


def train(docs: DataFrame, text_col: str = "text", negatives: int = NEGATIVE_ROWS) -> Model:
    """Multinomial logistic regression over presence of n-grams, and the calibrated threshold.

    All classes weigh the same. Learns from the fixed notices, from ``negatives`` lines of the corpus at most, and from
    some licences outside the families.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    # the least hashes: the same rows whatever their order
    sample = docs.where(text.isNotNull()).select(F.xxhash64(text).alias("h"), F.substring(text, 1, NEGATIVE_CHARS).alias("text"))
    sample = sample.orderBy("h", "text").limit(NEGATIVE_DOCS)
    lines = sample.select(F.explode(F.split("text", "\n")).alias("line")).where(~F.col("line").rlike(CUE) & F.col("line").rlike(r"\p{L}"))
    few = sorted(r.line for r in lines.distinct().orderBy(F.xxhash64("line"), "line").limit(negatives).collect())
    classes = [*FAMILIES, UNKNOWN, NONE]
    rows = [(float(classes.index(c)), t) for c, t in examples()] + [(float(classes.index(NONE)), t) for t in few or ["."]]
    size = Counter(c for c, _ in rows)
    labelled = spark.createDataFrame([(c, 1 / size[c], t) for c, t in rows], "label double, weight double, text string")
    labelled = labelled.selectExpr("label", "weight", f"{grams('text')} AS grams").coalesce(2)
    vector = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(labelled)
    fit = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, maxIter=60).fit(vector.transform(labelled))
    matrix = fit.coefficientMatrix.toArray()
    model = Model(classes, [(g, *map(float, matrix[:, i])) for i, g in enumerate(vector.vocabulary)],
                  [float(x) for x in fit.interceptVector])
    return calibrated(spark, model)


def calibrated(spark: SparkSession, model: Model) -> Model:
    """Put the threshold between the worst twentieth of known notices with a word left out
    and the best twentieth of foreign ones."""
    import math

    known = []
    for family, text in (e for e in examples() if e[0] != UNKNOWN):
        words = text.split()
        known += [(family, " ".join(words[:i] + words[i + 1:])) for i in range(min(3, len(words)))]
    rows = spark.createDataFrame([(True, f, t) for f, t in known] + [
        (False, UNKNOWN, o.format(n)) for n in HELD_BACK for o in OPENINGS],
                                 "known boolean, family string, text string")
    got = scored(rows.select("text").distinct(), model).join(rows, "text").select("known", "family", "best", "p").collect()
    inside = sorted(r.p for r in got if r.known and r.best == r.family)
    outside = sorted(r.p for r in got if not r.known and r.best in FAMILIES)
    low = inside[len(inside) // 20] if inside else 0.5
    high = outside[min(len(outside) - 1, math.ceil(len(outside) * 0.95))] if outside else low
    model.threshold = (low + high) / 2 if high < low else low
    return model


def scored(paragraphs: DataFrame, model: Model) -> DataFrame:
    """text, best, p: the most probable class of each distinct text.

    Weights are at most VOCABULARY rows and are broadcast; texts without a known n-gram
    have the intercepts alone.
    """
    spark, k = paragraphs.sparkSession, len(model.classes)
    schema = "gram string, " + ", ".join(f"w{i} double" for i in range(k))
    weights = F.broadcast(spark.createDataFrame(model.weights, schema))
    each = paragraphs.selectExpr("text", f"explode_outer({grams('text')}) AS gram").join(weights, "gram", "left")
    sums = each.groupBy("text").agg(*[
        (F.coalesce(F.sum(f"w{i}"), F.lit(0.0)) + F.lit(b)).alias(f"s{i}") for i, b in enumerate(model.intercepts)])
    scores = f"array({', '.join(f's{i}' for i in range(k))})"
    names = "array(" + ", ".join(f"'{c}'" for c in model.classes) + ")"
    return sums.selectExpr("text", f"{scores} AS s").selectExpr(
        "text", f"element_at({names}, CAST(array_position(s, array_max(s)) AS INT)) AS best",
        "1 / aggregate(s, 0D, (a, x) -> a + exp(x - array_max(s))) AS p")


def notices(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph, family, probability, template, similarity and confirmed for every notice.

    A paragraph is a line; one with a cue, which is not most probably ordinary text, is a
    notice. Its family is the most probable one if the probability reaches the
    threshold and a template of the family confirms it, else ``unknown``.

    Null and empty texts have no paragraphs. Repeated rows are reported each. Equal
    paragraphs are scored once, however many documents hold them. Other columns are
    ignored; no rows: no output.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    held = docs.where(text.rlike(CUE)).select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("paragraph", "text"))
    held = stored(held.where(F.col("text").rlike(CUE)), "notices")
    best = scored(held.select("text").distinct(), model).where((F.col("best") != NONE) | (F.col("p") < ORDINARY))
    known = spark.createDataFrame(templates(), "best string, template string, words string").selectExpr(
        "best", "template", f"{grams('words')} AS model_grams")
    close = (best.join(F.broadcast(known), "best", "left")  # the fixed templates
             .selectExpr("text", "best", "p", "template", f"size(array_intersect({grams('text')}, model_grams)) / size(model_grams) AS similarity")
             .groupBy("text", "best", "p").agg(F.max(F.struct("similarity", "template")).alias("m")))
    sure = (F.col("p") >= model.threshold) & ~F.col("best").isin(UNKNOWN, NONE)
    confirmed = F.coalesce(F.col("m.similarity") >= CONFIRMED, F.lit(False))
    verdict = close.select(
        "text", F.when(sure & confirmed, F.col("best")).otherwise(UNKNOWN).alias("family"), F.col("p").alias("probability"),
        F.col("m.template").alias("template"), F.col("m.similarity").alias("similarity"), (sure & confirmed).alias("confirmed"))
    return held.join(stored(verdict, "notice-verdicts"), "text").select(
        "doc_id", "paragraph", "family", "probability", "template", "similarity", "confirmed")
