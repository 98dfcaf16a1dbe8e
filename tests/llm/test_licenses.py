import math
import re

import pytest
from pyspark.sql import functions as F

from adlumen.llm import licenses
from adlumen.llm.queries import QUERIES
from tests.llm import brute


@pytest.fixture(scope="module")
def model(spark, small):
    return licenses.train(spark.read.parquet(f"{small}/documents.parquet"))


def test_every_planted_notice_is_found(spark, small):
    got = {(r.doc_id, r.paragraph): r.family for r in QUERIES["op3_licence_notices"](spark, small).collect()}
    want = {}
    for r in brute.rows(small, "documents"):
        for i, line in enumerate(r["text"].split("\n")):
            for mark, family in (("MIT License.", "MIT"), ("Apache License", "Apache"), ("CC BY-NC", "CC-BY-NC"), ("GNU General", "GPL")):
                if mark in line:
                    want[r["doc_id"], i] = family
    assert want and got == want


def test_scores_agree_with_plain_arithmetic(spark, model):
    text = "Released under the MIT License"
    words = text.lower().split()
    grams = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}
    score = list(model.intercepts)
    for gram, *weights in model.weights:
        if gram in grams:
            score = [s + w for s, w in zip(score, weights)]
    p = math.exp(max(score)) / sum(map(math.exp, score))
    got = licenses.scored(spark.createDataFrame([(text,)], "text string"), model).head()
    assert got.best == model.classes[score.index(max(score))] == "MIT" and got.p == pytest.approx(p, rel=1e-9)


def test_every_known_notice_reaches_the_classifier(spark, model):
    texts = [t for _, t in licenses.examples()]
    assert [t for t in texts if not re.search(licenses.CUE, t)] == []
    docs = spark.createDataFrame([(i, f"Some words before.\n{t}\nAnd after.") for i, t in enumerate(
        ["Released under GPL-3.0.", "Distributed under the Apache-2.0.", "Published under GNU GPL v3", "Released under the MPL-2.0."])],
        "doc_id long, text string")
    got = {(r.doc_id, r.paragraph): r.family for r in licenses.notices(docs, model).collect()}
    assert got == {(0, 1): "GPL", (1, 1): "Apache", (2, 1): "GPL", (3, 1): "MPL"}


def test_fit_does_not_depend_on_the_order_of_rows(spark, small, model):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    again = licenses.train(docs.orderBy(F.desc("doc_id")))
    assert again.threshold == pytest.approx(model.threshold, rel=1e-6)
    assert {w[0] for w in again.weights} == {w[0] for w in model.weights}


def test_nulls_ties_long_and_empty(spark, model):
    rows = [(1, None), (2, ""), (3, "x\nReleased under the MIT License."), (3, "x\nReleased under the MIT License."), (None, "Licensed under CC BY-SA 4.0"),
            (4, "Licensed under the Foo Bar License."), (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
            (6, "plain words " * 30_000 + "\nLicensed under the Apache License, Version 2.0."), (7, "nothing to see")]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, family string")
    got = sorted((str(r.doc_id), r.paragraph, r.family) for r in licenses.notices(docs, model).collect())
    assert got == [("3", 1, "MIT"), ("3", 1, "MIT"), ("4", 0, "unknown"), ("5", 0, "MIT"), ("6", 1, "Apache"), ("None", 0, "CC-BY-SA")]
    assert licenses.notices(docs.limit(0), model).count() == 0
