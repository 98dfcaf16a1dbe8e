"""Different texts and shingles that have one 64-bit hash are not taken for each other."""

import random
import types

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlumen.llm import common, golay, shingles
from adlumen.llm.common import numbered
from tests.llm.test_shingles import kept, near_copies

#: Two texts, and shingles, of one hash.
ONE, OTHER = "a b c d ]j,;z)ol", "s b c d fv%@[^6:"
LAST_ID = (1 << 63) - 1


def frame(spark, rows, types="doc_id long, text string, number int"):
    return spark.createDataFrame(rows, types)


def test_numbers_are_equal_for_equal_texts_only(spark):
    docs = frame(spark, [(i, t, -i) for i, t in enumerate([ONE, OTHER, ONE, OTHER, "x", None, ""])])
    assert docs.selectExpr("xxhash64(text) AS h").distinct().count() == 4
    got = numbered(docs, "n")
    assert got.columns == [*docs.columns, "n"]
    n = {r.doc_id: r.n for r in got.collect()}
    assert n[0] == n[2] and n[1] == n[3] and n[5] == n[6] and len({*n.values()}) == 4
    assert sum(v < 0 for v in {*n.values()}) == 1


def test_stage_keeps_a_text_that_has_the_hash_of_another(spark, small):
    docs = frame(spark, [(1, ONE, 1), (2, OTHER, 2), (3, OTHER, 3), (4, ONE.upper(), 4)])
    got = corpus_pipeline.near_duplicates(spark, docs, small)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, ONE, 1), (2, OTHER, 2)]


@pytest.mark.parametrize("one_of_each", [golay.one_of_each, lambda docs: shingles.one_of_each(docs, 5)])
def test_rows_of_one_id_and_hash_stay(spark, one_of_each):
    docs = frame(spark, [(1, ONE, 1), (1, OTHER, 2), (None, "one two three four five", 3), (LAST_ID, "One two three four five", 4),
                         (LAST_ID, "one two three four five", 5), (None, "six seven eight nine ten", 6)])
    got = sorted(r.number for r in one_of_each(docs).collect())
    assert got in ([1, 2, 4, 6], [1, 2, 5, 6])
    texts = docs.selectExpr("concat('d', doc_id) AS doc_id", "text").where("doc_id IS NOT NULL")
    assert sorted(r.text.lower() for r in one_of_each(texts).collect()) == [ONE, "one two three four five", OTHER]


def test_shingles_of_one_hash_within_a_text_hide_no_pair(spark):
    words = f"{ONE} {OTHER} v w x y".split()
    texts = [" ".join(words), " ".join(words[:-2])]  # ten shingles, and eight of them
    assert [len({*golay.shingle_texts(t, 5)}) for t in texts] == [10, 8]
    assert [len({*golay.shingle_hashes(t, 5).tolist()}) for t in texts] == [9, 7]
    docs = spark.createDataFrame([*enumerate(texts)], "node long, text string")
    assert [(r.a, r.b) for r in shingles.links(docs, 5).collect()] == [(0, 1)]


def test_stage_does_not_depend_on_the_hash_of_texts(spark, small, monkeypatch):
    coarse = types.SimpleNamespace(**vars(F) | {"xxhash64": lambda text: F.xxhash64(text).bitwiseAND(3)})
    monkeypatch.setattr(common, "F", coarse)
    rows = near_copies(40)
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(8)
    numbers = {(r.text or "", r.n) for r in numbered(docs, "n").collect()}
    assert len(numbers) == len({t for t, _ in numbers}) == len({n for _, n in numbers}) and sum(n >= 0 for _, n in numbers) == 4
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, small).collect()) == sorted(kept(rows))


def test_shared_keys_tell_similar_sets_even_if_most_hashes_are_shared(spark):
    rng, rows = random.Random(2), []
    while len(rows) < 600:
        a = set(rng.sample(range(10_000), rng.choice([5, 10, 40])))
        b = set(rng.sample(sorted(a), rng.randrange(len(a) * 4 // 5, len(a) + 1))) | set(rng.sample(range(10_000), rng.randrange(len(a) // 8 + 1)))
        if shingles.alike(a, b):
            some = rng.choice([1, 2, 5, 30])
            heads = [sorted({v % some for v in s})[:shingles.prefix(len(s))] for s in (a, b)]
            lost = max(shingles.prefix(len(s)) - len({v % some for v in s}) for s in (a, b))
            rows.append((len(set(heads[0]) & set(heads[1])), len(a), len(b), max(0, lost)))
    pairs = spark.createDataFrame(rows, "n long, x long, y long, lost long")
    assert pairs.where("n > 0").where(shingles._enough("n + lost", "x", "y", 80)).count() == len(rows)
    assert pairs.where(shingles._enough("n", "x", "y", 80)).count() < len(rows)
