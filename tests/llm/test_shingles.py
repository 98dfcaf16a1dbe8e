import random

import numpy as np
import pytest

import corpus_pipeline
from adlumen.llm import golay, shingles
from tests.llm import brute


def shingle_set(text: str | None, size: int = corpus_pipeline.SHINGLE) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def kept(docs: list[tuple[int, str | None]]) -> set[int]:
    sets, edges = {d: shingle_set(t) for d, t in docs}, []
    for a, x in sets.items():
        edges += [(a, b) for b, y in sets.items() if a < b and 10 * len(x & y) >= 8 * len(x | y)]
    roots = brute.least_reachable(list(sets), edges)
    return {d for d in sets if roots[d] == d}


def near_copies(n: int) -> list[tuple[int, str | None]]:
    """Texts of 6 to 200 words, each with copies of a similarity around the limit, chained."""
    rng, out = random.Random(11), []
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([6, 12, 40, 120, 200]))
        for _ in range(rng.choice([1, 2, 3, 12])):
            words = [*words]
            for _ in range(rng.randrange(1 + len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words) + rng.choice(["", " tail", " one more tail"]))
    rng.shuffle(out)
    return [*enumerate(out), (9001, None), (9002, ""), (9003, " \n"), (9004, "two words"), (9005, "Two  words")]


def test_stage_agrees_with_brute_force_jaccard(spark, small):
    rows = near_copies(60)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string")
    got = corpus_pipeline.near_duplicates(spark, docs, small)
    assert got.columns == docs.columns
    want = kept(rows)
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    # pairs that four bits would have missed
    far = [golay.fingerprint(t, corpus_pipeline.SHINGLE) for _, t in rows[:-5]]
    sets = [shingle_set(t) for _, t in rows[:-5]]
    assert sum(10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) and (far[i] ^ far[j]).bit_count() > 4
               for i in range(len(far)) for j in range(i)) > 50


def test_order_of_shingles_does_not_matter(spark, small, monkeypatch):
    rows = near_copies(20)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (1, 2):
        monkeypatch.setattr(shingles, "SAMPLE", sample)
        assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, small).collect()} == kept(rows)


@pytest.mark.parametrize("size", [1, 2, 4, 5, 9, 10, 11, 500])
def test_prefix_and_parities_hold_for_similar_sets(size):
    rng = np.random.default_rng(size)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        drop = rng.integers(0, size // 5 + 1)
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 1 << 63, rng.integers(0, size // 9 + 1)).astype(np.uint64)]))
        if shingles.alike(a, b):
            assert np.isin(a[:shingles.prefix(len(a))], b[:shingles.prefix(len(b))]).any()
            differ = np.bitwise_count((shingles.parities(a) ^ shingles.parities(b)).view(np.uint64)).sum()
            assert 180 * differ <= 20 * (len(a) + len(b))


def test_groups_of_packed_postings_do_not_change_the_links(spark):
    rows = [r for r in near_copies(40) if r[1]]
    docs = spark.createDataFrame(rows, "node long, text string")
    one, many = (shingles.components(shingles.links(docs, 5, group=g)).collect() for g in (1 << 20, 100))
    assert one and sorted(one) == sorted(many)


def test_texts_with_one_common_passage_are_no_candidates(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{d}x{i}" for i in range(300)) + " " + passage for d in range(30)]
    docs = spark.createDataFrame([*enumerate([*texts, texts[0] + " tail"])], "node long, text string")
    assert [(r.a, r.b) for r in shingles.links(docs, 5).collect()] == [(0, 30)]


def test_shingles_of_one_hash_are_not_taken_for_each_other(spark):
    texts = ["a b c d ]j,;z)ol", "s b c d fv%@[^6:"]
    assert golay.shingle_hashes(texts[0], 5).tolist() == golay.shingle_hashes(texts[1], 5).tolist()
    docs = spark.createDataFrame([*enumerate(texts), (2, texts[0].upper())], "node long, text string")
    assert [(r.a, r.b) for r in shingles.links(docs, 5).collect()] == [(0, 2)]
