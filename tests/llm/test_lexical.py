from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from adlumen.llm import lexical
from adlumen.llm.queries import QUERIES
from tests.llm import brute

TEXT = st.text(alphabet="aAbB \u00e9\u00d7-1\n", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4), TEXT)
def test_automaton_counts_whole_terms(items, text):
    block = lexical.Items(list(range(len(items))), items)
    read = lexical.readable(text)
    got = Counter(block.terms[i] for i in block.found(read))
    want = Counter(t for t in read.split() if t in set(block.terms))
    assert got == want and lexical.length(read) == len(read.split())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=3, max_size=3), min_size=1, max_size=12), st.integers(1, 5), st.integers(1, 4))
def test_best_keeps_ties_by_document(scores, step, k):
    best = lexical.Best(k, 3)
    for at in range(0, len(scores), step):
        part = np.array(scores[at:at + step])
        best.add(part, pa.array(range(100 - at, 100 - at - len(part), -1)))
    got = [tuple(r.values()) for r in best.held.to_pylist()] if best.held is not None else []
    want = []
    for i in range(3):
        above = [(i, r[i], 100 - at) for at, r in enumerate(scores) if r[i] > 0]
        want += sorted(above, key=lambda x: (-x[1], x[2]))[:k]
    assert got == want


def test_query_agrees_with_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(small, "documents")]
    got = {}
    for r in QUERIES["op11_lexical_search"](spark, small).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
    assert got == {r["item_id"]: brute.lexical_best(docs, r["text"]) for r in brute.rows(small, "benchmark")}


DOCS = [(3, "One two, two-three"), (1, "one TWO two three"), (2, None), (4, ""), (5, "..."), (None, "one two two three"), (9, "zw\u00d6lf " * 40_000 + "rare"),
        (1, "one TWO two three"), (7, "onetwo \u00e9one")]
ITEMS = [(1, "two two one"), (2, None), (3, "!!"), (4, "rare nowhere"), (1, "two two one"), (None, "\u00e9one"), (4, "three")]


def test_nulls_ties_repeats_long_texts_and_any_number_of_blocks(spark):
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, score string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(((i, rank, *hit) for i, text in dict.fromkeys(ITEMS) for rank, hit in enumerate(brute.lexical_best(DOCS, text, 3), 1)), key=str)
    for block in (8, 1 << 20):
        assert sorted((tuple(r) for r in lexical.search(docs, items, 3, block_bytes=block).collect()), key=str) == want
    assert any(r[2] is None for r in lexical.search(docs, items, 10).collect())
    assert lexical.search(docs.limit(0), items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.where("doc_id = 2"), items).count() == 0


def test_ids_of_other_kinds(spark):
    docs = spark.createDataFrame([("b", "one"), ("a", "one"), (None, "one"), ("c", "two")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in lexical.search(docs, items).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_scores_in_small_meetings(monkeypatch):
    block = lexical.Items([0, 1], ["a b b", "b c"])
    counts = [Counter(block.found(lexical.readable(t))) for t in ("a b c c", "b", "")]
    weight = np.array([3, 5, 7])
    whole = block.scores(weight, [100, 50, 25], counts)
    monkeypatch.setattr(lexical, "MEETINGS", 1)
    assert (block.scores(weight, [100, 50, 25], counts) == whole).all() and whole[2].sum() == 0 and whole[0, 0] > 0
