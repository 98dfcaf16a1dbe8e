from hashlib import sha256

import numpy as np
from hypothesis import given, settings, strategies as st

from adlumen.llm import decontaminate as dc
from adlumen.llm.fmindex import FMIndex, Wavelet, suffix_order
from adlumen.llm.queries import QUERIES
from tests.llm import brute

SYMBOLS = st.lists(st.integers(0, 5), min_size=1, max_size=200)


@given(SYMBOLS)
def test_suffixes_are_in_order(symbols):
    text = np.array([s + 1 for s in symbols] + [0])
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@given(SYMBOLS)
def test_wavelet_counts_and_returns_symbols(symbols):
    tree, text = Wavelet(np.array(symbols)), np.array(symbols)
    at = np.arange(len(text) + 1)
    for s in range(6):
        if s < 1 << tree.depth:
            assert tree.rank(np.full(len(at), s), at).tolist() == [int((text[:i] == s).sum()) for i in at]
    assert tree.get(at[:-1]).tolist() == symbols


@settings(max_examples=100, deadline=None)
@given(SYMBOLS, st.lists(st.lists(st.integers(0, 6), min_size=3, max_size=3), min_size=1, max_size=6))
def test_phrases_are_located(symbols, phrases):
    index = FMIndex(np.array(symbols), sample=4)
    low, high = index.find(np.array(phrases))
    for p, a, b in zip(phrases, low, high):
        want = [i for i in range(len(symbols) - 2) if symbols[i:i + 3] == p]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_query_agrees_with_brute_force(spark, small):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_benchmark_hits"](spark, small).collect()}
    found = brute.phrases([(r["item_id"], r["text"]) for r in brute.rows(small, "benchmark")])
    seen = 0
    for r in brute.rows(small, "documents"):
        n, hit, items = brute.benchmark_hits(r["text"], found)
        seen += bool(hit)
        assert got[r["doc_id"]] == (n, len(hit), len(items), sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    assert seen


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (10, "short item"), (2, None), (3, "..."), (10, "short item")]
DOCS = [(1, "X one-two three four five, six SEVEN eight nine ten. Eleven twelve"), (2, None), (3, ""), (4, "A Short, item short item"),
        (5, "two three four five six seven eight nine ten"), (None, "short item"), (6, "filler é " * 30_000 + "short item")]


def frames(spark):
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, found string, n_chars int")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_nulls_ties_long_and_empty_in_any_number_of_blocks(spark):
    docs, items = frames(spark)
    found = brute.phrases(ITEMS)
    for block in (30, 1 << 20):
        got = {r.doc_id: r for r in dc.report(docs, items, block_bytes=block).collect()}
        for doc, text in DOCS:
            n, hit, owners = brute.benchmark_hits(text, found)
            assert (got[doc].n_words, got[doc].n_hit, got[doc].n_items) == (n, len(hit), len(owners))
    assert dc.report(docs.limit(0), items).count() == 0
    assert not any(r.contaminated for r in dc.report(docs, items.limit(0)).collect())


def test_passages_are_cut_and_columns_kept(spark):
    docs, items = frames(spark)
    out = dc.decontaminated(docs, items)
    assert out.columns == docs.columns
    got, found = {r.doc_id: r for r in out.collect()}, brute.phrases(ITEMS)
    for doc, text in DOCS:
        hit = brute.benchmark_hits(text, found)[1]
        want = brute.cut_hits(text, hit) if hit else text
        assert got[doc].text == want and got[doc].n_chars == (len(want) if hit else 1) and got[doc].found == "x"
