import random

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from adlumen.llm import spelling
from adlumen.llm.queries import QUERIES
from tests.llm import brute

WORDS = st.lists(st.text(alphabet="ab\u00e9", min_size=1, max_size=4), min_size=1, max_size=25, unique=True)


@settings(max_examples=25, deadline=None)
@given(WORDS)
def test_near_words_are_found_once(spark, words):
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = sorted((r.word, r.near, r.near_n) for r in spelling.neighbours(frame).collect())
    assert got == sorted((a, b, words.index(b)) for a in words for b in words if a != b and brute.one_edit(a, b))


def test_groups_reach_across_batches():
    rests = ["a"] * 3 + ["b"] * 5 + ["c"] + ["d"] * 4
    table = pa.table({"rest": rests, "edit": [str(i) for i in range(len(rests))]})
    for size in range(1, 14):
        parts = list(spelling._cut(iter(table.to_batches(max_chunksize=size))))
        assert [r for p in parts for r in p.column("rest").to_pylist()] == rests
        seen = [set(p.column("rest").to_pylist()) for p in parts]
        assert sum(map(len, seen)) == 4


def test_long_chains_reach_their_root(spark):
    chain = [f"w{i:02}" for i in range(28)]
    forms = [*zip(chain, chain[1:]), ("x", "w05"), ("y", "z")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "w27" for w in [*chain[:-1], "x"]} | {"y": "z"}


def test_query_agrees_with_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(small, "documents")]
    got = [tuple(r) for r in QUERIES["op12_spelling_variants"](spark, small).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute.spelling_variants(brute.spelling_words(docs))
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] for r in want) and any(r[4] == 0 for r in want)


def test_nulls_ties_repeats_and_long_texts(spark):
    rng = random.Random(4)
    base = ["lesson", "leson", "lessons", "\u00e9l\u00e8ve\u00e9", "\u00c9l\u00e8ve\u00e9", "banana", "bananas", "bandana", "kitten", "mitten", "LESSON"]
    docs = [(i, " ".join(rng.choices(base, [90, 1, 8, 3, 1, 40, 2, 6, 20, 20, 5], k=40))) for i in range(60)]
    docs += [(None, None), (None, "lesson " * 3), (8, ""), (9, "12 ..."), (60, "a" * 50_000 + " lesson"), (1, docs[1][1]), (61, "attention," * 30_000 + "attentions")]
    frame = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, n int, word string")
    got = [tuple(r) for r in spelling.variants(frame, occurrences=2).collect()]
    want = brute.spelling_variants(brute.spelling_words(docs, least=2))
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] and r[1] != r[2] for r in want) or any(r[1] for r in want)
    assert spelling.variants(frame.limit(0)).count() == 0


def test_counts_are_handed_on_when_a_task_has_many(spark, monkeypatch):
    docs = [(i, "abcdef bcdefg cdefgh " * 2) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {tuple(r) for r in spelling.words(frame).collect()}
    monkeypatch.setattr(spelling, "COUNTED", 1)
    assert {tuple(r) for r in spelling.words(frame).collect()} == whole == set(brute.spelling_words(docs).items())
