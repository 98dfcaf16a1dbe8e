import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from adlumen.llm import repeats
from adlumen.llm.queries import QUERIES
from tests.llm import brute


def rows(frame, into="repeats"):
    return sorted(((r.doc_id, r[into].n_words, r[into].n_removed, r[into].kept) for r in frame.collect()), key=str)


def test_levels_double_at_most():
    assert repeats.levels() == [7, 13, 25, 50] and repeats.levels(5) == [5]
    for window in range(1, 200):
        sizes = repeats.levels(window)
        assert sizes[-1] == window and all(a < b <= 2 * a for a, b in zip(sizes, sizes[1:]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \u00e9\t\u00a0", max_size=80), st.integers(1, 9))
def test_equal_windows_have_equal_hashes_and_others_do_not(text, size):
    words = text.encode().split()
    h = repeats.longer(repeats.word_hashes(text.encode()), 1, size)
    windows = [tuple(words[i:i + size]) for i in range(max(0, len(words) - size + 1))]
    assert len(h) == len(windows) and len(set(h.tolist())) == len(set(windows))
    assert len(set(zip(windows, h.tolist()))) == len(set(windows))


@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.integers(1, 6))
def test_least_of_neighbours(values, n):
    if len(values) >= n:
        assert repeats.least(np.array(values), n).tolist() == [min(values[i:i + n]) for i in range(len(values) - n + 1)]


@given(st.lists(st.booleans(), min_size=1, max_size=40), st.integers(1, 6))
def test_places_and_spans(alive, window):
    flags = np.array(alive)
    assert (repeats._flags(repeats._marks(flags), len(flags)) == flags).all()
    got = {j for a, b in repeats.covered(np.flatnonzero(flags), window) for j in range(a, b)}
    assert got == {j for i in np.flatnonzero(flags).tolist() for j in range(i, i + window)}


def planted(seed: int, n: int) -> list:
    """Documents put together from a few passages, so that windows overlap in all ways."""
    rng = random.Random(seed)
    parts = [[f"{rng.choice('abc')}{rng.randrange(4)}" for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    docs = []
    for i in range(n):
        words = [w for _ in range(rng.randrange(4)) for w in rng.choice(parts)[rng.randrange(3):]]
        docs.append((rng.choice([i, i, i // 2, None]), rng.choice([" ", "\n", "\t "]).join(words)))
    return docs + [docs[3], docs[3], (0, docs[5][1]), (None, None), (-4, ""), (7, " \n")]


@pytest.mark.parametrize("window", [1, 6, 20])
def test_planted_passages_agree_with_brute_force(spark, window):
    docs = planted(window, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(brute.without_repeats(docs, window), key=str)
    assert rows(repeats.deduplicated(frame, window)) == want
    assert rows(repeats.deduplicated(frame, window, shortest=2)) == want
    assert sum(r[2] for r in want)


def test_query_agrees_with_brute_force(spark, small):
    from hashlib import sha256

    docs = [(r["doc_id"], r["text"]) for r in brute.rows(small, "documents")]
    got = {tuple(r) for r in QUERIES["op13_repeated_passages"](spark, small).collect()}
    assert got == {(d, n, gone, sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute.without_repeats(docs, 50)}


def test_long_texts_other_ids_clashing_columns_and_no_rows(spark):
    tail = " ".join(f"w{i}" for i in range(60))
    docs = [("b", "x " * 70_000 + tail), ("a", tail), ("c", "y " * 49), (None, "z " * 10 + tail), ("d", "x " * 51)]
    frame = spark.createDataFrame([(*d, 1, "n", 2, "u") for d in docs], "doc_id string, text string, node int, repeats string, spans int, uid string")
    out = repeats.deduplicated(frame)
    assert out.columns == [*frame.columns, "repeats_"]
    got = {r.doc_id: (r.repeats_.n_words, r.repeats_.n_removed) for r in out.collect()}
    assert got == {"b": (70_060, 60), "a": (60, 0), "c": (49, 0), None: (70, 60), "d": (51, 51)}
    assert repeats.deduplicated(frame.limit(0)).count() == 0
    assert rows(repeats.deduplicated(frame.where("doc_id = 'c'").drop("repeats")))[0][1:3] == (49, 0)
