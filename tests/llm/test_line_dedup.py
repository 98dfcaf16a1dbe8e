import random

import numpy as np
import pytest
from hypothesis import given, strategies as st

from adlumen.llm import line_dedup as ld
from adlumen.llm.queries import QUERIES
from tests.llm import brute

LINES = st.lists(st.lists(st.sampled_from(["a", "B", "é", "the", "of", "\t", "", "zz"]), max_size=6).map(" ".join), max_size=6).map("\n".join)


@given(st.lists(st.one_of(st.none(), LINES), max_size=5))
def test_sets_are_the_words_of_lines(texts):
    sets = ld.Sets(texts)
    want = [(d, i, len(set(x.lower().split(" ")) - {""} - {"\t"})) for d, t in enumerate(texts)
            for i, x in enumerate((t or "").split("\n")) if x.encode().split()]
    got = list(zip(sets.doc.tolist(), sets.number.tolist(), sets.size.tolist())) if sets.lines else []
    assert got == [w for w in want]


def test_equal_sets_have_equal_keys_and_parities_bound_the_difference():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(2000)]
    for n in (5, 60, 90, 170, 400):
        a = rng.sample(words, n)
        b = a[max(1, n // 10):] + rng.sample(words, n // 20)
        s = ld.Sets([" ".join(a), " ".join(reversed(a)), " ".join(b)])
        assert s.key[0] == s.key[1] != s.key[2]
        width = np.minimum(*ld.width(s.size[[0, 2]]))
        p = s.parity.view(np.uint64)
        apart = ld.differing([x[[0]] for x in p], [x[[2]] for x in p], np.array([width]))
        assert apart[0] <= len(set(a) ^ set(b))


def expect(docs):
    gone = brute.lines_gone([(d, t) for d, t in docs])
    return {d: (sum((d, i) in gone for i in range(len((t or "").split("\n")))),
                None if t is None else brute.without_lines(d, t, gone)) for d, t in docs}


def test_query_agrees_with_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(small, "documents")]
    got = {r.doc_id: (r.n_removed, r.text) for r in QUERIES["op1_line_dedup"](spark, small).collect()}
    assert got == expect(docs) and sum(n for n, _ in got.values()) > 50


@pytest.mark.parametrize(("group", "first"), [(20_000, 4), (5, 1)])
def test_near_copies_split_groups_and_second_round(spark, group, first):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(12)]
    docs = []
    for d in range(80):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.sample(base, rng.randrange(4, 12)) + [f"x{rng.randrange(40)}"] * rng.randrange(2)
            lines.append(" ".join(words))
        docs.append((d, "\n".join(lines)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.text) for r in ld.report(frame, group=group, first=first).collect()}
    assert got == expect(docs)


def test_nulls_ties_long_and_empty(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "a b c d e f\n\nnew line here"), (4, "F e d c b a\nother words only"), (None, "a b c d e f g"),
            (5, long), (6, long + " tail"), (7, "same row twice\nthis too"), (7, "same row twice\nthis too"), (8, "This TOO\nsame row twice")]
    frame = spark.createDataFrame([(*r, "k", "d", 5) for r in rows], "doc_id long, text string, kept_lines string, doc_key string, n_chars int")
    got = sorted(((r.doc_id is not None, r.doc_id, r.n_removed, r.text) for r in ld.report(frame).collect()), key=str)
    want = [(False, None, 0, "a b c d e f g"), (True, 1, 0, None), (True, 2, 0, ""), (True, 3, 1, "\nnew line here"),
            (True, 4, 1, "other words only"), (True, 5, 0, long), (True, 6, 1, ""), (True, 7, 0, "same row twice\nthis too"),
            (True, 7, 0, "same row twice\nthis too"), (True, 8, 2, "")]
    assert got == sorted(want, key=str)
    kept = ld.cleaned(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.n_chars) for r in kept.where("doc_id in (3, 4, 6, 8) or doc_id is null").collect()) == [(0, 13), (3, 14), (4, 16)]
    assert ld.report(frame.limit(0)).count() == 0
