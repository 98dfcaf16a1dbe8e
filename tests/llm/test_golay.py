import random

import numpy as np
from hypothesis import given, settings, strategies as st

from adlumen.llm import golay
from adlumen.llm.components import components
from adlumen.llm.queries import QUERIES
from tests.llm import brute


def test_code_is_perfect():
    near = golay.nearby()
    nearest = [min(bin(p).count("1") for p in row) for row in near.tolist()]
    assert near.shape == (2048, 6) and max(nearest) == 3
    assert all(golay.remainder(p) == rest for rest, row in enumerate(near.tolist()) for p in row)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), max_size=4))
def test_marks_within_four_bits_share_a_key(mark, bits):
    other = mark
    for b in bits:
        other ^= 1 << b
    row, key = golay.keys(np.array([mark, other], dtype=np.uint64))
    assert set(key[row == 0]) & set(key[row == 1])


@given(st.text(alphabet="aB é\n\t.", max_size=200))
def test_fingerprint(text):
    assert golay.fingerprint(text) == brute.fingerprint(text)


def clustered(n: int) -> list[int]:
    rng, out = random.Random(5), []
    for _ in range(n):
        mark = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40])):
            for _ in range(rng.randrange(4)):
                mark ^= 1 << rng.randrange(64)
            out.append(mark)
    return out


def test_links_connect_what_is_close_even_in_split_groups(spark):
    marks = sorted(set(clustered(30)))
    frame = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "mark long")
    array = np.array(marks, dtype=np.uint64)
    edges = [(marks[i], marks[j]) for i in range(len(marks)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 4)]
    want = brute.least_reachable(marks, edges)
    for group in (4, 4096):
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in golay.links(frame, group=group).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert brute.least_reachable(marks, links) == want


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    edges += [(100 + i, 101 + i) for i in range(50)] + [(200, 201 + i) for i in range(30)] + [(-5, 7), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.least_reachable(sorted({n for e in edges for n in e}), edges)
    assert {n: want[n] for n in got} == got
    assert {n for n in want if want[n] != n or list(want.values()).count(n) > 1} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_agrees_with_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(small, "documents")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_golay_near_duplicates"](spark, small).collect()}
    want = brute.simhash_components(docs)
    assert got == {d: (f"{brute.fingerprint(t):016x}", want[d]) for d, t in docs}
    assert len(set(want.values())) < len(docs)


def test_nulls_ties_long_and_empty(spark):
    long = "one two three four five " * 20_000
    rows = [(3, None), (2, ""), (7, " \n"), (5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (9, long), (None, "alone here now")]
    docs = spark.createDataFrame([(*r, "m", 1) for r in rows], "doc_id long, text string, mark string, root int")
    got = {(r.doc_id, r.mark): r.component_id for r in golay.near_duplicates(docs).collect()}
    assert got[(3, 0)] == got[(2, 0)] == got[(7, 0)] == 2
    assert {c for (d, m), c in got.items() if d in (5,)} == {5}
    assert golay.near_duplicates(docs).count() == len(rows)
    one = golay.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id) for r in one.collect()), key=str) == sorted(
        [(False, 2), (False, 5), (False, 9), (True, None)], key=str)
    assert golay.near_duplicates(docs.limit(0)).count() == 0 and golay.one_of_each(docs.limit(0)).count() == 0
