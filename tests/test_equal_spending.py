"""Users with the same events lie on the same side of every limit, whatever the order of their rows."""

import datetime as dt
import random

import pytest

from __spark_entry__ import queries
from adlumen.functions.sums import exact_sum

KINDS, COPIES = 12, 20


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Twelve users, twenty copies of each with its amounts in another order; the last spends 700.00."""
    rng, rows = random.Random(5), []
    for kind in range(KINDS):
        cents = [rng.randrange(1, 9_000) for _ in range(9)]
        if kind == KINDS - 1:
            cents = [9_447, 8_562, 9_257, 10_020, 9_216, 6_060, 6_092, 8_952, 2_394]
        for copy in range(COPIES):
            user, own = copy * KINDS + kind, rng.sample(cents, len(cents))
            at = [("purchase", c / 100) for c in own] + [("view", 1.0)] * (6 + kind) + [("click", 1.0)] * kind
            rows += [(dt.datetime(2024, 1, 2 + i % 25, i, kind), user, event, value) for i, (event, value) in enumerate(at)
                     if i < 24]
    rows = [(i, *r, '{"k": 1}') for i, r in enumerate(rows)]
    folder = str(tmp_path_factory.mktemp("copies"))
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["memberships", "rfm_scores", "rfm_tiers", "rfm_tiers_cant_lose", "segment_rule_index"])
def test_copies_of_a_user_are_judged_alike(spark, copies, name):
    found = {u: set() for u in range(KINDS * COPIES)}
    for r in queries()[name](spark, copies).collect():
        found[r.user_id].add(tuple(v for k, v in r.asDict().items() if k != "user_id"))
    for kind in range(KINDS):
        assert len({frozenset(found[copy * KINDS + kind]) for copy in range(COPIES)}) == 1


def test_sum_of_doubles(spark):
    rows = [("cents", v) for v in random.Random(1).choices([0.1, 0.2, 0.7, 19.99], k=999)]
    rows += [("mixed", v) for v in (1e25, 1.0, 0.1234567890123, None)] + [("none", None), ("nan", float("nan")), ("nan", 1.0),
                                                                         ("inf", float("inf")), ("inf", 2.0)]
    values = spark.createDataFrame(rows, "name string, v double")
    got = {r.name: r.s for r in values.groupBy("name").agg(exact_sum(values.v).alias("s")).collect()}
    assert got["cents"] == sum(round(100 * v) for n, v in rows if n == "cents") / 100
    assert got["mixed"] == 1e25 and got["none"] is None and got["nan"] != got["nan"] and got["inf"] == float("inf")
