from adlumen.llm import ring


def docs(spark, rows, kind="doc_id long, text string, shard string, slot double"):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], kind)


def test_counts_differ_by_one_and_slots_are_gapless(spark, small):
    got = ring.assign(spark.read.parquet(f"{small}/documents.parquet"), 24).toPandas()
    counts = got.groupby("shard").size()
    assert len(got) == 200 and len(counts) == 24 and counts.max() - counts.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_agrees_with_one_key_after_the_other(spark):
    given = docs(spark, [(i, f"t{i}") for i in range(300)])
    n, k = 7, 3
    got = {r.doc_id: r.shard for r in ring.assign(given, n, vnodes=k).collect()}
    places, owners = ring.ring(n, k)
    at = {r.doc_id: r.at for r in given.selectExpr("doc_id", "xxhash64(doc_id) AS at").collect()}
    arc = {d: int((places < a).sum()) % len(places) for d, a in at.items()}
    room = ring.capacities(300, n, 1.0)
    want, waiting = {}, sorted(at, key=lambda d: (arc[d], at[d], d))
    for step in range(len(places)):
        rest = []
        for d in waiting:
            shard = owners[(arc[d] + step) % len(places)]
            if room[shard]:
                room[shard] -= 1
                want[d] = shard
            else:
                rest.append(d)
        waiting = rest
    assert got == want


def test_few_rows_move_when_a_shard_joins(spark):
    given = docs(spark, [(i, "t") for i in range(4000)])
    before = {r.doc_id: r.shard for r in ring.assign(given, 24, load=1.25).collect()}
    after = {r.doc_id: r.shard for r in ring.assign(given, 25, load=1.25).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.25 * len(before)


def test_nulls_ties_long_and_empty(spark):
    long = "ä" * 200_000
    got = ring.assign(docs(spark, [(1, None), (1, None), (None, "a"), (None, ""), (2, long)]), 2).collect()
    assert sorted((r.size, r.text_crc32) for r in got)[:3] == [(8, 0), (8, 0), (8, 0)]
    assert max(r.size for r in got) == 400_008 and len(got) == 5
    assert sorted(sum(r.shard == s for r in got) for s in (0, 1)) == [2, 3]
    assert ring.assign(docs(spark, []), 2).count() == 0
