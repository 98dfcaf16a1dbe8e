"""Judged stream ingest: every row accounted for, replays without effect."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import types as T

from adlumen import schemas as S
from adlumen.streaming.events import read_stream
from adlumen.streaming.ingest import JudgedIngest


NULLABLE = T.StructType([T.StructField(f.name, f.dataType) for f in S.AD_EVENT.fields])


def event(spark, *rows):
    """(id, hour, minute, revenue) as ad events of one day."""
    full = []
    for id_, hour, minute, revenue in rows:
        at = None if hour is None else dt.datetime(2024, 1, 1, hour, minute)
        values = {"event_id": id_, "event_type": "click", "timestamp": at, "revenue": revenue, "cost": 0.1,
                  "country_code": "us", "device_type": "mobile"}
        full.append(tuple(values.get(c, "x") for c in S.columns_of(S.AD_EVENT)))
    return spark.createDataFrame(full, NULLABLE)


def ledger(sink, spark):
    return {r.batch: (r.landed, r.stored, r.quarantined, r.late, r.duplicates) for r in sink.ledger(spark).collect()}


def test_batches_are_judged_by_what_came_before(spark, tmp_path):
    sink = JudgedIngest(str(tmp_path), "log", 3600)
    assert ledger(sink, spark) == {} and sink.stored(spark, S.AD_EVENT).count() == 0
    # a copy within the batch, a refused row whose clock is ahead
    sink.process(event(spark, ("a", 5, 0, 1.0), ("a", 5, 0, 1.0), ("b", 1, 0, 1.0), ("c", 23, 0, -1.0)), 0)
    assert ledger(sink, spark) == {0: (4, 2, 1, 0, 1)}
    # the watermark is 4:00: d is late, e on its edge is not; a comes again, f has no time
    sink.process(event(spark, ("d", 3, 59, 1.0), ("e", 4, 0, 1.0), ("a", 5, 0, 1.0), ("f", None, 0, 1.0), ("g", 9, 0, 1.0)), 1)
    assert ledger(sink, spark)[1] == (5, 2, 1, 1, 1)
    sink.process(event(spark, ("e", 4, 0, 1.0), ("h", 9, 0, 1.0)), 2)
    assert ledger(sink, spark)[2] == (2, 1, 0, 1, 0)
    sink.process(event(spark).limit(0), 3)
    assert ledger(sink, spark)[3] == (0, 0, 0, 0, 0)
    assert sorted((r.event_id, r.batch) for r in sink.stored(spark, S.AD_EVENT).collect()) == [
        ("a", 0), ("b", 0), ("e", 1), ("g", 1), ("h", 2)]
    assert sorted((r.event_id, r.batch, r.outcome, tuple(r.errors)) for r in sink.refused(spark, S.AD_EVENT).collect()) == [
        ("c", 0, "quarantined", ("negative_revenue",)), ("d", 1, "late", ()), ("e", 2, "late", ()),
        ("f", 1, "quarantined", ("missing_timestamp",))]
    assert all(a == b + c + d + e for a, b, c, d, e in ledger(sink, spark).values())


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    sink = JudgedIngest(str(tmp_path), "log", 3600)
    batches = [event(spark, ("a", 5, 0, 1.0), ("b", 6, 0, -1.0)), event(spark, ("a", 5, 0, 1.0), ("c", 1, 0, 1.0), ("d", 8, 0, 1.0))]

    def everything():
        return (sorted(map(str, sink.stored(spark, S.AD_EVENT).collect())), sorted(map(str, sink.refused(spark, S.AD_EVENT).collect())),
                sorted(map(str, sink.ledger(spark).collect())))

    for n, batch in enumerate(batches):
        sink.process(batch, n)
    before = everything()
    for n in (0, 1, 1, 0):
        sink.process(batches[n], n)
    assert everything() == before and ledger(sink, spark) == {0: (2, 1, 1, 0, 0), 1: (3, 1, 0, 1, 1)}


def test_batches_without_a_ledger_row_are_not_read(spark, tmp_path, monkeypatch):
    sink = JudgedIngest(str(tmp_path), "log", 3600)
    sink.process(event(spark, ("a", 5, 0, 1.0)), 0)
    replace = JudgedIngest._replace

    def broken(self, rows, table, batch):
        if table == "ledger":
            raise RuntimeError("lost")
        return replace(self, rows, table, batch)

    with monkeypatch.context() as patch:
        patch.setattr(JudgedIngest, "_replace", broken)
        with pytest.raises(RuntimeError):
            sink.process(event(spark, ("b", 5, 0, 1.0)), 1)
    assert [r.event_id for r in sink.stored(spark, S.AD_EVENT).collect()] == ["a"]
    sink.process(event(spark, ("b", 5, 0, 1.0)), 1)
    assert sorted(r.event_id for r in sink.stored(spark, S.AD_EVENT).collect()) == ["a", "b"]


def test_two_queries_share_a_root(spark, tmp_path):
    one, two = JudgedIngest(str(tmp_path), "one", 3600), JudgedIngest(str(tmp_path), "two", 3600)
    one.process(event(spark, ("a", 9, 0, 1.0)), 0)
    two.process(event(spark, ("a", 1, 0, 1.0)), 0)
    two.process(event(spark, ("b", 1, 0, 1.0)), 1)
    assert ledger(one, spark) == {0: (1, 1, 0, 0, 0)} and ledger(two, spark) == {0: (1, 1, 0, 0, 0), 1: (1, 1, 0, 0, 0)}


def test_a_crash_before_the_checkpoint_replays_the_batch(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), tmp_path / "check"
    sink = JudgedIngest(str(tmp_path / "out"), "log", 3600)

    def run():
        sink.start(read_stream(spark, source, S.AD_EVENT), str(checkpoint)).awaitTermination()

    event(spark, ("a", 5, 0, 1.0), ("b", 6, 0, -1.0)).write.parquet(source)
    run()
    event(spark, ("a", 5, 0, 1.0), ("c", 1, 0, 1.0), ("d", 8, 0, 1.0)).write.mode("append").parquet(source)
    run()
    assert ledger(sink, spark) == {0: (2, 1, 1, 0, 0), 1: (3, 1, 0, 1, 1)}
    for name in ("1", ".1.crc"):  # as if the driver had died before the batch was noted as done
        Path(checkpoint, "commits", name).unlink(missing_ok=True)
    run()
    assert ledger(sink, spark) == {0: (2, 1, 1, 0, 0), 1: (3, 1, 0, 1, 1)}
    assert sorted(r.event_id for r in sink.stored(spark, S.AD_EVENT).collect()) == ["a", "d"]
