"""Tables with versions: what readers see between the steps of a change, and after ones that break off."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from adlumen.plans import compaction
from adlumen.sinks.snapshots import Conflict, Table

SCHEMA = T.StructType([T.StructField("ad", T.LongType()), T.StructField("clicks", T.LongType()), T.StructField("version", T.IntegerType()),
                       T.StructField("day", T.DateType()), T.StructField("kind", T.StringType())])
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def held(table, version=None):
    return sorted(map(tuple, table.read(version).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), SCHEMA, ("day", "kind"))


FIRST = [(1, 10, 1, D1, "a"), (2, 20, 1, D1, "b+ %/="), (3, 30, 1, D2, "a"), (4, 40, 1, None, None)]


def test_versions_are_kept_and_repeated_operations_do_nothing(spark, table):
    assert table.version() is None and held(table) == [] and table.history().count() == 0
    assert table.append(rows(spark, *FIRST), "one") == 1
    assert held(table) == sorted(FIRST, key=str)
    more = (5, 50, 1, D3, "a")
    assert table.append(rows(spark, more), "two") == 2 and table.append(rows(spark, more), "two") == 2
    assert held(table) == sorted([*FIRST, more], key=str) and held(table, 1) == sorted(FIRST, key=str)
    assert [(r.version, r.operation, r.added, r.removed) for r in table.history().orderBy("version").collect()] == [
        (1, "one", 4, 0), (2, "two", 1, 0)]
    with pytest.raises(ValueError):
        table.read(9)


def test_partition_values_are_read_from_paths_and_prune(spark, table):
    table.append(rows(spark, *FIRST), "one")
    found = {(r.day, r.kind) for r in table.files().collect()}
    assert found == {(r[3], r[4]) for r in FIRST}
    only = table.read(where=F.col("kind") == "b+ %/=")
    assert [r.ad for r in only.collect()] == [2]
    assert len(only.inputFiles()) == 1


def test_attempts_without_a_commit_change_nothing(spark, table):
    table.append(rows(spark, *FIRST), "one")
    lost = table.write(rows(spark, (9, 9, 9, D1, "a")))
    assert held(table) == sorted(FIRST, key=str)
    assert {r.path for r in table.orphans().collect()} == {r.path for r in lost.collect()}
    table.append(rows(spark, (9, 9, 9, D1, "a")), "again")
    assert len(held(table)) == 5 and table.orphans().count() == 1


def test_a_commit_that_comes_second_is_refused(spark, table):
    table.append(rows(spark, *FIRST), "one")
    since = table.version()
    added = table.write(rows(spark, (9, 9, 9, D1, "a")))
    table.append(rows(spark, (5, 50, 1, D3, "a")), "two")
    with pytest.raises(Conflict):
        table.commit("late", added, since=since)
    # the rename itself does not replace either
    with pytest.raises(Conflict):
        table._publish(2, {"version": 2, "operation": "late", "manifest": "x", "added": 0, "removed": 0})
    assert table.version() == 2 and len(held(table)) == 5 and table.version_of("late") is None


def test_replace_removes_partitions_that_are_gone(spark, table):
    table.append(rows(spark, *FIRST), "one")
    new = rows(spark, (1, 11, 2, D1, "a"))
    with pytest.raises(ValueError):
        table.replace(rows(spark, (1, 11, 2, D2, "a")), F.col("day") == F.lit(D1), "wrong day")
    assert table.version() == 1
    for _ in range(2):
        assert table.replace(new, F.col("day") == F.lit(D1), "rerun") == 2
    assert held(table) == sorted([(1, 11, 2, D1, "a"), *FIRST[2:]], key=str)
    table.replace(new.limit(0), F.col("day").isNotNull(), "nothing left")
    assert held(table) == [FIRST[3]]
    assert held(table, 1) == sorted(FIRST, key=str)


def test_merge_rewrites_only_files_with_a_key(spark, table):
    table.append(rows(spark, *[(i, i, 1, d, "a") for i in range(20) for d in (D1, D2, D3)]), "one")
    table.append(rows(spark, *[(i, i, 1, D1, "a") for i in range(20, 40)], (99, 1, 1, None, None)), "two")
    before = {r.path: r for r in table.files().collect()}
    updates = rows(spark, (3, 300, 2, D1, "a"), (70, 7, 2, D2, "a"), (5, 5_000, 0, D1, "a"), (99, 2, 2, None, None))
    for _ in range(2):
        assert table.merge(updates, ["ad", "day"], "version", "three") == 3
    after = {r.path for r in table.files().collect()}
    gone = [before[p] for p in set(before) - after]
    # of five files two hold a key: that of ads 0 to 19 on the first day and the one without a day
    assert len(before) == 5 and sorted((r.day, r.kind) for r in gone if r.day) == [(D1, "a")] and len(gone) == 2
    got = {(r[0], r[3]): r[1] for r in held(table)}
    assert got[3, D1] == 300 and got[70, D2] == 7 and got[5, D1] == 5 and got[99, None] == 2 and len(got) == 82


def test_merge_of_a_whole_scope_lets_rows_vanish(spark, table):
    table.append(rows(spark, *FIRST, (6, 60, 5, D1, "a"), (7, 70, 1, D1, "c")), "one")
    day = F.col("day") == F.lit(D1)
    table.merge(rows(spark, (1, 11, 2, D1, "a")), ["ad", "day"], "version", "rerun", scope=day)
    # ad 6 has a higher version than any update and stays
    assert held(table) == sorted([(1, 11, 2, D1, "a"), (6, 60, 5, D1, "a"), *FIRST[2:]], key=str)
    table.merge(rows(spark, FIRST[0]).limit(0), ["ad", "day"], "version", "nothing", scope=day)
    assert held(table) == sorted(FIRST[2:], key=str)


def test_expiry_lists_what_no_kept_version_needs(spark, table):
    table.append(rows(spark, *FIRST), "one")
    first = {r.path for r in table.files().collect()}
    table.replace(rows(spark, (1, 11, 2, D1, "a")), F.col("day") == F.lit(D1), "two")
    assert table.expire(keep=2).count() == 0
    for _ in range(2):  # a second call tells the same
        gone = {r.path for r in table.expire(keep=1).collect()}
        assert gone and gone == first - {r.path for r in table.files().collect()}
    for path in gone:
        Path(path.removeprefix("file:")).unlink()
    assert len(held(table)) == 3 and table.history().count() == 1
    with pytest.raises(ValueError):
        table.expire(0)


@pytest.fixture
def events(spark, tmp_path):
    """Two small files in each of three hours, as plain folders; one hour has too many copies."""
    root = str(tmp_path / "events")
    base = spark.range(120).selectExpr(
        "cast(id AS string) AS event_id", "timestamp'2024-01-15 00:00:00' + make_dt_interval(0, cast(id % 3 AS int)) AS timestamp",
        "2024 AS year", "1 AS month", "15 AS day", "cast(id % 3 AS int) AS hour", "'click' AS event_type")
    for part in (base.where("id < 60"), base.where("id >= 60"), base.where("id % 3 = 2")):
        # zero-padded as written by ingest
        part.withColumns({"month": F.lit("01"), "hour": F.format_string("%02d", "hour")}).coalesce(1).write.mode("append").partitionBy(
            "year", "month", "day", "hour", "event_type").parquet(root)
    return Table(spark, root, base.schema, ("year", "month", "day", "hour", "event_type"))


def test_compaction_is_seen_whole_or_not_at_all(spark, events):
    assert events.adopt() == 1 and events.adopt() == 1
    everything = sorted(map(tuple, events.read().collect()))
    assert len(everything) == 160 and events.files().count() == 7
    judged = {r.hour: r for r in compaction.compact(events, "first").collect()}
    assert [judged[h].is_valid for h in range(3)] == [True, True, False]
    now = sorted(map(tuple, events.read().collect()))
    assert now == everything and events.files().count() == 5  # one file for each valid hour
    assert events.version() == 2 and compaction.compact(events, "first") is None
    assert sorted(map(tuple, events.read().collect())) == everything and events.version() == 2
    assert sorted(map(tuple, events.read(1).collect())) == everything
    # compacted and new files of an hour lie in different folders and still meet
    events.append(spark.createDataFrame([("x", dt.datetime(2024, 1, 15), 2024, 1, 15, 0, "click")], events.schema), "more")
    assert {r.hour: (r.is_valid, r.input_file_count) for r in compaction.compact(events, "second").collect()} == {
        0: (True, 2), 2: (False, 3)}
    assert events.read().count() == 161 and events.files().count() == 5


def test_a_compaction_that_breaks_off_can_be_run_again(spark, events, monkeypatch):
    events.adopt()
    everything = sorted(map(tuple, events.read().collect()))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Table, "_publish", broken)
        with pytest.raises(RuntimeError):
            compaction.compact(events, "first")
    assert events.version() == 1 and sorted(map(tuple, events.read().collect())) == everything
    compaction.compact(events, "first")
    assert events.version() == 2 and sorted(map(tuple, events.read().collect())) == everything


def test_nothing_to_compact_makes_no_version(spark, table):
    table.append(rows(spark, FIRST[0]), "one")
    assert compaction.compact(table, "x", dedup_keys=("ad",), order=F.col("version")) is None and table.version() == 1
