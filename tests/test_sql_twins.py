"""Every registered query against its SQL on DuckDB."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adlumen.queries import all_queries, all_sql
from adlumen.sources import inventory
from tools.check_sql import canonical

TABLES = ("events orders lineitem customer part documents").split()
ALL_TABLES = [*TABLES, *"region nation supplier embeddings pages benchmark labels conversations".split()]


@pytest.fixture(scope="module")
def connection(small):
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(small) / name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows(spark, connection, small, name):
    got = queries()[name](spark, small).toPandas()
    want = connection.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
    assert isinstance(got, pd.DataFrame)


def test_listed_sizes(spark, small):
    rows = {r.name: r.size for r in inventory.list_files(spark, small).collect()}
    assert rows == {p.name: p.stat().st_size for p in Path(small).glob("*.parquet")}


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    """A third of the events on one user and one ad, a tenth without a user."""
    folder = tmp_path_factory.mktemp("skewed")
    duckdb.connect().execute(f"""COPY (
        SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 10 = 1 THEN NULL
                                  ELSE user_id END AS user_id,
               event_type, value, CASE WHEN event_id % 3 = 0 THEN '{{"k": 0}}' ELSE props END AS props
        FROM '{small}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)""")
    for name in TABLES[1:]:
        (folder / f"{name}.parquet").symlink_to(Path(small) / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [
    "attribution", "attribution_by_user", "nested_report", "top_ads", "hierarchy_rollup",
    "window_counts", "decayed_metrics", "user_features", "rfm_thresholds", "rfm_tiers",
    "dedup_events", "dedup_accounting", "hourly_rolling_counts"])
def test_same_rows_with_a_dominant_key(spark, skewed, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet'")
    got = queries()[name](spark, skewed).toPandas()
    assert canonical(got) == canonical(connection.execute(oracle_sql()[name]).df())
