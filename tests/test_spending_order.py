"""Over doubles the SQL's rows depend on the order of the events, with one thread too; on decimals they are the query's."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.test_equal_spending import copies  # noqa: F401
from tools.check_sql import canonical


def by_sql(folder, name, kind, order):
    connection = duckdb.connect()
    connection.execute("SET threads = 1")
    connection.execute(f"CREATE TABLE events AS SELECT * REPLACE (CAST(value AS {kind}) AS value) "
                       f"FROM '{folder}/events.parquet/*.parquet' ORDER BY {order}")
    return connection.execute(oracle_sql()[name]).df()


@pytest.mark.parametrize("name", ["memberships", "rfm_scores", "rfm_tiers"])
def test_only_the_sql_on_doubles_depends_on_the_order_of_rows(spark, copies, name):  # noqa: F811
    orders = ["event_id", "event_id DESC", "value"]
    want = by_sql(copies, name, "DECIMAL(18, 2)", orders[0])
    got = queries()[name](spark, copies).toPandas()
    assert len(want) and canonical(got[sorted(want.columns)]) == canonical(want)
    assert all(canonical(by_sql(copies, name, "DECIMAL(18, 2)", o)) == canonical(want) for o in orders)
    assert len({str(canonical(by_sql(copies, name, "DOUBLE", o))) for o in orders}) > 1
