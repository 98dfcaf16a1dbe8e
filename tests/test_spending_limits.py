"""Users whose spending lies on a limit: rows are those of the SQL where it adds cents without rounding."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.test_equal_spending import copies  # noqa: F401
from tools.check_sql import canonical


@pytest.mark.parametrize("name", ["rfm_scores", "rfm_tiers", "rfm_tiers_cant_lose", "segment_rule_index"])
def test_rows_of_the_sql_on_decimals(spark, copies, name):  # noqa: F811
    connection = duckdb.connect()
    connection.execute("CREATE VIEW events AS SELECT * REPLACE (CAST(value AS DECIMAL(18, 2)) AS value) "
                       f"FROM '{copies}/events.parquet/*.parquet'")
    got, want = queries()[name](spark, copies).toPandas(), connection.execute(oracle_sql()[name]).df()
    assert len(want) and canonical(got[sorted(want.columns)]) == canonical(want)
