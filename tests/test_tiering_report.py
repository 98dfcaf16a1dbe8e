"""The tiering report against its SQL where a figure lies just below a half or nothing is moved."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tools.check_sql import canonical


@pytest.mark.parametrize("day, gb", [("1997-03-01", 1.004998), ("1997-03-01", 1.0049), ("2001-08-01", 3.0)])
def test_report_on_few_orders(spark, tmp_path, day, gb):
    connection = duckdb.connect()
    connection.execute(f"""COPY (SELECT 1::BIGINT AS o_orderkey, 1::BIGINT AS o_custkey, 'O' AS o_orderstatus,
        {gb} * 1073741824 / 1000::DOUBLE AS o_totalprice, TIMESTAMP '{day} 00:00:00' AS o_orderdate, '1' AS o_orderpriority)
        TO '{tmp_path}/orders.parquet' (FORMAT parquet)""")
    connection.execute(f"""COPY (SELECT 9::BIGINT AS l_orderkey, TIMESTAMP '1997-03-02 00:00:00' AS l_shipdate)
        TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)""")
    for name in ("orders", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    got = queries()["tiering_report"](spark, str(tmp_path)).toPandas()
    assert canonical(got) == canonical(connection.execute(oracle_sql()["tiering_report"]).df())
