"""Every query of the packet pipelines against its DuckDB oracle (the driver's check)."""

import duckdb
import pytest

import __spark_entry__ as E
from testbed import queries as plans
from scripts.check_oracle import TABLES, digest, duck_rows, spark_rows
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(plans.queries()) == set(plans.oracle_sql())


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_oracle(spark, con, name):
    got = digest(*spark_rows(E.queries()[name](spark, SF_SMALL)))
    want = digest(*duck_rows(con, SQL[name]))
    assert got[0] == want[0] and got[1] == want[1]
    assert got[2] == want[2]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["from_node", "to_node", "packet_count", "window_start",
                          "window_end", "kind", "job_id"]
