import duckdb
import pytest

import __spark_entry__ as contract
from places import TESTDATA
from tools.check_queries import TABLES, rows_of

FOLDER = str(TESTDATA / "sf0.001")

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_a_statement():
    """Those of the text operators have one where SQL can express them on whole tables."""
    queries, statements = set(contract.queries()), set(contract.oracle_sql())
    assert statements <= queries
    assert {q for q in queries if q.startswith("q_")} <= statements


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_statement(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
