"""Every query with SQL equals it on the smallest tables; the others give rows."""

import pytest
from oracle import DATA, compare, connect

from tidegauge import plans

SF_DIR = f"{DATA}/sf0.001"
QUERIES, SQL = plans.all_queries(), plans.all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).limit(1).count() == 1
