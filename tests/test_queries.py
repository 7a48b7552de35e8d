"""Every query that SQL can express, against DuckDB on the same tables."""

import pytest

from corpweave.plans import queries
from tests.differential import DATA, duck, duck_rows, spark_rows

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, con, name):
    assert spark_rows(queries.Q[name](spark, SF)) == duck_rows(con, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.Q) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.Q[name](spark, SF).count() >= 0
