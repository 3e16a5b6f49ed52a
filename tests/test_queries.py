"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from oracle import duck, rows_of, rows_of_sql
from tailmap.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    assert rows_of(QUERIES[name](spark, SF)) == rows_of_sql(db, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["chr", "strand"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
