"""Every registered query with SQL, compared with DuckDB on whole tables."""

import pytest

import __spark_entry__ as entrypoint
from cohortlens.queries import load
from tests.compare import differences

OWN, SQL = load().queries, load().sql
# Fits have no SQL; the grid of 144 fits is left to the full comparison run.
LONG = {"cl12_feature_set_grid"}
ROWS_ONLY = [n for n in OWN if n not in SQL and n not in LONG]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, spark, small, duckdb_small):
    df = OWN[name](spark, small)
    assert differences(df, duckdb_small, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(name, spark, small):
    assert OWN[name](spark, small).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entrypoint.queries())


def test_entry(spark):
    assert entrypoint.entry(spark).columns[:2] == ["prediction", "name"]
