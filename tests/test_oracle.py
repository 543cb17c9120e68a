"""Every registered query against its DuckDB oracle on the driver tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck_con

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_con(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, f"{name}: {problems}"
    assert n > 0, f"{name} returned no rows"
