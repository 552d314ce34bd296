"""Every catalogue query against its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from stratum.plans import catalogue
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, compare_pandas, duck

QUERIES = {k: q for k, q in entry.queries().items() if k in catalogue.QUERIES}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in catalogue.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    assert name in ORACLE, f"{name} has no oracle SQL"
    problems = compare(df, con, ORACLE[name]) + compare_pandas(df, con, ORACLE[name])
    assert not problems, "\n".join(problems)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
