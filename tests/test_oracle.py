"""Every registered query against its DuckDB oracle SQL at sf0.001 (exact match)."""
import pytest

import __spark_entry__ as E
from check_oracle import digest, duck
from quotelake.plans.oracle import ORACLE
from quotelake.plans.registry import QUERIES
from tests.conftest import SF001



@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in sdf.collect()]
    res = con.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    d_rows = res.fetchall()
    assert len(rows) == len(d_rows)
    assert digest(sdf.columns, rows)[0] == digest(res.columns, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "symbol" and df.count() == 5
