"""Every registered query against its DuckDB statement at sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

from __spark_entry__ import oracle_sql, queries  # noqa: E402

QS = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    from fleetlens.registry import queries as reports_and_operators
    assert set(reports_and_operators()) <= set(SQL) <= set(QS)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF_SMALL, key, QS[key], SQL.get(key), con)
    assert ok, msg


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["spike_day", "hosts_affected", "incident_count", "peak_cpu"]
    assert df.count() > 0
