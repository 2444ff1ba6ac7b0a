"""Every registered query against its DuckDB SQL on the driver's tables."""

import pytest

from feedmetrics.plans.compare import compare, duck_connection
from feedmetrics.plans.registry import oracle_sql, queries

KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_dir, key):
    r = compare(spark, con, key, queries()[key], oracle_sql()[key], sf_dir)
    assert r["names_ok"], r
    assert not r["type_diff"], r
    assert r["values_ok"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["isp", "hit", "hit1", "miss", "rate"]
    assert len(rows) >= 1
