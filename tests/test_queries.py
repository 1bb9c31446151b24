"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke test."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.harness import compare, duck

from shopcube.plans.registry import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_per_unit" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    without = sorted(set(QUERIES) - set(ORACLES))
    assert without == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF001), con, ORACLES[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_one_pass_segment_equals_asof_path(spark):
    from shopcube.operators.history import customer_history, segment_as_of, segment_at_usage
    from shopcube.plans.model import Model
    m = Model(spark, SF001)
    a = segment_at_usage(m.usage, m.priced_orders)
    b = segment_as_of(m.usage, customer_history(m.priced_orders))
    key = lambda df: sorted(map(tuple, df.select("usage_key", "customer_segment_at_usage")  # noqa
                                .collect()))
    assert key(a) == key(b)
