"""Every registered query against its DuckDB oracle on the smallest test tables.

(The driver runs the same comparison at sf0.01: ``python -m tests.compare``.)
"""

import pytest

from __spark_entry__ import entry, oracle_sql
from holdwise.plans.registry import QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == [
        "sk_product", "sk_date", "acc_units", "acc_total_cost_brl", "acc_avg_cost_brl",
        "total_market_value_brl", "market_value_per_unit_brl",
    ]
    assert df.count() > 0
