"""Every registered query against its SQL twin, value by value."""

import pytest
from compare import duck, mismatch

import __spark_entry__ as driver
from wattline.plans.oracles import ORACLES
from wattline.plans.queries import QUERIES

ROWS_ONLY = {
    "forecast_revenue",
    "model_selection",
    "forecast_units",
}


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_only_models_go_without_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, small, name):
    assert mismatch(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 50
    scores = [r.risk_score for r in df.collect()]
    assert scores == sorted(scores, reverse=True)
