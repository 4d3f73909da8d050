import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.functions import quantiles as quantiles_module
from wattline.functions.quantiles import attach_scalars, exact_quantiles

POINTS = (0.0, 0.05, 0.08, 0.5, 0.9, 0.95, 0.98, 1.0)


def quantiles(df, accuracy=2000):
    wanted = {f"q{i}": ("x", p) for i, p in enumerate(POINTS)}
    return list(exact_quantiles(df, wanted, accuracy).first())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_small_inputs_equal_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantiles(df) == pytest.approx(list(np.quantile(values, POINTS)), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("accuracy", [20, 200, 2000])
@pytest.mark.parametrize("kind", ["spread", "ties", "hot"])
def test_large_inputs_stay_exact_at_any_accuracy(spark, accuracy, kind):
    value = {
        "spread": "pmod(xxhash64(id), 1000003) / 7.0D",
        "ties": "cast(pmod(xxhash64(id), 11) as double)",
        "hot": "case when id % 3 = 0 then 5.0D else pmod(xxhash64(id), 100003) / 9973.0D end",
    }[kind]
    df = spark.range(0, 120_000, numPartitions=16).selectExpr(f"{value} as x")
    want = np.quantile(np.array([r.x for r in df.collect()]), POINTS)
    assert quantiles(df, accuracy) == pytest.approx(list(want), rel=1e-13)


def test_nulls_and_nan_are_skipped(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (3.0,)], "x double")
    assert exact_quantiles(df, {"m": ("x", 0.5)}).first().m == 2.0


def test_no_values_give_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"m": ("x", 0.5)}).first().m is None


def test_ties_return_the_value_itself(spark):
    df = spark.createDataFrame([(0.1,)] * 20, "x double")
    assert exact_quantiles(df, {"m": ("x", 0.95)}).first().m == 0.1


def test_attached_scalars_need_no_join(spark):
    df = spark.range(10)
    out = attach_scalars(df, df.agg(F.max("id").alias("top"))).select("id", "stats.top")
    assert {r.top for r in out.collect()} == {9}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", [1, 50, 5_000])
@pytest.mark.parametrize("kind", ["spread", "ties", "hot", "wide"])
def test_narrowing_to_any_size_gives_the_same(spark, kind, limit):
    value = {
        "spread": "pmod(xxhash64(id), 1000003) / 7.0D",
        "ties": "cast(pmod(xxhash64(id), 11) as double)",
        "hot": "case when id % 3 = 0 then 5.0D else pmod(xxhash64(id), 100003) / 9973.0D end",
        "wide": "pow(10.0D, pmod(xxhash64(id), 600) - 300) * if(id % 2 = 0, 1, -1)",
    }[kind]
    df = spark.range(0, 30_000, numPartitions=8).selectExpr(f"{value} as x", "cast(id as double) as y").cache()
    wanted = {f"q{i}": ("x", p) for i, p in enumerate(POINTS)} | {"y": ("y", 0.3)}
    want = [*np.quantile(np.array([r.x for r in df.collect()]), POINTS), 0.3 * 29_999]
    assert list(exact_quantiles(df, wanted, 40, limit).first()) == pytest.approx(want, rel=1e-12)
    df.unpersist()


def test_no_more_values_are_read_than_the_limit(spark, monkeypatch):
    """However large the column, what is read at last has at most `limit` rows, and few rounds lead there."""
    read, rounds = [], []
    plain_read, plain_narrowed = quantiles_module._read, quantiles_module._narrowed
    monkeypatch.setattr(quantiles_module, "_read", lambda df, cells: read.extend(c.rows for c in cells) or plain_read(df, cells))
    monkeypatch.setattr(quantiles_module, "_narrowed", lambda *a: rounds.append(1) or plain_narrowed(*a))
    df = spark.range(0, 1_000_000, numPartitions=8).selectExpr("(id * 7919 % 1000003) / 3.0D as x")
    got = exact_quantiles(df, {"a": ("x", 0.95), "b": ("x", 0.05)}, limit=1_000).first()
    values = np.arange(1_000_000) * 7919 % 1_000_003 / 3.0
    assert list(got) == pytest.approx(list(np.quantile(values, [0.95, 0.05])), rel=1e-13)
    assert all(n <= 1_000 for n in read) and len(rounds) <= 2
