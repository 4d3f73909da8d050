import datetime

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattline.operators import forecast, likelihood, seasonal

START = datetime.date(2022, 1, 1)


def series(spark, **values):
    data = [
        (key, START + datetime.timedelta(days=i), float(v)) for key, ys in values.items() for i, v in enumerate(ys)
    ]
    return spark.createDataFrame(data, "series_key string, ds date, y double")


def ar1(n, phi, seed=1):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + rng.normal()
    return y


def test_recovers_a_known_coefficient():
    fit = forecast.fit_arima(ar1(4000, 0.7), (1, 0, 0))
    assert fit["ar"][0] == pytest.approx(0.7, abs=0.05)


def test_recovers_a_moving_average():
    rng = np.random.default_rng(3)
    e = rng.normal(size=6000)
    fit = forecast.fit_arima(e[1:] + 0.5 * e[:-1], (0, 0, 1))
    assert fit["ma"][0] == pytest.approx(0.5, abs=0.06)


def test_information_criteria_prefer_the_true_order():
    y = ar1(3000, 0.7)
    assert forecast.fit_arima(y, (1, 0, 0))["bic"] < forecast.fit_arima(y, (5, 0, 2))["bic"]


def test_trend_beats_repeating_last_week(spark):
    rng = np.random.default_rng(5)
    y = 100 + 2.0 * np.arange(400) + rng.normal(size=400)
    ahead = forecast.forecast_arima(series(spark, a=y[:-30]), (1, 1, 1)).orderBy("ds").collect()
    error = np.abs(np.array([r.forecast for r in ahead]) - y[-30:]).mean()
    naive = np.abs(np.resize(y[-37:-30], 30) - y[-30:]).mean()
    assert len(ahead) == 30 and error < naive


def test_weekly_cycle_is_found(spark):
    week = np.array([5.0, 1, 2, 3, 4, 8, 9])
    y = np.tile(week, 60)
    got = forecast.forecast_seasonal(series(spark, a=y)).orderBy("ds").collect()
    want = np.resize(week, 450)[420:]
    assert len(got) == 30
    assert np.abs(np.array([r.yhat for r in got]) - want).max() < 0.3
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in got)


def test_many_series_side_by_side(spark):
    df = series(spark, a=ar1(200, 0.5), b=ar1(300, 0.2, 7), c=[4.0], d=[1.0, 2.0, 3.0])
    for got in (forecast.forecast_arima(df), forecast.forecast_seasonal(df)):
        assert dict(rows(got.groupBy("series_key").count())) == dict.fromkeys("abcd", 30)
    assert forecast.forecast_seasonal(df).filter("isnan(yhat) or yhat is null").isEmpty()


def test_the_asked_order_or_no_forecast(spark):
    df = series(spark, a=ar1(200, 0.5), b=ar1(20, 0.2), c=[4.0]).unionByName(
        spark.createDataFrame([("d", None, 1.0)], "series_key string, ds date, y double")
    )
    got = forecast.forecast_arima(df, (7, 1, 7))
    assert {tuple(r) for r in got.select("p", "d", "q").distinct().collect()} == {(7, 1, 7)}
    by_key = {r.series_key: r for r in got.groupBy("series_key").agg(
        F.count("*").alias("n"), F.count("forecast").alias("known"), F.min("ds").alias("ds"), F.max("status").alias("status")
    ).collect()}
    assert [(by_key[k].n, by_key[k].known) for k in "abcd"] == [(30, 30), (30, 0), (30, 0), (1, 0)]
    assert by_key["a"].status == forecast.FITTED and "too few" in by_key["b"].status and by_key["d"].status == "no values"
    assert by_key["c"].ds == START + datetime.timedelta(days=1)


def test_trend_changes_do_not_depend_on_the_length(spark):
    for n in (1, 20, 300):
        x = seasonal.design(np.arange(float(n))[None], np.zeros(1), np.array([max(n - 1.0, 1.0)]), 25, 10, 3)
        assert x.shape == (1, n, 2 + 26 + 25)
    turning = series(spark, a=ar1(60, 0.5) + np.abs(np.arange(60) - 20))
    few, many = forecast.forecast_seasonal(turning, hinges=2, yearly=0), forecast.forecast_seasonal(turning, yearly=0)
    assert few.count() == many.count() == 30 and not few.exceptAll(many).isEmpty()


def test_penalised_fit_is_optimal():
    """At the least penalised squares no coefficient can be moved either way for the better."""
    rng = np.random.default_rng(2)
    days, y = np.tile(np.arange(200.0), (3, 1)), rng.normal(size=(3, 200)).cumsum(axis=1) / 5
    x = seasonal.design(days, np.zeros(3), np.full(3, 199.0), 8, 2, 1)
    beta, penalty = seasonal.fit(x, y, 8, expected=2.0, cycles=0.1)
    off = y - (x @ beta[:, :, None])[:, :, 0]
    slope = (x.transpose(0, 2, 1) @ off[:, :, None])[:, :, 0]
    assert np.abs(slope[:, :2]).max() < 1e-6
    assert np.abs(slope[:, 2:8] - 0.1 * beta[:, 2:8]).max() < 1e-6
    delta = beta[:, 8:]
    zero = delta == 0
    assert zero.any() and (~zero).any()
    bound = np.tile(penalty[:, None], (1, 8))
    assert np.all(np.abs(slope[:, 8:][zero]) <= bound[zero] + 1e-6)
    assert np.abs(slope[:, 8:][~zero] - bound[~zero] * np.sign(delta[~zero])).max() < 1e-5


def test_few_changes_are_found_where_they_are():
    t = np.arange(300.0)
    y = 0.1 * t + 0.5 * np.maximum(0, t - 150) + np.random.default_rng(3).normal(size=300)
    x = seasonal.design(t[None], np.zeros(1), np.array([299.0]), 25, 0, 0)
    delta = seasonal.fit(x, ((y - y.mean()) / y.std())[None], 25)[0][0, 2:]
    turns = seasonal.turns(25)[np.abs(delta) > 1e-3]
    assert 1 <= len(turns) <= 6 and np.abs(turns - 0.5).min() < 0.05


def test_intervals_widen_and_cover():
    """About four fifths of the days held out lie inside; the further ahead, the wider."""
    rng, inside, ratio = np.random.default_rng(4), [], []
    ys = []
    for _ in range(150):
        changes = (rng.random(330) < 0.03) & ((np.arange(330) < 240) | (np.arange(330) >= 300))
        slope = np.cumsum(np.where(changes, rng.laplace(0, 0.1, 330), 0.0))
        ys.append(np.cumsum(slope) + rng.normal(size=330))
    days = [np.arange(300.0)] * 150
    yhat, low, high = seasonal.forecast([str(i) for i in range(150)], days, [y[:300] for y in ys], 30, yearly=0, weekly=0)
    future = np.array([y[300:] for y in ys])
    inside = ((low <= future) & (future <= high)).mean()
    assert 0.65 <= inside <= 0.93
    wide = (high - low).mean(axis=0)
    assert wide[-1] > 1.1 * wide[0] and np.all(low <= yhat) and np.all(yhat <= high)


def test_blocks_do_not_change_a_series(spark):
    df = series(spark, **{f"s{i}": ar1(40 + i, 0.5, i) + 0.2 * np.arange(40 + i) for i in range(12)})
    frames = []
    for points in (1, 300, 1 << 16):
        known = [s for s in sorted(df.select("series_key").distinct().collect())]
        assert len(known) == 12
        run = lambda block: [
            {"series_key": [s.key], "yhat": [float(v[0])]}
            for s, v in zip(block, seasonal.forecast([s.key for s in block], [s.days for s in block], [s.y for s in block], 5)[1])
        ]
        frames.append(rows(forecast._in_blocks(df, run, "series_key STRING, yhat DOUBLE", points), "series_key"))
    assert all(abs(a[1] - b[1]) < 1e-8 for other in frames[1:] for a, b in zip(frames[0], other))
    assert [r[0] for r in frames[0]] == [r[0] for r in frames[2]]


def dense(x, ar, ma):
    """Log-likelihood with the best variance from the full covariance matrix."""
    n, psi = len(x), np.zeros(3000)
    for i in range(3000):
        psi[i] = (1.0 if i == 0 else ma[i - 1] if i <= len(ma) else 0.0) + sum(ar[j] * psi[i - 1 - j] for j in range(min(len(ar), i)))
    auto = np.array([psi[: 3000 - h] @ psi[h:] for h in range(n)])
    cov = auto[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    variance = x @ np.linalg.solve(cov, x) / n
    return -0.5 * (n * np.log(2 * np.pi * variance) + np.linalg.slogdet(cov)[1] + n)


def test_filter_gives_the_exact_likelihood():
    x = np.random.default_rng(0).normal(size=(3, 60))
    lengths = np.array([60, 41, 20])
    partial_ar = np.array([[0.6, -0.3, 0.2], [0.1, 0.1, 0.9], [0.0, 0.0, 0.0]])
    partial_ma = np.array([[0.5, 0.2], [-0.7, 0.1], [0.99, 0.0]])
    ar, ma = likelihood.coefficients(partial_ar), -likelihood.coefficients(partial_ma)
    found = likelihood.kalman(x, lengths, ar, ma).loglik
    want = [dense(x[i, : lengths[i]], ar[i], ma[i]) for i in range(3)]
    assert found == pytest.approx(want, rel=1e-9)
    assert likelihood.partials(ar) == pytest.approx(partial_ar, abs=1e-12)


def simulated(n, seed):
    ar = likelihood.coefficients(np.array([[0.5, -0.3, 0.2, 0.1, -0.2, 0.1, 0.4]]))[0]
    ma = -likelihood.coefficients(np.array([[0.3, 0.2, -0.1, 0.2, 0.1, -0.2, 0.3]]))[0]
    rng, y = np.random.default_rng(seed), np.zeros(n + 300)
    e = rng.normal(size=n + 300)
    for t in range(7, n + 300):
        y[t] = ar @ y[t - 7 : t][::-1] + e[t] + ma @ e[t - 7 : t][::-1]
    return np.cumsum(y[300:]), ar, ma


def test_search_never_ends_below_its_start():
    ys, truths = zip(*[(y, (ar, ma)) for y, ar, ma in (simulated(500 + 40 * i, i) for i in range(4))])
    fits = forecast.fit_block(list(ys), (7, 1, 7), 30)
    for y, (ar, ma), fit in zip(ys, truths, fits):
        w = np.diff(y)
        true = likelihood.kalman(w[None], np.array([len(w)]), ar[None], ma[None]).loglik[0]
        assert fit["loglik"] >= fit["start"] - 1e-6 and fit["loglik"] > true - 1
        assert fit["aic"] == pytest.approx(-2 * fit["loglik"] + 30) and len(fit["ahead"]) == 30
        assert fit["bic"] == pytest.approx(-2 * fit["loglik"] + 15 * np.log(len(w)))
        own = likelihood.kalman(w[None], np.array([len(w)]), fit["ar"][None], fit["ma"][None]).loglik[0]
        assert own == pytest.approx(fit["loglik"], rel=1e-8)


def test_a_block_equals_its_series_alone():
    ys = [simulated(n, n)[0] for n in (300, 420, 350)]
    together = forecast.fit_block([*ys, np.ones(5)], (1, 1, 1), 10)
    assert isinstance(together[3], str) and "too few" in together[3]
    for y, fit in zip(ys, together):
        (alone,) = forecast.fit_block([y], (1, 1, 1), 10)
        assert fit["loglik"] == pytest.approx(alone["loglik"], rel=1e-6)
        assert forecast.predict_arima(y, fit, 10) == pytest.approx(forecast.predict_arima(y, alone, 10), rel=1e-2)


def test_a_series_without_movement_is_fitted():
    (fit,) = forecast.fit_block([np.full(60, 4.0)], (1, 1, 1), 5)
    assert forecast.predict_arima(np.full(60, 4.0), fit, 5) == pytest.approx([4.0] * 5)


def test_selection_has_every_order_of_every_series(spark):
    ranked = forecast.select_arima(series(spark, a=ar1(400, 0.6), b=ar1(50, 0.5), c=[1.0])).collect()
    for key in "abc":
        mine = sorted((r for r in ranked if r.series_key == key), key=lambda r: r.place)
        assert [r.place for r in mine] == [1, 2, 3, 4, 5]
        assert {(r.p, r.d, r.q) for r in mine} == set(forecast.CANDIDATE_ORDERS)
        known = [r.rmse for r in mine if r.rmse is not None]
        assert known == sorted(known) and [r.rmse for r in mine][: len(known)] == known
        assert all((r.rmse is None) == (r.status != forecast.FITTED) for r in mine)
    assert all(r.rmse is None for r in ranked if r.series_key == "c")


def test_forecast_does_not_depend_on_partitions(spark):
    df = series(spark, a=ar1(200, 0.5), b=ar1(300, 0.2, 7))
    one = forecast.forecast_arima(df.repartition(1)).select("series_key", "ds", F.round("forecast", 9))
    many = forecast.forecast_arima(df.repartition(9)).select("series_key", "ds", F.round("forecast", 9))
    assert one.exceptAll(many).isEmpty()


def test_errors_skip_a_zero_actual(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 4.0, 3.0)], "series_key string, y double, forecast double")
    assert rows(forecast.forecast_errors(df)) == [("a", 1.0, 1.0, 25.0)]


def test_holdout_and_gaps(spark):
    df = series(spark, a=range(40), b=range(5))
    counts = dict(rows(forecast.holdout(df).filter("split = 'test'").groupBy("series_key").count()))
    assert counts == {"a": 30, "b": 5}
    gappy = df.filter("series_key = 'a' and y not in (3, 4)")
    filled = forecast.fill_gaps(gappy)
    assert filled.count() == 40 and filled.filter("y = 0").count() == 3


def test_future_days(spark):
    got = forecast.future_dates(series(spark, a=range(3)), 2)
    assert rows(got) == [("a", datetime.date(2022, 1, 4)), ("a", datetime.date(2022, 1, 5))]


def test_explosive_roots_are_tamed():
    for raw in ([1.4], [0.5, 0.9], [-2.0, -1.5, 0.3]):
        kept = forecast._stable(np.array(raw))
        assert np.all(np.abs(np.roots(np.concatenate([[1.0], -kept]))) < 1.0)
