"""Forecasts for many series at once, in blocks of series.

A series frame has `series_key`, `ds` and `y`, at most one row per day, so a
series is as long as the calendar and never as long as the data. The national
total is one series; towns and meters give as many as there are. Series are dealt
out by a hash of their key and come sorted; a task reads them off into blocks of
bounded size, whose numbers are worked out together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators import likelihood, seasonal
from wattline.operators.seasonal import HINGES

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HORIZON = 30
REVENUE_ORDER = (7, 1, 7)
# The orders that the model selection compares.
CANDIDATE_ORDERS = ((1, 1, 1), (2, 1, 2), (3, 1, 3), (5, 1, 2), (7, 1, 7))

#: Points of the series that are worked on together, unless one series has more.
BLOCK_POINTS = 1 << 16


def as_series(daily: DataFrame, value: str, date: str = "date", key: Column | None = None) -> DataFrame:
    """`series_key, ds, y` from a daily table; one series unless a key is given."""
    key = F.lit("all") if key is None else key.cast("string")
    return daily.select(key.alias("series_key"), F.col(date).alias("ds"), F.col(value).cast("double").alias("y"))


class Series(NamedTuple):
    """One series in order: days since 1970 and values of the points that have both."""

    key: str | None
    days: np.ndarray
    y: np.ndarray


def _read_off(batches: Iterator[pa.RecordBatch]) -> Iterator[Series]:
    """The series of a stream sorted by key and day; only the current one is held."""
    held: list[pa.RecordBatch] = []

    def series() -> Series:
        table = pa.Table.from_batches(held)
        days = table.column("ds").cast(pa.int32()).cast(pa.float64()).to_numpy()
        y = table.column("y").to_numpy()
        known = ~np.isnan(days) & ~np.isnan(y)
        return Series(held[0].column("series_key")[0].as_py(), days[known], y[known])

    for batch in batches:
        keys = batch.column("series_key").to_pylist()
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            if held and held[0].column("series_key")[0].as_py() != keys[low]:
                yield series()
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield series()


def _in_blocks(
    series: DataFrame, run: Callable[[list[Series]], list[dict]], schema: str, points: int = BLOCK_POINTS
) -> DataFrame:
    """The columns of `schema` that `run` gives for blocks of series."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"STRING": pa.string(), "DATE": pa.date32(), "DOUBLE": pa.float64(), "INT": pa.int32()}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]

    def result(block: list[Series]) -> pa.RecordBatch:
        parts = run(block)
        columns = [[v for part in parts for v in part[name]] for name in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[Series] = []
        for one in _read_off(batches):
            # A block is as wide as its longest series.
            longest = max([len(one.y), *[len(s.y) for s in block]])
            if block and (len(block) + 1) * longest > points:
                yield result(block)
                block = []
            block.append(one)
        if block:
            yield result(block)

    narrow = series.select(F.col("series_key").cast("string"), F.col("ds").cast("date"), F.col("y").cast("double"))
    # Few bytes can mean much work, so the number of tasks is not left to their size.
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return narrow.repartition(tasks, "series_key").sortWithinPartitions("series_key", "ds", "y").mapInArrow(work, schema)


def fill_gaps(series: DataFrame, value: float = 0.0) -> DataFrame:
    """Add the missing days between the first and the last of each series; a missing value is filled too.

    Every point is followed by the days up to the next one, so the series is read once and joined with nothing.
    """
    following = F.lead("ds").over(Window.partitionBy("series_key").orderBy("ds"))
    upto = F.greatest(F.date_sub(following, 1), F.col("ds"))
    filled = F.when(F.col("day") == F.col("ds"), F.coalesce("y", F.lit(value))).otherwise(F.lit(value))
    days = series.where(F.col("ds").isNotNull()).withColumn("upto", upto).withColumn("day", F.explode(F.sequence("ds", "upto")))
    return days.select("series_key", F.col("day").alias("ds"), filled.alias("y"))


def future_dates(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The `horizon` days after the last one of each series."""
    last = series.groupBy("series_key").agg(F.max("ds").alias("last"))
    span = F.sequence(F.date_add("last", 1), F.date_add("last", horizon))
    return last.select("series_key", F.explode(span).alias("ds"))


def holdout(series: DataFrame, n: int = HORIZON) -> DataFrame:
    """Mark the last `n` points of each series as the test part."""
    newest = Window.partitionBy("series_key").orderBy(F.desc("ds"))
    part = F.when(F.row_number().over(newest) <= n, "test").otherwise("train")
    return series.withColumn("split", part)


def seasonal_naive(series: DataFrame, lag: int = 7) -> DataFrame:
    """Forecast every point by the one `lag` rows before it."""
    w = Window.partitionBy("series_key").orderBy("ds")
    return series.withColumn("forecast", F.lag("y", lag).over(w))


def forecast_errors(df: DataFrame, keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """MAE, RMSE and MAPE (%) of `forecast` against `y`; a zero actual has no MAPE."""
    error = F.col("y") - F.col("forecast")
    return df.groupBy(*keys).agg(
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        F.round(F.avg(F.abs(F.try_divide(error, F.col("y")))) * 100, 6).alias("mape"),
    )


def _stable(coefficients: np.ndarray) -> np.ndarray:
    """Reflect explosive roots of 1 - c1 z - c2 z^2 - ... so that recursions die out."""
    if len(coefficients) == 0 or not np.any(coefficients):
        return coefficients
    roots = np.roots(np.concatenate([[1.0], -coefficients]))
    size = np.abs(roots)
    if np.all(size < 0.999):
        return coefficients
    roots = np.where(size >= 1.0, roots / np.maximum(size, 1e-12) ** 2, roots)
    size = np.abs(roots)
    roots = np.where(size >= 0.999, roots * (0.998 / np.maximum(size, 1e-12)), roots)
    return -np.real(np.poly(roots))[1:]


def _lags(x: np.ndarray, count: int, start: int) -> np.ndarray:
    return np.column_stack([x[start - k : len(x) - k] for k in range(1, count + 1)]) if count else np.empty((len(x) - start, 0))


def _least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] == 0:
        return np.empty(0)
    scale = np.trace(a.T @ a) / a.shape[1]
    return np.linalg.solve(a.T @ a + 1e-8 * (scale or 1.0) * np.eye(a.shape[1]), a.T @ b)


def _residuals(w: np.ndarray, ar: np.ndarray, ma: np.ndarray, mean: float) -> np.ndarray:
    """One-step errors of the recursion, with zeros before the first point."""
    p, q = len(ar), len(ma)
    centred = np.concatenate([np.zeros(p), w - mean])
    e = np.zeros(len(w) + q)
    for t in range(len(w)):
        past = centred[t : t + p][::-1]
        e[t + q] = centred[t + p] - ar @ past - ma @ e[t : t + q][::-1]
    return e[q:]


def fit_arima(y: np.ndarray, order: tuple[int, int, int]) -> dict:
    """Hannan-Rissanen: a long autoregression supplies the shocks, then least squares.

    Raises ValueError when the series is too short for the order.
    """
    p, d, q = order
    w = np.diff(y, n=d) if d else np.asarray(y, dtype=float)
    long_lag = max(p, q) + max(p + q, 7)
    if len(w) < long_lag + 2 * (p + q) + 5:
        raise ValueError(f"{len(y)} points are too few for order {order}")
    mean = 0.0 if d else float(w.mean())
    x = w - mean
    first = _least_squares(_lags(x, long_lag, long_lag), x[long_lag:])
    shocks = np.concatenate([np.zeros(long_lag), x[long_lag:] - _lags(x, long_lag, long_lag) @ first])
    start = long_lag + max(p, q)
    design = np.column_stack([_lags(x, p, start), _lags(shocks, q, start)])
    beta = _least_squares(design, x[start:])
    ar = _stable(beta[:p])
    ma = -_stable(-beta[p:])
    e = _residuals(w, ar, ma, mean)
    used = e[max(p, q) :]
    variance = max(float(np.mean(used**2)), 1e-300)
    k, n = p + q + 1 + (0 if d else 1), len(used)
    return {
        "order": order,
        "ar": ar,
        "ma": ma,
        "mean": mean,
        "residuals": e,
        "w": w,
        "aic": n * np.log(variance) + 2 * k,
        "bic": n * np.log(variance) + k * np.log(n),
    }


def predict_arima(y: np.ndarray, fit: dict, horizon: int) -> np.ndarray:
    """The days after `y` under `fit`."""
    p, d, q = fit["order"]
    if "ahead" in fit:
        out = fit["ahead"][:horizon] + fit["mean"]
    else:
        x = list(fit["w"] - fit["mean"])
        e = list(fit["residuals"])
        for _ in range(horizon):
            past = np.array(x[-p:][::-1]) if p else np.empty(0)
            shocks = np.array(e[-q:][::-1]) if q else np.empty(0)
            x.append(float(fit["ar"] @ past + fit["ma"] @ shocks))
            e.append(0.0)
        out = np.array(x[-horizon:]) + fit["mean"]
    for level in range(d - 1, -1, -1):
        out = np.diff(y, n=level)[-1] + np.cumsum(out)
    return out


def fit_block(ys: list[np.ndarray], order: tuple[int, int, int], horizon: int, exact: bool = True) -> list[dict | str]:
    """A fit of each series, or the reason why there is none.

    Hannan-Rissanen gives every series its start. With `exact` the search for the
    largest likelihood goes on from there, for all series of the block together;
    `loglik`, `aic` and `bic` are then those of the exact likelihood, `start` is
    the likelihood it began at.
    """
    out: list[dict | str] = []
    for y in ys:
        try:
            out.append(fit_arima(y, order))
        except (ValueError, np.linalg.LinAlgError) as reason:
            out.append(str(reason))
    fitted = [f for f in out if isinstance(f, dict)]
    if not exact or not fitted:
        return out
    p, d, q = order
    # Filtered at unit scale; a series that never moves keeps its own.
    scales = np.array([float(np.std(f["w"] - f["mean"])) or 1.0 for f in fitted])
    lengths = np.array([len(f["w"]) for f in fitted])
    x = np.zeros((len(fitted), int(lengths.max())))
    for row, f, scale in zip(x, fitted, scales, strict=True):
        row[: len(f["w"])] = (f["w"] - f["mean"]) / scale
    best = likelihood.fit_block(x, lengths, np.array([f["ar"] for f in fitted]), np.array([f["ma"] for f in fitted]))
    ahead, k = best.ahead(horizon) * scales[:, None], p + q + 1 + (0 if d else 1)
    for i, f in enumerate(fitted):
        loglik, begun = (float(v[i] - lengths[i] * np.log(scales[i])) for v in (best.loglik, best.start))
        f |= {
            "ar": best.ar[i],
            "ma": best.ma[i],
            "ahead": ahead[i],
            "start": begun,
            "loglik": loglik,
            "aic": -2 * loglik + 2 * k,
            "bic": -2 * loglik + k * np.log(lengths[i]),
        }
    return out


_ARIMA = "series_key STRING, ds DATE, forecast DOUBLE, p INT, d INT, q INT, status STRING"
FITTED = "fitted"


def forecast_arima(
    series: DataFrame, order: tuple[int, int, int] = REVENUE_ORDER, horizon: int = HORIZON, exact: bool = True
) -> DataFrame:
    """`series_key, ds, forecast, p, d, q, status` for the days after each series.

    Fitted by the exact likelihood, or else by least squares alone. The order is
    never changed: a series it cannot be fitted to gets NULL forecasts and the
    reason as its status. A series without any dated value has no days to forecast
    and one row with NULLs.
    """
    order = tuple(order)

    def run(block: list[Series]) -> list[dict]:
        known = [s for s in block if len(s.y)]
        fits = iter(fit_block([s.y for s in known], order, horizon, exact))
        out = []
        for s in block:
            days, values, status = [None], [None], "no values"
            if len(s.y):
                fit = next(fits)
                days = (int(s.days[-1]) + np.arange(1, horizon + 1)).tolist()
                values, status = [None] * horizon, fit
                if isinstance(fit, dict):
                    ahead = predict_arima(s.y, fit, horizon)
                    values, status = [float(v) if np.isfinite(v) else None for v in ahead], FITTED
            named = {"series_key": s.key, "status": status} | dict(zip("pdq", order, strict=True))
            out.append({"ds": days, "forecast": values} | {k: [v] * len(days) for k, v in named.items()})
        return out

    return _in_blocks(series, run, _ARIMA)


_MEASURES = ("aic", "bic", "mae", "rmse", "mape")
_SELECTION = "series_key STRING, p INT, d INT, q INT, aic DOUBLE, bic DOUBLE, mae DOUBLE, rmse DOUBLE, mape DOUBLE, status STRING"


def _measured(train: np.ndarray, test: np.ndarray, fit: dict) -> dict[str, float]:
    error = test - predict_arima(train, fit, len(test))
    share = np.abs(error[test != 0] / test[test != 0])
    return {
        "aic": fit["aic"],
        "bic": fit["bic"],
        "mae": np.mean(np.abs(error)),
        "rmse": np.sqrt(np.mean(error**2)),
        "mape": np.mean(share) * 100 if len(share) else np.nan,
    }


def select_arima(
    series: DataFrame,
    orders: Sequence[tuple[int, int, int]] = CANDIDATE_ORDERS,
    test_points: int = HORIZON,
    exact: bool = True,
) -> DataFrame:
    """Score each order on the last points of each series; `place` 1 is the best RMSE.

    Series and orders are dealt out together, so a single long series still uses
    several tasks. An order that cannot be fitted has NULL measures, the reason as
    its status and a place behind the others.
    """
    # An order is a prefix of the key, so that the orders of a series are series of their own.
    own = F.coalesce(F.concat(F.lit("="), F.col("series_key").cast("string")), F.lit(""))
    keys = F.array(*[F.concat(F.lit(f"{p} {d} {q} "), own) for p, d, q in orders])
    paired = series.select(F.explode(keys).alias("series_key"), "ds", "y")

    def run(block: list[Series]) -> list[dict]:
        by_order: dict[tuple[int, int, int], list[Series]] = {}
        for s in block:
            order, own = tuple(map(int, s.key.split(" ", 3)[:3])), s.key.split(" ", 3)[3]
            by_order.setdefault(order, []).append(s._replace(key=own[1:] if own else None))
        out = []
        for order, mine in by_order.items():
            fits = fit_block([s.y[:-test_points] for s in mine], order, test_points, exact)
            for s, fit in zip(mine, fits, strict=True):
                row = dict.fromkeys(_MEASURES) | dict(zip("pdq", order, strict=True)) | {"series_key": s.key, "status": fit}
                if isinstance(fit, dict):
                    found = _measured(s.y[:-test_points], s.y[-test_points:], fit)
                    row |= {"status": FITTED} | {k: float(v) if np.isfinite(v) else None for k, v in found.items()}
                out.append({k: [v] for k, v in row.items()})
        return out

    scored = _in_blocks(paired, run, _SELECTION)
    best = Window.partitionBy("series_key").orderBy(F.col("rmse").asc_nulls_last(), "p", "d", "q")
    return scored.withColumn("place", F.row_number().over(best))


def forecast_seasonal(
    series: DataFrame, horizon: int = HORIZON, hinges: int = HINGES, yearly: int = seasonal.YEARLY, weekly: int = seasonal.WEEKLY
) -> DataFrame:
    """Trend plus yearly and weekly cycles: `series_key, ds, yhat, yhat_lower, yhat_upper`.

    Every series gets the same `hinges` possible changes of trend, however short
    it is; most of them stay zero. The interval holds 80 % of simulated futures.
    See `seasonal` for the model. A series without any dated value has no rows.
    """

    def run(block: list[Series]) -> list[dict]:
        known = [s for s in block if len(s.y)]
        if not known:
            return []
        found = seasonal.forecast([s.key for s in known], [s.days for s in known], [s.y for s in known], horizon, hinges, yearly, weekly)
        out = []
        for s, values in zip(known, zip(*found, strict=True), strict=True):
            days = (int(s.days[-1]) + np.arange(1, horizon + 1)).tolist()
            columns = dict(zip(("yhat", "yhat_lower", "yhat_upper"), (v.tolist() for v in values), strict=True))
            out.append({"series_key": [s.key] * horizon, "ds": days} | columns)
        return out

    schema = "series_key STRING, ds DATE, yhat DOUBLE, yhat_lower DOUBLE, yhat_upper DOUBLE"
    return _in_blocks(series, run, schema)
