"""Trend with sparse changes, yearly and weekly cycles, for a block of series at once.

After Taylor and Letham, "Forecasting at Scale", 2018. The level and the slope of a
series are free, cycles shrink by a squared penalty, and possible changes of the
slope, on a grid over the first four fifths of the history, by an absolute one, so
that most of them are exactly zero. The free and the squared part are solved out of the
normal equations of all series together; coordinate descent then goes over the
changes alone, each step one operation on the whole block.

The interval simulates the future: changes of the slope come as often as the grid
had places and as large as those found, on top of the errors of the fit. Random
numbers follow from the series key and the seed, so neither blocks nor tasks matter.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

YEARLY, WEEKLY, HINGES = 10, 3, 25
#: How large a change of slope is expected to be, for values of unit spread over a history of length one, and the penalty
#: on the square of a cycle's height. A change costs its size times the variance of the errors over the size expected.
CHANGE_SCALE, CYCLE_PENALTY = 0.25, 0.1
#: A series with this many points for each coefficient has its variance from a fit whose changes are nearly free; a shorter
#: one from the fit without changes, since it could follow every point.
ENOUGH, NEARLY_FREE = 2, 1e-6
#: Share of the history that may hold changes.
CHANGING = 0.8
SWEEPS, TOLERANCE = 1000, 1e-9
PATHS, SEED, COVERED = 1000, 42, 0.8
#: Standard normal value that a share of COVERED lies within, two-sided.
INTERVAL_Z = 1.2815515655446004


def design(days: np.ndarray, start: np.ndarray, span: np.ndarray, hinges: int, yearly: int, weekly: int) -> np.ndarray:
    """(series, day, column): level, slope, cycles, and behind them the changes of slope."""
    t = (days - start[:, None]) / span[:, None]
    columns = [np.ones_like(t), t]
    for period, terms in ((365.25, yearly), (7.0, weekly)):
        for k in range(1, terms + 1):
            angle = 2.0 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    columns += [np.maximum(0.0, t - h) for h in turns(hinges)]
    return np.stack(columns, axis=2)


def turns(hinges: int) -> np.ndarray:
    """Where the slope may change, as shares of the history."""
    return np.linspace(0.0, CHANGING, hinges + 2)[1:-1]


def _descended(g: np.ndarray, c: np.ndarray, delta: np.ndarray, penalty: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The changes with the least penalised squares under the normal equations (g, c), by coordinate descent from `delta`."""
    delta, diagonal = delta.copy(), np.einsum("sjj->sj", g)
    usable = diagonal > least[:, None]
    step = np.where(usable, 1.0 / np.where(usable, diagonal, 1.0), 0.0)
    open_ = np.arange(len(c))
    for _ in range(SWEEPS):
        now = delta[open_]
        before, own_g, own_c, own_step, own_d = now.copy(), g[open_], c[open_], step[open_], diagonal[open_]
        for j in range(c.shape[1]):
            rest = own_c[:, j] - np.einsum("sk,sk->s", own_g[:, j], now) + own_d[:, j] * now[:, j]
            now[:, j] = np.sign(rest) * np.maximum(np.abs(rest) - penalty[open_], 0.0) * own_step[:, j]
        delta[open_] = now
        open_ = open_[np.abs(now - before).max(axis=1) > TOLERANCE]
        if not len(open_):
            break
    return delta


def fit(x: np.ndarray, y: np.ndarray, hinges: int, expected: float = CHANGE_SCALE, cycles: float = CYCLE_PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(series, column) coefficients with the least penalised squares, and each series' penalty on its changes of slope.

    Least half the squared errors, plus `cycles` times half the squared heights of
    the cycles, plus the penalty times the absolute changes of slope. Rows of zeros
    in `x` and `y` do not count.
    """
    smooth = x.shape[2] - hinges
    gram, cross = x.transpose(0, 2, 1) @ x, (x.transpose(0, 2, 1) @ y[:, :, None])[:, :, 0]
    points, ridge = gram[:, 0, 0], np.full(smooth, cycles)
    # Level and slope are free; a trace of a penalty keeps a series of one day solvable.
    ridge[:2] = 0.0
    a = gram[:, :smooth, :smooth] + np.diag(ridge) + 1e-12 * np.eye(smooth) * points[:, None, None]
    mixed = gram[:, :smooth, smooth:]
    solved = np.linalg.solve(a, np.concatenate([cross[:, :smooth, None], mixed], axis=2))
    own, carried = solved[:, :, 0], solved[:, :, 1:]
    # What the changes explain beyond everything smooth.
    g = gram[:, smooth:, smooth:] - mixed.transpose(0, 2, 1) @ carried
    c = cross[:, smooth:] - (mixed.transpose(0, 2, 1) @ own[:, :, None])[:, :, 0]

    def with_changes(delta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        beta = np.concatenate([own - (carried @ delta[:, :, None])[:, :, 0], delta], axis=1)
        return beta, ((y - (x @ beta[:, :, None])[:, :, 0]) ** 2).sum(axis=1)

    beta, squares = with_changes(np.zeros_like(c))
    if not hinges:
        return beta, np.zeros(len(y))
    free = np.linalg.solve(g + NEARLY_FREE * np.eye(hinges) * points[:, None, None], c[:, :, None])[:, :, 0]
    enough = points > ENOUGH * x.shape[2]
    left = np.where(enough, with_changes(free)[1] / np.where(enough, points - x.shape[2], 1.0), squares / points)
    penalty = left / expected
    return with_changes(_descended(g, c, np.zeros_like(c), penalty, 1e-9 * points))[0], penalty


def half_widths(key: str | None, size: float, span: float, horizon: int, hinges: int, error: float, paths: int = PATHS) -> np.ndarray:
    """How far from the line a share of COVERED of simulated futures stays, for every day ahead.

    Changes of slope come at the rate of the grid and with the mean absolute size
    given. A future and its mirror image are equally likely, so one bound serves both sides.
    """
    draw = np.random.default_rng(int(hashlib.md5(f"{SEED}|{key}".encode()).hexdigest()[:15], 16))
    ahead = np.arange(1, horizon + 1) / span
    many = draw.poisson(hinges * ahead[-1], paths)
    path = np.repeat(np.arange(paths), many)
    at, change = draw.uniform(0.0, ahead[-1], many.sum()), draw.laplace(0.0, size, many.sum())
    away = error * draw.normal(size=(paths, horizon))
    np.add.at(away, path, change[:, None] * np.maximum(0.0, ahead[None, :] - at[:, None]))
    return np.quantile(np.abs(away), COVERED, axis=0)


def forecast(
    keys: Sequence[str | None],
    days: Sequence[np.ndarray],
    ys: Sequence[np.ndarray],
    horizon: int,
    hinges: int = HINGES,
    yearly: int = YEARLY,
    weekly: int = WEEKLY,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(series, day) forecasts and their lower and upper bounds for the days after each series."""
    lengths = np.array([len(y) for y in ys])
    most = int(lengths.max())
    here = np.arange(most)[None, :] < lengths[:, None]
    day, y = np.zeros((len(ys), most)), np.zeros((len(ys), most))
    day[here], y[here] = np.concatenate(days), np.concatenate(ys)
    start = np.array([d[0] for d in days])
    span = np.maximum(np.array([d[-1] for d in days]) - start, 1.0)
    level = y.sum(axis=1) / lengths
    spread = np.sqrt(np.where(here, (y - level[:, None]) ** 2, 0.0).sum(axis=1) / lengths)
    scale = np.where(spread > 0, spread, 1.0)
    unit = np.where(here, (y - level[:, None]) / scale[:, None], 0.0)
    x = design(day, start, span, hinges, yearly, weekly) * here[:, :, None]
    beta, _ = fit(x, unit, hinges)
    off = np.where(here, unit - (x @ beta[:, :, None])[:, :, 0], 0.0)
    error = np.sqrt((off**2).sum(axis=1) / lengths)
    ahead = np.array([d[-1] for d in days])[:, None] + np.arange(1, horizon + 1)[None, :]
    yhat = (design(ahead, start, span, hinges, yearly, weekly) @ beta[:, :, None])[:, :, 0]
    lower = yhat - INTERVAL_Z * error[:, None]
    upper = yhat + INTERVAL_Z * error[:, None]
    size = np.abs(beta[:, -hinges:]).mean(axis=1) if hinges else np.zeros(len(ys))
    # Without any change found the errors alone make the interval, and need no simulation.
    for i in np.flatnonzero(size > 0):
        wide = half_widths(keys[i], size[i], span[i], horizon, hinges, error[i])
        lower[i], upper[i] = yhat[i] - wide, yhat[i] + wide
    return tuple(v * scale[:, None] + level[:, None] for v in (yhat, lower, upper))
