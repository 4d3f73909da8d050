"""Exact Gaussian likelihood of ARMA models, for a block of series at once.

A Kalman filter over the state space form of an ARMA(p, q) process starts from its
stationary distribution and runs over the days of all series of a block together,
every step a few array operations whatever the number of series. The search for the largest likelihood moves partial autocorrelations through a
hyperbolic tangent, so every point it tries is stationary and invertible; it is a
quasi-Newton search with a bounded number of steps that accepts improvements only.

A lane is one series under one set of coefficients. Series of different lengths stand side by side from their first
day on; a lane is left alone after its last day.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEARCH_STEPS = 40
#: The search ends where a step adds less than this to the log-likelihood.
ENOUGH = 1e-3
#: Lanes filtered in one call.
LANES = 512
_STEADY, _EVERY = 1e-15, 16
_LARGEST = 0.9999
_STRETCHES = (1.0, 0.3, 0.08, 0.01)


def coefficients(partial: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients of lanes of partial autocorrelations, by the Durbin-Levinson recursion."""
    lanes, p = partial.shape
    phi = np.zeros((lanes, p))
    for k in range(p):
        own = partial[:, k : k + 1]
        phi[:, :k] -= own * phi[:, :k][:, ::-1].copy()
        phi[:, k : k + 1] = own
    return phi


def partials(phi: np.ndarray) -> np.ndarray:
    """The inverse of `coefficients`, for stationary lanes."""
    phi, out = phi.copy(), np.zeros_like(phi)
    for k in range(phi.shape[1] - 1, -1, -1):
        out[:, k] = np.clip(phi[:, k], -_LARGEST, _LARGEST)
        own = out[:, k : k + 1]
        phi[:, :k] = (phi[:, :k] + own * phi[:, :k][:, ::-1]) / (1 - own**2)
    return out


@dataclass
class Filtered:
    """Log-likelihood with the best variance, that variance, and the state expected after the last day."""

    loglik: np.ndarray
    variance: np.ndarray
    state: np.ndarray


def _stationary(phi: np.ndarray, shock: np.ndarray) -> np.ndarray:
    """Covariance P with P = T P T' + shock shock', by doubling the number of days it has built up over."""
    lanes, r = phi.shape
    move = np.zeros((lanes, r, r))
    move[:, :, 0] = phi
    move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    p = shock[:, :, None] * shock[:, None, :]
    for _ in range(40):
        step = move @ p @ move.transpose(0, 2, 1)
        p = p + step
        if np.abs(step).max() <= 1e-13 * np.abs(p).max():
            break
        move = move @ move
    return p


def _moved(phi: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The state a day later, without a shock; the first axis is the state's."""
    out = phi * state[0]
    out[:-1] += state[1:]
    return out


def kalman(x: np.ndarray, lengths: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> Filtered:
    """Filter lanes of `x` (lane, day), each up to its length, under their coefficients.

    The covariance starts at rest, so a day changes it by one column times itself;
    only that column, its weight, the spread of the next value and the gain are
    carried on (Morf, Sidhu, Kailath, 1974), which is the same filter.
    """
    lanes, days = x.shape
    r = max(ar.shape[1], ma.shape[1] + 1)
    phi, shock = np.zeros((lanes, r)), np.zeros((lanes, r))
    phi[:, : ar.shape[1]], shock[:, 0], shock[:, 1 : 1 + ma.shape[1]] = ar, 1.0, ma
    p, phi = _stationary(phi, shock), np.ascontiguousarray(phi.T)
    spread = p[:, 0, 0].copy()
    gain = _moved(phi, np.ascontiguousarray(p[:, :, 0].T)) / spread
    column, weight, state, steady = gain.copy(), -spread, np.zeros((r, lanes)), False
    shortest = int(lengths.min())
    offs, spreads, across = np.empty((days, lanes)), np.empty((days, lanes)), np.ascontiguousarray(x.T)
    for t in range(days):
        off = across[t] - state[0]
        offs[t], spreads[t] = off, spread
        new = _moved(phi, state)
        new += gain * off
        state = new if t < shortest else np.where(t < lengths, new, state)
        if steady:
            continue
        first = column[0]
        share = first * weight
        moved = _moved(phi, column)
        less = first * share
        later = spread + less
        gain = (gain * spread + moved * share) / later
        column = moved - gain * first
        weight = weight + share * share / spread
        spread = later
        if t % _EVERY == 0:
            steady = bool(np.abs(less).max() <= _STEADY)
    here = np.arange(days)[:, None] < lengths
    squares = np.where(here, offs * offs / spreads, 0.0).sum(axis=0)
    logs = np.where(here, np.log(spreads), 0.0).sum(axis=0)
    variance = np.maximum(squares / lengths, 1e-300)
    return Filtered(-0.5 * (lengths * (np.log(2 * np.pi * variance) + 1) + logs), variance, state.T)


@dataclass
class Fitted:
    """Coefficients of a block's lanes, the likelihood at the start of the search and at its end, and the last state."""

    ar: np.ndarray
    ma: np.ndarray
    start: np.ndarray
    loglik: np.ndarray
    variance: np.ndarray
    state: np.ndarray

    def ahead(self, horizon: int) -> np.ndarray:
        """Expected values of the days after each lane's last one."""
        phi = np.zeros_like(self.state)
        phi[:, : self.ar.shape[1]] = self.ar
        out, state = np.zeros((len(phi), horizon)), self.state.T
        for h in range(horizon):
            out[:, h] = state[0]
            state = _moved(phi.T, state)
        return out


def _cost(x: np.ndarray, lengths: np.ndarray, points: np.ndarray, p: int) -> np.ndarray:
    """Negative log-likelihood per day of every series at its points (series, point, parameter)."""
    series, many, k = points.shape
    out, most = np.zeros((series, many)), max(1, LANES // many)
    for start in range(0, series, most):
        part = slice(start, start + most)
        unbound = np.tanh(points[part].reshape(len(x[part]) * many, k))
        rows, n = np.repeat(x[part], many, axis=0), np.repeat(lengths[part], many)
        found = kalman(rows, n, coefficients(unbound[:, :p]), -coefficients(unbound[:, p:]))
        out[part] = (-found.loglik / n).reshape(-1, many)
    return np.nan_to_num(out, nan=np.inf, posinf=np.inf)


def fit_block(x: np.ndarray, lengths: np.ndarray, ar: np.ndarray, ma: np.ndarray, steps: int = SEARCH_STEPS) -> Fitted:
    """The best coefficients that `steps` steps of the search find for each series, from those given on.

    A series whose likelihood no longer rises is left where it is, so the end is never below the start.
    """
    p, k = ar.shape[1], ar.shape[1] + ma.shape[1]
    point = np.arctanh(np.concatenate([partials(ar), partials(-ma)], axis=1))
    begun = best = _cost(x, lengths, point[:, None, :], p)[:, 0]
    inverse, gradient, open_ = np.tile(np.eye(k), (len(x), 1, 1)), None, np.full(len(x), k > 0)
    nudge = 1e-6
    for _ in range(steps):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        slope = (_cost(x[at], lengths[at], point[at, None, :] + nudge * np.eye(k)[None], p) - best[at, None]) / nudge
        slope = np.where(np.isfinite(slope), slope, 0.0)
        if gradient is not None:
            moved, change = point[at] - last_point[at], slope - gradient[at]
            curved = (moved * change).sum(axis=1)
            inverse[at] = _updated(inverse[at], moved, change, curved)
        else:
            gradient, last_point = np.zeros_like(point), point.copy()
        gradient[at], last_point[at] = slope, point[at]
        way = -(inverse[at] @ slope[:, :, None])[:, :, 0]
        uphill = (way * slope).sum(axis=1) >= 0
        inverse[at[uphill]], way[uphill] = np.eye(k), -slope[uphill]
        # No step moves a parameter further than one, where the tangent is flat.
        way /= np.maximum(1.0, np.abs(way).max(axis=1))[:, None]
        ends = point[at, None, :] + np.array(_STRETCHES)[None, :, None] * way[:, None, :]
        costs = _cost(x[at], lengths[at], ends, p)
        choice = costs.argmin(axis=1)
        cost = costs[np.arange(len(at)), choice]
        better = cost < best[at]
        point[at[better]] = ends[better, choice[better]]
        open_[at[~better | ((best[at] - cost) * lengths[at] < ENOUGH)]] = False
        best = best.copy()
        best[at[better]] = cost[better]
    unbound = np.tanh(point)
    ar, ma = coefficients(unbound[:, :p]), -coefficients(unbound[:, p:])
    end = kalman(x, lengths, ar, ma)
    return Fitted(ar, ma, -begun * lengths, end.loglik, end.variance, end.state)


def _updated(inverse: np.ndarray, moved: np.ndarray, change: np.ndarray, curved: np.ndarray) -> np.ndarray:
    """The inverse Hessians after a step (Broyden, Fletcher, Goldfarb, Shanno); those without curvature stay."""
    known = curved > 1e-12
    rho = np.where(known, 1.0 / np.where(known, curved, 1.0), 0.0)[:, None, None]
    left = np.eye(moved.shape[1]) - rho * moved[:, :, None] * change[:, None, :]
    new = left @ inverse @ left.transpose(0, 2, 1) + rho * moved[:, :, None] * moved[:, None, :]
    return np.where(known[:, None, None], new, inverse)
