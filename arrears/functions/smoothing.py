"""Damped additive exponential smoothing of a batch of monthly series.

The textbook recursion in error form, with forecast f = l + phi*b + s[t-m]
and error e = y - f:

    l' = l + phi*b + alpha*e
    b' = phi*b + alpha*beta*e
    s' = s + gamma*e

For fixed (alpha, beta, gamma, phi) the errors are linear in the initial
level, trend and season, so those are solved by least squares for every
candidate of a grid; the part that depends on the parameters only is shared by
all series of one length.  From its best candidates each series then goes down
to the least sum of squares by damped Gauss-Newton steps over parameters and
initial states together, all series of a block at once: a first look from the
best candidates of several alphas, and on to the bottom from the best of those.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np

from arrears import contracts as K

# Candidate parameters (fixed values).  gamma stays below 1 - alpha.
ALPHAS = (0.02, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
BETAS = (0.01, 0.1, 0.3, 0.6, 0.9)
GAMMAS = (0.01, 0.1, 0.25, 0.5)
PHIS = (0.8, 0.9, 0.95, 0.98)

#: Candidates (alpha, beta, phi) of the fold over arrays (:func:`arrears.operators.forecast.fit_by_fold`).
FOLD_GRID = tuple(product(ALPHAS, (0.01, 0.1, 0.3), (0.8, 0.98)))

#: Bounds of (alpha, beta, gamma, phi) for the descent; gamma also stays below 1 - alpha.
LOWEST = (1e-4, 1e-4, 1e-4, 0.8)
HIGHEST = (0.999, 0.9999, 0.9998, 0.98)

#: Series handled at once, which bounds the memory of a task, and columns of the recursion at once.
_CHUNK, _BLOCK = 512, 512
#: Series screened at once: their states stay in a core's cache.
_SCREEN = 256
#: Valleys followed to the bottom, steps, the gains that end a first look and the descent.
_VALLEYS, _STEPS, _GLANCE, _ENOUGH = 3, 40, 1e-3, 1e-5


@lru_cache(maxsize=2)
def candidates(seasonal: bool) -> np.ndarray:
    """Rows of (alpha, beta, gamma, phi)."""
    rows = [
        (a, b, g, p)
        for a, b, g, p in product(ALPHAS, BETAS, GAMMAS if seasonal else (0.0,), PHIS)
        if a + g < 1.0
    ]
    return np.array(rows)


def errors(y, params, level, trend, season):
    """One-step errors and final states; all arguments broadcast together.

    ``y`` has time on its last axis, ``season`` the 12 seasons on its first
    (or is empty).  Returns errors with time first, then level, trend, season.
    """
    alpha, beta, gamma, phi = params
    seasons = [s for s in season]
    out = []
    for t in range(y.shape[-1]):
        slot = t % len(seasons) if seasons else 0
        base = level + phi * trend
        e = y[..., t] - base - (seasons[slot] if seasons else 0.0)
        level = base + alpha * e
        trend = phi * trend + alpha * beta * e
        if seasons:
            seasons[slot] = seasons[slot] + gamma * e
        out.append(e)
    return np.stack(out), level, trend, seasons


@lru_cache(maxsize=4)  # a few MB each, more with longer series
def _start_basis(n: int, seasonal: bool):
    """Per candidate: effect of each initial state on the errors.

    Returns the pseudo-inverse (to solve for the states) and a transposed
    orthonormal basis (to get the least sum of squares without solving).
    """
    grid = candidates(seasonal)
    size = 2 + (K.SEASON if seasonal else 0)
    unit = np.eye(size)
    params = [grid[:, i][:, None] for i in range(4)]
    season = [unit[2 + j][None, :] for j in range(K.SEASON)] if seasonal else []
    zero = np.zeros((1, 1, n))
    effect, *_ = errors(zero, params, unit[0][None, :], unit[1][None, :], season)
    effect = np.moveaxis(effect, 0, 1)  # candidate, time, state
    left, values, right = np.linalg.svd(effect, full_matrices=False)
    keep = values > values.max(axis=1, keepdims=True) * 1e-10
    left = left * keep[:, None, :]
    inverse = np.where(keep, 1.0 / np.where(keep, values, 1.0), 0.0)
    basis = np.ascontiguousarray(np.swapaxes(left, 1, 2))
    return (np.swapaxes(right, 1, 2) * inverse[:, None, :]) @ basis, basis


def _slopes(y, months, params, start, seasonal, by):
    """:func:`slopes` of series of ``months`` months, longest first and padded.

    Returns (series, time) and fills ``by`` (series, 4 + states, time), which
    the caller keeps: fresh memory would cost more than the work.  The recursion runs over blocks that stay in the processor's cache.  The
    months treat all seasons alike, so the initial season j moves the errors as
    the first one does, j months later: one row stands for all twelve.
    """
    n = y.shape[1]
    found = np.empty(y.shape)
    value = 7 if seasonal else 6  # the row of the series itself, behind the derivatives
    for begin in range(0, len(y), _BLOCK):
        part = slice(begin, begin + _BLOCK)
        first = np.ascontiguousarray(start[part].T)
        amounts = np.ascontiguousarray(y[part].T)
        inside = np.arange(n) < months[part, None]
        alpha, beta, gamma, phi = np.ascontiguousarray(params[part].T)
        width = len(alpha)
        level, trend, base, damped, spare = np.zeros((5, value + 1, width))
        level[4], trend[5], level[value], trend[value] = 1.0, 1.0, first[0], first[1]
        seasons = np.zeros((K.SEASON if seasonal else 0, value + 1, width))
        if seasonal:
            seasons[0, 6] = 1.0
            seasons[:, value] = first[2:]
        carry = alpha * beta
        out = np.zeros((n, value + 1, width))
        for t, active in enumerate(inside.sum(axis=0)):
            if active < width:  # the shorter series have ended
                width = active
                level, trend, base, damped, spare = (x[:, :width] for x in (level, trend, base, damped, spare))
                seasons = seasons[:, :, :width]
                alpha, beta, gamma, phi, carry = (x[:width] for x in (alpha, beta, gamma, phi, carry))
            by_e = out[t, :, :width]
            before = trend[value].copy()
            np.multiply(phi, trend, out=damped)
            np.add(level, damped, out=base)
            base[3] += before
            np.negative(base, out=by_e)
            by_e[value] += amounts[t, :width]
            if seasonal:
                season = seasons[t % K.SEASON]
                by_e -= season
            e = by_e[value]
            np.multiply(alpha, by_e, out=level)
            level += base
            level[0] += e
            np.multiply(carry, by_e, out=trend)
            trend += damped
            trend[0] += beta * e
            trend[1] += alpha * e
            trend[3] += before
            if seasonal:
                season += np.multiply(gamma, by_e, out=spare)
                season[2] += e
        found[part] = out[:, value].T
        rows = by[part]
        rows[:, :value] = out[:, :value].transpose(2, 1, 0)
        for j in range(1, K.SEASON if seasonal else 0):
            rows[:, 6 + j, :j] = 0.0
            rows[:, 6 + j, j:] = rows[:, 6, : n - j]
        for m in np.unique(months[part]):
            rows[months[part] == m, 7:, m:] = 0.0
    return found


def slopes(y, params, start, seasonal):
    """One-step errors and their derivatives by the four parameters and the initial states.

    ``y`` is (series, time), ``params`` (series, 4), ``start`` (series, states).
    Returns (time, series) and (time, 4 + states, series).
    """
    by = np.empty((len(y), 4 + start.shape[1], y.shape[1]))
    e = _slopes(y, np.full(len(y), y.shape[1]), params, start, seasonal, by)
    return e.T, by.transpose(2, 1, 0)


def descend(y, params, start, seasonal, enough=_ENOUGH, months=None):
    """``(params, start, sse)`` at the bottom of each series' valley, within the bounds.

    ``months`` are the lengths of padded series.  Damping rises where a step did not help and falls where it did; a
    parameter at a bound stays there while the slope points outwards.
    """
    if months is None:
        months = np.full(len(y), y.shape[1])
    order = np.argsort(-months, kind="stable")  # longest first
    y, months, params, start = y[order], months[order], params[order], start[order]
    low, high = np.array(LOWEST), np.array(HIGHEST)
    point = np.concatenate([np.clip(params, low, high), start], axis=1)
    if not seasonal:
        point[:, 2] = 0.0
    damping = np.full(len(y), 1e-2)
    by, by_there, spare = np.empty((3, len(y), point.shape[1], y.shape[1]))
    e = _slopes(y, months, point[:, :4], point[:, 4:], seasonal, by)
    sse = (e**2).sum(axis=1)
    live = np.arange(len(y))
    for _ in range(_STEPS):
        j = np.take(by, live, axis=0, out=spare[: len(live)], mode="clip") if len(live) < len(y) else by
        grade = (j @ e[live, :, None])[:, :, 0]
        square = j @ j.transpose(0, 2, 1)
        here = point[live]
        top = np.broadcast_to(high, (len(live), 4)).copy()
        top[:, 2] = np.maximum(low[2], np.minimum(top[:, 2], 0.9999 - here[:, 0]))
        held = np.zeros(grade.shape, dtype=bool)
        held[:, :4] = ((here[:, :4] <= low) & (grade[:, :4] > 0)) | ((here[:, :4] >= top) & (grade[:, :4] < 0))
        if not seasonal:
            held[:, 2] = True
        at_bound = np.flatnonzero(held.any(axis=1))
        square[at_bound] *= ~(held[at_bound, :, None] | held[at_bound, None, :])
        diagonal = np.einsum("kii->ki", square)  # a view
        scale = np.maximum(diagonal.max(axis=1, keepdims=True) * 1e-12, 1e-30)
        diagonal += damping[live, None] * diagonal + scale
        diagonal[held] = 1.0
        step = np.linalg.solve(square, np.where(held, 0.0, -grade)[:, :, None])[:, :, 0]
        there = here + step
        there[:, :4] = np.clip(there[:, :4], low, high)
        there[:, 2] = np.clip(there[:, 2], low[2], np.maximum(low[2], 0.9999 - there[:, 0])) if seasonal else 0.0
        e_there = _slopes(y[live], months[live], there[:, :4], there[:, 4:], seasonal, by_there[: len(live)])
        sse_there = (e_there**2).sum(axis=1)
        better = sse_there < sse[live]  # not so for values out of range
        gain = np.where(better, sse[live] - sse_there, 0.0) / np.maximum(sse[live], 1e-300)
        won = live[better]
        point[won], sse[won] = there[better], sse_there[better]
        e[won] = e_there[better]
        for here, there_ in zip(won, np.flatnonzero(better)):
            by[here] = by_there[there_]
        damping[live] = np.where(better, np.maximum(damping[live] / 4, 1e-10), damping[live] * 5)
        live = live[np.where(better, gain > enough, damping[live] < 1e6)]
        if not len(live):
            break
    back = np.argsort(order)
    return point[back, :4], point[back, 4:], sse[back]


def fit(y: np.ndarray) -> dict[str, np.ndarray]:
    """Least squares parameters and final states for series of one common length."""
    return fit_padded(y, np.full(len(y), y.shape[1]), y.shape[1] >= K.SEASONAL_FROM)


def fit_padded(y: np.ndarray, months: np.ndarray, seasonal: bool) -> dict[str, np.ndarray]:
    """:func:`fit` of series of ``months`` months, padded to one length; all of them with or without season."""
    order = np.argsort(months, kind="stable")
    parts = [
        _fit_block(y[some, : months[some[-1]]], months[some], seasonal)
        for some in (order[begin : begin + _CHUNK] for begin in range(0, len(y), _CHUNK))
    ]
    back = np.argsort(order)
    return {name: np.concatenate([p[name] for p in parts])[back] for name in parts[0]}


def _fit_block(block: np.ndarray, months: np.ndarray, seasonal: bool) -> dict[str, np.ndarray]:
    grid = candidates(seasonal)
    # where to start from: the best candidate of every alpha, of short series of every alpha and beta
    kinds = grid[:, 0] if seasonal else grid[:, 0] + 1j * grid[:, 1]
    groups = np.unique(kinds)[:, None] == kinds
    states = 2 + (K.SEASON if seasonal else 0)
    none = [np.zeros(())] * (states - 2)
    same = [(n, np.flatnonzero(months == n)) for n in np.unique(months)]
    own, start = np.empty((len(groups), len(block)), dtype=int), np.empty((len(groups), len(block), states))
    for n, some in same:
        solve, basis = _start_basis(int(n), seasonal)
        params = [grid[:, i][None, :] for i in range(4)]
        free, *_ = errors(block[some, None, :n], params, np.zeros(()), np.zeros(()), none)
        by_candidate = np.ascontiguousarray(np.moveaxis(free, 2, 0))  # candidate, time, series
        explained = basis @ by_candidate
        sse = ((by_candidate**2).sum(axis=1) - (explained**2).sum(axis=1)).T
        own[:, some] = [np.where(a, sse, np.inf).argmin(axis=1) for a in groups]  # start, series
        first, who = own[:, some].reshape(-1), np.tile(np.arange(len(some)), len(own))
        start[:, some] = -np.matmul(solve[first], by_candidate[first, :, who][:, :, None]).reshape(len(own), len(some), states)
    pick = np.arange(len(block))
    first, who = own.reshape(-1), np.tile(pick, len(own))
    params, start, sse = descend(block[who], grid[first], start.reshape(-1, states), seasonal, _GLANCE, months[who])
    near = np.argsort(sse.reshape(len(own), -1), axis=0, kind="stable")[:_VALLEYS] * len(block) + pick
    near, who = near.reshape(-1), np.tile(pick, _VALLEYS)
    params, start, sse = descend(block[who], params[near], start[near], seasonal, months=months[who])
    best = sse.reshape(_VALLEYS, -1).argmin(axis=0) * len(block) + pick
    chosen, start = params[best], start[best]
    found = {name: chosen[:, i].copy() for i, name in enumerate(("alpha", "beta", "gamma", "phi"))}
    found |= {name: np.empty(len(block)) for name in ("level", "trend", "sse")}
    found["season"] = np.zeros((len(block), states - 2))
    for n, some in same:
        season = [start[some, 2 + j] for j in range(states - 2)]
        resid, level, trend, season = errors(block[some, :n], chosen[some].T, start[some, 0], start[some, 1], season)
        found["level"][some], found["trend"][some], found["sse"][some] = level, trend, (resid**2).sum(axis=0)
        if seasonal:  # season that applies to the months after the last one, in order
            found["season"][some] = np.stack([season[(n + j) % K.SEASON] for j in range(K.SEASON)], axis=1)
    return found


def screened_errors(amounts: np.ndarray, lengths: np.ndarray, phi: float, steps: np.ndarray) -> np.ndarray:
    """Least sums of squares up to rounding, a row per series and a column per candidate.

    ``amounts`` holds the months of all series one after the other, ``steps``
    the factors ``p, q, w`` of each month and candidate (months x 3 x
    candidates, one month more than the longest series); all candidates share
    ``phi``.  The recursion is that of
    :func:`arrears.operators.forecast._screened_errors`.
    """
    out = np.zeros((len(lengths), steps.shape[2]))
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    for rows in np.split(order, range(_SCREEN, len(order), _SCREEN)):
        months = np.arange(lengths[rows[0]] if len(rows) else 0)
        known = months < lengths[rows, None]
        y = np.zeros(known.shape)
        y[known] = amounts[(starts[rows, None] + months)[known]]
        y = np.ascontiguousarray(y.T)
        going = known.sum(axis=0)
        with np.errstate(over="ignore", invalid="ignore"):
            differences = y[2:] - (1 + phi) * y[1:-1] + phi * y[:-2]
            # last and last but one error, the squares so far, and room for the products
            last, older, squares, near, far = np.zeros((5, steps.shape[2], len(rows)))
            for t, n in enumerate(going[2:], 2):
                p, q, w = steps[t, 0, :, None], steps[t, 1, :, None], steps[t + 1, 2, :, None]
                error = older[:, :n]  # its old values are read before the new ones are written
                np.multiply(error, q, out=far[:, :n])
                np.multiply(last[:, :n], p, out=near[:, :n])
                np.add(near[:, :n], differences[t - 2, :n], out=near[:, :n])
                np.add(near[:, :n], far[:, :n], out=error)
                np.multiply(error, w, out=near[:, :n])
                np.multiply(near[:, :n], near[:, :n], out=near[:, :n])
                np.add(squares[:, :n], near[:, :n], out=squares[:, :n])
                last, older = older, last
        out[rows] = squares.T
    return out
