import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.functions import smoothing
from arrears.operators import forecast, reports, series


def monthly(spark, points):
    return spark.createDataFrame([(k, dt.date(y, m, 1), float(v)) for k, y, m, v in points],
                                 "series_key string, month date, amount double")


def test_months_are_filled_without_gaps(spark):
    out = series.fill_months(monthly(spark, [("a", 2024, 11, 5), ("a", 2025, 2, 7), ("b", 2025, 1, 1)])).orderBy("series_key", "month")
    assert [(r.series_key, r.month.strftime("%Y-%m"), r.amount) for r in out.collect()] == [
        ("a", "2024-11", 5.0), ("a", "2024-12", 0.0), ("a", "2025-01", 0.0), ("a", "2025-02", 7.0), ("b", "2025-01", 1.0)]


def test_projection_by_hand(spark):
    values = [10, 20, 30, 40, 50, 60, 70]
    points = [("a", 2025, i + 1, v) for i, v in enumerate(values)] + [("a", 2025, 12, 1000)]
    out = series.project(monthly(spark, points), "2025-08-01").orderBy("h").collect()
    window = np.array(values[1:], float)
    weights = np.exp(np.linspace(0, 1, 6))
    mean = float(window @ (weights / weights.sum()))
    slope = float(np.polyfit(np.arange(6), window, 1)[0])
    spread = 1.5 * window.std(ddof=1)
    assert [r.month for r in out] == [dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 3, 1)]
    for r in out:
        assert r.amount == pytest.approx(mean + slope * r.h)
        assert r.low == pytest.approx(max(0.0, mean + slope * r.h - spread))
        assert r.high == pytest.approx(mean + slope * r.h + spread)


def test_projection_of_one_month_and_of_none(spark):
    points = [("one", 2025, 1, 100), ("future", 2026, 1, 5)]
    out = series.project(monthly(spark, points), "2025-06-01").orderBy("h").collect()
    assert {r.series_key for r in out} == {"one"}
    assert [(r.amount, r.low, r.high) for r in out] == [(100.0, 70.0, 130.0)] * 3


def test_highlights_give_ties_to_the_first_month(spark):
    df = monthly(spark, [("a", 2025, m, v) for m, v in ((1, 5), (2, 9), (3, 9), (4, 5))]).drop("series_key")
    out = {r.month.month: r for r in reports.month_highlights(df).collect()}
    assert [m for m in out if out[m].is_best] == [2] and [m for m in out if out[m].is_worst] == [1]
    assert [out[m].above_average for m in sorted(out)] == [False, True, True, False]


def simulate_series(n, alpha, beta, gamma, phi, level, trend, season, noise):
    """Plain scalar recursion, written apart from the library."""
    season, values = list(season), []
    for t in range(n):
        s = season[t % 12] if season else 0.0
        y = level + phi * trend + s + noise[t]
        new_level = alpha * (y - s) + (1 - alpha) * (level + phi * trend)
        new_trend = beta * (new_level - level) + (1 - beta) * phi * trend
        if season:
            season[t % 12] = gamma * (y - level - phi * trend) + (1 - gamma) * s
        level, trend = new_level, new_trend
        values.append(y)
    return values, level, trend, season


@pytest.mark.parametrize("n,seasonal", [(40, True), (18, False)])
def test_noiseless_series_is_continued_exactly(spark, n, seasonal):
    season = [30 * math.sin(2 * math.pi * i / 12) for i in range(12)] if seasonal else []
    values, *_ = simulate_series(n + 3, 0.2, 0.1, 0.1, 0.95, 100.0, 4.0, season, [0.0] * (n + 3))
    start = dt.date(2020, 1, 1)
    points = [("s", start.year + i // 12, i % 12 + 1, values[i]) for i in range(n)]
    fits = forecast.fit_series(monthly(spark, points))
    row = fits.select("*", *[forecast.point_forecast(h).alias(f"f{h}") for h in (1, 2, 3)]).first()
    assert row.n_months == n and row.n_params == (18 if seasonal else 5)
    assert [row.f1, row.f2, row.f3] == pytest.approx(values[n:], rel=1e-5)


def test_fit_is_the_best_candidate(spark):
    """Against a slow search: scalar recursion and a generic least-squares start."""
    rng = np.random.default_rng(0)
    y = 50 + np.cumsum(rng.normal(0, 5, 15))
    best = None
    for a, b, g, p in smoothing.candidates(False):
        def residuals(x0):
            level, trend, out = x0[0], x0[1], []
            for v in y:
                e = v - level - p * trend
                new = level + p * trend + a * e
                trend = p * trend + b * (new - level - p * trend)
                level = new
                out.append(e)
            return np.array(out)
        base = residuals([0.0, 0.0])
        effect = np.stack([residuals([1.0, 0.0]) - base, residuals([0.0, 1.0]) - base], axis=1)
        x0 = np.linalg.lstsq(effect, -base, rcond=None)[0]
        sse = float((residuals(x0) ** 2).sum())
        best = sse if best is None else min(best, sse)
    found = smoothing.fit(y[None, :])
    assert found["sse"][0] <= best * (1 + 1e-9)


@pytest.mark.parametrize("n", [10, 18, 36, 60])
def test_fits_reach_the_least_error_of_a_search(n):
    """Within a thousandth of the best of many random starts, series by series."""
    rng = np.random.default_rng(n)
    seasonal = n >= 24
    y = 200 + np.cumsum(rng.normal(0, 6, (10, n)), axis=1) + 30 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(0, 8, (10, n))
    y[0] = 100.0
    y[1, ::3] = 0.0
    found = smoothing.fit(y)
    grid, (solve, _) = smoothing.candidates(seasonal), smoothing._start_basis(n, seasonal)
    best = np.full(len(y), np.inf)
    for k in rng.integers(0, len(grid), 25):
        params = np.repeat(grid[k : k + 1], len(y), axis=0)
        free, _ = smoothing.slopes(y, params, np.zeros((len(y), 14 if seasonal else 2)), seasonal)
        start = -np.einsum("st,tk->ks", solve[k], free)
        best = np.minimum(best, smoothing.descend(y, params, start, seasonal)[2])
    assert (found["sse"] <= best * 1.001 + 1e-6).all()
    assert (found["alpha"] + found["gamma"] < 1).all() and (found["phi"] <= 0.98).all()


def test_slopes_are_derivatives():
    rng = np.random.default_rng(3)
    y, params, start = rng.normal(50, 9, (1, 30)), np.array([[0.3, 0.2, 0.1, 0.9]]), rng.normal(0, 5, (1, 14))
    e, by = smoothing.slopes(y, params, start, True)
    for k in range(18):
        moved = np.concatenate([params, start], axis=1)
        moved[0, k] += 1e-6
        other, _ = smoothing.slopes(y, moved[:, :4], moved[:, 4:], True)
        assert by[:, k, 0] == pytest.approx((other - e)[:, 0] / 1e-6, abs=1e-3)


def test_bands_are_ordered_repeatable_and_normal(spark):
    rows = [(f"k{i}", dt.date(2025, 1, 1), 40, 0.3, 0.1, 0.0, 0.9, 1000.0, 0.0, 400.0, None) for i in range(20)]
    fits = spark.createDataFrame(rows, "series_key string, last_month date, n_months int, alpha double, beta double, "
                                 "gamma double, phi double, level double, trend double, sse double, season array<double>")
    one = sorted(map(tuple, forecast.bands(fits.repartition(1)).collect()))
    two = sorted(map(tuple, forecast.bands(fits.repartition(7)).collect()))
    assert one == two
    sigma = math.sqrt(400 / 40)
    carry = [0.3 * (1 + 0.1 * 0.9), 0.3 * (1 + 0.1 * (0.9 + 0.81))]
    spread = [sigma, sigma * math.sqrt(1 + carry[0] ** 2), sigma * math.sqrt(1 + carry[0] ** 2 + carry[1] ** 2)]
    for h in (1, 2, 3):
        mine = [r for r in one if r[1] == h]
        assert all(r[4] <= r[3] <= r[5] for r in mine)
        assert np.mean([r[5] - r[3] for r in mine]) == pytest.approx(1.2816 * spread[h - 1], rel=0.06)
        assert {r[2] for r in mine} == {f"2025-0{h + 1}"}
    assert forecast.horizon_total(forecast.bands(fits)).count() == 20


def test_bands_are_the_limit_of_simulated_paths(spark):
    rng = np.random.default_rng(4)
    z = rng.standard_normal((200_000, 3))
    carry = [0.3 * (1 + 0.1 * 0.9), 0.3 * (1 + 0.1 * (0.9 + 0.81))]
    paths = np.stack([z[:, 0], z[:, 1] + carry[0] * z[:, 0], z[:, 2] + carry[0] * z[:, 1] + carry[1] * z[:, 0]], axis=1)
    fits = spark.createDataFrame(
        [("k", dt.date(2025, 1, 1), 1, 0.3, 0.1, 0.9, 1000.0, 0.0, 100.0, None)],
        "series_key string, last_month date, n_months int, alpha double, beta double, phi double, level double, "
        "trend double, sse double, season array<double>",
    )
    for row in forecast.bands(fits).collect():
        low, high = 1000 + 10 * np.quantile(paths[:, row.h - 1], [0.1, 0.9])
        assert [row.p10, row.p90] == pytest.approx([low, high], abs=0.15)


def test_short_series_are_projected_by_their_mean(spark):
    points = [("one", 2025, 1, 100.0), ("two", 2025, 1, 10.0), ("two", 2025, 2, 20.0)]
    points += [("long", 2024, m, 50.0 + m) for m in range(1, 10)]
    out = forecast.forecast(monthly(spark, points)).collect()
    by_key = {k: [r for r in sorted(out, key=lambda r: r.h) if r.series_key == k] for k in ("one", "two", "long")}
    assert all(len(rows) == 3 for rows in by_key.values())
    assert {k: rows[0].method for k, rows in by_key.items()} == {"one": "weighted mean", "two": "weighted mean", "long": "smoothing"}
    assert [(r.month, r.expected, r.p10, r.p90) for r in by_key["one"]] == [(f"2025-0{m}", 100.0, 70.0, 130.0) for m in (2, 3, 4)]
    mean = (10 + 20 * math.e) / (1 + math.e)
    assert by_key["two"][0].expected == pytest.approx(mean + 10, abs=0.01)
    assert forecast.fit_series(monthly(spark, points)).count() == 1


def test_fold_finds_the_least_squares_of_its_grid(spark):
    rng = np.random.default_rng(8)
    rows = [(f"k{i}", dt.date(2025, 1, 1), [float(x) for x in 500 + 20 * np.arange(n) + rng.normal(0, 60, n)])
            for i, n in enumerate([3, 4, 11, 23, 40])]
    rows += [("flat", dt.date(2025, 1, 1), [0.0] * 6), ("hot", dt.date(2025, 1, 1), [1e9] * 5 + [0.0] * 5)]
    df = spark.createDataFrame(rows, "series_key string, last_month date, amounts array<double>")
    fits = forecast.fit_by_fold(df)
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    got = {r.series_key: r for r in fits.collect()}
    assert set(got) == {k for k, *_ in rows}
    for key, _, amounts in rows:
        y = np.array(amounts)
        tried = []
        for a, b, p in smoothing.FOLD_GRID:
            params = [np.float64(v) for v in (a, b, 0.0, p)]
            effects = [smoothing.errors(0 * y, params, l, t, [])[0] for l, t in ((1.0, 0.0), (0.0, 1.0))]
            error = smoothing.errors(y, params, 0.0, 0.0, [])[0]
            start, *_ = np.linalg.lstsq(-np.stack(effects, axis=1), error, rcond=None)
            e, level, trend, _ = smoothing.errors(y, params, start[0], start[1], [])
            tried.append((float((e**2).sum()), level, trend, a, b, p))
        r, scale = got[key], float((y**2).sum()) or 1.0
        best = min(tried)
        assert r.sse == pytest.approx(best[0], rel=1e-6, abs=1e-12 * scale)
        own = next(t for t in tried if t[3:] == (r.alpha, r.beta, r.phi))
        assert (r.level, r.trend) == pytest.approx(own[1:3], rel=1e-5, abs=1e-6 * scale**0.5)
        assert r.n_params == 5 and r.season is None
        assert (r.aic is None) == (r.sse == 0)


def test_fold_screens_its_grid_and_tries_only_possible_winners_in_full(spark):
    rng = np.random.default_rng(11)
    rows = [(f"k{i}", dt.date(2025, 1, 1), [float(x) for x in 900 + 9 * np.arange(n) + rng.normal(0, 70, n)])
            for i, n in enumerate([3, 4, 5, 17, 64, forecast.SCREENED, forecast.SCREENED + 1])]
    df = spark.createDataFrame(rows, "series_key string, last_month date, amounts array<double>")
    grid = sorted(smoothing.FOLD_GRID, key=lambda c: c[2])
    got = {r.series_key: r for r in forecast._screened(df, grid).collect()}
    for key, _, amounts in rows:
        y = np.array(amounts)
        if len(y) > forecast.SCREENED:
            assert got[key]._errors is None and got[key]._most is None
            continue
        for (a, b, p), screened in zip(grid, got[key]._errors, strict=True):
            params = [np.float64(v) for v in (a, b, 0.0, p)]
            effects = [smoothing.errors(0 * y, params, l, t, [])[0] for l, t in ((1.0, 0.0), (0.0, 1.0))]
            error = smoothing.errors(y, params, 0.0, 0.0, [])[0]
            start, *_ = np.linalg.lstsq(-np.stack(effects, axis=1), error, rcond=None)
            sse = float((smoothing.errors(y, params, start[0], start[1], [])[0] ** 2).sum())
            assert abs(screened - sse) <= 1e-12 * float((y**2).sum())
        assert sum(e <= got[key]._most for e in got[key]._errors) == 1


def test_fold_keeps_its_winners_with_and_without_screening(spark, monkeypatch):
    rng = np.random.default_rng(12)
    rows = [(f"k{i}", dt.date(2025, 1, 1), [float(x) for x in rng.gamma(0.5, 800, n).round(2)]) for i, n in enumerate([*range(3, 40), 130])]
    rows += [("zero", dt.date(2025, 1, 1), [0.0] * 9), ("line", dt.date(2025, 1, 1), [5.0 * k for k in range(30)]),
             ("lost", dt.date(2025, 1, 1), [1.0, math.nan, 2.0, 4.0]), ("far", dt.date(2025, 1, 1), [1.0, math.inf, 2.0, 4.0])]
    df = spark.createDataFrame(rows, "series_key string, last_month date, amounts array<double>")
    screened = sorted(map(str, forecast.fit_by_fold(df).collect()))
    monkeypatch.setattr(forecast, "SCREENED", 2)
    assert screened == sorted(map(str, forecast.fit_by_fold(df).collect()))
    assert len(screened) == len(rows)


def test_fold_screened_in_batches_has_the_same_fits(spark):
    rng = np.random.default_rng(13)
    lengths = [*rng.permutation(np.repeat(np.arange(3, 43), 20)), forecast.SCREENED, forecast.SCREENED + 1, 3]
    rows = [(f"k{i}", dt.date(2025, 1, 1), [float(x) for x in rng.gamma(0.5, 800, n).round(2)]) for i, n in enumerate(lengths)]
    odd = {"zero": [0.0] * 9, "line": [5.0 * k for k in range(30)], "huge": [1e200, 3e200, 2e200, 1e200, 5.0],
           "lost": [1.0, math.nan, 2.0, 4.0], "far": [1.0, math.inf, 2.0, 4.0], "gone": [-math.inf, math.inf, 0.0]}
    rows += [(key, dt.date(2025, 1, 1), amounts) for key, amounts in odd.items()]
    df = spark.createDataFrame(rows, "series_key string, last_month date, amounts array<double>").repartition(2)
    grid = sorted(smoothing.FOLD_GRID, key=lambda c: c[2])
    folded = {r.series_key: r for r in forecast._screened(df, grid).collect()}
    possible = df.select("series_key", forecast._screened_in_batches(grid)(F.col("amounts")).alias("k")).collect()
    assert {r.series_key for r in possible} == {k for k, *_ in rows} and len(possible) == len(rows)
    for key, numbers in possible:
        if key in ("huge", "lost", "far", "gone") or folded[key]._errors is None:
            assert numbers == list(range(len(grid)))
        else:
            assert numbers == [k for k, e in enumerate(folded[key]._errors) if e <= folded[key]._most]
    phi, steps = 0.8, np.array([forecast._screening_steps(c) for c in grid if c[2] == 0.8], dtype=float).transpose(1, 2, 0)
    short = [(key, y) for key, _, y in rows if key not in ("huge", "lost", "far", "gone") and len(y) <= forecast.SCREENED]
    months = np.array([len(y) for _, y in short])
    batched = smoothing.screened_errors(np.concatenate([y for _, y in short]), months, phi, steps)
    for (key, y), errors in zip(short, batched, strict=True):
        assert np.abs(errors - folded[key]._errors[: len(errors)]).max() <= 1e-12 * sum(v * v for v in y)
    fits = forecast.fit_by_fold(df, in_batches=True)
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(map(str, fits.collect())) == sorted(map(str, forecast.fit_by_fold(df).collect()))


def test_forecast_without_season_leaves_no_screening_to_interpreted_lambdas(spark):
    points = [("a", 2025, m, 10 * m) for m in range(1, 9)] + [("b", 2025, 1, 4)]
    out = forecast.forecast(monthly(spark, points), seasonal=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hypot" not in plan.lower() and "ArrowEvalPython" in plan
    assert {(r.series_key, r.method) for r in out.collect()} == {("a", "smoothing"), ("b", "weighted mean")}


@pytest.mark.parametrize("seasonal", [False, True])
def test_series_of_many_lengths_are_fitted_together_as_each_alone(seasonal):
    rng = np.random.default_rng(21)
    months = rng.permutation([3, 4, 7, 7, 23] if not seasonal else [24, 25, 36, 36, 61, 80])
    padded = np.zeros((len(months), months.max()))
    for row, n in zip(padded, months):
        row[:n] = 300 + np.cumsum(rng.normal(0, 9, n)) + 20 * np.sin(np.arange(n) * np.pi / 6)
    together = smoothing.fit_padded(padded, months, seasonal)
    for k, n in enumerate(months):
        alone = smoothing.fit(padded[k : k + 1, :n])
        assert together["sse"][k] == pytest.approx(alone["sse"][0], rel=1e-6, abs=1e-6)
        for h in range(1, 4):
            ahead = [f["level"][i] + sum(f["phi"][i] ** np.arange(1, h + 1)) * f["trend"][i] + (f["season"][i][h - 1] if seasonal else 0)
                     for f, i in ((together, k), (alone, 0))]
            assert ahead[0] == pytest.approx(ahead[1], rel=1e-3)


def test_a_batch_of_many_lengths_takes_few_descents(monkeypatch):
    """As many as blocks of series, not as many as lengths."""
    import pandas as pd
    calls, descend = [], smoothing.descend
    monkeypatch.setattr(smoothing, "descend", lambda *a, **k: calls.append(1) or descend(*a, **k))
    rng = np.random.default_rng(22)
    batch = pd.Series([list(rng.gamma(0.5, 800, n)) for n in range(3, 43)])
    (out,) = forecast._fit.func(iter([batch]))
    assert len(calls) == 4 and len(out) == 40 and out["sse"].notna().all()
    assert [len(s) for s in out["season"]] == [0] * 21 + [12] * 19
