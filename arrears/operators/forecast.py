"""Cash forecast for many series at once."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from arrears import contracts as K, deploy
from arrears.functions import formats, numeric, smoothing
from arrears.operators import series

#: months that a fit needs
SHORTEST = 3

_FIT_FIELDS = ["alpha", "beta", "gamma", "phi", "level", "trend", "sse"]
_FIT_TYPE = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in _FIT_FIELDS]
    + [T.StructField("season", T.ArrayType(T.DoubleType()))]
)


@F.pandas_udf(_FIT_TYPE)
def _fit(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Arrow batches of month arrays; series with a season are fitted together, and so are those without."""
    for batch in batches:
        lengths = batch.map(len).to_numpy()
        out = pd.DataFrame(index=range(len(batch)), columns=_FIT_FIELDS, dtype=float)
        season = [None] * len(batch)
        for seasonal in (False, True):
            where = np.flatnonzero((lengths >= K.SEASONAL_FROM) == seasonal)
            if not len(where):
                continue
            padded = np.zeros((len(where), lengths[where].max()))
            for row, amounts in zip(padded, batch.iloc[where]):
                row[: len(amounts)] = amounts
            found = smoothing.fit_padded(padded, lengths[where], seasonal)
            for name in _FIT_FIELDS:
                out.loc[where, name] = found[name]
            for row, values in zip(where, found["season"]):
                season[row] = values
        yield out.assign(season=season)


# Marked so that the optimiser never runs the function once per field that is
# read from its result; it depends on its arguments only.
_fit_once = _fit.asNondeterministic()


def month_arrays(filled: DataFrame) -> DataFrame:
    """One row per key with its months in order; as long as the calendar."""
    packed = filled.groupBy("series_key").agg(
        F.array_sort(F.collect_list(F.struct("month", "amount"))).alias("points"),
        F.max("month").alias("last_month"),
    )
    return packed.select(
        "series_key", "last_month", F.transform("points", lambda p: p["amount"]).alias("amounts")
    )


def spread_arrays(monthly: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """``month_arrays`` of the gap-filled series, spread over tasks for the fit.

    The arrays are small but the fit is not: a given number of partitions
    keeps adaptive execution from merging them, and this one exchange also
    serves the gap filling and the grouping.  ``n_partitions`` should grow
    with the keys (some thousands of keys each); the session's number of
    shuffle partitions is the default.
    """
    spark = monthly.sparkSession
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return month_arrays(series.fill_months(monthly.repartition(n, "series_key")))


def fit_series(monthly: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Damped additive smoothing per key, with yearly season from 24 months on.

    Keys with fewer than three months have no fit; :func:`forecast` projects
    their weighted mean.  Spark spreads the keys over tasks; a task sees one
    key as one array of months, however many payments the key had.
    """
    return fit_arrays(spread_arrays(monthly, n_partitions).where(F.size("amounts") >= SHORTEST))


def fit_arrays(arrays: DataFrame) -> DataFrame:
    """The fits of month arrays with three months at least."""
    deploy.ship(arrays.sparkSession)
    n = F.size("amounts")
    seasonal = n >= K.SEASONAL_FROM
    n_params = F.when(seasonal, 4 + 2 + K.SEASON).otherwise(3 + 2)
    sse = F.col("fit.sse")
    aic = n * F.ln(F.when(sse > 0, sse) / n) + 2 * n_params
    return arrays.withColumn("fit", _fit_once("amounts")).select(
        "series_key",
        "last_month",
        n.alias("n_months"),
        n_params.alias("n_params"),
        "fit.*",
        aic.alias("aic"),
    )


def _fold(amounts: Column, candidate: Column) -> Column:
    """Sums and last states of one candidate over the months, for any initial level and trend.

    The one-step forecasts are linear in both initial values: ``a`` runs from
    zero over the amounts, ``u`` and ``v`` run from level 1 and trend 1 over
    zeros.  ``f`` is the next forecast, ``g`` the damped trend in it.
    """
    alpha, carry, phi = candidate["alpha"], candidate["alpha"] * candidate["beta"], candidate["phi"]
    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.struct(
        zero.alias("fa"), zero.alias("ga"), one.alias("fu"), zero.alias("gu"), phi.alias("fv"), phi.alias("gv"),
        *[zero.alias(s) for s in ("aa", "au", "av", "uu", "uv", "vv")],
    )

    def step(s: Column, y: Column) -> Column:
        e = y - s["fa"]
        ga = phi * (s["ga"] + carry * e)
        gu = phi * (s["gu"] - carry * s["fu"])
        gv = phi * (s["gv"] - carry * s["fv"])
        return F.struct(
            (s["fa"] + alpha * e + ga).alias("fa"), ga.alias("ga"),
            (s["fu"] - alpha * s["fu"] + gu).alias("fu"), gu.alias("gu"),
            (s["fv"] - alpha * s["fv"] + gv).alias("fv"), gv.alias("gv"),
            (s["aa"] + e * e).alias("aa"), (s["au"] + e * s["fu"]).alias("au"), (s["av"] + e * s["fv"]).alias("av"),
            (s["uu"] + s["fu"] * s["fu"]).alias("uu"), (s["uv"] + s["fu"] * s["fv"]).alias("uv"),
            (s["vv"] + s["fv"] * s["fv"]).alias("vv"),
        )

    return F.aggregate(amounts, start, step)


def _solved(candidate: Column, s: Column) -> Column:
    """The candidate with its least-squares initial states: ``sse`` first, so that the least struct wins."""
    det = s["uu"] * s["vv"] - s["uv"] * s["uv"]
    both = det > F.lit(1e-12) * s["uu"] * s["vv"]
    level = F.when(both, (s["au"] * s["vv"] - s["av"] * s["uv"]) / det).otherwise(s["au"] / s["uu"])
    trend = F.when(both, (s["av"] * s["uu"] - s["au"] * s["uv"]) / det).otherwise(0.0)

    def finished(start: Column) -> Column:
        f = s["fa"] + start["l"] * s["fu"] + start["b"] * s["fv"]
        g = s["ga"] + start["l"] * s["gu"] + start["b"] * s["gv"]
        return F.struct(
            F.greatest(s["aa"] - start["l"] * s["au"] - start["b"] * s["av"], F.lit(0.0)).alias("sse"),
            candidate["alpha"].alias("alpha"), candidate["beta"].alias("beta"), candidate["phi"].alias("phi"),
            (f - g).alias("level"), (g / candidate["phi"]).alias("trend"),
        )

    return F.get(F.transform(F.array(F.struct(level.alias("l"), trend.alias("b"))), finished), F.lit(0))


#: months up to which candidates of the fold are screened; longer series try every one in full
SCREENED = 120
#: share of the sum of squared amounts that a screened error may be off: its rounding stays 1,000 times below
_SLACK = 1e-9
#: normal equations with a determinant below this share of its product are not screened
_CROOKED = 1e-4


def _screening_steps(candidate: tuple[float, float, float]) -> list[tuple[float | None, float | None, float | None]]:
    """``p, q, w`` per month: its error is ``d + p e[-1] + q e[-2]``, ``w`` weighs the error of the month before.

    Recursive least squares of the initial states: the first two months settle
    them, and each later one is forecast from all before it.  The squares of
    the weighted errors add up to the least sum of squares.  ``d`` is the
    amount less (1 + phi) times the month before plus phi times the one before
    that.  All three depend on the candidate and the place of the month, not on
    the series.
    """
    alpha, beta, phi = candidate
    carry = alpha * beta
    fu, gu, fv, gv, uu, uv, vv = 1.0, 0.0, phi, phi, 0.0, 0.0, 0.0
    # factors of the last and the last but one error in the next one; the last one's weight
    near, far, next_far, weight = 0.0, 0.0, 0.0, 0.0
    steps = []
    for t in range(SCREENED):
        steps.append((near if t > 2 else 0.0, far if t > 3 else 0.0, weight))
        uu, uv, vv = uu + fu * fu, uv + fu * fv, vv + fv * fv
        if t > 0:
            det = uu * vv - uv * uv
            if not det > _CROOKED * uu * vv:
                return steps[:2] + [(None, None, None)] * (SCREENED - 1)  # errors of NULL: nothing is screened
            by_level, by_trend = (fu * vv - fv * uv) / det, (fv * uu - fu * uv) / det
            own = fu * by_level + fv * by_trend
            weight = (1 - own) ** 0.5 if t > 1 else 0.0
            level, trend = own + alpha * (1 - own), phi * (gu * by_level + gv * by_trend + carry * (1 - own))
            near, far, next_far = 1 + phi - level - trend, next_far, phi * (level - 1)
        gu, gv = phi * (gu - carry * fu), phi * (gv - carry * fv)
        fu, fv = fu - alpha * fu + gu, fv - alpha * fv + gv
    return steps + [(0.0, 0.0, weight)]


def _screened_errors(candidates: list[tuple[float, float, float]]) -> str:
    """SQL text of the least sums of squares of candidates that share phi, up to rounding.

    One fold for all of them: a struct for each month and candidate would cost
    several times the arithmetic.
    """
    phi = candidates[0][2]
    rows = [dict(zip("pqw", zip(*step))) for step in zip(*map(_screening_steps, candidates))]
    none = f"array_repeat(0D, {len(candidates)})"
    differences = (
        "transform(amounts, (y, i) -> IF(i < 2, 0D,"
        f" y - {1 + phi!r}D * get(amounts, i - 1) + {phi!r}D * get(amounts, i - 2)))"
    )
    # one step more than months: it adds the last month's error
    return f"""aggregate(
        arrays_zip(
            concat({differences}, array(0D)),
            slice(from_json('{json.dumps(rows)}', 'array<struct<p: array<double>, q: array<double>, w: array<double>>>'),
                  1, size(amounts) + 1)),
        named_struct('e', {none}, 'f', {none}, 'r', {none}),
        (s, x) -> named_struct(
            'e', zip_with(
                zip_with(x.`1`.p, s.e, (p, e) -> p * e),
                zip_with(x.`1`.q, s.f, (q, f) -> q * f), (near, far) -> x.`0` + near + far),
            'f', s.e,
            'r', zip_with(s.r, zip_with(x.`1`.w, s.e, (w, e) -> w * e), (r, e) -> hypot(r, e))),
        s -> transform(s.r, r -> r * r))"""


def _screened(arrays: DataFrame, grid: list[tuple[float, float, float]]) -> DataFrame:
    """``arrays`` with the screened errors of a grid in order of phi, and the most that a winner can have."""
    errors = F.expr("concat(%s)" % ", ".join(
        _screened_errors([c for c in grid if c[2] == phi]) for phi in dict.fromkeys(c[2] for c in grid)
    ))
    squares = F.aggregate("amounts", F.lit(0.0), lambda s, y: s + y * y)
    return arrays.select(
        "series_key", "last_month", "amounts", F.when(F.size("amounts") <= SCREENED, errors).alias("_errors")
    ).withColumn("_most", F.array_min("_errors") + F.lit(_SLACK) * squares)


def _screened_in_batches(grid: list[tuple[float, float, float]]) -> Callable[[Column], Column]:
    """The numbers of a grid's possible winners, in order of phi, over Arrow batches of month arrays.

    All candidates are possible in series over ``SCREENED`` months, and those
    whose error is no finite number.
    """
    steps = {
        phi: np.array([_screening_steps(c) for c in grid if c[2] == phi], dtype=float).transpose(1, 2, 0)
        for phi in dict.fromkeys(c[2] for c in grid)
    }
    longest = SCREENED

    @F.arrow_udf("array<int>")
    def possible(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            amounts = batch.flatten().to_numpy(zero_copy_only=False)
            short = lengths <= longest
            kept = np.ones((len(lengths), len(grid)), dtype=bool)
            amounts, months = amounts[np.repeat(short, lengths)], lengths[short]
            errors = np.concatenate(
                [smoothing.screened_errors(amounts, months, phi, s) for phi, s in steps.items()], axis=1
            )
            errors[~np.isfinite(errors)] = np.nan
            with np.errstate(over="ignore"):
                squares = np.bincount(np.repeat(np.arange(len(months)), months), amounts * amounts, len(months))
            most = np.fmin.reduce(errors, axis=1) + _SLACK * squares
            kept[short] = ~(errors > most[:, None])
            ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
            numbers = np.nonzero(kept)[1]
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32()))

    # as for the fits: never run once per column that reads the result
    return possible.asNondeterministic()


def fit_by_fold(
    arrays: DataFrame, grid: tuple[tuple[float, float, float], ...] = smoothing.FOLD_GRID, in_batches: bool = False
) -> DataFrame:
    """Non-seasonal fits by a fold over each month array, with built-in expressions only.

    Every candidate (alpha, beta, phi) passes over the months, carrying
    level, trend and the sums of the least-squares problem of its initial
    states; the least sum of squares wins, ties go to the smaller parameters.
    A shorter pass first finds each candidate's sum of squares up to rounding:
    only those that this leaves as possible winners take the full one.
    No Python worker and no shuffle.  ``in_batches`` runs the shorter pass, and
    only that, over Arrow batches in Python workers, for many series: Spark
    interprets its lambdas.  The fits are the same bit by bit.  Columns as
    :func:`fit_arrays`; arrays of three months at least, without NULLs.
    """
    grid = sorted(grid, key=lambda c: c[2])
    candidates = F.expr("array(%s)" % ", ".join(
        f"named_struct('alpha', {a!r}D, 'beta', {b!r}D, 'phi', {p!r}D)" for a, b, p in grid
    ))

    def tried(c: Column) -> Column:
        states = F.array(_fold(F.col("amounts"), c))
        return F.get(F.transform(states, lambda s: _solved(c, s)), F.lit(0))

    def possible(c: Column, k: Column) -> Column:
        return ~F.coalesce(F.get(F.col("_errors"), k) > F.col("_most"), F.lit(False))

    if in_batches:
        deploy.ship(arrays.sparkSession)
        amounts = F.col("amounts").cast("array<double>")
        screened = arrays.withColumn("_possible", _screened_in_batches(grid)(amounts))
        left = F.transform("_possible", lambda k: F.get(candidates, k))
    else:
        screened, left = _screened(arrays, grid), F.filter(candidates, possible)
    n = F.size("amounts")
    n_params = F.lit(3 + 2)
    sse = F.col("fit.sse")
    # a fold for each candidate is dear: the winner must not be computed again for each of its fields
    winner = F.array(F.array_min(F.transform(left, tried)))
    return screened.select(
        "series_key", "last_month", n.alias("n_months"), F.explode(winner).alias("fit")
    ).select(
        "series_key", "last_month", "n_months", n_params.alias("n_params"),
        "fit.alpha", "fit.beta", F.lit(0.0).alias("gamma"), "fit.phi", "fit.level", "fit.trend", "fit.sse",
        F.lit(None).cast("array<double>").alias("season"),
        (F.col("n_months") * F.ln(F.when(sse > 0, sse) / F.col("n_months")) + 2 * n_params).alias("aic"),
    )


def _damping(h: int) -> Column:
    """phi + phi^2 + ... + phi^h"""
    total = F.col("phi")
    for k in range(2, h + 1):
        total = total + F.pow("phi", F.lit(k))
    return total


def point_forecast(h: int) -> Column:
    season = F.coalesce(F.get("season", F.lit((h - 1) % K.SEASON)), F.lit(0.0))
    return F.col("level") + _damping(h) * F.col("trend") + season


#: standard deviations of a normal error between the middle and the 10 or 90 percent point
_TENTH = 1.2815515655446004


def error_growth(h: int) -> Column:
    """Standard deviation of the error ``h`` months ahead, in units of one month's.

    An error of one month reaches the later ones through level and trend, so
    the error of month h is a sum of independent normal errors.
    """
    total = F.lit(1.0)
    for k in range(1, h):
        carry = F.col("alpha") * (1 + F.col("beta") * _damping(k))
        total = total + carry * carry
    return F.sqrt(total)


def bands(fits: DataFrame) -> DataFrame:
    """Expected month amounts with the 10 and 90 percent points of normal errors.

    These are the points that simulated paths tend to as their number grows.
    Amounts are cut at 0 and rounded.
    """
    sigma = F.sqrt(F.col("sse") / F.col("n_months"))

    def money(c: Column) -> Column:
        return numeric.round_even(numeric.clip_zero(c), 2)

    entries = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"),
                F.add_months("last_month", h).alias("month"),
                money(point_forecast(h)).alias("expected"),
                money(point_forecast(h) - _TENTH * sigma * error_growth(h)).alias("p10"),
                money(point_forecast(h) + _TENTH * sigma * error_growth(h)).alias("p90"),
            )
            for h in range(1, K.HORIZON + 1)
        ]
    )
    return fits.select("series_key", F.inline(entries)).select(
        "series_key", "h", formats.year_month(F.col("month")).alias("month"),
        "expected", "p10", "p90",
    )


def short_series(arrays: DataFrame) -> DataFrame:
    """The weighted-mean projection of series with fewer than three months."""
    back = F.size("amounts") - 1 - F.col("i")
    rows = arrays.select("series_key", "last_month", "amounts", F.posexplode("amounts").alias("i", "amount"))
    monthly = rows.select("series_key", "last_month", F.add_months("last_month", -back).alias("month"), "amount")
    ahead = series.project_known(monthly, "9999-12-31")

    def money(c: str) -> Column:
        return numeric.round_even(numeric.clip_zero(F.col(c)), 2)

    return ahead.select(
        "series_key", "h", formats.year_month(F.col("month")).alias("month"),
        money("amount").alias("expected"), money("low").alias("p10"), money("high").alias("p90"),
    )


def forecast(monthly: DataFrame, n_partitions: int | None = None, seasonal: bool = True) -> DataFrame:
    """Every key: smoothing from three months on, the weighted-mean projection below.

    ``method`` says which of the two.  ``seasonal=False`` fits by a fold inside
    the JVM (:func:`fit_by_fold`, screened in batches), without a yearly season.
    """
    arrays = spread_arrays(monthly, n_partitions)
    long = arrays.where(F.size("amounts") >= SHORTEST)
    long = bands(fit_arrays(long) if seasonal else fit_by_fold(long, in_batches=True))
    short = short_series(arrays.where(F.size("amounts") < SHORTEST))
    return long.withColumn("method", F.lit("smoothing")).unionByName(
        short.withColumn("method", F.lit("weighted mean"))
    )


def horizon_total(forecasts: DataFrame) -> DataFrame:
    """Expected amount over the whole horizon per key."""
    return forecasts.groupBy("series_key").agg(F.sum("expected").alias("expected_total"))
