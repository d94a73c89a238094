"""Monthly series per key, and the weighted-mean projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrears import contracts as K
from arrears.functions import dates, numeric


def monthly_series(payments: DataFrame, key: Column | None = None) -> DataFrame:
    """``series_key, month, amount`` from rows with ``paid_date`` and ``total``.

    Partial sums per month leave each task before the shuffle, so a key that
    holds most of the rows costs a few hundred rows per task.
    """
    key = F.lit("all") if key is None else key
    return (
        payments.where("paid_date IS NOT NULL AND total IS NOT NULL")
        .groupBy(key.alias("series_key"), dates.month_start(F.col("paid_date")).alias("month"))
        .agg(F.sum("total").alias("amount"))
        .where(F.col("series_key").isNotNull())
    )


def fill_months(monthly: DataFrame) -> DataFrame:
    """Every month from a key's first to its last; missing months are 0.

    Each month also emits the empty months up to the next one, so there is no
    calendar table and no join.  Further columns are carried along.
    """
    extra = [c for c in monthly.columns if c not in ("series_key", "month", "amount")]
    ahead = F.lead("month").over(Window.partitionBy("series_key").orderBy("month"))
    until = F.coalesce(F.add_months(ahead, -1), F.col("month"))
    spread = monthly.withColumn("until", until).select(
        "series_key",
        F.col("month").alias("own"),
        "amount",
        *extra,
        F.explode(F.sequence("month", "until", F.expr("interval 1 month"))).alias("month"),
    )
    return spread.select(
        "series_key",
        "month",
        F.when(F.col("month") == F.col("own"), F.col("amount")).otherwise(0.0).alias("amount"),
        *extra,
    )


def with_last_month(monthly: DataFrame) -> DataFrame:
    """Adds each key's last month, payments with a future date included.

    Everything that is derived from the result reads one shuffle by key: a
    filter on the month is not pushed below the window.
    """
    return monthly.withColumn(
        "last_month", F.max("month").over(Window.partitionBy("series_key"))
    )


def history(monthly: DataFrame, as_of: str) -> DataFrame:
    """Months up to today, gaps filled per key."""
    return fill_months(monthly.where(F.col("month") <= F.lit(as_of).cast("date")))


def programmed(monthly: DataFrame, as_of: str) -> DataFrame:
    """Months after today: payments that already have a date."""
    return monthly.where(F.col("month") > F.lit(as_of).cast("date"))


def last_months(filled: DataFrame, n: int = K.WINDOW_MONTHS) -> DataFrame:
    """The last ``n`` months per key (fewer if there are fewer).

    ``i`` counts from 0 at the oldest kept month, ``n_months`` is their number.
    """
    newest = Window.partitionBy("series_key").orderBy(F.col("month").desc())
    whole = Window.partitionBy("series_key")
    kept = filled.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= n)
    return kept.withColumn("n_months", F.count("*").over(whole).cast("int")).withColumn(
        "i", (F.col("n_months") - F.col("back")).cast("int")
    ).drop("back")


def window_statistics(window: DataFrame, *carried: str) -> DataFrame:
    """Weighted mean, slope and deviation of each key's last months.

    Weights are exp(0) for the oldest month up to exp(1) for the newest.
    ``carried`` columns are constant per key.
    """
    weight = F.exp(F.coalesce(numeric.ratio(F.col("i"), F.col("n_months") - 1), F.lit(0.0)))
    return window.withColumn("weight", weight).groupBy("series_key").agg(
        F.count("*").alias("n_months"),
        (F.sum(F.col("weight") * F.col("amount")) / F.sum("weight")).alias("weighted_mean"),
        F.coalesce(F.regr_slope("amount", F.col("i").cast("double")), F.lit(0.0)).alias("slope"),
        F.stddev_samp("amount").alias("deviation"),
        *[F.max(c).alias(c) for c in carried],
    )


def project(monthly: DataFrame, as_of: str, horizon: int = K.HORIZON) -> DataFrame:
    """Projected months per key with a band of 1.5 deviations.

    Level and slope use the months up to today; the projected months follow
    the last month of the whole series, payments with a future date included.
    A key without history yields no rows.
    """
    return project_known(with_last_month(monthly), as_of, horizon)


def project_known(tagged: DataFrame, as_of: str, horizon: int = K.HORIZON) -> DataFrame:
    """``project`` of months that already carry their key's ``last_month``."""
    stats = window_statistics(last_months(history(tagged, as_of)), "last_month")
    spread = F.coalesce(
        F.when(F.col("n_months") > 1, F.col("deviation")),
        F.col("weighted_mean") * K.SINGLE_POINT_BAND,
    )
    ahead = stats.withColumn("spread", F.lit(K.BAND_SIGMAS) * spread).withColumn(
        "h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    )
    value = numeric.clip_zero(F.col("weighted_mean") + F.col("slope") * F.col("h"))
    return ahead.withColumn("amount", value).select(
        "series_key",
        "h",
        F.add_months("last_month", F.col("h")).alias("month"),
        "amount",
        numeric.clip_zero(F.col("amount") - F.col("spread")).alias("low"),
        (F.col("amount") + F.col("spread")).alias("high"),
    )


def cash_outlook(monthly: DataFrame, as_of: str, horizon: int = K.HORIZON) -> DataFrame:
    """History, programmed and projected months in one long table.

    One pass over one exchange by key: months up to today fill the gap to the
    next one, later months stay as they are, and the last month of the history
    carries the projection of :func:`project` behind it.
    """
    now = F.lit(as_of).cast("date")
    key = Window.partitionBy("series_key")
    ahead = F.lead("month").over(key.orderBy("month"))
    past = F.col("month") <= now
    until = F.when(past & (ahead <= now), F.add_months(ahead, -1)).otherwise(F.col("month"))
    filled = (
        monthly.select("series_key", "month", "amount", until.alias("until"), F.max("month").over(key).alias("last_month"))
        .withColumn("own", F.col("month"))
        .withColumn("month", F.explode(F.sequence("own", "until", F.expr("interval 1 month"))))
        .withColumn("amount", F.when(F.col("month") == F.col("own"), F.col("amount")).otherwise(0.0))
        .withColumn("kind", F.when(F.col("own") <= now, "history").otherwise("programmed"))
    )
    kind = Window.partitionBy("series_key", "kind")
    newest = kind.orderBy(F.col("month").desc())
    back = F.row_number().over(newest)
    n_months = F.least(F.count("*").over(kind), F.lit(K.WINDOW_MONTHS))
    # newest first: this row and the next ones are the window of the last month
    window = newest.rowsBetween(Window.currentRow, K.WINDOW_MONTHS - 1)
    placed = filled.withColumn("back", back).withColumn("n_months", n_months).withColumn(
        "i", (F.col("n_months") - F.col("back")).cast("double")
    )
    weight = F.exp(F.coalesce(numeric.ratio(F.col("i"), F.col("n_months") - 1), F.lit(0.0)))
    known = placed.withColumn("weight", weight).withColumns(
        {
            "mean": F.sum(F.col("weight") * F.col("amount")).over(window) / F.sum("weight").over(window),
            "slope": F.coalesce(F.regr_slope("amount", "i").over(window), F.lit(0.0)),
            "deviation": F.stddev_samp("amount").over(window),
        }
    )
    spread = F.lit(K.BAND_SIGMAS) * F.coalesce(
        F.when(F.col("n_months") > 1, F.col("deviation")), F.col("mean") * K.SINGLE_POINT_BAND
    )

    def entry(month: Column, what: Column, amount: Column, low: Column, high: Column) -> Column:
        return F.struct(
            month.alias("month"), what.alias("kind"), amount.alias("amount"), low.alias("low"), high.alias("high")
        )

    none = F.lit(None).cast("double")
    own = entry(F.col("month"), F.col("kind"), F.col("amount"), none, none)
    steps = []
    for h in range(1, horizon + 1):
        value = numeric.clip_zero(F.col("mean") + F.col("slope") * h)
        steps.append(
            entry(F.add_months("last_month", h), F.lit("projected"), value, numeric.clip_zero(value - spread), value + spread)
        )
    last = (F.col("kind") == "history") & (F.col("back") == 1)
    return known.select("series_key", F.inline(F.when(last, F.array(own, *steps)).otherwise(F.array(own))))
