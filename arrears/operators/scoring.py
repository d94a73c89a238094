"""Client features and the three 0-100 scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from arrears import contracts as K
from arrears.functions import numeric
from arrears.operators import cleaning, quantiles


def client_features(invoices: DataFrame) -> DataFrame:
    """One row per client: counts, amounts, unpaid share and payment speed.

    One shuffle on the client with map-side partial aggregates.  Clients that
    never paid get the 95th percentile of the days over all rows; that figure
    is a scalar subquery over a per-day histogram.
    """
    rows = cleaning.for_scoring(invoices)
    base = rows.groupBy("client").agg(
        F.count("total").alias("n_invoices"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_amount"),
        F.count_if(F.col("is_paid") == 0).alias("n_unpaid"),
        F.avg(F.when(F.col("is_paid") == 1, F.col("days_to_pay"))).alias("avg_paid_days"),
    )
    late = quantiles.day_quantiles(rows, "days_to_pay", {"late": K.LATE_QUANTILE})
    return base.select(
        "client",
        "n_invoices",
        "total_amount",
        "n_unpaid",
        F.coalesce("avg_paid_days", late.scalar()).alias("avg_days_to_pay"),
        numeric.ratio(F.col("n_unpaid"), F.col("n_invoices")).alias("pct_unpaid"),
    )


def client_scores(features: DataFrame, computed_on: str) -> DataFrame:
    """Features plus pay, value and risk scores, relative to this batch.

    Every bound comes from one aggregate over the features; totals of -1 or
    less have no logarithm, so their value score is NULL.
    """
    weight = F.log1p(F.col("n_invoices").cast("double")) * F.when(
        F.col("total_amount") > -1, F.log1p("total_amount")
    )
    weighted = features.withColumn("weight", weight)
    bounds = weighted.agg(
        *[
            fn(name).alias(f"{label}_{name}")
            for name in ("avg_days_to_pay", "pct_unpaid", "weight")
            for label, fn in (("low", F.min), ("high", F.max))
        ]
    )
    scaled = weighted.withColumn("b", quantiles.one_row(bounds))

    def scale(name: str):
        return numeric.min_max(
            F.col(name), F.col(f"b.low_{name}"), F.col(f"b.high_{name}")
        )

    delay, unpaid, value = scale("avg_days_to_pay"), scale("pct_unpaid"), scale("weight")
    risk = F.lit(K.UNPAID_WEIGHT) * unpaid + F.lit(K.DELAY_WEIGHT) * delay
    return scaled.select(
        "client",
        "n_invoices",
        "total_amount",
        "avg_days_to_pay",
        "pct_unpaid",
        numeric.round_even((F.lit(1.0) - delay) * 100, 2).alias("pay_score"),
        numeric.round_even(value * 100, 2).alias("value_score"),
        numeric.round_even(risk * 100, 2).alias("risk_score"),
        F.lit(computed_on).alias("computed_on"),
    )


def top_clients(scores: DataFrame, n: int = 10) -> DataFrame:
    """Best clients by value score with their rank; ties break on the name.

    The window runs over the ``n`` rows that the top-k operator kept.
    """
    order = [F.col("value_score").desc_nulls_last(), F.col("client")]
    top = scores.orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), *scores.columns)


def score_table(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.col("value_score").desc_nulls_last(), "client")


def payment_day_range(features: DataFrame) -> DataFrame:
    """Least, median and most average days to pay over the clients."""
    return quantiles.exact_quantiles(
        features, "avg_days_to_pay", {"min_days": 0.0, "median_days": 0.5, "max_days": 1.0}
    )
