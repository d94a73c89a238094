import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.functions import bands, formats
from arrears.operators import quantiles, reports, scoring

FEATURES = "client string, n_invoices bigint, total_amount double, avg_days_to_pay double, pct_unpaid double"


def test_features_and_imputation(spark):
    rows = [("X", 100.0, 1, 4), ("X", 200.0, 1, 6), ("Y", 500.0, 1, 0), ("Z", 1000.0, 0, None), ("Z", 1000.0, 0, None),
            (None, 5.0, 1, 900), ("X", None, 1, 900)]
    df = spark.createDataFrame(rows, "client string, total double, is_paid int, days_to_pay int").select(
        "*", F.lit(None).cast("date").alias("invoice_date"), F.lit(None).cast("date").alias("paid_date"))
    out = {r.client: r for r in scoring.client_features(df).collect()}
    assert (out["X"].n_invoices, out["X"].total_amount, out["X"].pct_unpaid, out["X"].avg_days_to_pay) == (2, 300.0, 0.0, 5.0)
    assert (out["Y"].n_invoices, out["Y"].avg_days_to_pay) == (1, 0.0)
    assert (out["Z"].total_amount, out["Z"].pct_unpaid) == (2000.0, 1.0)
    assert out["Z"].avg_days_to_pay == pytest.approx(5.8)


def test_scores_by_hand(spark):
    rows = [("A", 1, 1000.0, 0.0, 0.0), ("B", 10, 10000.0, 10.0, 0.5), ("C", 5, 5000.0, 30.0, 1.0), ("D", 20, 50000.0, 60.0, 0.25)]
    out = {r.client: r for r in scoring.client_scores(spark.createDataFrame(rows, FEATURES), "2026-06-11").collect()}
    want = {"A": (100.0, 0.0, 0.0), "B": (83.33, 36.67, 61.44), "C": (50.0, 80.0, 37.20), "D": (0.0, 55.0, 100.0)}
    for client, (pay, risk, value) in want.items():
        assert out[client].pay_score == pytest.approx(pay, abs=0.01)
        assert out[client].risk_score == pytest.approx(risk, abs=0.01)
        assert out[client].value_score == pytest.approx(value, abs=0.02)


def test_constant_columns_and_missing_logarithm(spark):
    rows = [("A", 3, 100.0, 7.0, 0.5), ("B", 3, -5.0, 7.0, 0.5)]
    out = {r.client: r for r in scoring.client_scores(spark.createDataFrame(rows, FEATURES), "x").collect()}
    assert (out["A"].pay_score, out["A"].risk_score, out["A"].value_score) == (100.0, 0.0, 0.0)
    assert out["B"].value_score is None


def test_scores_stay_in_range_and_rank(spark):
    rng = random.Random(1)
    rows = [(f"C{i:03}", rng.randint(1, 50), rng.random() * 1e6, rng.random() * 300, rng.random()) for i in range(200)]
    scores = scoring.client_scores(spark.createDataFrame(rows, FEATURES), "x")
    for name in ("pay_score", "value_score", "risk_score"):
        low, high = scores.agg(F.min(name), F.max(name)).first()
        assert 0 <= low <= high <= 100
    top = scoring.top_clients(scores).collect()
    assert [r["rank"] for r in top] == list(range(1, 11))
    assert [r.value_score for r in top] == sorted((r.value_score for r in top), reverse=True)


@pytest.mark.parametrize("values", [
    [float(v) for v in range(1, 5)],
    [5.0],
    [1.0, 1.0, 1.0, 9.0],
    [random.Random(2).gauss(0, 1e6) for _ in range(5000)],
    [7.25] * 3000 + [random.Random(3).random() for _ in range(3000)],
])
def test_exact_quantiles_match_linear_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    row = quantiles.exact_quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_exact_quantiles_by_group(spark):
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.3), rng.random() * 1e5) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g int, v double")
    for r in quantiles.exact_quantiles(df, "v", {"q1": 0.25, "q3": 0.75}, by="g").collect():
        group = [v for g, v in rows if g == r.g]
        assert r.q1 == pytest.approx(np.quantile(group, 0.25))
        assert r.q3 == pytest.approx(np.quantile(group, 0.75))


def test_exact_quantiles_of_values_close_together(spark):
    rng = random.Random(6)
    values = [1e6 + rng.random() * 1e-6 for _ in range(20000)] + [-1e300, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    row = quantiles.exact_quantiles(df, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    assert [row.p10, row.p50, row.p99] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.99]).tolist(), rel=1e-15)


def test_cuts_deal_clustered_values_evenly(spark):
    values = [0.0, 1e9] + [5.0 + i * 1e-9 for i in range(20 * quantiles.SLICES)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shares = [i / quantiles.SLICES for i in range(1, quantiles.SLICES)]
    edges = df.select(F.percentile_approx("v", F.lit(shares), quantiles.CUT_ACCURACY).alias("c")).first().c
    cuts = F.lit(edges)
    held = df.groupBy(quantiles.cuts_below(cuts, F.col("v")).alias("s")).count().collect()
    assert len(held) == quantiles.SLICES and max(r["count"] for r in held) <= 40
    got = {r.v: r.s for r in df.select("v", quantiles.cuts_below(cuts, F.col("v")).alias("s")).collect()}
    assert got == {v: int(np.searchsorted(edges, v)) for v in values}


def test_quantiles_order_infinite_amounts_and_pass_over_nan(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in [inf, inf, inf, 1.0, -inf, nan, None]], "v double")
    row = quantiles.exact_quantiles(df, "v", {"low": 0.0, "p25": 0.25, "p75": 0.75, "high": 1.0}).first()
    assert [row.low, row.p25, row.p75, row.high] == [-inf, 1.0, inf, inf]


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles.exact_quantiles(df, "v", {"m": 0.5}).first().m is None


@pytest.mark.parametrize("values", [
    [0.1 * i for i in range(31)], [1.0, 2.0, 2.0, 5.0], [3.0, 3.0],
    [random.Random(5).random() for _ in range(1000)],
])
def test_histogram_matches_numpy(spark, values):
    out = reports.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r.n for r in out] == counts.tolist()
    assert [r.low for r in out] == pytest.approx(edges[:-1].tolist())
    assert [r.high for r in out] == pytest.approx(edges[1:].tolist())


def test_bands_at_their_edges(spark):
    df = spark.createDataFrame([(70.0,), (70.01,), (40.0,), (39.99,)], "s double")
    assert [r[0] for r in df.select(bands.risk_band(F.col("s"))).collect()] == ["MEDIO", "ALTO", "MEDIO", "BAJO"]
    assert [r[0] for r in df.select(bands.score_band(F.col("s"))).collect()] == ["green", "green", "orange", "red"]
    df = spark.createDataFrame([(30,), (31,), (60,), (61,), (None,)], "d int")
    assert [r[0] for r in df.select(bands.speed_band(F.col("d"))).collect()] == ["<=30", "31-60", "31-60", ">60", None]


def test_formats(spark):
    df = spark.createDataFrame([(1234567.891, "2025-03-05", "x" * 60)], "v double, d string, t string")
    row = df.select(
        formats.money(F.col("v")), formats.compact_money(F.col("v")), formats.compact_money(F.lit(2500.0)),
        formats.month_name_year(F.col("d").cast("date")), formats.shorten(F.col("t")), formats.percent(F.lit(0.256)),
        formats.money(F.lit(-5.0)),
    ).first()
    assert list(row) == ["$1,234,567.89", "$1.2M", "$2k", "Marzo 2025", "x" * 55 + "…", "25.6%", "$-5.00"]


def test_a_client_with_a_third_of_the_rows(spark):
    """Same figures as a plain computation when one client dominates."""
    rng = random.Random(6)
    rows = []
    for i in range(12000):
        client = "HOT" if i % 3 == 0 else f"C{rng.randint(1, 400):03}"
        paid = rng.random() < 0.6
        rows.append((i, client, float(rng.randint(1, 10**6)) / 100, int(paid), rng.randint(0, 400) if paid else None))
    df = spark.createDataFrame(rows, "invoice_id int, client string, total double, is_paid int, days_to_pay int").select(
        "*", F.lit("2025-01-01").cast("date").alias("invoice_date"), F.lit(None).cast("date").alias("paid_date"),
        F.lit("x").alias("concept"))
    features = {r.client: r for r in scoring.client_features(df).collect()}
    medians = {r.client: r.median_days for r in reports.client_median_days(df).collect()}
    for client in ("HOT", "C001", "C400"):
        mine = [r for r in rows if r[1] == client]
        days = [r[4] for r in mine if r[3]]
        assert features[client].n_invoices == len(mine)
        assert features[client].total_amount == pytest.approx(sum(r[2] for r in mine))
        assert features[client].avg_days_to_pay == pytest.approx(np.mean(days))
        assert medians[client] == pytest.approx(np.median([d for d in days if d > 0]))
    # every pending page holds the rows that a plain sort puts there
    pending = sorted(r[0] for r in rows if not r[3])
    for page in (0, 7, 10**6):
        first = min(page, -(-len(pending) // 15) - 1) * 15
        got = reports.pending_page(df, page, slices=16).collect()
        assert [r.invoice_id for r in got] == pending[first:first + 15]
        assert got[0].n_rows == len(pending)
