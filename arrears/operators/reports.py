"""Collection, portfolio and distribution reports over the invoice table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrears import contracts as K
from arrears.functions import bands, dates, formats, numeric
from arrears.operators import cleaning, quantiles


def _paid() -> Column:
    return F.col("is_paid") == 1


def _sum_where(condition: Column, value: str = "total") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0.0))


def with_share(df: DataFrame, column: str, alias: str = "share") -> DataFrame:
    """Each row's part of the column total; the total is a scalar subquery."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(alias, numeric.ratio(F.col(column), total))


# --------------------------------------------------------------------------
# Totals
# --------------------------------------------------------------------------


def portfolio_kpis(invoices: DataFrame) -> DataFrame:
    """One row of portfolio figures from a single aggregate."""
    paid = _paid()
    sums = invoices.agg(
        F.count("*").alias("n_invoices"),
        F.count_if(paid).alias("n_paid"),
        F.count_if(F.col("is_paid") == 0).alias("n_pending"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("invoiced"),
        _sum_where(paid).alias("collected"),
        _sum_where(F.col("is_paid") == 0).alias("pending"),
        F.avg(F.when(paid, F.col("days_to_pay"))).alias("avg_days_to_pay"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        F.count_distinct("client").alias("n_clients"),
    )
    return sums.select(
        "*",
        F.coalesce(numeric.ratio(F.col("collected"), F.col("invoiced")) * 100, F.lit(0.0)).alias(
            "pct_collected"
        ),
        (numeric.ratio(F.col("n_paid"), F.col("n_invoices")) * 100).alias("pct_paid"),
        (numeric.ratio(F.col("n_pending"), F.col("n_invoices")) * 100).alias("pct_pending"),
    )


def receivables_kpis(ledger: DataFrame, quotes: DataFrame) -> DataFrame:
    """Open balance, quote pipeline and their sum, with count and mean."""
    open_side = ledger.agg(
        F.coalesce(F.sum("curtrxam"), F.lit(0.0)).alias("open_balance"),
        F.count("*").alias("n_ledger"),
        F.avg("curtrxam").alias("avg_balance"),
    )
    pipeline = quotes.agg(F.coalesce(F.sum("importe"), F.lit(0.0)).alias("p")).scalar()
    return open_side.withColumn("pipeline", pipeline).select(
        "open_balance",
        "pipeline",
        (F.col("open_balance") + F.col("pipeline")).alias("exposure"),
        "n_ledger",
        "avg_balance",
    )


def financial_panorama(invoices: DataFrame, ledger: DataFrame, quotes: DataFrame) -> DataFrame:
    """Invoiced, collected, open balance and pipeline as (position, measure, value)."""
    sales = invoices.agg(
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("invoiced"),
        _sum_where(_paid()).alias("collected"),
    )
    open_side = ledger.agg(F.coalesce(F.sum("curtrxam"), F.lit(0.0)).alias("open_balance"))
    ahead = quotes.agg(F.coalesce(F.sum("importe"), F.lit(0.0)).alias("pipeline"))
    rows = None
    for part in (sales, open_side, ahead):
        long = part.unpivot([], part.columns, "measure", "value")
        rows = long if rows is None else rows.unionByName(long)
    order = F.array(*[F.lit(m) for m in ("invoiced", "collected", "open_balance", "pipeline")])
    return rows.select(F.array_position(order, F.col("measure")).cast("int").alias("position"),
                       "measure", "value")


# --------------------------------------------------------------------------
# Per client
# --------------------------------------------------------------------------


def client_collection(invoices: DataFrame) -> DataFrame:
    """Invoiced, collected and pending per client with the collected share.

    One conditional aggregate instead of joining two; a client without any
    collection gets 0.
    """
    per_client = invoices.where(F.col("client").isNotNull()).groupBy("client").agg(
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("invoiced"),
        _sum_where(_paid()).alias("collected"),
    )
    return per_client.select(
        "client",
        "invoiced",
        "collected",
        (F.col("invoiced") - F.col("collected")).alias("pending"),
        F.coalesce(numeric.ratio(F.col("collected"), F.col("invoiced")) * 100, F.lit(0.0)).alias(
            "pct_collected"
        ),
    )


def aligned_totals(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Outer join of two per-key tables; figures missing on a side become 0."""
    figures = [c for c in left.columns + right.columns if c != key]
    both = left.where(F.col(key).isNotNull()).join(
        right.where(F.col(key).isNotNull()), key, "full_outer"
    )
    return both.select(key, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in figures])


def client_summary(invoices: DataFrame) -> DataFrame:
    """Count, amount, unpaid count and unpaid percent (one decimal) per client."""
    per_client = invoices.where(F.col("client").isNotNull()).groupBy("client").agg(
        F.count("total").alias("n_invoices"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_amount"),
        F.count_if(~_paid()).alias("n_unpaid"),
    )
    pct = numeric.ratio(F.col("n_unpaid"), F.col("n_invoices")) * 100
    return per_client.withColumn("pct_unpaid", numeric.round_even(pct, 1))


def top_by(df: DataFrame, measure: str, key: str = "client", n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest measure; ties break on the key."""
    return df.orderBy(F.col(measure).desc(), key).limit(n)


def risk_map(summary: DataFrame) -> DataFrame:
    """Clients placed against the median amount and the median unpaid percent."""
    medians = quantiles.one_row(
        quantiles.several_quantiles(summary, {"amount": ("total_amount", 0.5), "pct": ("pct_unpaid", 0.5)})
    )
    placed = summary.withColumn("m", medians).select(
        *summary.columns, F.col("m.amount").alias("median_amount"), F.col("m.pct").alias("median_pct_unpaid")
    )
    high_value = F.col("total_amount") > F.col("median_amount")
    high_risk = F.col("pct_unpaid") > F.col("median_pct_unpaid")
    quadrant = (
        F.when(high_value & high_risk, "high value, high risk")
        .when(high_value, "high value, low risk")
        .when(high_risk, "low value, high risk")
        .otherwise("low value, low risk")
    )
    return placed.withColumn("quadrant", quadrant)


def client_median_days(invoices: DataFrame) -> DataFrame:
    """Median days to pay per client over invoices that took a day or more."""
    medians = quantiles.day_quantiles(
        cleaning.paid_after_days(invoices).where(F.col("client").isNotNull()),
        "days_to_pay",
        {"median_days": 0.5},
        by=["client"],
    )
    return medians.withColumn("speed", bands.speed_band(F.col("median_days")))


# --------------------------------------------------------------------------
# Months
# --------------------------------------------------------------------------


def monthly_collected(invoices: DataFrame) -> DataFrame:
    """Collected amount per payment month."""
    return (
        cleaning.for_cash_series(invoices)
        .groupBy(dates.month_start(F.col("paid_date")).alias("month"))
        .agg(F.sum("total").alias("amount"))
    )


def month_highlights(monthly: DataFrame) -> DataFrame:
    """Each month against the monthly mean, with best and worst month marked.

    Ties go to the earliest month.
    """
    day = F.unix_date("month")
    facts = quantiles.one_row(
        monthly.agg(
            F.avg("amount").alias("mean"),
            F.max_by("month", F.struct("amount", -day)).alias("best"),
            F.min_by("month", F.struct("amount", day)).alias("worst"),
        )
    )
    return monthly.withColumn("f", facts).select(
        "month",
        "amount",
        (F.col("amount") >= F.col("f.mean")).alias("above_average"),
        (F.col("month") == F.col("f.best")).alias("is_best"),
        (F.col("month") == F.col("f.worst")).alias("is_worst"),
    )


# --------------------------------------------------------------------------
# Distributions
# --------------------------------------------------------------------------


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles."""
    basics = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    quartiles = quantiles.one_row(
        quantiles.exact_quantiles(df, column, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    )
    return basics.withColumn("q", quartiles).select(
        "count", "mean", "std", "min",
        F.col("q.p25").alias("p25"), F.col("q.p50").alias("p50"), F.col("q.p75").alias("p75"),
        "max",
    )


def centre(df: DataFrame, column: str) -> DataFrame:
    """Mean and median, the two reference lines of every distribution."""
    median = quantiles.exact_quantiles(df, column, {"median": 0.5}).scalar()
    return df.agg(F.avg(column).alias("mean")).withColumn("median", median)


def day_centre(invoices: DataFrame) -> DataFrame:
    """Mean and median of the days to pay, from a per-day histogram."""
    rows = cleaning.paid_after_days(invoices)
    median = quantiles.day_quantiles(rows, "days_to_pay", {"median": 0.5}).scalar()
    return rows.agg(F.avg("days_to_pay").alias("mean")).withColumn("median", median)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed.

    Empty bins are listed too.  A value that the division puts on the wrong
    side of an edge is moved to the bin whose edges enclose it.
    """
    spark = df.sparkSession
    rows = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    limits = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(
        # a constant column gets a unit-wide range around it
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )

    def edge(i: Column) -> Column:
        step = (F.col("r.hi") - F.col("r.lo")) / bins
        return F.when(i >= bins, F.col("r.hi")).otherwise(F.col("r.lo") + i * step)

    placed = rows.withColumn("r", quantiles.one_row(limits)).withColumn(
        "i",
        F.least(
            F.floor((F.col("v") - F.col("r.lo")) / (F.col("r.hi") - F.col("r.lo")) * bins),
            F.lit(bins - 1),
        ).cast("int"),
    )
    i = F.col("i")
    moved = (
        F.when(F.col("v") < edge(i), i - 1)
        .when((F.col("v") >= edge(i + 1)) & (i < bins - 1), i + 1)
        .otherwise(i)
    )
    counts = placed.groupBy(moved.alias("bin")).agg(F.count("*").alias("n"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = spine.join(counts, "bin", "left").withColumn("r", quantiles.one_row(limits))
    return full.where(F.col("r.lo").isNotNull()).select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def speed_histogram(invoices: DataFrame) -> DataFrame:
    """Paid invoices per payment-speed band with shares in percent."""
    counts = (
        cleaning.paid_after_days(invoices)
        .groupBy(bands.speed_band(F.col("days_to_pay")).alias("speed"))
        .agg(F.count("*").alias("n"))
    )
    shared = with_share(counts, "n")
    return shared.select("speed", "n", (F.col("share") * 100).alias("pct"))


def box_plot(invoices: DataFrame) -> DataFrame:
    """Quartiles, whiskers and outlier count of the total, paid and pending."""
    rows = invoices.where("total IS NOT NULL AND is_paid IS NOT NULL").select("is_paid", "total")
    fenced = rows.join(F.broadcast(_fences(rows)), "is_paid")
    inside = F.col("total").between(F.col("low_fence"), F.col("high_fence"))
    return fenced.groupBy("is_paid", "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        # a whisker never ends inside the box
        F.least(F.min(F.when(inside, F.col("total"))), F.col("q1")).alias("low_whisker"),
        F.greatest(F.max(F.when(inside, F.col("total"))), F.col("q3")).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
    )


def box_plot_outliers(invoices: DataFrame) -> DataFrame:
    """Every invoice beyond the whiskers of its group."""
    rows = invoices.where("total IS NOT NULL AND is_paid IS NOT NULL")
    fenced = rows.join(F.broadcast(_fences(rows)), "is_paid")
    return fenced.where(~F.col("total").between(F.col("low_fence"), F.col("high_fence"))).select(
        "invoice_id", "is_paid", "total"
    )


def _fences(rows: DataFrame) -> DataFrame:
    """One row per paid flag, so at most two: safe to broadcast."""
    quartiles = quantiles.exact_quantiles(
        rows, "total", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by="is_paid"
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "*", (F.col("q1") - reach).alias("low_fence"), (F.col("q3") + reach).alias("high_fence")
    )


# --------------------------------------------------------------------------
# Categories
# --------------------------------------------------------------------------


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return with_share(counts, "n").orderBy(F.col("n").desc(), column)


def collected_by_category(categorised: DataFrame) -> DataFrame:
    """Collected amount, invoices and mean ticket per category."""
    return (
        categorised.where(_paid())
        .groupBy("category")
        .agg(
            F.coalesce(F.sum("total"), F.lit(0.0)).alias("collected"),
            F.count("total").alias("n_invoices"),
            F.avg("total").alias("avg_ticket"),
        )
        .select(
            "category",
            formats.display_name(F.col("category"), K.CATEGORY_SHORT_NAMES).alias("category_name"),
            "collected",
            "n_invoices",
            "avg_ticket",
        )
        .orderBy(F.col("collected").desc(), "category")
    )


def category_coverage(categorised: DataFrame) -> DataFrame:
    """How many rows got a category of their own."""
    known = F.count_if(F.col("category") != K.OTHER)
    return categorised.agg(known.alias("n_classified"), F.count("*").alias("n_rows")).select(
        "n_classified", "n_rows",
        numeric.ratio(F.col("n_classified"), F.col("n_rows")).alias("coverage"),
    )


# --------------------------------------------------------------------------
# Pending invoices
# --------------------------------------------------------------------------


def pending_invoices(invoices: DataFrame) -> DataFrame:
    """Unpaid invoices, newest first; ties break on the invoice."""
    return (
        invoices.where("is_paid = 0 AND client IS NOT NULL")
        .select("invoice_id", "client", "invoice_date", "concept", "total")
        .orderBy(F.col("invoice_date").desc_nulls_last(), "invoice_id")
    )


def pending_total(pending: DataFrame) -> DataFrame:
    return pending.agg(
        F.count("*").alias("n_pending"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("pending_total"),
    )


def pending_report(invoices: DataFrame) -> DataFrame:
    """Pending invoices with report formats and the grand total on each row."""
    pending = pending_invoices(invoices)
    grand = pending.agg(F.sum("total")).scalar()
    return pending.select(
        "invoice_id",
        "client",
        formats.day_month_year(F.col("invoice_date")).alias("invoice_date"),
        formats.shorten(F.col("concept")).alias("concept"),
        formats.money(F.col("total")).alias("total"),
        formats.money(grand).alias("grand_total"),
    )


def pending_page(
    invoices: DataFrame, page: int, size: int = K.PAGE_SIZE, slices: int = 4096
) -> DataFrame:
    """One page of the pending invoices; a page past the end shows the last.

    Position and page counters come along, so that the page can be captioned.
    A deep page must not sort everything before it into one task, so the page
    is located first: by counts per day, then by counts per slice of the
    invoice numbers of those days.  Only the slices that the page touches are
    ranked; numbers are unique, which bounds a slice.  Rows without a number
    are a slice of their own behind those of their day, ranked by client,
    concept and total.
    """
    rows = invoices.where("is_paid = 0 AND client IS NOT NULL").select(
        "invoice_id", "client", "invoice_date", "concept", "total"
    )
    newest_first = Window.orderBy(F.col("invoice_date").desc())
    per_day = rows.groupBy("invoice_date").agg(
        F.count("*").alias("n"),
        F.min("invoice_id").alias("low_id"),
        F.max("invoice_id").alias("high_id"),
    )
    n_rows = per_day.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    n_pages = F.greatest(F.ceil(n_rows / size), F.lit(1)).cast("int")
    shown = F.least(F.lit(max(page, 0)), n_pages - 1)
    days = (
        # at most one row per calendar day
        per_day.withColumn("before", F.sum("n").over(newest_first) - F.col("n"))
        .withColumn("first", (shown * size).cast("bigint"))
        .where(
            (F.col("before") < F.col("first") + size)
            & (F.col("before") + F.col("n") > F.col("first"))
        )
    )
    width = F.floor((F.col("high_id") - F.col("low_id")) / slices) + 1
    in_days = rows.join(
        F.broadcast(days.select("invoice_date", "before", "first", "low_id", width.alias("width"))),
        "invoice_date",
    ).withColumn(
        "slice",
        F.coalesce(F.floor((F.col("invoice_id") - F.col("low_id")) / F.col("width")), F.lit(slices + 1)),
    )
    by_slice = Window.partitionBy("invoice_date").orderBy("slice")
    touched = (
        in_days.groupBy("invoice_date", "slice", "before", "first")
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.col("before") + F.sum("n").over(by_slice) - F.col("n"))
        .where((F.col("start") < F.col("first") + size) & (F.col("start") + F.col("n") > F.col("first")))
    )
    in_slice = Window.partitionBy("invoice_date", "slice").orderBy("invoice_id", "client", "concept", "total")
    placed = in_days.join(
        F.broadcast(touched.select("invoice_date", "slice", "start")), ["invoice_date", "slice"]
    ).withColumn("position", F.col("start") + F.row_number().over(in_slice))
    return (
        placed.where(
            (F.col("position") > F.col("first")) & (F.col("position") <= F.col("first") + size)
        )
        .select(
            "position",
            shown.cast("int").alias("page"),
            n_pages.alias("n_pages"),
            n_rows.alias("n_rows"),
            *rows.columns,
        )
        .orderBy("position")
    )
