"""Every operator as a named query over a folder of order tables.

Doubles are rounded half to even (2 digits for money and scores, 6 for
ratios), so that two engines that add in a different order agree.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrears import contracts as K
from arrears.functions import bands, dates, formats, numeric, text
from arrears.operators import (
    classifier, cleaning, evaluation, forecast, keyword_rules, quality, reports, sampling, scoring, series, tfidf,
)
from arrears.sources import invoice_export as exports, order_tables as feed, staging, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "1999-01-01"
COMPUTED_ON = "2026-06-11"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: numeric.round_even(F.col(c), digits) for c in columns})


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.client_features(feed.invoices(spark, sf_dir))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.client_scores(_features(spark, sf_dir), COMPUTED_ON)


# --------------------------------------------------------------------------
# Scans, sinks, cleaning
# --------------------------------------------------------------------------


@query
def invoice_export(spark, sf_dir):
    """The raw export with trimmed headers."""
    raw = cleaning.trim_headers(feed.raw_invoices(spark, sf_dir))
    return raw.select(
        F.col("Folio").alias("folio"),
        F.col("Cliente").alias("cliente"),
        F.col("Fecha").alias("fecha"),
        F.col("FECHA DE PAGO").alias("fecha_de_pago"),
        F.col("Concepto").alias("concepto"),
        F.col("Total").alias("total"),
    )


@query
def clean_invoices(spark, sf_dir):
    return cleaning.clean_invoices(feed.raw_invoices(spark, sf_dir))


@query
def clean_invoices_from_csv(spark, sf_dir):
    """Write the export as CSV files, scan the folder as text, clean it."""
    path = staging.fresh_path(spark, "export")
    raw = feed.raw_invoices(spark, sf_dir)
    exports.write_csv(raw.select(*[F.col(f"`{n}`") for n in K.RAW_INVOICES.fieldNames()]), path)
    return cleaning.clean_invoices(exports.read_invoices(spark, path))


@query
def invoices_from_shuffled_csv(spark, sf_dir):
    """Two exports, one with other column order, further columns and fractional numbers."""
    path = staging.fresh_path(spark, "export")
    raw = cleaning.trim_headers(feed.raw_invoices(spark, sf_dir))
    half = F.col("Folio").cast("bigint") % 2 == 0
    exports.write_csv(raw.where(half).withColumnRenamed("Total", " Total "), f"{path}/plain")
    other = raw.where(~half).select(
        F.lit("x").alias("Notas"), "Cliente", F.concat("Folio", F.lit(".0")).alias(" Folio"), F.col("FECHA DE PAGO"),
        "Fecha", F.lit(1).alias("Extra"), "Concepto", F.col("Total").alias("Total "),
    )
    exports.write_csv(other, f"{path}/other")
    return cleaning.clean_invoices(exports.read_invoices(spark, f"{path}/*"))


@query
def date_spellings(spark, sf_dir):
    """One date per order in twelve spellings, one of them no date."""
    date = F.col("o_orderdate")
    forms = [
        "dd/MM/yyyy", "d/M/yyyy", "dd/MM/yyyy HH:mm", "dd-MM-yyyy", "dd/MM/yy", "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd HH:mm:ss.SSS", "  dd/MM/yyyy ", "yyyy-MM-dd", "dd.MM.yyyy", "yyyy/MM/dd",
    ]
    kind = F.col("o_orderkey") % (len(forms) + 1)
    spelled = F.when(kind == len(forms), F.lit("32/13/2025"))
    for i, form in enumerate(forms):
        spelled = spelled.when(kind == i, F.date_format(date, form))
    rows = feed.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), kind.alias("kind"), spelled.alias("spelled")
    )
    # two digits say nothing about the century: those dates come out in this one
    return rows.select(
        "order_key", "kind", dates.mixed_date(F.col("spelled")).alias("lenient"),
        dates.mixed_date(F.col("spelled"), iso_text=False).alias("strict"),
    )


@query
def dropped_invoices(spark, sf_dir):
    raw = cleaning.trim_headers(feed.raw_invoices(spark, sf_dir))
    spoiled = F.when(F.col("Folio").cast("bigint") % 31 == 0, F.lit("pronto")).otherwise(F.col("FECHA DE PAGO"))
    return cleaning.dropped_invoices(raw.withColumn("FECHA DE PAGO", spoiled))


@query
def scanned_labels(spark, sf_dir):
    """Write a label file with the columns in another order, scan it by header."""
    path = staging.fresh_path(spark, "labels")
    rows = feed.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("categoria_modelo"), F.col("p_name").alias("concepto"), F.col("p_brand").alias("etiqueta_auto")
    )
    exports.write_csv(rows, path)
    return exports.read_labels(spark, path)


@query
def invoices_with_line_breaks(spark, sf_dir):
    """Exports with line breaks and quotes in the concepts, scanned in splits of 64 KB and cleaned."""
    path = staging.fresh_path(spark, "export")
    raw = feed.raw_invoices(spark, sf_dir)
    rows = raw.select(*[F.col(f"`{n}`") for n in K.RAW_INVOICES.fieldNames()])
    broken = F.when(
        F.col("Folio").cast("bigint") % 3 == 0,
        F.concat(F.lit("uno\n\"dos\", "), F.coalesce("Concepto", F.lit("")), F.lit("\n\ntres")),
    ).otherwise(F.col("Concepto"))
    exports.write_csv(rows.withColumn("Concepto", broken), path, for_excel=True)
    with exports.quoted_records.splits_of(spark, 1 << 16):
        # a written table: the scan keeps the splits that it was planned with
        return staging.kept(cleaning.clean_invoices(exports.read_invoices(spark, path)), "scanned")


@query
def sheet_with_line_breaks(spark, sf_dir):
    """Ledger sheets whose order numbers hold line breaks, banner and header included."""
    path = staging.fresh_path(spark, "sheet")
    ledger = feed.raw_ledger(spark, sf_dir).where("factura IS NOT NULL")
    cells = [F.concat("oc", F.lit("\nlote \"B\"")).alias("oc") if c == "oc" else F.col(c) for c in K.LEDGER.fieldNames()]
    line = F.to_csv(F.struct(F.lit("").alias("blank"), *cells), {"escape": exports.ESCAPE, "quoteAll": "true"})
    body = ledger.select(F.pmod(F.xxhash64("factura"), F.lit(3)).alias("sheet"), F.lit(9).alias("place"), line.alias("value"))
    top = spark.range(3).select(
        F.col("id").alias("sheet"),
        F.posexplode(F.array(F.lit('"Cartera\nvencida"'), F.lit(""), F.lit(',Factura,"O\nC",Saldo,Orig,Fecha'))).alias("place", "value"),
    )
    every = top.unionByName(body).repartition("sheet").sortWithinPartitions("sheet", "place")
    every.select("sheet", "value").write.partitionBy("sheet").text(path)
    with exports.quoted_records.splits_of(spark, 1 << 12):
        found = staging.kept(exports.read_sheet(spark, path, K.LEDGER, 2, skip_columns=1), "scanned")
    return rounded(cleaning.clean_ledger(found), 2, "curtrxam")


@query
def scanned_sheet(spark, sf_dir):
    """Write ledger sheets with banner, header and an empty first column, scan and clean them."""
    path = staging.fresh_path(spark, "sheet")
    ledger = feed.raw_ledger(spark, sf_dir)
    sheet = F.pmod(F.xxhash64("factura"), F.lit(3))
    line = F.to_csv(F.struct(F.lit("").alias("blank"), *[F.col(c) for c in K.LEDGER.fieldNames()]), {"escape": exports.ESCAPE})
    body = ledger.where("factura IS NOT NULL").select(sheet.alias("sheet"), F.lit(9).alias("place"), line.alias("value"))
    top = spark.range(3).select(
        F.col("id").alias("sheet"), F.posexplode(F.array(F.lit("Cartera"), F.lit(""), F.lit(",Factura,OC,Saldo,Orig,Fecha"))).alias("place", "value")
    )
    every = top.unionByName(body).repartition("sheet").sortWithinPartitions("sheet", "place")
    every.select("sheet", "value").write.partitionBy("sheet").text(path)
    return rounded(cleaning.clean_ledger(exports.read_sheet(spark, path, K.LEDGER, 2, skip_columns=1)), 2, "curtrxam")


@query
def copied_tables(spark, sf_dir):
    """Copies of catalog tables; missing and empty sources are passed over."""
    name = f"copied_{uuid.uuid4().hex}"
    root = staging.fresh_path(spark, "tables")
    sources = {n: feed.table(spark, sf_dir, n) for n in ("customer", "supplier")}
    sources["empty"] = feed.table(spark, sf_dir, "nation").limit(0)
    for n, df in sources.items():
        tables.swap_table(spark, f"{name}_{n}", df, root)
    pairs = {f"{name}_{n}": f"{name}_{n}_copy" for n in [*sources, "missing"]}
    report = tables.copy_tables(spark, pairs, root)
    return report.withColumn("table_name", F.replace("table_name", F.lit(f"{name}_"), F.lit("")))


@query
def date_parsing_modes(spark, sf_dir):
    """Lenient and strict reading of the same date text."""
    raw = feed.raw_invoices(spark, sf_dir)
    return raw.select(
        F.col("Folio").cast("bigint").alias("invoice_id"),
        dates.mixed_date(F.col("Fecha")).alias("lenient"),
        dates.mixed_date(F.col("Fecha"), iso_text=False).alias("strict"),
    )


@query
def invoices_for_scoring(spark, sf_dir):
    return cleaning.for_scoring(feed.invoices(spark, sf_dir))


@query
def payments_for_cash_series(spark, sf_dir):
    return cleaning.for_cash_series(feed.invoices(spark, sf_dir))


@query
def invoices_for_classifier(spark, sf_dir):
    return cleaning.for_classifier(feed.invoices(spark, sf_dir))


@query
def invoices_with_total(spark, sf_dir):
    return cleaning.with_total(feed.invoices(spark, sf_dir))


@query
def ledger_balances(spark, sf_dir):
    return cleaning.clean_ledger(feed.raw_ledger(spark, sf_dir))


@query
def open_quotes(spark, sf_dir):
    return cleaning.clean_quotes(feed.raw_quotes(spark, sf_dir))


@query
def widened_invoices(spark, sf_dir):
    return cleaning.widen(feed.invoices(spark, sf_dir))


@query
def conformed_invoices(spark, sf_dir):
    return cleaning.conform(cleaning.widen(feed.invoices(spark, sf_dir)))


def _documents(spark, sf_dir):
    docs = feed.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return tfidf.spread(docs, "doc_id")


@query
def normalized_documents(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", text.normalize(F.col("text")).alias("normalized"))


@query
def invoice_categories(spark, sf_dir):
    """Keyword category of every invoice concept."""
    rows = cleaning.keyword_categories(feed.invoices(spark, sf_dir))
    return rows.select(
        "invoice_id", "category", formats.display_name(F.col("category")).alias("category_name")
    )


@query
def documents_by_rule_table(spark, sf_dir):
    """The first benchmark item whose opening words a document holds: as many rules as there are items."""
    rules = feed.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("priority"), F.col("item_id").cast("string").alias("category"),
        F.upper(F.left("text", F.lit(24))).alias("keyword"),
    )
    found = keyword_rules.categories_by_rules(_documents(spark, sf_dir).select("doc_id", "text"), "text", rules)
    return found.select("doc_id", "category")


@query
def report_formats(spark, sf_dir):
    rows = feed.invoices(spark, sf_dir)
    return rows.select(
        "invoice_id",
        formats.day_month_year(F.col("invoice_date")).alias("day"),
        formats.year_month(F.col("invoice_date")).alias("year_month"),
        formats.month_name_year(F.col("invoice_date")).alias("month_name"),
        formats.money(F.col("total")).alias("money"),
        formats.compact_money(F.col("total") * 5).alias("compact"),
        formats.shorten(F.col("concept"), 30).alias("short_marked"),
        formats.shorten(F.col("concept"), 22, "").alias("short_plain"),
        formats.percent(F.col("total") / 1_000_000).alias("pct"),
    )


@query
def rounding(spark, sf_dir):
    """Half-to-even rounding at 1, 2 and 4 digits."""
    lines = feed.table(spark, sf_dir, "lineitem")
    part = F.col("l_quantity") / 8
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        numeric.round_even(part, 1).alias("one"),
        numeric.round_even(part, 2).alias("two"),
        numeric.round_even(F.col("l_extendedprice") / 1024, 4).alias("four"),
    )


@query
def guarded_math(spark, sf_dir):
    rows = feed.invoices(spark, sf_dir)
    out = rows.select(
        "invoice_id",
        F.log1p("total").alias("log_total"),
        F.exp(F.col("is_paid") * 0.5).alias("exp_paid"),
        numeric.clip_zero(F.col("total") - 200000).alias("above"),
        numeric.ratio(F.col("total"), F.col("is_paid")).alias("guarded_ratio"),
        numeric.ratio(F.col("total"), F.col("days_to_pay")).alias("per_day"),
    )
    return rounded(out, 6, "log_total", "exp_paid", "above", "guarded_ratio", "per_day")


@query
def business_filters(spark, sf_dir):
    """The optional, membership and business-rule filters in one table."""
    rows = cleaning.keyword_categories(feed.invoices(spark, sf_dir))
    rows = cleaning.equal_if_present(rows, "client_type", "any")
    rows = cleaning.equal_if_present(rows, "is_paid", 1)
    rows = cleaning.only_members(rows, "category", [])
    rows = cleaning.only_members(rows, "category", ["instalacion_nueva", "venta_refaccion"])
    rows = cleaning.paid_after_days(rows).where(F.col("category") != K.OTHER)
    due = dates.month_start(F.col("paid_date")) <= F.lit(AS_OF).cast("date")
    return rows.select("invoice_id", "category", "days_to_pay", due.alias("up_to_today"))


# --------------------------------------------------------------------------
# Scores
# --------------------------------------------------------------------------


@query
def client_features(spark, sf_dir):
    out = rounded(_features(spark, sf_dir), 2, "total_amount")
    return rounded(out, 6, "avg_days_to_pay", "pct_unpaid")


@query
def client_scores(spark, sf_dir):
    out = rounded(_scores(spark, sf_dir), 2, "total_amount")
    return rounded(out, 6, "avg_days_to_pay", "pct_unpaid")


@query
def top_clients_by_value(spark, sf_dir):
    top = scoring.top_clients(_scores(spark, sf_dir)).drop("computed_on")
    return rounded(rounded(top, 2, "total_amount"), 6, "avg_days_to_pay", "pct_unpaid")


@query
def score_table(spark, sf_dir):
    """All scores by value with the bands that the page shows."""
    ranked = scoring.score_table(_scores(spark, sf_dir))
    return ranked.select(
        "client",
        "pay_score",
        "value_score",
        "risk_score",
        bands.score_band(F.col("pay_score")).alias("pay_band"),
        bands.score_band(F.col("value_score")).alias("value_band"),
        bands.risk_band(F.col("risk_score")).alias("risk_band"),
        bands.unpaid_alert(F.col("pct_unpaid")).alias("unpaid_alert"),
    )


@query
def payment_day_range(spark, sf_dir):
    out = scoring.payment_day_range(_features(spark, sf_dir))
    return rounded(out, 6, "min_days", "median_days", "max_days")


@query
def client_selector(spark, sf_dir):
    return cleaning.selector_values(feed.invoices(spark, sf_dir), "client")


# --------------------------------------------------------------------------
# Guards
# --------------------------------------------------------------------------


@query
def invoice_load_problems(spark, sf_dir):
    """Line items loaded as if they were invoices: repeated and missing values."""
    rows = feed.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("invoice_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate").cast("date")).alias("invoice_date"),
        F.when(F.col("l_linestatus") != "F", F.lit("x")).alias("client"),
        F.col("l_extendedprice").alias("total"),
        F.lit(0).alias("is_paid"),
    )
    return quality.problems(rows, quality.INVOICE_GUARD, 1_000_000_000)


@query
def clean_load_problems(spark, sf_dir):
    """The clean invoices break one rule only: every tenth number has lost its total."""
    rows = feed.invoices(spark, sf_dir)
    broken = rows.withColumn("total", F.when(F.col("invoice_id") % 10 != 0, F.col("total")))
    return quality.problems(broken, quality.INVOICE_GUARD, 0)


@query
def contract_refusals(spark, sf_dir):
    """Batches without numbers, clients, dates or totals do not get into the table."""
    table = f"contract_{uuid.uuid4().hex}"
    root = staging.fresh_path(spark, "tables")
    rows = feed.invoices(spark, sf_dir)
    tables.guarded_swap(spark, table, rows, quality.INVOICE_GUARD, root, K.INVOICES)
    refused = []
    for column in ("invoice_id", "client", "invoice_date", "total"):
        lost = F.when(F.col("is_paid") == 1, F.col(column)).alias(column)
        try:
            tables.guarded_swap(
                spark, table, rows.select(*[lost if c == column else c for c in rows.columns]), quality.INVOICE_GUARD, root
            )
        except quality.ValidationError as error:
            refused.append((column, len(error.problems)))
    n_rows = spark.table(table).count()
    return spark.createDataFrame([(c, n, n_rows) for c, n in refused], "column_name string, n_problems int, n_rows bigint")


@query
def repeats_of_a_refusal(spark, sf_dir):
    """The full list of repeated numbers that hangs on a refusal."""
    rows = feed.invoices(spark, sf_dir)
    twice = rows.unionByName(rows.where("invoice_id % 7 = 0"))
    try:
        quality.refuse_if_broken(twice, "invoices", quality.INVOICE_GUARD, 0)
    except quality.ValidationError as error:
        return error.repeated
    raise AssertionError("the batch was not refused")


@query
def score_load_problems(spark, sf_dir):
    """Orders loaded as if they were scores: one client per order."""
    rows = feed.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("client")
    )
    return quality.problems(rows, quality.SCORE_GUARD, 0)


@query
def repeated_invoice_keys(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("invoice_id"))
    return quality.repeated_keys(rows, "invoice_id")


@query
def constraint_obstacles(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoice_id"),
        F.when(F.col("l_returnflag") != "R", "x").alias("client"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("total"),
    )
    return quality.constraint_obstacles(rows, "invoice_id", ["invoice_id", "client", "total"])


@query
def invoice_null_profile(spark, sf_dir):
    return quality.null_profile(feed.invoices(spark, sf_dir))


@query
def table_reconciliation(spark, sf_dir):
    """Row counts of the raw tables against copies with a filter or without."""
    names = ["customer", "orders", "part", "supplier"]
    source = {n: feed.table(spark, sf_dir, n) for n in names}
    target = {
        "customer": source["customer"],
        "orders": source["orders"].where("o_orderstatus <> 'P'"),
        "part": source["part"].withColumn("p_size", F.col("p_size") + 1),
        "nation": feed.table(spark, sf_dir, "nation"),
    }
    return quality.reconcile(source, target)


@query
def changed_order_keys(spark, sf_dir):
    """The orders that differ from a copy with edited, missing, new and repeated rows."""
    orders = feed.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    edited = orders.where(key % 1013 != 0).withColumn(
        "o_orderstatus", F.when(key % 997 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    )
    added = orders.where((key % 1511 == 0) & (key > 0)).withColumn("o_orderkey", -key)
    repeated = edited.where(key % 2003 == 0)
    return quality.differing_keys(orders, edited.unionByName(added).unionByName(repeated), ["o_orderkey"])


@query
def guarded_load(spark, sf_dir):
    """Load, replace and refuse: the table after two loads and a bad batch."""
    table = f"guarded_load_{uuid.uuid4().hex}"
    root = staging.fresh_path(spark, "tables")
    rows = feed.invoices(spark, sf_dir)
    tables.guarded_swap(spark, table, rows, quality.INVOICE_GUARD, root, K.INVOICES)
    tables.guarded_swap(
        spark, table, spark.table(table).withColumn("total", F.col("total") + 1),
        quality.INVOICE_GUARD, root,
    )
    try:
        tables.guarded_swap(
            spark, table, rows.where("is_paid = 0"), quality.INVOICE_GUARD, root
        )
        refused = 0
    except quality.ValidationError as error:
        refused = len(error.problems)
    out = spark.table(table).agg(
        F.count("*").alias("n_rows"), F.sum("total").alias("total"), F.sum("is_paid").alias("n_paid")
    )
    return rounded(out, 2, "total").withColumn("n_refusals", F.lit(refused))


# --------------------------------------------------------------------------
# Reports
# --------------------------------------------------------------------------


@query
def portfolio_kpis(spark, sf_dir):
    out = reports.portfolio_kpis(feed.invoices(spark, sf_dir))
    out = rounded(out, 2, "invoiced", "collected", "pending")
    return rounded(out, 6, "avg_days_to_pay", "pct_collected", "pct_paid", "pct_pending")


@query
def client_collection(spark, sf_dir):
    out = reports.client_collection(feed.invoices(spark, sf_dir))
    return rounded(rounded(out, 2, "invoiced", "collected", "pending"), 6, "pct_collected")


@query
def aligned_client_totals(spark, sf_dir):
    rows = feed.invoices(spark, sf_dir)
    invoiced = rows.groupBy("client").agg(F.sum("total").alias("invoiced"))
    collected = rows.where("is_paid = 1").groupBy("client").agg(F.sum("total").alias("collected"))
    return rounded(reports.aligned_totals(invoiced, collected, "client"), 2, "invoiced", "collected")


@query
def client_summary(spark, sf_dir):
    out = reports.client_summary(feed.invoices(spark, sf_dir))
    out = out.withColumn("unpaid_alert", bands.unpaid_alert_pct(F.col("pct_unpaid")))
    return rounded(out, 2, "total_amount").orderBy(F.col("total_amount").desc(), "client")


@query
def top_clients_by_amount(spark, sf_dir):
    top = reports.top_by(reports.client_collection(feed.invoices(spark, sf_dir)), "invoiced")
    out = rounded(rounded(top, 2, "invoiced", "collected", "pending"), 6, "pct_collected")
    return out.withColumn("label", formats.compact_money(F.col("invoiced")))


@query
def top_clients_by_count(spark, sf_dir):
    top = reports.top_by(reports.client_summary(feed.invoices(spark, sf_dir)), "n_invoices")
    return rounded(top, 2, "total_amount")


@query
def risk_map(spark, sf_dir):
    out = reports.risk_map(reports.client_summary(feed.invoices(spark, sf_dir)))
    return rounded(out, 2, "total_amount", "median_amount", "median_pct_unpaid")


@query
def median_days_per_client(spark, sf_dir):
    out = reports.client_median_days(feed.invoices(spark, sf_dir))
    return rounded(out, 2, "median_days").orderBy("median_days", "client")


@query
def days_centre(spark, sf_dir):
    return rounded(reports.day_centre(feed.invoices(spark, sf_dir)), 6, "mean", "median")


@query
def total_centre(spark, sf_dir):
    return rounded(reports.centre(feed.invoices(spark, sf_dir), "total"), 2, "mean", "median")


@query
def balance_centre(spark, sf_dir):
    ledger = cleaning.clean_ledger(feed.raw_ledger(spark, sf_dir))
    return rounded(reports.centre(ledger, "curtrxam"), 2, "mean", "median")


@query
def total_description(spark, sf_dir):
    out = reports.describe(feed.invoices(spark, sf_dir), "total")
    return rounded(out, 2, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def payment_speed(spark, sf_dir):
    return rounded(reports.speed_histogram(feed.invoices(spark, sf_dir)), 6, "pct")


@query
def total_histogram(spark, sf_dir):
    out = reports.histogram(feed.invoices(spark, sf_dir), "total", K.AMOUNT_BINS)
    return rounded(out, 2, "low", "high")


@query
def days_histogram(spark, sf_dir):
    rows = cleaning.paid_after_days(feed.invoices(spark, sf_dir))
    return rounded(reports.histogram(rows, "days_to_pay", K.DAYS_BINS), 2, "low", "high")


@query
def balance_histogram(spark, sf_dir):
    ledger = cleaning.clean_ledger(feed.raw_ledger(spark, sf_dir))
    return rounded(reports.histogram(ledger, "curtrxam", K.BALANCE_BINS), 2, "low", "high")


@query
def total_box_plot(spark, sf_dir):
    out = reports.box_plot(feed.invoices(spark, sf_dir))
    return rounded(out, 2, "q1", "median", "q3", "low_whisker", "high_whisker")


@query
def line_box_plot_outliers(spark, sf_dir):
    """Rows beyond the whiskers, on a function of the price with a long tail."""
    price = F.col("l_extendedprice")
    rows = feed.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_id"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_paid"),
        F.exp(price / 15000).alias("total"),
    )
    return rounded(reports.box_plot_outliers(rows), 2, "total")


@query
def category_counts(spark, sf_dir):
    rows = cleaning.keyword_categories(feed.invoices(spark, sf_dir))
    return rounded(reports.value_counts(rows, "category"), 6, "share")


@query
def collected_by_category(spark, sf_dir):
    rows = cleaning.keyword_categories(feed.invoices(spark, sf_dir))
    return rounded(reports.collected_by_category(rows), 2, "collected", "avg_ticket")


@query
def category_coverage(spark, sf_dir):
    rows = cleaning.keyword_categories(feed.invoices(spark, sf_dir))
    return rounded(reports.category_coverage(rows), 6, "coverage")


@query
def monthly_collected(spark, sf_dir):
    return rounded(reports.monthly_collected(feed.invoices(spark, sf_dir)), 2, "amount")


@query
def month_highlights(spark, sf_dir):
    monthly = reports.monthly_collected(feed.invoices(spark, sf_dir))
    return rounded(reports.month_highlights(monthly), 2, "amount")


@query
def receivables_kpis(spark, sf_dir):
    out = reports.receivables_kpis(
        cleaning.clean_ledger(feed.raw_ledger(spark, sf_dir)),
        cleaning.clean_quotes(feed.raw_quotes(spark, sf_dir)),
    )
    return rounded(out, 2, "open_balance", "pipeline", "exposure", "avg_balance")


@query
def financial_panorama(spark, sf_dir):
    out = reports.financial_panorama(
        feed.invoices(spark, sf_dir),
        cleaning.clean_ledger(feed.raw_ledger(spark, sf_dir)),
        cleaning.clean_quotes(feed.raw_quotes(spark, sf_dir)),
    )
    return rounded(out, 2, "value")


@query
def pending_invoices(spark, sf_dir):
    return reports.pending_report(feed.invoices(spark, sf_dir))


@query
def pending_total(spark, sf_dir):
    pending = reports.pending_invoices(feed.invoices(spark, sf_dir))
    return rounded(reports.pending_total(pending), 2, "pending_total")


@query
def pending_page(spark, sf_dir):
    return reports.pending_page(feed.invoices(spark, sf_dir), 3)


@query
def last_pending_page(spark, sf_dir):
    """A page index past the end shows the last page."""
    return reports.pending_page(feed.invoices(spark, sf_dir), 1_000_000_000)


@query
def pending_page_without_numbers(spark, sf_dir):
    """A page where every third invoice has lost its number."""
    rows = feed.invoices(spark, sf_dir)
    lost = F.when(F.col("invoice_id") % 3 > 0, F.col("invoice_id"))
    return reports.pending_page(rows.withColumn("invoice_id", lost), 3)


# --------------------------------------------------------------------------
# Monthly series
# --------------------------------------------------------------------------


def _payments(spark, sf_dir):
    return feed.invoices(spark, sf_dir)


def _by_client(spark, sf_dir):
    return series.monthly_series(_payments(spark, sf_dir), F.col("client"))


def _by_category(spark, sf_dir):
    rows = cleaning.keyword_categories(_payments(spark, sf_dir))
    return series.monthly_series(rows, F.col("category"))


@query
def filled_months(spark, sf_dir):
    return rounded(series.fill_months(_by_client(spark, sf_dir)), 2, "amount")


@query
def recent_window_per_client(spark, sf_dir):
    window = series.last_months(series.history(_by_client(spark, sf_dir), AS_OF))
    out = series.window_statistics(window)
    return rounded(rounded(out, 2, "weighted_mean", "deviation"), 4, "slope")


@query
def cash_projection(spark, sf_dir):
    out = series.project(series.monthly_series(_payments(spark, sf_dir)), AS_OF)
    out = rounded(out, 2, "amount", "low", "high")
    return out.withColumn("label", formats.month_name_year(F.col("month")))


@query
def cash_projection_by_category(spark, sf_dir):
    out = series.project(_by_category(spark, sf_dir), AS_OF)
    return rounded(out, 2, "amount", "low", "high")


@query
def cash_projection_by_client(spark, sf_dir):
    out = series.project(_by_client(spark, sf_dir), AS_OF)
    return rounded(out, 2, "amount", "low", "high")


@query
def cash_outlook(spark, sf_dir):
    out = series.cash_outlook(_by_category(spark, sf_dir), AS_OF)
    return rounded(out, 2, "amount", "low", "high")


@query
def forecast_fits(spark, sf_dir):
    """Smoothing parameters and AIC per client."""
    out = forecast.fit_series(_by_client(spark, sf_dir))
    return out.select(
        "series_key", "last_month", "n_months", "n_params", "alpha", "beta", "gamma", "phi", "sse", "aic"
    )


@query
def cash_forecast(spark, sf_dir):
    return forecast.forecast(series.monthly_series(_payments(spark, sf_dir)))


@query
def cash_forecast_by_client(spark, sf_dir):
    return forecast.forecast(_by_client(spark, sf_dir))


@query
def forecast_clients(spark, sf_dir):
    """Every client with its method and the number of months that it got."""
    out = forecast.forecast(_by_client(spark, sf_dir))
    return out.groupBy("series_key", "method").agg(F.count("*").alias("n_months"))


@query
def cash_forecast_short_clients(spark, sf_dir):
    """Clients with one or two months: the weighted-mean projection."""
    return forecast.forecast(_by_client(spark, sf_dir)).where("method = 'weighted mean'")


@query
def forecast_bands(spark, sf_dir):
    """Bands of fits whose parameters come from the customers."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal").cast("double")
    fits = feed.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("series_key"),
        F.lit("1998-12-01").cast("date").alias("last_month"),
        F.lit(40).alias("n_months"),
        (0.1 + (key % 7) / 10).alias("alpha"),
        (0.01 + (key % 5) / 10).alias("beta"),
        (0.8 + (key % 4) / 20).alias("phi"),
        (balance + 2000).alias("level"),
        (balance / 100).alias("trend"),
        (F.abs(balance) * 50).alias("sse"),
        F.lit(None).cast("array<double>").alias("season"),
    )
    return forecast.bands(fits)


def _cents_by_client(spark, sf_dir):
    # sums of money differ in their last bits with the order of the rows
    return rounded(_by_client(spark, sf_dir), 2, "amount")


@query
def folded_fits(spark, sf_dir):
    """Non-seasonal smoothing per client by a fold over its months."""
    arrays = forecast.spread_arrays(_cents_by_client(spark, sf_dir))
    out = forecast.fit_by_fold(arrays.where(F.size("amounts") >= forecast.SHORTEST), in_batches=True)
    out = out.select("series_key", "last_month", "n_months", "alpha", "beta", "phi", "level", "trend", "sse", "aic")
    return rounded(rounded(rounded(out, 2, "level", "trend"), 0, "sse"), 4, "aic")


@query
def folded_forecast(spark, sf_dir):
    """Forecasts of every client without a yearly season."""
    return forecast.forecast(_cents_by_client(spark, sf_dir), seasonal=False)


@query
def cash_projection_total(spark, sf_dir):
    """Expected amount of each client over the projected months."""
    projected = series.project(_by_client(spark, sf_dir), AS_OF).withColumnRenamed("amount", "expected")
    return rounded(forecast.horizon_total(projected), 2, "expected_total")


@query
def cash_forecast_total(spark, sf_dir):
    return forecast.horizon_total(forecast.forecast(_by_category(spark, sf_dir)))


# --------------------------------------------------------------------------
# Texts
# --------------------------------------------------------------------------


@query
def document_terms(spark, sf_dir):
    return tfidf.document_terms(_documents(spark, sf_dir), "doc_id", "text")


@query
def term_weights(spark, sf_dir):
    docs = feed.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tfidf.term_weights(docs, "doc_id", "text")
    return rounded(out, 6, "weight")


@query
def language_folds(spark, sf_dir):
    docs = feed.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.stratified_folds(docs, "doc_id", "lang")


@query
def language_holdout(spark, sf_dir):
    docs = feed.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.stratified_holdout(docs, "doc_id", "lang")


@query
def label_agreement_report(spark, sf_dir):
    """Quality label against a rule on the text length."""
    joined = feed.table(spark, sf_dir, "labels").join(
        feed.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    ruled = joined.select("quality", (F.col("n_chars") % 3).cast("int").alias("ruled"))
    out = evaluation.classification_report(ruled, "quality", "ruled")
    return rounded(out, 6, "precision", "recall", "f1")


@query
def label_agreement_by_fold(spark, sf_dir):
    labels = feed.table(spark, sf_dir, "labels")
    rows = sampling.stratified_folds(labels, "doc_id", "quality")
    out = evaluation.accuracy_by_fold(rows, "fold", "quality", "toxic")
    return rounded(out, 6, "accuracy", "mean_accuracy", "std_accuracy")


def _labelled_concepts(spark, sf_dir):
    """Distinct service concepts with their keyword category as the label."""
    concepts = feed.service_concepts(spark, sf_dir).distinct()
    return cleaning.keyword_categories(concepts, alias="label").withColumn("key", F.col("concept"))


def _concept_model(spark, sf_dir):
    slug = hashlib.md5(sf_dir.encode()).hexdigest()
    path = f"{staging.shared_folder(spark)}/{spark.sparkContext.applicationId}/model-{slug}"
    return classifier.load_or_train(
        spark, path, lambda: classifier.train(_labelled_concepts(spark, sf_dir), "key", "concept", "label")
    )


def _predictions(spark, sf_dir):
    rows = cleaning.for_classifier(feed.invoices(spark, sf_dir))
    return classifier.predict(rows, "invoice_id", "concept", _concept_model(spark, sf_dir))


@query
def concept_training_set(spark, sf_dir):
    rows = classifier.training_set(_labelled_concepts(spark, sf_dir), "key", "concept", "label")
    return rows.select(text.normalize(F.col("text")).alias("text"), "label")


@query
def classified_invoices(spark, sf_dir):
    return _predictions(spark, sf_dir).drop("best")


@query
def prediction_summary(spark, sf_dir):
    out = classifier.prediction_summary(_predictions(spark, sf_dir))
    return rounded(rounded(out, 2, "amount"), 4, "avg_confidence")


@query
def invoices_to_review(spark, sf_dir):
    return classifier.review_list(_predictions(spark, sf_dir))


@query
def classified_by_table_solver(spark, sf_dir):
    """Invoices by the model whose coefficients never leave their table."""
    slug = hashlib.md5(sf_dir.encode()).hexdigest()
    path = f"{staging.shared_folder(spark)}/{spark.sparkContext.applicationId}/tables-{slug}"
    labelled = _labelled_concepts(spark, sf_dir)
    model = classifier.load_or_train(
        spark, path, lambda: classifier.train(labelled, "key", "concept", "label", solver="tables", tolerance=1e-4)
    )
    rows = cleaning.for_classifier(feed.invoices(spark, sf_dir))
    return classifier.predict(rows, "invoice_id", "concept", model).drop("best")


def _counted_predictions(spark, sf_dir):
    """Predictions of the closed-form model, stored and loaded as a job would."""
    slug = hashlib.md5(sf_dir.encode()).hexdigest()
    path = f"{staging.shared_folder(spark)}/{spark.sparkContext.applicationId}/counted-{slug}"
    model = classifier.load_or_train(
        spark, path, lambda: classifier.train_by_counts(_labelled_concepts(spark, sf_dir), "key", "concept", "label")
    )
    return classifier.predict(cleaning.for_classifier(feed.invoices(spark, sf_dir)), "invoice_id", "concept", model)


@query
def classified_by_counts(spark, sf_dir):
    return _counted_predictions(spark, sf_dir)


@query
def counted_prediction_summary(spark, sf_dir):
    out = classifier.prediction_summary(_counted_predictions(spark, sf_dir))
    return rounded(rounded(out, 2, "amount"), 4, "avg_confidence")


@query
def counted_invoices_to_review(spark, sf_dir):
    return classifier.review_list(_counted_predictions(spark, sf_dir))


@query
def concept_cross_validation(spark, sf_dir):
    """Five stratified folds over the labelled concepts."""
    out = classifier.cross_validation(_labelled_concepts(spark, sf_dir), "key", "concept", "label")
    return rounded(out, 6, "accuracy", "mean_accuracy", "std_accuracy")


@query
def concept_holdout_report(spark, sf_dir):
    out = classifier.holdout_report(_labelled_concepts(spark, sf_dir), "key", "concept", "label")
    return rounded(out, 6, "precision", "recall", "f1")


@query
def language_holdout_report(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    out = classifier.holdout_report(docs, "doc_id", "text", "lang")
    return rounded(out, 6, "precision", "recall", "f1")
