"""From the raw invoice export to the invoice contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from arrears import contracts as K
from arrears.functions import dates, numeric, text


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def _number(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return numeric.to_number(F.col(name))
    return numeric.drop_nan(F.col(name).cast("double"))


def _read(raw: DataFrame, iso_text: bool) -> DataFrame:
    """The export's columns with their types, all rows."""
    raw = trim_headers(raw)
    types = {f.name: f.dataType for f in raw.schema.fields}
    # a sheet with a gap in its numbers writes them as fractions
    folio = F.regexp_replace(F.trim(F.col("Folio").cast("string")), r"\.0+$", "")
    return raw.select(
        folio.try_cast("bigint").alias("invoice_id"),
        text.client_name(F.col("Cliente")).alias("client"),
        dates.as_date(F.col("Fecha"), types["Fecha"], iso_text).alias("invoice_date"),
        F.col("Concepto").alias("concept"),
        _number(raw, "Total").alias("total"),
        dates.as_date(F.col("FECHA DE PAGO"), types["FECHA DE PAGO"], iso_text).alias("paid_date"),
        F.trim(F.col("FECHA DE PAGO").cast("string")).alias("paid_text"),
    )


def clean_invoices(raw: DataFrame, iso_text: bool = True) -> DataFrame:
    """Raw export to the ``invoices`` contract; one narrow pass, no shuffle.

    Rows without a client are cancellations and are dropped; so are rows whose
    invoice date cannot be read.  :func:`dropped_invoices` counts them.
    """
    return _read(raw, iso_text).dropna(subset=["client", "invoice_date"]).select(
        "invoice_id",
        "client",
        "invoice_date",
        "concept",
        "total",
        "paid_date",
        dates.days_to_pay(F.col("paid_date"), F.col("invoice_date")).alias("days_to_pay"),
        F.col("paid_date").isNotNull().cast("int").alias("is_paid"),
    )


def dropped_invoices(raw: DataFrame, iso_text: bool = True) -> DataFrame:
    """``reason, n``: rows that cleaning drops, and payment dates that it cannot read.

    Every dropped row has one reason; an unreadable payment date is counted for
    kept rows, which it turns unpaid.
    """
    rows = _read(raw, iso_text)
    reason = (
        F.when(F.col("client").isNull(), "no client")
        .when(F.col("invoice_date").isNull(), "unreadable invoice date")
        .when(F.col("paid_date").isNull() & (F.length("paid_text") > 0), "unreadable payment date")
    )
    return rows.select(reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def clean_ledger(raw: DataFrame) -> DataFrame:
    """Receivables ledger: rows need an invoice, balances must be numbers."""
    return raw.dropna(subset=["factura"]).select(
        "factura",
        "oc",
        numeric.to_number(F.col("curtrxam")).alias("curtrxam"),
        "orctrxam1",
        dates.as_date(F.col("fecha_calculo"), raw.schema["fecha_calculo"].dataType).alias(
            "fecha_calculo"
        ),
    )


def clean_quotes(raw: DataFrame) -> DataFrame:
    """Quotes without an invoice yet: rows need a quote, amounts must be numbers."""
    return raw.dropna(subset=["cot"]).select(
        "cot", "suc", numeric.to_number(F.col("importe")).alias("importe"), "concepto"
    )


def conform(df: DataFrame) -> DataFrame:
    """Loosely typed invoices to the contract types.

    Timestamps become dates, fractional days become nullable whole days with
    NaN as NULL.  Parquet enforces neither keys nor mandatory columns: the
    guard of the contract does, before a batch replaces a table.
    """
    return df.select(
        F.col("invoice_id").cast("bigint").alias("invoice_id"),
        "client",
        F.col("invoice_date").cast("date").alias("invoice_date"),
        "concept",
        F.col("total").cast("double").alias("total"),
        F.col("paid_date").cast("date").alias("paid_date"),
        numeric.to_whole(F.col("days_to_pay").cast("double")).alias("days_to_pay"),
        F.col("is_paid").cast("int").alias("is_paid"),
    )


def widen(df: DataFrame) -> DataFrame:
    """Contract types back to timestamps and fractional days."""
    return df.select(
        "invoice_id",
        "client",
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        "concept",
        "total",
        F.col("paid_date").cast("timestamp_ntz").alias("paid_date"),
        F.col("days_to_pay").cast("double").alias("days_to_pay"),
        "is_paid",
    )


# --------------------------------------------------------------------------
# Projected and filtered reads of the stored tables
# --------------------------------------------------------------------------


def for_scoring(invoices: DataFrame) -> DataFrame:
    return invoices.where("client IS NOT NULL AND total IS NOT NULL").select(
        "client", "invoice_date", "paid_date", "total", "days_to_pay", "is_paid"
    )


def for_cash_series(invoices: DataFrame) -> DataFrame:
    return invoices.where("paid_date IS NOT NULL AND total IS NOT NULL").select(
        "paid_date", "total"
    )


def for_classifier(invoices: DataFrame) -> DataFrame:
    return invoices.select("invoice_id", "client", "invoice_date", "concept", "total", "is_paid")


def with_total(invoices: DataFrame) -> DataFrame:
    return invoices.where("total IS NOT NULL")


# --------------------------------------------------------------------------
# Business filters
# --------------------------------------------------------------------------


def equal_if_present(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Equality filter on an optional column; ``None`` keeps every row."""
    if value is None or column not in df.columns:
        return df
    return df.where(F.col(column) == value)


def only_members(df: DataFrame, column: str, chosen: list[str]) -> DataFrame:
    """Multiple selection; an empty selection keeps every row."""
    return df.where(F.col(column).isin(list(chosen))) if chosen else df


def paid_after_days(invoices: DataFrame) -> DataFrame:
    """Paid invoices that took at least one day."""
    return invoices.where("is_paid = 1 AND days_to_pay > 0")


def selector_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def keyword_categories(
    invoices: DataFrame,
    rules: dict[str, list[str]] = K.KEYWORD_RULES,
    column: str = "concept",
    alias: str = "category",
) -> DataFrame:
    return invoices.withColumn(alias, text.keyword_category(F.col(column), rules))
