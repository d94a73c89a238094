"""The scheduled jobs: load invoices, score clients, classify, forecast.

Every job validates before it replaces anything.  A refused batch raises
``ValidationError`` with all problems and leaves tables and exports alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrears import contracts as K
from arrears.operators import classifier, cleaning, forecast, quality, scoring, series
from arrears.sources import invoice_export, staging, tables


def _settled(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, so that validating and writing it is one run."""
    path = staging.fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def load_invoices(
    spark: SparkSession, raw: DataFrame, root: str, table: str = "invoices"
) -> DataFrame:
    """Clean the export, guard it, replace the invoice table."""
    batch = _settled(spark, cleaning.clean_invoices(raw), "invoices")
    tables.guarded_swap(spark, table, batch, quality.INVOICE_GUARD, root, K.INVOICES)
    return spark.table(table)


def score_clients(
    spark: SparkSession,
    root: str,
    computed_on: str,
    invoices: str = "invoices",
    table: str = "client_scores",
    export: str | None = None,
) -> DataFrame:
    """Score all clients, guard the scores, replace the table, export a CSV."""
    features = scoring.client_features(spark.table(invoices))
    batch = _settled(spark, scoring.client_scores(features, computed_on), "scores")
    tables.guarded_swap(spark, table, batch, quality.SCORE_GUARD, root, K.CLIENT_SCORES)
    if export:
        invoice_export.write_csv(spark.table(table), export, for_excel=True)
    return spark.table(table)


def refresh(
    spark: SparkSession, export_path: str, root: str, computed_on: str, csv: str | None = None
) -> DataFrame:
    """The weekly run: scan, clean, validate, swap, then score."""
    load_invoices(spark, invoice_export.read_invoices(spark, export_path), root)
    return score_clients(spark, root, computed_on, export=csv)


def classify_invoices(
    spark: SparkSession, labels_path: str, model_path: str, export: str, invoices: str = "invoices"
) -> DataFrame:
    """Load or train the classifier, predict every invoice, export a CSV."""

    def build() -> classifier.TextModel:
        labels = invoice_export.read_labels(spark, labels_path)
        # every row is a text of its own, equal ones too
        keyed = _settled(spark, labels.withColumn("key", F.monotonically_increasing_id()), "labels")
        return classifier.train(keyed, "key", "concepto", "categoria_modelo")

    model = classifier.load_or_train(spark, model_path, build)
    rows = cleaning.for_classifier(spark.table(invoices))
    predicted = _settled(
        spark, classifier.predict(rows, "invoice_id", "concept", model).drop("best"), "predicted"
    )
    invoice_export.write_csv(predicted, export, for_excel=True)
    return predicted


def forecast_cash(spark: SparkSession, export: str, invoices: str = "invoices") -> DataFrame:
    """Forecast of the whole portfolio for three months, exported as CSV."""
    monthly = series.monthly_series(cleaning.for_cash_series(spark.table(invoices)))
    out = _settled(spark, forecast.forecast(monthly), "forecast")
    invoice_export.write_csv(out, export, for_excel=True)
    return out
