"""The figures of the three dashboard pages, as lazy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrears.functions import bands
from arrears.operators import cleaning, reports, scoring, series


def summary_page(invoices: DataFrame, page: int = 0) -> dict[str, DataFrame]:
    rows = cleaning.with_total(invoices)
    return {
        "kpis": reports.portfolio_kpis(rows),
        "top_clients": reports.top_by(reports.client_collection(rows), "invoiced"),
        "pending_total": reports.pending_total(reports.pending_invoices(rows)),
        "pending_page": reports.pending_page(rows, page),
    }


def score_page(
    scores: DataFrame, clients: list[str] | None = None, client_type: str | None = None
) -> dict[str, DataFrame]:
    """Score table with an optional client type, else a client selection."""
    if "client_type" in scores.columns:
        chosen = cleaning.equal_if_present(scores, "client_type", client_type)
    else:
        chosen = cleaning.only_members(scores, "client", clients or [])
    return {
        "selector": cleaning.selector_values(scores, "client"),
        "scores": scoring.score_table(
            chosen.withColumn("risk_band", bands.risk_band(F.col("risk_score")))
        ),
    }


def cash_page(invoices: DataFrame, as_of: str) -> dict[str, DataFrame]:
    monthly = series.monthly_series(cleaning.with_total(invoices).where("is_paid = 1"))
    return {"outlook": series.cash_outlook(monthly, as_of), "projection": series.project(monthly, as_of)}
