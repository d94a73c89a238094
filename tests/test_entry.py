"""The registry against DuckDB on the smallest tables, and the shape of the plans."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from arrears.plans.registry import QUERIES
from oracle_queries import ORACLES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# iterative or simulated: no SQL twin
ROWS_ONLY = {
    "forecast_fits", "cash_forecast", "cash_forecast_by_client", "cash_forecast_total",
    "classified_invoices", "prediction_summary", "invoices_to_review",
    "classified_by_table_solver", "concept_cross_validation", "concept_holdout_report", "language_holdout_report",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(v):
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return [columns[i] for i in order], sorted(tuple(show(r[i]) for i in order) for r in rows)


def test_every_query_has_a_twin_or_a_reason():
    assert set(QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert not set(entry.oracle_sql()) - set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert canonical(df.columns, df.collect()) == canonical(columns, want.fetchall())


def test_entry_ranks_ten_clients(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, 11))
    assert all(0 <= r.value_score <= 100 and not math.isnan(r.value_score) for r in rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["client_scores", "portfolio_kpis", "risk_map", "total_box_plot", "cash_projection_by_client"])
def test_plans_have_no_cross_product_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert operator not in text


def test_reads_are_pruned_and_pushed(spark):
    text = plan(entry.queries()["payments_for_cash_series"](spark, SF))
    assert "ReadSchema: struct<total:double,paid_date:date>" in text
    assert "IsNotNull(paid_date)" in text
