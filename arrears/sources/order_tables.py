"""Invoice, ledger and quote feeds derived from the order tables.

The order, line item, customer, part and supplier tables stand in for the
spreadsheets: they yield the same messy export (padded names, mixed date
text, cancelled rows, unpaid rows) at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arrears.operators import cleaning
from arrears.sources import staging

# Service phrase per part type (fixed values).
SERVICE_PHRASES = {
    "STANDARD": "Mantenimiento preventivo a",
    "PROMO": "Reparación por fuga en",
    "ECONOMY": "Instalación de minisplit",
    "MEDIUM": "Compresor y refacción para",
    "SMALL": "Diagnostico, complemento de",
    "LARGE": "Traslado de",
}

#: Line number and part key packed into one number: the least one names the
#: part of the first line, and the packed minimum stays a plain hash aggregate.
_PACK = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _service_concept() -> Column:
    phrase = F.lit(None).cast("string")
    for part_type, words in SERVICE_PHRASES.items():
        phrase = F.when(F.col("p_type") == part_type, words).otherwise(phrase)
    return F.concat(phrase, F.lit(" "), F.col("p_name"), F.lit(", "), F.col("p_brand"))


def service_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concept text of every part."""
    return table(spark, sf_dir, "part").select(_service_concept().alias("concept"))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export as it arrives, with its original headers.

    Line items are reduced per order before the join; the aggregate and the
    join share the partitioning on the order key.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").alias("last_ship"),
            F.min(F.col("l_linenumber") * F.lit(_PACK) + F.col("l_partkey")).alias("first_line"),
        )
        .withColumn("part_key", F.col("first_line") % _PACK)
    )
    part = table(spark, sf_dir, "part").select("p_partkey", _service_concept().alias("Concepto"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key, ordered = F.col("o_orderkey"), F.col("o_orderdate")
    joined = (
        table(spark, sf_dir, "orders")
        .join(lines, F.col("l_orderkey") == key, "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("p_partkey") == F.col("part_key"), "left")
    )
    return joined.select(
        key.cast("string").alias("Folio"),
        F.when(key % 17 != 0, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))).alias("Cliente"),
        F.when(key % 29 == 0, "no date")
        .when(key % 3 == 0, F.date_format(ordered, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ordered, "dd/MM/yyyy"))
        .alias("Fecha"),
        "Concepto",
        F.col("o_totalprice").alias(" Total "),
        F.when(F.col("o_orderstatus") != "P", F.date_format("last_ship", "dd/MM/yyyy")).alias(
            "FECHA DE PAGO"
        ),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean invoice table: loaded once, then read by every report."""
    return staging.staged(
        spark,
        f"invoices:{sf_dir}",
        lambda: cleaning.clean_invoices(raw_invoices(spark, sf_dir)),
    )


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open balances per supplier, as text with some unreadable amounts."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(key % 11 != 0, F.col("s_name")).alias("factura"),
        F.concat(F.lit("OC-"), key.cast("string")).alias("oc"),
        F.when(key % 7 == 0, "$1,000")
        .when(key % 13 == 0, "nan")
        .otherwise(F.col("s_acctbal").cast("decimal(18,2)").cast("string"))
        .alias("curtrxam"),
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("orctrxam1"),
        F.when(key % 5 == 0, "pendiente").otherwise("11/03/2026").alias("fecha_calculo"),
    )


def raw_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open quotes per part, as text with some unreadable amounts."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(key % 19 != 0, F.concat(F.lit("C-"), key.cast("string"))).alias("cot"),
        F.col("p_brand").alias("suc"),
        F.when(key % 23 == 0, "por definir")
        .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
        .alias("importe"),
        _service_concept().alias("concepto"),
    )
