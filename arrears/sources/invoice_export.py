"""Scans of the tabular exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from arrears import contracts as K
from arrears.sources import quoted_records

#: a quote within a quoted cell is written twice, as spreadsheet programs do
ESCAPE = '"'


def _positions(names: list[str], wanted: list[str], file: str) -> dict[str, int]:
    by_name = {name.strip().strip("\ufeff").strip('"').strip(): i for i, name in enumerate(names)}
    missing = [w for w in wanted if w.strip() not in by_name]
    if missing:
        raise ValueError(f"{file}: no column {', '.join(map(repr, missing))} in {sorted(by_name)}")
    return {w: by_name[w.strip()] for w in wanted}


def _texts(count: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(count)])


def _parsed(records: DataFrame, schema: T.StructType) -> Column:
    """The cells of ``record``, whose quoted cells may hold line breaks."""
    return F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), {"multiLine": "true", "escape": ESCAPE})


def read_by_header(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """CSV files under ``path`` as text, columns taken by header name.

    Every file may order its columns in its own way and have further ones;
    blanks around a header and a byte order mark do not count.  A file without
    one of the ``wanted`` columns is an error.  One scan takes the first line of
    each file and looks for lines that end within quotes; files without such
    lines and with one header are one scan by the CSV reader, the others are
    stitched (``quoted_records``).  The driver holds the names of the files, as
    Spark's own listing does.
    """
    found = quoted_records.lines(spark, path)
    first = found.groupBy("file").agg(
        F.min_by("value", F.when(F.col("start") == 0, F.col("order"))).alias("line"),
        F.max(quoted_records.odd_quotes()).alias("broken"),
    )
    # one row per distinct header, with the names of its files
    headers = first.groupBy("line", "broken").agg(F.collect_list("file").alias("files")).orderBy("line").collect()
    scans = []
    for header in headers:
        if header.broken:
            continue
        files = sorted(header.files)
        names = spark.read.option("header", True).option("escape", ESCAPE).csv(files[0]).columns
        rows = spark.read.schema(_texts(len(names))).options(header=True, enforceSchema=True, escape=ESCAPE).csv(files)
        scans.append(rows.select(*[F.col(f"c{i}").alias(w) for w, i in _positions(names, wanted, files[0]).items()]))
    broken = [f for header in headers if header.broken for f in header.files]
    if broken:
        records = quoted_records.stitched(quoted_records.lines(spark, broken))
        top = records.where("start = 0 AND number = 1").groupBy("record").agg(F.collect_list("file").alias("files"))
        for header in top.orderBy("record").collect():
            one = spark.createDataFrame([(header.record,)], "record string")
            # no file has more columns than commas
            cells = one.select(_parsed(one, _texts(header.record.count(",") + 1)).alias("r")).first().r
            rows = records.where(F.col("file").isin(header.files) & ~F.expr("start = 0 AND number = 1") & (F.length("record") > 0))
            rows = rows.select(_parsed(rows, _texts(len(cells))).alias("r"))
            at = _positions([c or "" for c in cells], wanted, header.files[0])
            scans.append(rows.select(*[F.col(f"r.c{i}").alias(w) for w, i in at.items()]))
    if not scans:
        return spark.createDataFrame([], T.StructType([T.StructField(w, T.StringType()) for w in wanted]))
    return reduce(DataFrame.unionByName, scans)


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV export under ``path`` as text columns by header name; no inference."""
    return read_by_header(spark, path, K.RAW_INVOICES.fieldNames())


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label CSV by header name; a UTF-8 byte order mark in front of the header is skipped."""
    return read_by_header(spark, path, K.LABELS.fieldNames())


def read_sheet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    banner_rows: int,
    skip_columns: int = 0,
    header_row: bool = True,
) -> DataFrame:
    """Sheet export with banner rows on top and positional columns.

    Blank banner lines count.  The row after the banner holds the sheet's own
    headers, which ``schema`` replaces.  Both can only sit at the top of a file:
    only its first split is ranked, all later splits pass through untouched.
    Where a line ends within quotes, lines are stitched to records first.
    """
    skipped = banner_rows + (1 if header_row else 0)
    padding = [T.StructField(f"_skip{i}", T.StringType()) for i in range(skip_columns)]
    positional = T.StructType(padding + list(schema.fields))
    found = quoted_records.lines(spark, path)
    if found.where(quoted_records.odd_quotes()).isEmpty():
        first = found.where(F.col("start") == 0).withColumn(
            "row", F.row_number().over(Window.partitionBy("file").orderBy("order"))
        )
        body = first.where(F.col("row") > skipped).select("value")
        whole = found.where(F.col("start") > 0).select("value").unionByName(body)
        records = whole.select(F.regexp_replace("value", "\r$", "").alias("record"))
    else:
        every = quoted_records.stitched(found)
        # a record of the top is numbered over the splits that a tiny split size may give it
        ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        before = every.groupBy("file", "start").agg(F.max("number").alias("n")).select(
            "file", "start", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")
        )
        records = every.join(before, ["file", "start"]).where(F.col("before") + F.col("number") > skipped).select("record")
    rows = records.where(F.length("record") > 0)
    parsed = rows.select(_parsed(rows, positional).alias("r"))
    return parsed.select(*[F.col(f"r.{name}") for name in schema.fieldNames()])


def write_csv(df: DataFrame, path: str, for_excel: bool = False) -> None:
    """CSV export with a header, replacing what was there.

    ``for_excel`` puts a byte order mark in front of each file's header, by which
    spreadsheet programs know the encoding; :func:`read_by_header` skips it.
    """
    if for_excel:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode("overwrite").options(header=True, escape=ESCAPE).csv(path)
