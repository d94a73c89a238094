"""Records of CSV text whose quoted cells may hold line breaks, without a file in one task.

Whether a line starts inside a quoted cell is the parity of the quotes before it in its
file.  Each split counts its own; the parities before the splits are a running sum over one
row per split.  Inside a split the lines are numbered by the records that start in it; what
precedes the first of them belongs to the last record of an earlier split.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from arrears.sources import staging

#: Bytes of splits that one task reads one after the other.
_TASK_BYTES = 16 << 20


def in_tasks(scan: DataFrame) -> DataFrame:
    """A plain scan whose small splits share tasks; the splits stay as they are.

    A task and a shuffled block per partition for each split of some KB would
    cost more than its lines; splits of ``_TASK_BYTES`` or more pass as they are.
    """
    spark = scan.sparkSession
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if size >= _TASK_BYTES:
        return scan
    splits = scan._jdf.rdd().getNumPartitions()
    tasks = max(spark.sparkContext.defaultParallelism, -(-splits * size // _TASK_BYTES))
    return scan if tasks >= splits else scan.coalesce(tasks)


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, file, start, order``: lines, the start of their split, their order within it."""
    scan = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    # a task reads a split from its first line to its last, whatever other splits it reads
    return in_tasks(scan).withColumn("order", F.monotonically_increasing_id())


def odd_quotes() -> Column:
    """Whether a line opens or closes a cell that goes on in another line; a quote in a cell is two."""
    return (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1


def _unix(column: str) -> Column:
    return F.regexp_replace(column, "\r$", "")


def stitched(found: DataFrame) -> DataFrame:
    """``file, start, number, record`` of ``lines``: number counts the records that start in a split from 1.

    The lines are shuffled by split, which the reader bounds, and the pieces of records are
    written once; then only the pieces that begin a split in the midst of a record are
    grouped and joined with the records that they continue.
    """
    spark = found.sparkSession
    marked = found.withColumn("odd", odd_quotes().cast("int"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = marked.groupBy("file", "start").agg(F.sum("odd").alias("odds")).select(
        "file", "start", (F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2).alias("begins")
    )
    split = Window.partitionBy("file", "start").orderBy("order")
    before = F.coalesce(F.sum("odd").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = marked.join(begins, ["file", "start"]).withColumn("outside", 1 - (F.col("begins") + before) % 2)
    number = F.sum("outside").over(split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.array_sort(F.collect_list(F.struct("order", "value")))
    made = inside.withColumn("number", number).groupBy("file", "start", "number").agg(
        F.array_join(F.transform(own, lambda x: x["value"]), "\n").alias("piece")
    )
    path = staging.fresh_path(spark, "records")
    made.write.parquet(path)
    pieces = in_tasks(spark.read.parquet(path))

    # one row per split: its last record, and so the owner of what the next splits begin with
    last = pieces.groupBy("file", "start").agg(F.max("number").alias("number"))
    latest = F.last(F.when(F.col("number") > 0, F.struct("start", "number")), ignorenulls=True).over(earlier)
    owners = last.select("file", "start", latest.alias("owner"))
    rests = (
        pieces.where("number = 0").join(owners, ["file", "start"])
        .groupBy("file", F.col("owner.start").alias("start"), F.col("owner.number").alias("number"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), "piece"))).alias("rest"))
    )
    whole = pieces.where("number > 0").join(rests, ["file", "start", "number"], "left")
    rest = F.coalesce(F.transform("rest", lambda x: x["piece"]), F.array().cast("array<string>"))
    joined = whole.withColumn("record", F.array_join(F.concat(F.array("piece"), rest), "\n"))
    return joined.select("file", "start", "number", _unix("record").alias("record"))


@contextmanager
def splits_of(spark: SparkSession, size: int):
    """Files are read in splits of at most ``size`` bytes meanwhile."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)
