"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from arrears.deploy import ship
from arrears.sources.staging import fresh_path

#: separates words: the ASCII white space of the contracts, \x20 and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: equal rows that one task makes again from their count
CHUNK = 1 << 16


def numbered(rows: DataFrame, name: str, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with a column ``name`` that numbers equal rows from 0; nulls are equal.

    Equal rows are summed to a count before the shuffle and made again from it, ``chunk`` of
    them in a task, so that no task holds a row that a third of the table repeats.
    """
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count(F.lit(1)).alias("__n"))
    few = counted.filter(F.col("__n") <= chunk).withColumn("__from", F.lit(0).cast("long"))
    many = (
        counted.filter(F.col("__n") > chunk)
        .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(chunk).cast("long"))))
        .repartition("__from", *[F.col(f"`{c}`") for c in rows.columns])
    )
    last = F.least(F.col("__from") + chunk, F.col("__n")) - 1
    made = few.unionByName(many).withColumn(name, F.explode(F.sequence(F.col("__from"), last)))
    return made.drop("__n", "__from")


#: bytes of an Arrow batch on its way to a Python worker, unless the session asks for less
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def on_executors(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, and bound what they get at once.

    The rows of a batch are counted in bytes: many long texts do not fill a worker.
    """
    ship(spark)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH))
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The strings of an Arrow column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 16 << 20):
    """The batches, cut so that no piece holds much more than ``limit`` bytes of ``column``.

    A single text is never cut: one piece may be one long text.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        rows = max(1, int(batch.num_rows * limit / max(1, batch.column(at).nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a reused worker does not keep the peak of every job."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


@contextlib.contextmanager
def without_cycles():
    """For code that makes very many small objects and no cycles: no passes of the cycle collector over them."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def removed(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nobody reads any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def shuffles_freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases now instead of at some later collection.

    Spark drops a shuffle's files once the driver has collected the last reference to it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
