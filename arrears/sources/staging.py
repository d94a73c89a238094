"""Written tables that cut lineage, in the folder the session names.

The folder is ``spark.checkpoint.dir``, which every executor can reach.  Only
a local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

_written: dict[tuple[str, str], str] = {}
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="arrears-")
    return _local[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``fresh_path`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table of its own."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(
    spark: SparkSession,
    key: str,
    build: Callable[[], DataFrame],
    schema: T.StructType | None = None,
) -> DataFrame:
    """The table ``key``, written once per application and read from Parquet.

    Reading it back gives column pruning and pushed filters to every report,
    and a lost executor costs a re-read instead of the whole derivation.
    ``schema`` overrides the types on reading.
    """
    slot = (spark.sparkContext.applicationId, key)
    if slot not in _written:
        path = fresh_path(spark, "staged")
        build().write.parquet(path)
        _written[slot] = path
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_written[slot])
