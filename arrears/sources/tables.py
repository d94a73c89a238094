"""Replace a catalog table in one step, or leave it exactly as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from arrears.operators import quality


def _with_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class ChangedMeanwhile(RuntimeError):
    """Another job replaced the table since its state was read."""


#: versions of a table that stay, the current one included
KEPT_VERSIONS = 5


def location(spark: SparkSession, table: str) -> str | None:
    """Folder of the current version; ``None`` if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


class _Folder:
    """A folder on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._path = self._new(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def claim(self, name: str) -> bool:
        """Make a file; false if it is there. Of several callers one succeeds."""
        return self._fs.createNewFile(self._new(self._path, name))

    def release(self, name: str) -> None:
        self._fs.delete(self._new(self._path, name), False)

    def remove_old(self, prefix: str, keep: int, current: str) -> None:
        """Delete the folders named ``prefix...`` but for the latest ``keep`` and ``current``."""
        found = [s for s in self._fs.listStatus(self._path) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
        found.sort(key=lambda s: (s.getModificationTime(), s.getPath().getName()), reverse=True)
        others = [s for s in found if s.getPath().getName() != current]
        for status in others[max(0, keep - 1) :]:
            self._fs.delete(status.getPath(), True)


def swap_table(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    root: str,
    schema: T.StructType | None = None,
    seen: str | None = None,
    keep_versions: int = KEPT_VERSIONS,
) -> None:
    """Replace all rows of ``table`` with ``df``, keeping its schema.

    The rows go to a new version folder under ``root``; readers move over only
    when the folder is complete and its row count was checked, by one change
    of the table's location.  Any failure before that leaves the old version
    in place, and ``df`` may read the table it replaces.

    ``seen`` is the version that the caller based its decision on (by default
    the one current at the start).  Each version can be succeeded once: a file
    named after it is made before the location changes, and who finds it there,
    or finds another version current, gets :class:`ChangedMeanwhile`.  A job
    that dies between the two leaves that file; it names the version, and
    removing it allows a new try.  The latest ``keep_versions`` versions stay.
    """
    exists = spark.catalog.tableExists(table)
    seen = seen or location(spark, table)
    contract = spark.table(table).schema if exists else (schema or df.schema)
    base = f"{root.rstrip('/')}/{table}"
    name = f"v-{uuid.uuid4().hex}"
    version = f"{base}/{name}"
    written = Observation()
    _with_contract(df, contract).observe(written, F.count(F.lit(1)).alias("n")).write.parquet(version)
    kept = spark.read.schema(contract).parquet(version).count()
    if kept != written.get["n"]:
        raise quality.ValidationError(table, [f"{written.get['n']} rows written, {kept} readable"])
    folder = _Folder(spark, base)
    claimed = "after-" + (seen.rstrip("/").rsplit("/", 1)[-1] if seen else "nothing")
    if location(spark, table) != seen or not folder.claim(claimed):
        raise ChangedMeanwhile(f"{table} is no longer at {seen}; the new rows are in {version}")
    try:
        if exists:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
            spark.catalog.refreshTable(table)
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{version}'")
    except Exception:
        folder.release(claimed)
        raise
    if not exists:
        folder.release(claimed)  # a dropped table may be made again
    folder.remove_old("v-", keep_versions, name)


def guarded_swap(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    guard: quality.Guard,
    root: str,
    schema: T.StructType | None = None,
) -> int | None:
    """Validate, then swap; a refused batch leaves the table untouched.

    Returns the row count that the table had before (``None`` if it is new).
    The version whose rows the guard counted must still be the current one when
    the table is switched.
    """
    seen = location(spark, table)
    before = quality.row_count(spark, table)
    quality.refuse_if_broken(df, table, guard, before)
    swap_table(spark, table, df, root, schema, seen)
    return before


def copy_tables(
    spark: SparkSession, pairs: dict[str, str], root: str
) -> DataFrame:
    """Copy each source table to its target name and report on the copies.

    Missing and empty sources are skipped; targets keep their schema.
    """
    copied = {}
    for source, target in pairs.items():
        if not spark.catalog.tableExists(source):
            continue
        df = spark.table(source)
        if df.isEmpty():
            continue
        swap_table(spark, target, df, root)
        copied[source] = target
    if not copied:
        return spark.createDataFrame(
            [], "table_name string, source_rows bigint, target_rows bigint, status string"
        )
    return quality.reconcile(
        {s: spark.table(s) for s in copied}, {s: spark.table(t) for s, t in copied.items()}
    )
