"""Make the package importable in the Python workers of every executor."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="arrears-")) / "arrears.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
