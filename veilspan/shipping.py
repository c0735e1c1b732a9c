"""Makes this package importable in Python workers that do not share the driver's path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    handle, path = tempfile.mkstemp(prefix="veilspan-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
