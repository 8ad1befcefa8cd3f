"""The package on the workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="package-")
        sc.addPyFile(shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name))
        _shipped.add(sc.applicationId)
