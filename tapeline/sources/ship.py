"""Ships this library to executors that don't have it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip to the Spark application, once: Python workers import the functions of its modules by name."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    place = Path(tempfile.mkdtemp(prefix="tapeline-"))
    copy = place / "code" / package.name
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(place / package.name), "zip", copy.parent))
    _shipped.add(app)
