"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, as a zip file that Spark distributes, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp()) / "package"
        shutil.copytree(root, to / root.name, ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(str(to.parent / f"{root.name}-code"), "zip", to))
        _shipped.add(sc.applicationId)
    return spark
