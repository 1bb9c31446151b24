"""Executors get this package from the driver, so that tasks can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")   # served to executors by the driver
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
