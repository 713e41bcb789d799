"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_maskwright_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="mw-code-"), "maskwright_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._maskwright_shipped = True
