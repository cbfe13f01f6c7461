"""Makes this package importable on executors that do not share the driver's folders."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))


def _archive() -> bytes:
    out = io.BytesIO()
    top = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    return out.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers once per application (``addPyFile``).

    Functions handed to ``mapInPandas`` / ``mapInArrow`` are pickled by reference,
    so a worker must be able to import the package. The archive is served by the
    driver; workers need no folder in common with it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_recordsmith_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="recordsmith-ship-")
    path = os.path.join(folder, "recordsmith_pkg.zip")
    with open(path, "wb") as f:
        f.write(_archive())
    sc.addPyFile(path)
    sc._recordsmith_shipped = True


def shipped(df: DataFrame) -> DataFrame:
    ship_package(df.sparkSession)
    return df
