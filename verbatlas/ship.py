"""Give the executors of a cluster this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to all Python workers, once per application.

    Functions that run in tasks are pickled by name, so a worker must be able to import them.
    Not needed where the package is installed or on ``PYTHONPATH`` of the workers. The archive is
    read by the driver alone, which serves it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="verbatlas-ship-"), "verbatlas.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("verbatlas", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
