"""Send this package to the executors, so that functions run there find it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application. Spark's own file server hands the archive to every executor, also to later ones."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="lateline-package-"), "lateline_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, root))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
