"""The package's code on the executors.

Functions that run in Python workers are found there by the package's name. A
session that was started without the package on its workers' path (no
``--py-files``, another working directory) gets it from the driver once, as a
zip of the sources that Spark distributes like any file of a job.
"""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    context = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(package):
        return
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
