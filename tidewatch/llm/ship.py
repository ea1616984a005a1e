"""Making this package importable in the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidewatch


def ship(spark: SparkSession) -> None:
    """Hand the package's source to every present and future executor, once a
    session, as `--py-files` would. Spark's own file server carries it."""
    context = spark.sparkContext
    if getattr(context, "_tidewatch_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(tidewatch.__file__))
    if os.path.isdir(top):  # already a zip file where it was shipped by --py-files
        target = os.path.join(tempfile.mkdtemp(prefix="tidewatch-src-"), "tidewatch-src.zip")
        with zipfile.ZipFile(target, "w") as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(target)
    context._tidewatch_shipped = True
