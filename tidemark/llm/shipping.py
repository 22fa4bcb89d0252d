"""Gives the workers of a session this package, where they were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidemark


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip to the session's files, once."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    file = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(file, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(file)
    context._tidemark_shipped = True
