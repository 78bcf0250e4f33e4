"""Python code in tasks needs this package on the workers, wherever the driver found it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application."""
    context = spark.sparkContext
    folder = Path(__file__).parent
    if context.applicationId in _shipped or not folder.is_dir():
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="chartmill-code-"), folder.name), "zip", folder.parent, folder.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
