"""Sends this package to the Python workers, wherever the session runs.

A job submitted with the package installed or on every worker's path does not need
it; a session started from a checkout does.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shipped(spark: SparkSession) -> SparkSession:
    """`spark`, whose workers can import this package; done once per application."""
    context = spark.sparkContext
    if getattr(context, "_corpweave_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpweave-")) / "corpweave.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    context._corpweave_shipped = True
    return spark
