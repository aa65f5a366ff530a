"""Getting this library to executors that don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import assaylake

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the library's modules to the application, once, unless PYTHONPATH already names their folder."""
    package = Path(assaylake.__file__).resolve().parent
    known = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    application = spark.sparkContext.applicationId
    if application in _SHIPPED or str(package.parent) in known:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="assaylake-"), "assaylake.zip")  # Spark's file server sends it on
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)
