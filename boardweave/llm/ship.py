"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import boardweave

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Spark's own file service gives the package to every executor, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(boardweave.__file__).parent
        handle, path = tempfile.mkstemp(prefix="boardweave-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(top.rglob("*.py")):
                archive.write(source, str(source.relative_to(top.parent)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
