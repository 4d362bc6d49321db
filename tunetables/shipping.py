"""The package itself, for the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application. Not needed
    where it is installed on them or given with ``--py-files``."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).resolve().parent
    # Spark copies the file to every executor, so a temporary one will do
    archive = Path(tempfile.mkdtemp(prefix="tunetables-")) / "tunetables.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(home.rglob("*.py")):
            z.write(source, source.relative_to(home.parent).as_posix())
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
