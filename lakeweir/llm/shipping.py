"""Getting the package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context.

    They run its functions, and need not have it installed then. Spark's file server of
    the driver delivers the archive.
    """
    context = spark.sparkContext
    if getattr(context, "_lakeweir_shipped", False) or not PACKAGE.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="lakeweir-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._lakeweir_shipped = True
