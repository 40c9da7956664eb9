"""Session helpers: defaults for local runs, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tesserae")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERAE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run; once per application.

    Arrow batches are kept small, for one row may hold a very long text.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tesserae_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tesserae-")) / "tesserae.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    sc._tesserae_shipped = True
