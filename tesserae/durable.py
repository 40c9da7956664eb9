"""Intermediate tables, written once where all executors can read them, and removed when nothing needs them."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it's unset, a temporary folder, in local mode only."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="tesserae-shared-"))
    return made


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Bytes of Parquet beyond which a table is not sent to the driver for a join.
SENT = 1 << 20


def unsent(df: DataFrame, path: str) -> DataFrame:
    """df, which is read from path, to be joined by sorting if its files are large.

    The planner takes packed bytes for the size of rows; in memory those of names and ids are ten times as many or more, and a plan of many joins has
    all that it broadcasts in the driver at once.
    """
    p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    return df.hint("merge") if files.getContentSummary(p).getLength() > SENT else df


def _at_exit(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        remove(spark, path)


def written(df: DataFrame) -> DataFrame:
    """df as a table of its own: computed once, whatever reads it; a lost executor costs no earlier step.

    It goes with ``forget``, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tesserae-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tesserae_written = path
    atexit.register(_at_exit, spark, path)
    return out


def temporary(spark: SparkSession) -> str:
    """A shared folder's place for what is needed until the driver ends."""
    path = f"{shared_folder(spark)}/tesserae-{uuid.uuid4().hex}"
    atexit.register(_at_exit, spark, path)
    return path


def forget(*frames: DataFrame) -> None:
    for df in frames:
        if path := getattr(df, "_tesserae_written", None):
            remove(df.sparkSession, path)
