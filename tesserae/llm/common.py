"""What the operators of this subpackage share: inputs, durable intermediates, distributed ranks."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.session import ship

#: What separates words everywhere in this subpackage: ASCII space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors share; a temporary folder only in local mode."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="tesserae-shared-"))
    return made


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # at exit the JVM may be gone already
        _remove(spark, path)


def durable(df: DataFrame) -> DataFrame:
    """df, written once as Parquet in the shared folder and read back: cuts the lineage, survives lost executors.

    Removed when the driver ends; ``release`` removes it before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tesserae-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tesserae_path = path
    atexit.register(_remove_quietly, spark, path)
    return out


def release(*frames: DataFrame) -> None:
    """Remove what ``durable`` wrote, once nothing reads it any more.

    Shuffle files go when the driver's JVM collects its garbage, which it may put off for long.
    """
    for df in frames:
        if path := getattr(df, "_tesserae_path", None):
            _remove(df.sparkSession, path)
    gc.collect()
    if (spark := SparkSession.getActiveSession()) is not None:
        spark.sparkContext._jvm.System.gc()


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(f, schema)


def hash_order(*parts: Column | str, seed: int) -> Column:
    """A seeded, uniform, non-negative 60-bit key that SQL engines share: leading digits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


#: 2 ** 60, the number of values of ``hash_order``.
HASHES = 1 << 60


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest n that at most ``most`` rows of counts reach; from 2 ** 16 on n are told apart by powers of two only."""
    coarse = F.when(F.col("n") < 1 << 16, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("bigint"))
    rows = counts.groupBy(coarse.alias("at")).agg(F.count(F.lit(1)).alias("k")).collect()  # at most 2 ** 16 + 48
    least, total = 1 << 62, 0
    for at, k in sorted(rows, reverse=True):
        total += k
        if total > most:
            break
        least = at
    return least


def running_total(counts: DataFrame, by: list[str], order: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """counts with ``out``: the sum of value over rows of the same ``by`` with a smaller ``order``.

    Two levels, so that no task holds more than ``width`` rows or the number of ``width``-blocks.
    order is a non-negative integer, unique within ``by``.
    """
    block, before = "__block", "__before"
    c = counts.withColumn(block, F.floor(F.col(order) / width))
    blocks = c.groupBy(*by, block).agg(F.sum(value).alias("__sum"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    blocks = blocks.select(*by, block, F.coalesce(F.sum("__sum").over(w.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    inner = Window.partitionBy(*by, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        c.join(blocks, [*by, block])
        .withColumn(out, F.col(before) + F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .drop(block, before)
    )


def ranked(df: DataFrame, by: list[str], bucket: Column, order: list[Column | str], value: str, out: str, extra: DataFrame | None = None) -> DataFrame:
    """df with ``out``: the sum of value over the rows before it in its ``by`` group, in the order (bucket, order).

    bucket must follow the order and be an integer: a group of any size is split by it over many
    tasks, which exchange only their sums. extra: columns by ``by`` (which is not empty then), joined to the
    sums (of which there are few) and not to the rows.
    """
    d = df.withColumn("__bucket", bucket)
    sums = d.groupBy(*by, "__bucket").agg(F.sum(value).alias("__total"))
    starts = running_total(sums, by, "__bucket", "__total", "__start").drop("__total")
    if extra is not None:
        starts = starts.join(extra, by)
    w = Window.partitionBy(*by, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        d.join(starts, [*by, "__bucket"])
        .withColumn(out, F.col("__start") + F.coalesce(F.sum(value).over(w), F.lit(0)))
        .drop("__bucket", "__start")
    )


def spare(name: str, taken: list[str]) -> str:
    """name, lengthened until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def repeated(df: DataFrame, n: str, k: str, by: list[str], most: int, width: int = 4096) -> DataFrame:
    """df with n rows for each row, numbered by k from 0; rows with more copies than ``width`` are dealt to several tasks.

    by: columns that tell rows apart; most: the largest n.
    """
    if most <= width:
        return df.withColumn(k, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1)))
    start = spare("start", df.columns)
    dealt = df.withColumn(start, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1, F.lit(width).cast("bigint")))).repartition(*by, start)
    return dealt.withColumn(k, F.explode(F.sequence(F.col(start), F.least(F.col(start) + width, F.col(n)) - 1))).drop(start)
