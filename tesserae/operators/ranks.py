"""Exact ranks and medians of groups of any size: rows are sorted by range over all tasks, and only sums are compared between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.durable import written


def _alike(a: DataFrame, b: DataFrame, names: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [a[m].eqNullSafe(b[n]) for m, n in names])


def ranked(df: DataFrame, by: list[str], order: list[str], rank: str = "rank", total: str | None = None, tasks: int | None = None) -> DataFrame:
    """df with ``rank``: each row's place in its group by order (nulls first), from 1 without gaps; with ``total``: the group's rows.

    One shuffle by range of (by, order): a group of any size lies in as many tasks as it fills, each
    with about as many rows as any other, provided that order tells most rows apart. Rows that agree in all of order
    are ranked in any order. The sorted rows are written once, so that their numbers stay what they are when a task is run
    again; pass slim rows and join what else belongs to them. tasks: how many ranges; the session's shuffle partitions by default.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    dealt = df.repartitionByRange(tasks, *keys) if tasks else df.repartitionByRange(*keys)
    # the id's upper bits are the task, the lower ones the row's place in it
    rows = written(dealt.sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())).withColumn("__task", F.shiftright("__id", 33))
    parts = rows.groupBy(*by, "__task").agg(F.min("__id").alias("__least"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("__n").over(w.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("__before", before).withColumn("__total", F.sum("__n").over(w))
    parts = parts.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__task").alias("__at"), "__least", "__before", "__total")
    met = rows.join(parts, (F.col("__task") == F.col("__at")) & _alike(rows, parts, [(c, f"__by_{c}") for c in by]) if by else F.col("__task") == F.col("__at"))
    out = [F.col(c) for c in df.columns] + [(F.col("__id") - F.col("__least") + F.col("__before") + 1).alias(rank)]
    return met.select(*out, *([F.col("__total").alias(total)] if total else []))


def medians(df: DataFrame, by: list[str], value: str, out: str = "median", tasks: int | None = None) -> DataFrame:
    """(by, n, out): exact medians of the values that are not null, the mean of the middle two where they are even in number."""
    r = ranked(df.where(F.col(value).isNotNull()).select(*by, value), by, [value], "__rank", "__total_rows", tasks)
    middle = (F.col("__rank") == F.floor((F.col("__total_rows") + 1) / 2)) | (F.col("__rank") == F.floor(F.col("__total_rows") / 2) + 1)
    mean = (F.min(value).cast("double") + F.max(value).cast("double")) / 2
    return r.where(middle).groupBy(*by).agg(F.max("__total_rows").alias("n"), mean.alias(out))


def numbered(df: DataFrame, by: list[str], order: str, rank: str = "rank", width: int = 65_536) -> DataFrame:
    """df with ``rank``: places from 1 by an integer ``order`` that is unique in the group.

    Nothing is written: rows meet in blocks of ``width`` numbers, which hold so many rows at most;
    blocks exchange their counts.
    """
    d = df.withColumn("__block", F.floor(F.col(order) / width))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    blocks = d.groupBy(*by, "__block").agg(F.count(F.lit(1)).alias("__n"))
    blocks = blocks.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__block").alias("__at"), F.coalesce(F.sum("__n").over(w.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    met = d.join(blocks, (F.col("__block") == F.col("__at")) & _alike(d, blocks, [(c, f"__by_{c}") for c in by]) if by else F.col("__block") == F.col("__at"))
    inner = Window.partitionBy(*by, "__block").orderBy(order)
    return met.withColumn(rank, F.col("__before") + F.row_number().over(inner)).select(*df.columns, rank)
