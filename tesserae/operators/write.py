"""Upserts on immutable tables: each gives the next version of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _numbered(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows whose key is there already are left out; of new rows with one key the first in order is taken."""
    first = _numbered(new, keys, order).where("__n = 1").drop("__n")
    return old.unionByName(first.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def insert_replace(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last new row of a key takes an old row's place as a whole: columns it doesn't name are null."""
    last = _numbered(new, keys, [c.desc() for c in order]).where("__n = 1").drop("__n")
    return old.join(last.select(*keys), keys, "left_anti").select(*old.columns).unionByName(last, allowMissingColumns=True)


def fill_once(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Empty columns take the new value, others stay. new: one row for each key."""
    given = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return old.join(given, keys, "left").select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in old.columns])


def new_ids(df: DataFrame, out: str, last: int, key: str, order: list[str], buckets: int = 1024) -> DataFrame:
    """df with ``out``: ids from last + 1 without gaps, dealt bucket by bucket of the key's hash; only the buckets' counts meet in one task."""
    d = df.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    return d.join(starts, "__b").withColumn(out, (F.lit(last) + F.col("__start") + place).cast("bigint")).drop("__b", "__start")


def collapsed(df: DataFrame, key: str, order: str, first: list[str], every: list[str], given: list[str], lists: dict[str, str]) -> DataFrame:
    """Several entries of one key as one: scalars of the first, flags that all have, the first value given, arrays joined by an element's key.

    lists: array column -> the field (or "" for the element itself) that tells its elements apart.
    """
    out = [F.min_by(c, order).alias(c) for c in first]
    out += [F.bool_and(F.coalesce(c, F.lit(False))).alias(c) for c in every]
    out += [F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.col(order))).alias(c) for c in given]
    out += [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(c, F.array()).alias("x")))), lambda s: s["x"])).alias(c) for c in lists]
    merged = df.groupBy(key).agg(*out)
    return merged.withColumns({c: _apart(F.col(c), name) for c, name in lists.items()})


def _apart(c: Column, name: str) -> Column:
    """An array's elements, the first of those that are alike in a field (or as a whole)."""
    mine = lambda x: x[name] if name else x
    return F.filter(c, lambda x, i: F.array_position(F.transform(c, lambda y: mine(y)), mine(x)) == i + 1)
