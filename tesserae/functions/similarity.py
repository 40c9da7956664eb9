"""Gestalt similarity of names, which Spark lacks: an Arrow UDF, and bounds that need none."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 * matched / total length of two texts, blocks found longest first; null with null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def lengths_allow(a: Column, b: Column, least: float) -> Column:
    """Whether lengths alone leave room for the ratio: no true pair is lost by it."""
    small, large = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return 2 * small >= F.lit(least) * (small + large) - 1e-9


def letters(c: Column) -> Column:
    """A text's characters, sorted: equal for anagrams."""
    return F.array_sort(F.filter(F.split(c, ""), lambda x: x != ""))


def letters_allow(a: Column, b: Column, least: float) -> Column:
    """Whether the characters in common, counted with repeats, leave room for the ratio."""
    common = F.aggregate(
        F.array_distinct(F.split(a, "")),
        F.lit(0),
        lambda n, x: n + F.when(x == "", 0).otherwise(F.least(F.length(a) - F.length(F.replace(a, x, F.lit(""))), F.length(b) - F.length(F.replace(b, x, F.lit(""))))),
    )
    return 2 * common >= F.lit(least) * (F.length(a) + F.length(b)) - 1e-9


def _segments(a: DataFrame, b: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(a, n, i, segment) and (b, n, i, segment): texts that may have the ratio share one of these. a, b: distinct texts, in one column each.

    A ratio of t leaves at most (1 - t) * (|a| + |b|) characters outside the matched blocks, which
    lie in the same order in both. If a is cut into one segment more than that, one of them is in b
    whole, and no further from its place than there are such characters. So a meets b by a segment.
    """
    a, b = (x.toDF(name) for x, name in ((a, "a"), (b, "b")))
    most, spare = (2 - least) / least, lambda total: F.floor(total * F.lit(1 - least) + 1e-9).cast("int")
    cuts = spare(F.col("n") + F.floor(F.col("n") * most + 1e-9)) + 1
    start, stop = F.expr("cast(i * n div k as int)"), F.expr("cast((i + 1) * n div k as int)")
    pieces = lambda df: df.withColumn("k", cuts).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("s", start).withColumn("l", stop - F.col("s"))
    held = pieces(a.withColumn("n", F.length("a"))).select("a", "n", "i", F.expr("substr(a, s + 1, l)").alias("segment"))
    near = b.withColumn("m", F.length("b")).withColumn("n", F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(F.col("m") / most - 1e-9)).cast("int"), F.greatest(F.lit(1), F.floor(F.col("m") * most + 1e-9)).cast("int"))))
    near = pieces(near).withColumn("d", spare(F.col("n") + F.col("m")))
    moved = near.withColumn("low", F.greatest(F.col("s") - F.col("d"), F.lit(0))).withColumn("high", F.least(F.col("s") + F.col("d"), F.col("m") - F.col("l"))).where("low <= high")
    sought = moved.withColumn("at", F.explode(F.sequence("low", "high"))).select("b", "n", "i", F.expr("substr(b, at + 1, l)").alias("segment"))
    return held, sought


def may_be_similar(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(a, b): all pairs of texts that may have the ratio, found without comparing all with all. a, b: distinct texts, in one column each."""
    held, sought = _segments(a, b, least)
    sought = sought.distinct()
    met = held.join(sought, ["n", "i", "segment"]).select("a", "b").distinct()
    return met.where(lengths_allow(F.col("a"), F.col("b"), least) & letters_allow(F.col("a"), F.col("b"), least))


def near_any(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(b): of the texts b those, and a few more, that may have the ratio with one of the texts a; no pairs are made."""
    held, sought = _segments(a, b, least)
    return sought.join(held.select("n", "i", "segment").distinct(), ["n", "i", "segment"], "left_semi").select("b").distinct()
