"""Chains of links (a row that goes, the row it goes into), followed to their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.durable import forget, written

#: Doublings: chains of up to 2 ** 40 links.
ROUNDS = 40


def ends(links: DataFrame, lower: str, upper: str) -> DataFrame:
    """(lower, upper, path): where each chain ends, and the rows from below its end down to this one.

    Every lower is in one link. Pointer doubling: a round joins each chain so far with the one it
    leads to, so that rounds grow with the logarithm of the longest chain; each is written. Paths sort a
    tree's rows as they are met when every row is followed by all that went into it, smaller ids
    first. A circle raises ValueError.
    """
    at = written(links.select(F.col(lower).alias("__x"), F.col(upper).alias("__at"), F.array(lower).alias("__path")))
    for _ in range(ROUNDS):
        up = at.select(F.col("__x").alias("__at"), F.col("__at").alias("__up"), F.col("__path").alias("__above"))
        joined = at.join(up, "__at", "left")
        moved = F.col("__up").isNotNull()
        new = written(
            joined.select(
                "__x",
                F.coalesce("__up", "__at").alias("__at"),
                F.when(moved, F.concat("__above", "__path")).otherwise(F.col("__path")).alias("__path"),
                moved.alias("__moved"),
                F.when((F.col("__up") == F.col("__x")) | F.array_contains("__above", F.col("__x")), F.col("__x")).alias("__round"),
            )
        )
        forget(at)
        seen = new.agg(F.count_if("__moved").alias("moved"), F.min("__round").alias("circle")).first()
        if seen["circle"] is not None:
            forget(new)
            raise ValueError(f"{seen['circle']} leads round to itself")
        at = new
        if not seen["moved"]:
            return at.select(F.col("__x").alias(lower), F.col("__at").alias(upper), F.col("__path").alias("path"))
    raise ValueError("chains did not end")
