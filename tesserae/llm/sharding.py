"""Sharding by proportional stratified interleaving, with DataFrame operations alone.

Rows of a source get a seeded random order; row r of n has the fractional rank (r + u) / n, u
being a number from 0 to 1 that a hash of the source gives, so that sources of one size don't fall on the same ranks.
Sorting all rows by it interleaves the sources in proportion, so that any run of consecutive
rows has the mixture of the whole. Cutting the sorted rows into equal runs gives the shards.

Neither order is ever sorted in one task: both keys are uniform, so an equal-width bucket of the
key is a small group, and only the buckets' counts are summed across tasks. A few narrow
shuffles; the texts are read once and never moved. Rows alike are ranked as one row with their
number, so that no bucket is crowded by copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import HASHES, durable, hash_order, ranked, repeated

#: Rows a task sorts together; the number of buckets follows the table.
ROWS_PER_BUCKET = 4096


def _offset(seed: int) -> Column:
    """A source's place between two ranks: 48 bits of an MD5 as a fraction."""
    told = F.concat(F.lit(f"{seed}|"), F.when(F.col("none"), "~").otherwise(F.concat(F.lit("="), F.col("key"))))
    return F.conv(F.substring(F.md5(told), 1, 12), 16, 10).cast("double") / float(1 << 48)


def shard(docs: DataFrame, shards: int = 8, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard), a row for each row of docs.

    Law ``rows``: shards differ by one row at most. size is the text's UTF-8 bytes plus 1 (a null
    text: 1, CRC 0). A null source is a source of its own. Ties of the random key are ordered by
    doc_id (nulls first), then by size and CRC; rows alike in all of them are interchangeable. An
    empty table gives an empty result. Columns beyond doc_id, text and source are ignored.
    """
    plain = docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.isnull("source").alias("none"),
        F.coalesce("source", F.lit("")).alias("key"),
    )
    alike = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("m"))
    slim = durable(alike.withColumn("h", hash_order("doc_id", "text_crc32", seed=seed)))
    found = slim.agg(F.sum("m").alias("rows"), F.max("m").alias("most")).first()
    rows, most = found["rows"] or 0, found["most"] or 0
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    width = -(-HASHES // buckets)
    totals = slim.groupBy("none", "key").agg(F.sum("m").alias("n"))
    ties = ["doc_id", "size", "text_crc32"]
    by_source = ranked(slim, ["none", "key"], F.expr(f"h div {width}"), ["h", *ties], "m", "r", totals)
    each = repeated(by_source, "m", "copy", ["none", "key", "h", *ties], most, ROWS_PER_BUCKET)
    spread = each.withColumn("f", (F.col("r") + F.col("copy") + _offset(seed)) / F.col("n")).withColumn("one", F.lit(1).cast("bigint"))
    placed = ranked(spread, [], F.floor(F.col("f") * buckets), ["f", "none", "key", "h", *ties], "one", "at")
    number = f"at * {shards} div {max(rows, 1)}"
    return placed.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.expr(number).cast("int").alias("shard"),
        (F.col("at") - F.expr(f"(({number}) * {rows} + {shards - 1}) div {shards}")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def read_shard(sharded: DataFrame, number: int) -> DataFrame:
    """One shard's rows in the order of their slots."""
    return sharded.where(F.col("shard") == number).orderBy("slot")
