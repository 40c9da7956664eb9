"""An extension: appearances taken from a stream of extractions as they arrive.

The directory is a batch world; this only applies its set-based, order-independent step (names
resolved against a frozen roster, new keys inserted) to every micro-batch. What depends on reading
order stays with the fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tesserae.operators.resolve import confident, resolve


def appearances(arrived: DataFrame, aliases: DataFrame) -> DataFrame:
    """(character_id, chapter_id, name_used) of a batch (chapter_id, name, pointer), each once."""
    met = confident(resolve(arrived, aliases))
    return met.select(F.col("cid").alias("character_id"), "chapter_id", F.col("name").alias("name_used")).dropDuplicates(["character_id", "chapter_id"])


def watch(stream: DataFrame, aliases: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends new appearances to a Parquet folder; a batch told again after a failure replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        appearances(df, aliases).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()


def told(spark, target: str) -> DataFrame:
    """What the batches so far have found, each appearance once, the first batch's."""
    return spark.read.parquet(target).groupBy("character_id", "chapter_id").agg(F.min_by("name_used", "batch").alias("name_used"))
