"""Mixing sources to target weights, with DataFrame operations alone.

Within a source, rows are put in the order of a seeded random key and their token counts are
summed up by distributed prefix sums; a source's budget is cut exactly, after as many whole
epochs as it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import HASHES, WORD, durable, hash_order, ranked, repeated, spare

ROWS_PER_BUCKET = 4096
#: Weights dealt to the sources in code point order, null last, again and again.
WEIGHTS = (3, 1, 2)
#: The mix's size as a share of all sizes, and the most often a source is repeated.
SHARE, MOST_EPOCHS = 1.5, 2


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes (none, key, source_size: a row for each source) with target.

    Weights share the mix; a target stops at ``most`` times its source's size and the excess goes
    to the others by weight until none is above. In closed form: order the sources by
    source_size / weight; those below the water level are filled, the rest get level * weight.
    There is a row for each source, so these windows see as many rows as weights are given for.
    """
    every = Window.partitionBy(F.lit(0))
    numbered = sizes.withColumn("i", F.row_number().over(every.orderBy("none", "key")) - 1).withColumn(
        "w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    )
    c = numbered.withColumn("cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    order = every.orderBy("ratio", "i")
    level = (
        c.withColumn("all", F.sum("source_size").over(every) * float(share))
        .withColumn("filled", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.col("filled")) / F.col("open"))
        .withColumn("k", F.row_number().over(order))
        .withColumn("first_open", F.min(F.when(F.col("level") < F.col("ratio"), F.col("k"))).over(every))
        .withColumn("water", F.min(F.when(F.col("k") == F.col("first_open"), F.col("level"))).over(every))
    )
    return level.select(
        "none", "key", "source_size", F.when(F.col("first_open").isNull() | (F.col("k") < F.col("first_open")), F.col("cap")).otherwise(F.col("water") * F.col("w")).alias("target")
    )


def _identity(docs: DataFrame) -> Column:
    """A hash of all that a row has: rows alike in it are one row and its copies. Columns that can't be hashed are left out."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"])


def mix(docs: DataFrame, seed: int = 7, **rule) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), a row for each row of docs.

    size: words of the text (a null text: 0). Every row is taken as many times whole as its source
    has epochs in the mix, and the rows first in the random order once more; the row at the
    cut gives its first words only, so that a source's taken words are its target, rounded.
    A null source is a source of its own, after all others. The random key is a hash of seed,
    doc_id, source and text, so reruns agree; rows alike in these are interchangeable in the
    result, and are ranked as one row with their number, so that copies crowd no bucket. A source
    without words has the target 0. An empty table gives an empty result. Columns beyond doc_id,
    text and source are ignored.
    """
    found, most = _mixed(docs, seed, F.lit(0).cast("bigint"), **rule)
    each = repeated(found, "m", "copy", ["h", "doc_id", "size"], most, ROWS_PER_BUCKET)
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before") - F.col("copy") * F.col("size"))).cast("bigint")
    return each.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + last).alias("taken"))


def _mixed(docs: DataFrame, seed: int, identity: Column, **rule) -> tuple[DataFrame, int]:
    """A row for each rows alike in identity, doc_id, source and text: m, how many; epochs; left, words that the source gives once more; before, words of it that come before. And the largest m."""
    plain = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.isnull("source").alias("none"),
        F.coalesce("source", F.lit("")).alias("key"),
        identity.alias("identity"),
        hash_order(F.col("doc_id"), F.col("source"), F.md5("text"), seed=seed).alias("h"),
    )
    slim = durable(plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("m")).withColumn("words", F.col("m") * F.col("size")))
    total = slim.agg(F.sum("m").alias("rows"), F.max("m").alias("most")).first()
    buckets = max(1, -(-(total["rows"] or 0) // ROWS_PER_BUCKET))
    goals = targets(slim.groupBy("none", "key").agg(F.sum("words").alias("source_size")), **rule)
    summed = ranked(slim, ["none", "key"], F.expr(f"h div {-(-HASHES // buckets)}"), ["h", "doc_id", "size", "identity"], "words", "before", goals)
    budget, any_words = F.round("target").cast("bigint"), F.col("source_size") > 0
    epochs = F.when(any_words, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    return summed.withColumn("epochs", epochs).withColumn("left", F.when(any_words, budget % F.col("source_size")).otherwise(0)), total["most"] or 0


def mixture(docs: DataFrame, seed: int = 7, **rule) -> DataFrame:
    """The mix itself, all columns of docs: a row for each time that a row is taken; a row taken in part has its first words, with a blank between them.

    The texts are shuffled once, against a table of decisions. n_chars, if there is one, follows
    the text of a row taken in part. Rows that are not taken are not returned. Copies (rows alike
    in all columns) are decided together, and only they.
    """
    names = docs.columns
    own: dict[str, str] = {}
    for c in ("id", "whole", "part", "n", "k"):
        own[c] = spare(f"__{c}", [*names, *own.values()])
    found, most = _mixed(docs, seed, _identity(docs), **rule)
    room = F.least(F.greatest(F.col("left") - F.col("before"), F.lit(0)), F.col("words"))  # words that these rows give once more
    once = F.when(F.col("size") > 0, F.floor(room / F.col("size"))).otherwise(0)
    part = F.when(F.col("size") > 0, room % F.col("size")).otherwise(0)
    whole = F.when(F.col("size") > 0, F.col("m") * F.col("epochs") + once).otherwise(0)
    counted = found.select(F.col("identity").alias(own["id"]), whole.cast("bigint").alias(own["whole"]), part.cast("bigint").alias(own["part"]))
    chosen = durable(counted.withColumn(own["n"], F.col(own["whole"]) + (F.col(own["part"]) > 0).cast("bigint")).where(F.col(own["n"]) > 0))
    keyed = docs.withColumn(own["id"], _identity(docs))
    if most > 1:
        keyed = keyed.dropDuplicates([own["id"]])
    copies = chosen.agg(F.max(own["n"])).first()[0] or 1
    rows = repeated(keyed.join(chosen, own["id"]), own["n"], own["k"], [own["id"]], copies, ROWS_PER_BUCKET)
    cut = F.col(own["k"]) == F.col(own["whole"])
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col(own["part"]).cast("int")), " ")
    rows = rows.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in names])
