"""Small tables with everything that real ones may hold."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(n, seed, words=None):
    r = random.Random(seed)
    words = words or ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(400)]
    return " ".join(r.choice(words) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, copies, repeated rows, odd characters."""
    long = "\n".join(prose(12, k) for k in range(3000))
    shared = prose(60, 5)
    rows = [
        (1, "Hello world. Don't STOP 12345!", "en", "a", 30),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, "   \t\n  \n", "en", None, 9),
        (5, long, "en", "b", len(long)),
        (6, shared, "en", "c", 1),
        (7, shared, "de", "a", 1),
        (8, prose(40, 8) + "\n" + shared + "\n" + prose(30, 9), "en", "c", 1),
        (9, "ÀÉ straße ﬁ ½ 日本語 🙂 <|endoftext|> <s> İx y  z\r\n\tq", "fr", "", 1),
        (9, "another text of the same number, long enough to be a line of its own", "fr", "z", 1),
        (10, prose(200, 11), "en", "a", 1),
        (10, prose(200, 11), "en", "a", 1),
        (None, prose(50, 12), "en", "a", 1),
        (None, None, None, None, None),
        (11, "one one one one two", "en", "d", 1),
    ]
    return rows + [(100 + k, prose(20 + k, 100 + k), "en", f"s{k % 4}", 1) for k in range(30)]


def docs(spark, rows=None, extra=False):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCS).repartition(4)
    if extra:  # names that the operators use themselves
        for c in ("size", "piece", "at", "h", "key", "shard", "class", "fp", "root", "node", "u", "score", "line", "one", "first"):
            df = df.selectExpr("*", f"'x' as {c}")
    return df


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
