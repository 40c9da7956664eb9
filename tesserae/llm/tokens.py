"""Token counts: pieces are counted once per distinct pre-token and joined to each document's pre-token frequencies.

Three passes. The first collects the corpus's distinct pre-tokens and how often each occurs; the
second counts the pieces of each, once; the third joins the counts to the documents' frequencies.
The most frequent pre-tokens, at most TRAVEL of them, travel with the tasks of the third pass as a
table of hashes and counts, so that only a document's rare pre-tokens are shuffled to their counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, least_count, release
from tesserae.llm.encode import Memory, piece_counts, pretokens

#: Pre-tokens whose counts travel with tasks: 12 bytes each.
TRAVEL = 1 << 20
#: Bytes of a pre-token that is worth sharing: longer ones (texts without blanks) hardly occur twice and are counted where they stand.
SHARED = 256
#: Bytes of text whose distinct pre-tokens a task holds.
HELD = 1 << 25


def _hash(token: str) -> int:
    x = xxhash.xxh3_64_intdigest(token)
    return x - (1 << 64) if x >> 63 else x


def _distinct(docs: DataFrame) -> DataFrame:
    """(token, n): the distinct pre-tokens and how often they occur."""

    def run(batches):
        held, size = [], 0

        def out():
            found = pc.value_counts(pa.concat_arrays(held))
            return pa.record_batch([found.field("values"), found.field("counts")], ["token", "n"])

        for b in batches:
            flat, _ = pretokens(b.column(0))
            held.append(flat.filter(pc.less_equal(pc.binary_length(flat), SHARED)))
            size += b.nbytes
            if size > HELD:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return arrow_map(docs.select("text"), run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def _counted(distinct: DataFrame, vocabulary: str) -> DataFrame:
    """(token, h, n, pieces)."""

    def run(batches):
        for b in batches:
            tokens = b.column(0).to_pylist()
            yield pa.record_batch([b.column(0), pa.array(list(map(_hash, tokens)), pa.int64()), b.column(1), pa.array(piece_counts(tokens, vocabulary), pa.int32())], ["token", "h", "n", "pieces"])

    return arrow_map(distinct, run, "token string, h bigint, n bigint, pieces int")


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096, travel: int = TRAVEL) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each row of docs, whole texts, null as empty.

    Pre-tokens are joined by a 64-bit hash; those that share one and have different counts are told
    apart by their texts. No document's ids are ever made. Rows are independent, so repeated rows
    count alike; an empty table gives an empty result; columns beyond doc_id and text are ignored.
    A very long text is held by one task, as one Arrow batch, beside its pre-tokens.
    """
    d = docs.select(F.col("doc_id").cast("bigint"), "text")
    counted = durable(_counted(_distinct(d), vocabulary))
    table = durable(counted.groupBy("h").agg(F.sum("n").alias("n"), F.min("pieces").alias("pieces"), F.max("pieces").alias("most")))
    clashing = table.where("pieces <> most").select("h")
    # as many as pairs of distinct pre-tokens have equal hashes: none, as a rule
    apart = {r["token"]: r["pieces"] for r in counted.join(clashing, "h", "left_semi").select("token", "pieces").collect()}
    least = least_count(table, travel)
    top = table.where(F.col("n") >= least).select("h", "pieces").toArrow()  # at most ``travel`` rows
    order = np.argsort(h := top.column("h").to_numpy())
    hashes, pieces = h[order], top.column("pieces").to_numpy()[order]
    release(counted)

    def look_up(token: str) -> tuple[int, int]:
        """(pieces, 0), or (-1, hash) of a rare pre-token."""
        if token in apart:
            return apart[token], 0
        if len(token.encode()) > SHARED:
            return piece_counts([token], vocabulary)[0], 0
        x = _hash(token)
        at = int(np.searchsorted(hashes, x))
        return (int(pieces[at]), 0) if at < len(hashes) and hashes[at] == x else (-1, x)

    def run(batches):
        memory = Memory(look_up)
        for b in batches:
            flat, offsets = pretokens(b.column(1))
            coded = flat.dictionary_encode()
            own, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
            memory.settle()
            found = np.array([memory[x] for x in own], np.int64).reshape(-1, 2)
            each = found[at, 0]
            row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            known = np.bincount(row, np.maximum(each, 0), b.num_rows).astype(np.int64)
            rare = each < 0
            pairs, n = np.unique(row[rare] * max(1, len(own)) + at[rare], return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(b.num_rows + 1) * max(1, len(own)))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(found[pairs % max(1, len(own)), 1]), pa.array(n, pa.int32())], ["h", "n"]))
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.record_batch([b.column(0), size, pa.array(known), lists], ["doc_id", "n_bytes", "known", "rare"])

    local = arrow_map(d, run, "doc_id bigint, n_bytes bigint, known bigint, rare array<struct<h:bigint,n:int>>")
    rows = durable(local.withColumn("row", F.monotonically_increasing_id()))  # written, so that the numbers stay
    found = rows.select("row", F.inline("rare")).join(table.where(F.col("n") < least).select("h", "pieces"), "h")
    sums = found.groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    out = rows.select("doc_id", "n_bytes", "known", "row").join(sums, "row", "left").select("doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).cast("bigint").alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
