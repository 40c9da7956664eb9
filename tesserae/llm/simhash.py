"""SimHash near-duplicates by anchor-point covering.

The 64 bits are cut into blocks, so that two fingerprints within the threshold are within its
share (threshold // blocks) in one block at least. In a block the anchors are the words of the
binary Golay code of length 23, whose balls of radius 3 cover every word exactly once (shorter
blocks are padded with zeros). A fingerprint lives at its one anchor within the covering radius
and is sent to all anchors within the radius plus the block's share; by the triangle inequality
it meets every fingerprint that is near it, at that one's anchor. Fingerprints are compared
there, all 64 bits.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release, spare
from tesserae.llm.components import Sets, components
from tesserae.session import ship

SHINGLE, THRESHOLD, SEED = 4, 4, 42
#: Widths of the blocks, low bits first; each is at most the code's length.
BLOCKS = (21, 21, 22)
#: The Golay code: length, covering radius, check bits, generator polynomial (fixed values).
LENGTH, RADIUS, CHECKS, GENERATOR = 23, 3, 11, 0b101011100011
#: Fingerprints that live at one anchor beyond so many are dealt to several tasks.
HOMES = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's word shingles; no words: 0."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone are lower-cased, ASCII white space alone separates
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for s in range(0, n, 1 << 15):
        counts += np.unpackbits(hashes[s : s + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), a row for each row of docs; fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([_signed(fingerprint(x, shingle)) for x in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, fp bigint")


def _syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each word by the generator polynomial."""
    x = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        x = np.where(x >> bit & 1, x ^ (GENERATOR << (bit - CHECKS)), x)
    return x


@cache
def _errors(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight up to reach, lightest first: where they begin, how many, all of them."""
    sets = [np.zeros(1, np.int64)]
    for w in range(1, reach + 1):
        before = sets[-1]
        top = np.array([int(x).bit_length() for x in before])
        sets.append(np.concatenate([before[top <= k] | (1 << k) for k in range(LENGTH)]))
    errors = np.concatenate(sets)
    syndromes = _syndrome(errors)
    order = np.argsort(syndromes, kind="stable")
    counts = np.bincount(syndromes, minlength=1 << CHECKS)
    return np.concatenate(([0], np.cumsum(counts)[:-1])), counts, errors[order]


def anchors(words: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into words, anchor, whether it is the word's own): the anchors within the radius plus extra."""
    starts, counts, errors = _errors(RADIUS + extra)
    s = _syndrome(words)
    n = counts[s]
    at = np.repeat(np.arange(len(words)), n)
    k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    error = errors[starts[s][at] + k]
    return at, words[at] ^ error, k == 0


def _replicas(fps: DataFrame, threshold: int, blocks: tuple[int, ...]) -> DataFrame:
    """(anchor, own, fp): every fingerprint at its own anchor and at those near it, for each block."""
    if sum(blocks) != 64 or max(blocks) > LENGTH:
        raise ValueError("blocks are to make up 64 bits, each as long as the code at most")
    share = threshold // len(blocks)

    def run(batches):
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            low = 0
            for k, width in enumerate(blocks):
                words = (x >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
                low += width
                at, anchor, own = anchors(words, share)
                yield pa.record_batch([pa.array(anchor + (k << LENGTH)), pa.array(own), pa.array(x.view(np.int64)[at])], ["anchor", "own", "fp"])

    return arrow_map(fps, run, "anchor bigint, own boolean, fp bigint")


class _Bucket:
    """The fingerprints that live at one anchor; links found are kept as a forest."""

    def __init__(self, threshold: int):
        self.threshold, self.homes, self.sets = threshold, [], Sets()
        self.array: np.ndarray | None = None

    def visit(self, probes: np.ndarray) -> None:
        if self.array is None:
            self.array = np.concatenate(self.homes) if self.homes else np.zeros(0, np.int64)
        homes = self.array
        step = max(1, (1 << 21) // max(1, len(homes)))
        for s in range(0, len(probes) if len(homes) else 0, step):
            part = probes[s : s + step]
            near = np.bitwise_count(part[:, None].view(np.uint64) ^ homes[None, :].view(np.uint64)) <= self.threshold
            near &= part[:, None] != homes[None, :]
            rows, cols = np.nonzero(near)
            for p, h in zip(part[rows].tolist(), homes[cols].tolist(), strict=True):
                self.sets.join(p, h)

    def links(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.sets.parent) if (r := self.sets.root(x)) != x]


def _compared(replicas: DataFrame, threshold: int) -> DataFrame:
    """(u, v): links found at each (anchor, part), at most one for each fingerprint that is there."""

    def run(batches):
        bucket, key = _Bucket(threshold), None
        for b in batches:
            anchor, part = b.column(0).to_numpy(), b.column(1).to_numpy()
            own, fp = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy()
            if not len(anchor):
                continue
            cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
            found = []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(anchor)], strict=True):
                if (now := (anchor[lo], part[lo])) != key:
                    found += bucket.links()
                    bucket, key = _Bucket(threshold), now
                lives = own[lo:hi]
                if lives.any():  # a bucket's own fingerprints come first
                    bucket.homes.append(fp[lo:hi][lives])
                    if bucket.array is not None:
                        raise AssertionError("the bucket's own fingerprints are to come first")
                if not lives.all():
                    bucket.visit(fp[lo:hi][~lives])
            if found:
                u, v = zip(*found, strict=True)
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
        if found := bucket.links():
            u, v = zip(*found, strict=True)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return arrow_map(replicas, run, "u bigint, v bigint")


def links(fps: DataFrame, threshold: int = THRESHOLD, blocks: tuple[int, ...] = BLOCKS, homes: int = HOMES) -> DataFrame:
    """fps: distinct fingerprints (fp). (u, v): enough of the pairs within the threshold to connect all that they connect.

    An anchor's own fingerprints are split into parts of about ``homes`` by a hash, and whoever
    visits the anchor visits each part; the number of anchors is fixed by the code.
    """
    spark = fps.sparkSession
    replicas = durable(_replicas(fps, threshold, blocks))
    crowded = {r["anchor"]: -(-r["n"] // homes) for r in replicas.where("own").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > homes).collect()}  # of len(blocks) * 4096 anchors
    if crowded:
        of = spark.createDataFrame(list(crowded.items()), "anchor bigint, parts int")
        split = replicas.join(F.broadcast(of), "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    else:
        split = replicas.withColumn("parts", F.lit(1))
    own = split.where("own").select("anchor", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("visits"), "fp")
    # the fingerprints that live at an anchor visit it too: they meet one another
    visiting = split.select("anchor", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("visits"), "fp")
    dealt = own.union(visiting).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "visits").select("anchor", "part", (F.col("visits") == 0).alias("own"), "fp")
    found = durable(_compared(dealt, threshold))
    release(replicas)
    return found


def grouped(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """(doc_id, fp, component_id, root), a row for each row of docs.

    component_id is the smallest doc_id that links of at most ``threshold`` differing bits reach,
    the row's own included; root is the component's smallest fingerprint. Copies share a
    fingerprint and are compared once. A null or empty text has the fingerprint 0 and links like
    any other. Null doc_ids count for nothing: a component of such rows alone has a null
    component_id. Repeated rows give repeated rows, an empty table an empty result; columns
    beyond doc_id and text are ignored.
    """
    fps = durable(fingerprints(docs, shingle))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = links(classes.select("fp"), threshold, blocks)
    roots = components(found)
    of = durable(classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(of.join(least, "root").select("fp", "component_id", "root"), "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """docs without near-duplicates, all columns as they are: of each component the row with the smallest doc_id stays.

    Rows without doc_id come after all others; ties are broken by the fingerprint, and of several
    rows alike in both one stays. The texts are shuffled once, against a table of ids.
    """
    from pyspark.sql import types as T

    names = docs.columns
    id_, fp_ = spare("__id", names), spare("__fp", names)
    own = spare("__own", [*names, id_, fp_])
    n = spare("__n", [*names, id_, fp_, own])
    slim = durable(grouped(docs, shingle, threshold))
    first = slim.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "fp")).alias("w"))
    wanted = first.select(F.col("w.doc_id").alias(id_), F.col("w.fp").alias(fp_))
    own_id = F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_))
    if not slim.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return docs.join(wanted, own_id, "left_semi")
    at = names.index("text")

    def run(batches):
        for b in batches:
            yield pa.record_batch([*b.columns, pa.array([_signed(fingerprint(x, shingle)) for x in b.column(at).to_pylist()], pa.int64())], [*names, own])

    ship(docs.sparkSession)
    tagged = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]))
    found = tagged.join(wanted, own_id & (F.col(own) == F.col(fp_)), "left_semi")
    order = Window.partitionBy("doc_id", own).orderBy(*[F.col(f"`{c}`") for c in names])
    return found.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in names])
