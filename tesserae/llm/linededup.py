"""Fuzzy line dedup: MinHash signatures of character shingles, banding, exact Jaccard, union-find.

Lines are compared in ASCII lower case and without white space around them; lines without a letter,
a digit or a character beyond ASCII are no text and stay. Equal lines are one class before any
banding, by a 64-bit hash of the line, however short they are. Two lines are similar by the Jaccard
index of their shingles: of 8 characters if the longer line has LONG characters or more, else of 5,
for one changed letter alters as many shingles as a shingle is long. A line that can be similar to
longer and to shorter ones is banded under both; one without a shingle can only be equal to another.
Only distinct lines are compared, and texts are fetched only for lines that share a band with
another.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release, spare
from tesserae.llm.components import Sets, components

#: Characters of a shingle in short pairs and in long ones; a pair is long if its longer line has so many characters.
SHORT_SHINGLE, LONG_SHINGLE, LONG = 5, 8, 80
SIMILARITY = 0.8
_WORDY = re.compile(rb"[0-9A-Za-z\x80-\xff]")
#: Ten bands of four minima find a pair of similarity 0.8 with a probability of 0.995.
BANDS, ROWS = 10, 4
#: A band's lines beyond so many are dealt to several tasks.
CROWD = 2048

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_D = np.uint64(0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def normal(line: bytes) -> bytes:
    """What is compared of a line: ASCII lower case, white space around it dropped."""
    return line.lower().strip()


def _rolled(text: bytes, k: int) -> np.ndarray:
    """A 64-bit number for each k characters in a row of a UTF-8 text."""
    c = np.frombuffer(text, np.uint8).astype(np.uint64) if text.isascii() else np.frombuffer(text.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(c) < k:
        return _mixed(c[:0])
    # numbers of 2, 4, 8 .. characters are put together from halves, what is left of k is put behind them
    whole, x, n, step = None, c, 1, _D
    done = 0
    for bit in range(k.bit_length()):
        if k >> bit & 1:
            if whole is None:
                whole = x
            else:  # the longer number first
                size = len(c) - (done + n) + 1
                whole = x[:size] * np.uint64(pow(int(_D), done, 1 << 64)) + whole[n : n + size]
            done += n
        if n * 2 <= k:
            x = x[: len(x) - n] * step + x[n:]
            n, step = n * 2, np.uint64(int(step) * int(step) & (1 << 64) - 1)
    return _mixed(whole)


def shingles(line: bytes, k: int) -> np.ndarray:
    """The line's distinct shingles, sorted."""
    x = np.sort(_rolled(line, k))
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def lengths(lines: list[bytes]) -> np.ndarray:
    """The lines' characters."""
    return np.fromiter((len(x) if x.isascii() else len(x.decode()) for x in lines), np.int64, len(lines))


def shared_by(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def signatures(lines: list[bytes], chars: np.ndarray, shingle: int, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(lines, bands) band keys of lines with a shingle or more: minima of one permutation in bins; an empty bin takes the next one's minimum."""
    k = bands * rows
    out = np.empty((len(lines), bands), np.int64)
    edges = np.concatenate(([0], np.cumsum(chars)))
    at = 0
    while at < len(lines):
        stop = max(at + 1, int(np.searchsorted(edges, edges[at] + (1 << 18), "right")) - 1)
        counts = chars[at:stop] - shingle + 1
        line = np.repeat(np.arange(stop - at), counts)
        where = np.arange(len(line)) + line * (shingle - 1)
        h = _rolled(b"".join(lines[at:stop]), shingle)[where]
        bins = ((h >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        low = np.full((stop - at) * k, _NONE)
        np.minimum.at(low, line * k + bins, h * _C)
        low = low.reshape(-1, k)
        empty = low == _NONE
        full = low.copy()
        for step in range(1, k):
            if not empty.any():
                break
            moved = np.roll(low, -step, axis=1)
            take = empty & (moved != _NONE)
            full[take] = moved[take] + np.uint64(step * int(_B) & (1 << 64) - 1)
            empty &= ~take
        full = full.reshape(stop - at, bands, rows)
        key = np.broadcast_to((np.arange(1, bands + 1) + 100 * shingle).astype(np.uint64) * _C, (stop - at, bands)).copy()
        for r in range(rows):
            key = _mixed(key ^ full[:, :, r])
        out[at:stop] = key.view(np.int64)
        at = stop
    return out


def banded(lines: list[bytes], similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all lines in a row, those among short lines before those among long ones, and where each line's begin and the last one's end."""
    chars = lengths(lines)
    short = (chars >= SHORT_SHINGLE) & (chars < LONG)
    long = (chars >= LONG_SHINGLE) & (chars >= np.floor(similarity * LONG))
    table = np.zeros((len(lines), 2, BANDS), np.int64)
    for k, (own, shingle) in enumerate(((short, SHORT_SHINGLE), (long, LONG_SHINGLE))):
        at = np.flatnonzero(own)
        table[at, k] = signatures([lines[i] for i in at], chars[at], shingle)
    use = np.stack([short, long], axis=1)
    return table[use].reshape(-1), np.concatenate(([0], np.cumsum(use.sum(axis=1) * BANDS)))


_FOUND = "key bigint, doc_id bigint, n_lines int, lines array<struct<line:int,class:bigint,bands:array<bigint>>>"


def _scanned(docs: DataFrame, similarity: float) -> DataFrame:
    """A row for each document: its lines with text, their classes and band keys."""

    def run(batches):
        for b in batches:
            numbers, classes, texts, ends, totals = [], [], [], [0], []
            for x in b.column(2).to_pylist():
                parts = x.encode().lower().split(b"\n") if x is not None else []
                totals.append(len(parts))
                for n, p in enumerate(parts):
                    if _WORDY.search(p := p.strip()):
                        texts.append(p)
                        numbers.append(n)
                        classes.append(xxhash.xxh3_64_intdigest(p))
                ends.append(len(numbers))
            keys, starts = banded(texts, similarity)
            bands = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(keys, pa.int64()))
            each = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(np.array(classes, np.uint64).view(np.int64)), bands], ["line", "class", "bands"])
            yield pa.record_batch([b.column(0), b.column(1), pa.array(totals, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)], ["key", "doc_id", "n_lines", "lines"])

    return arrow_map(docs.select(_key(), F.col("doc_id").cast("bigint"), "text"), run, _FOUND)


def _key():
    """A document's identity: rows alike in doc_id and text are one document."""
    return F.xxhash64("doc_id", "text").alias("key")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, text) for the classes wanted, each from the document and line given with it."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("line", "class")).alias("want"))
    found = docs.select(_key(), "text").join(lists, "key")

    def run(batches):
        for b in batches:
            classes, texts = [], []
            for x, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts = x.encode().split(b"\n")
                for w in want:
                    classes.append(w["class"])
                    texts.append(normal(parts[w["line"]]))
            yield pa.record_batch([pa.array(classes, pa.int64()), pa.array(texts, pa.binary())], ["class", "text"])

    return arrow_map(found.select("text", "want"), run, "class bigint, text binary")


class Line:
    """A line's shingles, of both lengths if it may be part of short and of long pairs."""

    def __init__(self, text: bytes):
        self.chars = len(text) if text.isascii() else len(text.decode())
        self.short = shingles(text, SHORT_SHINGLE) if self.chars < LONG else None
        self._long, self._text = None, text

    @property
    def long(self) -> np.ndarray:
        if self._long is None:
            self._long = shingles(self._text, LONG_SHINGLE)
        return self._long

    def similar(self, other: Line, similarity: float) -> bool:
        a, b = (self.short, other.short) if self.short is not None and other.short is not None else (self.long, other.long)
        if not len(a) or min(len(a), len(b)) < similarity * max(len(a), len(b)):
            return False
        both = shared_by(a, b)
        return both >= similarity * (len(a) + len(b) - both)


class _Band:
    """Lines of one band. A line is compared with members of each group until one is similar: what a group connects is not compared again."""

    def __init__(self, similarity: float):
        self.similarity, self.sets = similarity, Sets()
        self.groups: list[list[tuple[int, Line]]] = []

    def add(self, cls: int, text: bytes) -> None:
        own = Line(text)
        same = []
        for i, g in enumerate(self.groups):
            for other, theirs in reversed(g):
                if other == cls:
                    return
                if own.similar(theirs, self.similarity):
                    self.sets.join(cls, other)
                    same.append(i)
                    break
        joined = [(cls, own)]
        for i in reversed(same):
            joined = self.groups.pop(i) + joined
        self.groups.append(joined)

    def links(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.sets.parent) if (r := self.sets.root(x)) != x]


def first_met(band: np.ndarray, cut: np.ndarray, start: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Which lines meet someone in a band for the first time. Lines of one (band, part) lie side by side: cut says where each such group begins, and the last one ends.

    band: each line's; bands: the bands of all lines in a row, start: where each line's begin. Two lines that share a band before this one are compared in that one.
    """
    out = np.zeros(len(band), bool)
    size = np.diff(cut)

    def own(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ten bands of each line among which its band is, and its place there: those among short lines, or among long ones."""
        first = bands[start[rows][:, None] + np.arange(BANDS)]
        there = first == band[rows][:, None]
        late = np.flatnonzero(~there.any(axis=1))
        if len(late):
            first[late] = bands[start[rows[late]][:, None] + BANDS + np.arange(BANDS)]
            there[late] = first[late] == band[rows[late]][:, None]
        return first, there.argmax(axis=1)

    two = cut[:-1][size == 2]
    if len(two):
        (a, place), (b, _) = own(two), own(two + 1)
        new = ~((a == b) & (np.arange(BANDS) < place[:, None])).any(axis=1)
        out[two] = out[two + 1] = new
    for at, n in zip(cut[:-1][size > 2], size[size > 2], strict=True):
        rows = np.arange(at, at + n)
        mine, places = own(rows)
        met = np.eye(n, dtype=bool)
        for k in range(int(places[0])):
            met |= mine[:, k][:, None] == mine[:, k][None, :]
        out[rows] = ~met.all(axis=1)
    return out


def _fresh(rows: DataFrame) -> DataFrame:
    """rows: (band, a, b, class, bands) clustered and sorted by the first three. (band, a, b, class) of those that meet someone there for the first time."""

    def of(batch: pa.RecordBatch, whole: bool) -> tuple[pa.RecordBatch | None, pa.RecordBatch]:
        """What is found in all groups, or in all but the last one, which may go on; and that one."""
        band, a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cut = np.concatenate(([0], np.flatnonzero((band[1:] != band[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1, [len(band)]))
        cut = cut if whole else cut[:-1]
        lists = batch.column(4)
        start = lists.offsets.to_numpy()[:-1].astype(np.int64)
        keep = first_met(band[: cut[-1]], cut, start, lists.values.to_numpy(zero_copy_only=False))
        found = batch.slice(0, int(cut[-1])).filter(pa.array(keep)).select(["band", "a", "b", "class"]) if keep.any() else None
        return found, batch.slice(int(cut[-1]))

    def run(batches):
        rest = None
        for batch in batches:
            if batch.num_rows:
                found, rest = of(batch if rest is None or not rest.num_rows else pa.concat_batches([rest, batch]), False)
                if found is not None:
                    yield found
        if rest is not None and rest.num_rows and (found := of(rest, True)[0]) is not None:
            yield found

    return arrow_map(rows, run, "band bigint, a int, b int, class bigint")


def _verified(rows: DataFrame, similarity: float) -> DataFrame:
    """rows: (band, a, b, class, text) clustered and sorted by the first three. (u, v): similar lines, at most one link for each."""

    def run(batches):
        band, key = _Band(similarity), None

        def out(found):
            u, v = zip(*found, strict=True)
            return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for b in batches:
            found = []
            for k1, k2, k3, cls, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (now := (k1, k2, k3)) != key:
                    found += band.links()
                    band, key = _Band(similarity), now
                band.add(cls, text)
            if found:
                yield out(found)
        if found := band.links():
            yield out(found)

    return arrow_map(rows, run, "u bigint, v bigint")


def duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """What was scanned, and (key, removed): for each document with duplicate lines their numbers, from 0.

    Of the lines that equal and similar ones connect, the first stays, in the order of doc_id
    (null last), line and document key.
    """
    fat = durable(_scanned(docs, similarity))
    lines = fat.select("key", "doc_id", F.inline("lines"))
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "line", "key")
    banded = durable(lines.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")))
    scanned = durable(fat.withColumn("lines", F.expr("transform(lines, x -> named_struct('line', x.line, 'class', x.class))")))
    release(fat)
    dealt = banded.select(F.explode("bands").alias("band"), "class")
    # a crowded band is cut into parts before its lines come together, and each two parts meet in a task of their own
    crowded = durable(dealt.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("band", F.ceil(F.col("n") / CROWD).cast("int").alias("parts")))
    parted = dealt.join(crowded, "band", "left").withColumn("own", F.pmod(F.xxhash64("class"), F.coalesce("parts", F.lit(1))).cast("int"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("band", "own")) == 1
    shared = durable(parted.repartition("band", "own").withColumn("alone", alone).where("parts is not null or not alone").drop("alone"))
    release()
    met = (
        shared.join(banded.select("class", "bands"), "class")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .select("band", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "class", "bands")
    )
    fresh = durable(_fresh(met.repartition("band", "a", "b").sortWithinPartitions("band", "a", "b", "class")))
    classes = durable(banded.drop("bands"))
    release(shared, banded, crowded)
    wanted = fresh.select("class").distinct().join(classes.select("class", F.col("first.key").alias("key"), F.col("first.line").alias("line")), "class")
    texts = durable(_texts(docs, wanted).dropDuplicates(["class"]))
    rows = fresh.join(texts, "class").repartition("band", "a", "b").sortWithinPartitions("band", "a", "b", "class").select("band", "a", "b", "class", "text")
    found = durable(_verified(rows, similarity))
    release(fresh, texts)
    roots = components(found)
    of = classes.select("class", "first", "n").join(roots, F.col("class") == F.col("node"), "left").select("class", "first", "n", "root").where("n > 1 or root is not null")
    of = durable(of.withColumn("root", F.coalesce("root", "class")))
    stays = of.groupBy("root").agg(F.min("first").alias("stays"))
    verdict = of.join(stays, "root").select("class", "stays")
    removed = (
        scanned.select("key", F.inline("lines"))
        .join(verdict, "class")
        .where(~((F.col("stays.key") == F.col("key")) & (F.col("stays.line") == F.col("line"))))
        .select("key", "line")
        .distinct()
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("line")).alias("removed"))
    )
    out = durable(removed)
    release(classes, of, found)
    return scanned, out


def line_report(docs: DataFrame, **rule) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed), a row for each row of docs; removed: numbers of duplicate lines, from 0.

    A null text has no lines, an empty one has one. A very long text is held by one task. Rows alike in doc_id and text are one document and judged alike; rows with the same doc_id and
    other texts are documents of their own. An empty table gives an empty result; further columns
    are ignored.
    """
    scanned, removed = duplicates(docs, **rule)
    none = F.array().cast("array<int>")
    return scanned.select("key", "doc_id", F.col("n_lines").cast("bigint")).join(removed, "key", "left").select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("removed", none).alias("removed"))


def drop_lines(docs: DataFrame, **rule) -> DataFrame:
    """docs with duplicate lines taken out of the texts; documents of which nothing but white space is left go.

    All other columns stay as they are, n_chars, if there is one, follows the text. Documents
    without a duplicate line stay untouched, empty ones too.
    """
    _, removed = duplicates(docs, **rule)
    names = docs.columns
    key, gone = spare("__key", names), spare("__removed", names)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number given stays: whole texts are not put together to few large tasks
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).repartition(parts, key).join(removed.select(F.col("key").alias(key), F.col("removed").alias(gone)), key, "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    new = F.when(F.col(gone).isNull(), F.col("text")).otherwise(left)
    out = joined.withColumn("text", new).where(F.col(gone).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in names])
