"""Packing documents into token sequences by length patterns.

Only the histogram of piece lengths reaches the driver: as many numbers as a sequence has tokens,
whatever the corpus. The driver fits pattern counts to it and returns a table of places; every
piece finds its own by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import HASHES, arrow_map, durable, hash_order, ranked, repeated
from tesserae.llm.encode import word_ids

LIMIT = 2048
#: Patterns to fit: into how many classes lengths are put, and how many pieces a pattern has at most. The fit with the fewest sequences stays.
GRAINS = ((64, 5), (128, 3))
#: Tokens that a pattern made of exact lengths may leave free; a pattern that would leave more is left to the residual packing.
SLACK = 2
#: Weight of the shortest eighth of the classes in the fit: they fill gaps afterwards.
SHORT = 0.1
ROWS_PER_BUCKET = 4096


def patterns(classes: int, pieces: int) -> np.ndarray:
    """A column for each multiset of 2 to ``pieces`` length classes that fills a sequence, rows are classes."""
    found = []

    def extend(head: tuple[int, ...], left: int, k: int) -> None:
        if k == 1:
            if head[-1] <= left <= classes:
                found.append((*head, left))
            return
        for c in range(head[-1] if head else 1, left // k + 1):
            extend((*head, c), left - c, k - 1)

    for k in range(2, pieces + 1):
        extend((), classes + k // 2, k)  # a piece is half a class below its class's upper end on average
    a = np.zeros((classes, len(found)))
    for j, p in enumerate(found):
        for c in p:
            a[c - 1, j] += 1
    return a


def nonnegative(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """argmin |a x - b| with x >= 0, by an active set (Lawson and Hanson)."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, np.abs(b).max())
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[on] = -np.inf
        j = int(gain.argmax())
        if gain[j] <= 1e-7 * scale:
            break
        on[j] = True
        while True:
            s = np.zeros_like(x)
            s[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if s[on].min() > 0:
                break
            low = on & (s <= 0)
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x += step * (s - x)
            on &= x > 1e-12 * scale
            x[~on] = 0
            if not on.any():
                break
        x = s if on.any() else np.zeros_like(x)
    return x


class Places:
    """What the driver hands out: rows (length, first rank, first sequence, offset), each for a run of ranks and sequences."""

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.copy()
        self.taken = np.zeros_like(histogram)
        self.sequences = self.whole = self.fitted = 0  # all; those of one piece that fills them; those that begin as a pattern
        self.rows: list[tuple[int, int, int, int]] = []
        self.open: list[list[tuple[int, int]]] = [[] for _ in histogram]  # by free tokens: (first sequence, how many)
        self.free = np.zeros(len(histogram), np.int64)

    def put(self, length: int, first: int, n: int, offset: int) -> None:
        self.rows.append((length, int(self.taken[length]), first, offset))
        self.taken[length] += n
        self.left[length] -= n

    def new(self, lengths: list[int], n: int) -> None:
        """n new sequences that begin with these pieces."""
        offset = 0
        for x in lengths:
            self.put(x, self.sequences, n, offset)
            offset += x
        self.gap(len(self.left) - 1 - offset, self.sequences, n)
        self.sequences += n

    def gap(self, size: int, first: int, n: int) -> None:
        self.open[size].append((first, n))
        self.free[size] = 1

    def fill(self, length: int) -> bool:
        """Pieces of a length into the sequences with the smallest gap that holds one; False if there is none."""
        found = np.flatnonzero(self.free[length:])
        if not len(found):
            return False
        size = length + int(found[0])
        first, n = self.open[size].pop()
        self.free[size] = bool(self.open[size])
        m = min(n, int(self.left[length]))
        self.put(length, first, m, len(self.left) - 1 - size)
        self.gap(size - length, first, m)
        if n > m:
            self.gap(size, first + m, n - m)
        return True


def _exact(left: np.ndarray, members: list[int], width: int, slack: int) -> list[int] | None:
    """Lengths there are for a pattern of classes, longest first: the most frequent ones, and a last pair that fills the sequence up to slack."""
    room, spare, chosen = len(left) - 1, left.copy(), []
    for c in members[:-2]:
        low = (c - 1) * width + 1
        part = spare[low : min(c * width, room) + 1]
        if not len(part) or not part.any():
            return None
        chosen.append(low + int(part.argmax()))
        spare[chosen[-1]] -= 1
        room -= chosen[-1]
    a = np.arange((members[-2] - 1) * width + 1, min(members[-2] * width, room - 1) + 1)
    a = a[spare[a] > 0] if len(a) else a
    for free in range(slack + 1):
        x = a[a < room - free]
        y = room - free - x
        n = np.where(x == y, spare[x] // 2, np.minimum(spare[x], spare[y]))
        if len(n) and n.max() > 0:
            k = int(n.argmax())
            return [*chosen, int(x[k]), int(y[k])]
    return None


def _planned(histogram: np.ndarray, classes: int, pieces: int, slack: int) -> Places:
    limit = len(histogram) - 1
    h = Places(histogram.astype(np.int64))
    if h.left[limit]:
        h.new([limit], int(h.left[limit]))
    h.whole = h.sequences
    width = -(-limit // classes)
    of = -(-np.arange(limit + 1) // width)  # class of a length, from 1
    a = patterns(classes, pieces)
    counts = np.bincount(of, weights=h.left, minlength=classes + 1)[1 : classes + 1]
    weight = np.where(np.arange(1, classes + 1) * 8 <= classes, SHORT, 1.0)
    x = nonnegative(a * weight[:, None], counts * weight) if counts.any() else np.zeros(a.shape[1])
    for j in np.lexsort((np.arange(len(x)), -x)):
        want = int(np.floor(x[j] + 0.5))
        if not want:
            break
        members = [c + 1 for c in np.flatnonzero(a[:, j]) for _ in range(int(a[c, j]))][::-1]
        while want > 0 and (chosen := _exact(h.left, members, width, slack)):
            n = min(want, *(int(h.left[c]) // chosen.count(c) for c in chosen))
            if n < 1:  # a length is wanted more often than it is there
                break
            h.new(chosen, n)
            want -= n
    h.fitted = h.sequences - h.whole
    for length in range(limit, 0, -1):
        while h.left[length]:
            if not h.fill(length):
                each = limit // length
                n = int(h.left[length])
                if n >= each:
                    h.new([length] * each, n // each)
                else:
                    h.new([length] * n, 1)
    return h


def planned(histogram: np.ndarray, grains: tuple[tuple[int, int], ...] = GRAINS, slack: int = SLACK) -> Places:
    """histogram[l]: how many pieces have l tokens, l up to the sequence length.

    Patterns of length classes are fitted to the classes' counts by non-negative least squares;
    their rounded counts are made of exact lengths, whose last pair is chosen so that the sequence
    is full. What is left over is packed best-fit decreasing, first into the gaps. Each step uses
    up a length or a pattern, so the table's size depends on the sequence length only.
    """
    return min((_planned(histogram, *g, slack) for g in grains), key=lambda h: h.sequences)


def plan(histogram: np.ndarray, **how) -> tuple[list[tuple[int, int, int, int]], int]:
    """The places, and how many sequences they take."""
    best = planned(histogram, **how)
    return best.rows, best.sequences


def pieces_of(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row's ids followed by ``end``, cut every ``limit`` ids."""

    def run(batches):
        tail = np.array([end], "<u4").tobytes()
        for b in batches:
            rows = []
            ids = word_ids([x or "" for x in b.column(1).to_pylist()], vocabulary)
            for key, x in zip(b.column(0).to_pylist(), ids, strict=True):
                x += tail
                for p, s in enumerate(range(0, len(x), 4 * limit)):
                    cut = x[s : s + 4 * limit]
                    rows.append((key, p, s // 4, len(cut) // 4, zlib.crc32(cut)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(docs: DataFrame, vocabulary: str, limit: int = LIMIT, seed: int = 5) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): a row for each piece of each row of docs.

    A null or empty text is the end id alone. Repeated rows are packed one by one. Pieces of a
    length are numbered in the order of a hash of what they are; pieces alike in all columns are
    interchangeable, and numbered as one with their number, so that copies crowd no bucket. An empty table gives an empty result; columns beyond doc_id and text are ignored.
    """
    pieces = durable(pieces_of(docs, vocabulary, limit))
    histogram = np.zeros(limit + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``limit`` rows
        histogram[length] = n
    rows, _ = plan(histogram)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)

    def run(batches):
        key = table[:, 0] * (1 << 44) + table[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("at").to_numpy()
            at = np.searchsorted(key, length * (1 << 44) + rank, "right") - 1
            yield pa.record_batch([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    buckets = max(1, -(-int(histogram.sum()) // ROWS_PER_BUCKET))
    alike = durable(pieces.groupBy(*pieces.columns).agg(F.count(F.lit(1)).alias("m")).withColumn("h", hash_order("doc_id", "piece", "ids_crc32", seed=seed)))
    most = alike.agg(F.max("m")).first()[0] or 0
    first = ranked(alike, ["length"], F.expr(f"h div {-(-HASHES // buckets)}"), ["h", "doc_id", "piece", "ids_crc32"], "m", "first")
    numbered = repeated(first, "m", "copy", ["doc_id", "piece", "ids_crc32"], most, ROWS_PER_BUCKET).withColumn("at", F.col("first") + F.col("copy"))
    return arrow_map(numbered, run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
