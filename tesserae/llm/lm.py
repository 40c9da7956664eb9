"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(group | class, history) * P(word | group). The class
comes from a softmax over hashed features of the history: the word before, the pair before, and the
words two and three places before (skips). A second softmax with features of its own, each hashed
together with the class, tells the groups of a class of frequent words apart: a common word is a
group of its own, others share theirs. Within its group a word has its smoothed share of the counts.
Classes are clusters of words by their neighbours, split by frequency; rare words join the cluster
that their spelling resembles and are one group there.

The frequent words, at most FREQUENT of them, travel with the tasks. Counts of all other words
stay distributed: a text's rare words are joined to them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, least_count, release

#: Words known to every task; words that are features of their own; words whose neighbours make the clusters, and neighbours counted.
FREQUENT, FEATURES, CLUSTERED, NEIGHBOURS = 131_072, 8_192, 2_048, 256
CLUSTERS, PAIRS = 8, 1 << 14
#: Of each cluster two classes of frequent words with half its mass each, and one of rare words; then the end of a text.
CLASSES = 3 * CLUSTERS + 1
END = CLASSES - 1
#: Groups of a class; buckets of their features.
GROUPS, FINE = CLASSES, 1 << 16
ROUNDS, RATE, BATCH = 2, 0.3, 8192
#: Tasks whose sums are added first: FAN rows of some 100 kB come together, then of 800,000 tasks 1,600.
FAN = 512
#: Tokens of a task that sends sums, at least.
MANY = 1 << 22
#: A feature for each word that is one, for each class, and for the text's beginning.
WORDS = FEATURES + CLASSES + 1
COARSE = 3 * WORDS + PAIRS
ROWS = COARSE + FINE


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, in ASCII lower case, split at ASCII white space; and where each text's begin and the last one's end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    filled = pc.binary_length(flat).to_numpy() > 0
    if not filled.all():
        offsets = np.concatenate(([0], np.cumsum(filled)))[offsets]
        flat = flat.filter(pa.array(filled))
    return flat, offsets


def _chunks(a: np.ndarray, rows: int = 1024) -> pa.RecordBatch:
    """Rows of a that have something, by blocks of rows: their places in the block, and what they have."""
    out = []
    for k in range(0, len(a), rows):
        block = a[k : k + rows]
        at = np.flatnonzero(block.any(axis=1)).astype("<u2")
        if len(at):
            out.append((k // rows, at.tobytes(), block[at].tobytes()))
    return pa.record_batch([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], ["chunk", "rows", "data"])


def _gathered(train: DataFrame, tokens: int) -> DataFrame:
    """train in no more tasks than one for MANY tokens each: every task sends sums of a fixed size, so they follow the input."""
    return train.coalesce(max(1, tokens // MANY))


def _summed(df: DataFrame, arrays, shape: tuple[int, int], dtype: str) -> np.ndarray:
    """The sum over all tasks of the arrays that ``arrays(batches)`` gives, of a fixed shape: added up in two levels of tasks."""
    width = shape[1]

    def emit(batches):
        total = arrays(batches)
        if total is not None:
            yield _chunks(total)

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros((1024, width), dtype)
        for rows, x in zip(t.column("rows"), t.column("data"), strict=True):
            total[np.frombuffer(rows.as_py(), "<u2")] += np.frombuffer(x.as_py(), dtype).reshape(-1, width)
        out = _chunks(total).to_pydict()
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()] * len(out["chunk"]), pa.int32()), "rows": pa.array(out["rows"], pa.binary()), "data": pa.array(out["data"], pa.binary())})

    schema = "chunk int, rows binary, data binary"
    rows = arrow_map(df, emit, schema)
    some = rows.withColumn("part", F.floor(F.spark_partition_id() / F.lit(FAN))).groupBy("chunk", "part").applyInArrow(add, schema)
    out = np.zeros(shape, dtype)
    for r in some.groupBy("chunk").applyInArrow(add, schema).collect():  # as many bytes as the shape has
        out[r["chunk"] * 1024 + np.frombuffer(r["rows"], "<u2").astype(np.int64)] = np.frombuffer(r["data"], dtype).reshape(-1, width)
    return out


@dataclass
class Vocabulary:
    """Frequent words by rank, and their classes; how rare words get theirs."""

    words: list[bytes]
    counts: np.ndarray  # of the frequent words
    classes: np.ndarray  # of the frequent words
    groups: np.ndarray  # of the frequent words, within their classes
    spelling: np.ndarray  # (65536, clusters): log-likelihood of two bytes in a row

    def ranks(self) -> pa.Array:
        """The frequent words, to look up a word's rank in."""
        return pa.array([w.decode() for w in self.words], pa.string())

    def rare(self, words: list[bytes]) -> np.ndarray:
        """The classes of words beyond the frequent ones, from their letters."""
        if not words:
            return np.zeros(0, np.int64)
        return 3 * spelled(words, self.spelling) + 2


def _bigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two bytes in a row of each word with its ends marked, and where each word's begin."""
    joined = np.frombuffer(b"".join([b" " + w + b" " for w in words]), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    pairs = joined[:-1] * 256 + joined[1:]
    keep = np.ones(len(pairs), bool)
    keep[ends[:-1] - 1] = False
    return pairs[keep], np.concatenate(([0], np.cumsum(lengths - 1)[:-1]))


def spelled(words: list[bytes], table: np.ndarray) -> np.ndarray:
    out = []
    for k in range(0, len(words), 20_000):
        pairs, starts = _bigrams(words[k : k + 20_000])
        out.append(np.add.reduceat(table[pairs], starts, axis=0).argmax(axis=1))
    return np.concatenate(out)


def clusters(near: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """Spherical k-means of rows of positive pointwise mutual information; begins with the farthest points, so it has no luck."""
    total = near.sum()
    if not total:
        return np.zeros(len(near), np.int64)
    expected = near.sum(1, keepdims=True) * near.sum(0, keepdims=True) / total
    x = np.log(np.maximum(near, 1e-9) / np.maximum(expected, 1e-9)).clip(0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = [x[0]]
    for _ in range(1, k):
        closest = np.max(x[: max(k, len(x) // 4)] @ np.array(centres).T, axis=1)
        centres.append(x[int(closest.argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        of = (x @ c.T).argmax(1)
        c = np.array([x[of == j].sum(0) if (of == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return (x @ c.T).argmax(1)


def _counted(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts; the end of a text is a blank, which no word is."""

    def run(batches):
        held, size, ends = [], 0, 0

        def out():
            found = pc.value_counts(split(pa.concat_arrays(held))[0])
            return pa.record_batch([found.field("values").cast(pa.binary()), found.field("counts")], ["word", "n"])

        for b in batches:
            held.append(b.column(0))
            size += b.column(0).nbytes
            ends += b.num_rows
            if size > 1 << 25:
                yield out()
                held, size = [], 0
        if held:
            yield out()
        if ends:
            yield pa.record_batch([pa.array([b" "], pa.binary()), pa.array([ends], pa.int64())], ["word", "n"])

    return arrow_map(train.select("text"), run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _neighbours(train: DataFrame, words: list[bytes]) -> np.ndarray:
    """How often each of the first CLUSTERED words has each of the first NEIGHBOURS words beside it."""
    known = [w.decode() for w in words[:CLUSTERED]]

    def arrays(batches):
        total = None
        values = pa.array(known, pa.string())
        for b in batches:
            flat, offsets = split(b.column(0))
            r = pc.fill_null(pc.index_in(flat, value_set=values), -1).to_numpy().astype(np.int64)
            if len(r) < 2:
                continue
            ends = offsets[1:-1]
            apart = np.zeros(len(r) - 1, bool)
            apart[ends[(ends > 0) & (ends < len(r))] - 1] = True  # words of two texts are no neighbours
            total = np.zeros(CLUSTERED * NEIGHBOURS, np.int64) if total is None else total
            for a, c in ((r[1:], r[:-1]), (r[:-1], r[1:])):
                ok = (a >= 0) & (c >= 0) & (c < NEIGHBOURS) & ~apart
                total += np.bincount(a[ok] * NEIGHBOURS + c[ok], minlength=len(total))
        return None if total is None else total.reshape(CLUSTERED, NEIGHBOURS)

    return _summed(train.select("text"), arrays, (CLUSTERED, NEIGHBOURS), "<i8")


def grouped(n: np.ndarray, most: int) -> np.ndarray:
    """Groups of words with counts n, the most frequent first: each takes words until it has an equal share of what is left."""
    out, left, group, held = np.zeros(len(n), np.int64), float(n.sum()), 0, 0.0
    for k, x in enumerate(n.tolist()):
        if held and group < most - 1 and held >= (left + held) / (most - group):
            group, held = group + 1, 0.0
        out[k] = group
        held += x
        left -= x
    return out


def vocabulary(train: DataFrame, counts: DataFrame) -> Vocabulary:
    least = least_count(counts.where("word <> X'20'"), FREQUENT)
    top = sorted(counts.where(f"word <> X'20' and n >= {least}").collect(), key=lambda r: (-r["n"], r["word"]))  # at most FREQUENT
    words = [bytes(r["word"]) for r in top]
    n = np.array([r["n"] for r in top], np.int64)
    of_top = clusters(_neighbours(train, words)[: len(words)].astype(float), CLUSTERS)[: len(words)] if words else np.zeros(0, np.int64)
    table = np.full((65_536, CLUSTERS), 0.5)
    if words:
        first = words[:CLUSTERED]
        pairs, starts = _bigrams(first)
        lengths = np.diff(np.concatenate((starts, [len(pairs)])))
        np.add.at(table, (pairs, np.repeat(of_top[: len(first)], lengths)), 1.0)
    spelling = np.log(table / table.sum(0, keepdims=True)).astype(np.float32)
    group = np.concatenate((of_top[:CLUSTERED], spelled(words[CLUSTERED:], spelling))) if len(words) > CLUSTERED else of_top
    classes, groups = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for g in range(CLUSTERS):
        own = np.flatnonzero(group == g)
        mass = np.cumsum(n[own])
        classes[own] = 3 * g + (mass > mass[-1] / 2) if len(own) else 0
    for c in range(CLASSES):
        own = np.flatnonzero(classes == c)
        groups[own] = grouped(n[own], GROUPS)
    return Vocabulary(words, n, classes, groups, spelling)


@dataclass
class Encoded:
    """Texts of a batch in one row, each followed by its end."""

    classes: np.ndarray
    features: np.ndarray  # (tokens, 4) rows of the weight table
    split: np.ndarray  # the tokens whose class has groups
    groups: np.ndarray  # of those tokens
    fine: np.ndarray  # of those tokens: (tokens, 3) rows of the weight table
    ranks: np.ndarray  # -1: rare, -2: end
    starts: np.ndarray
    rare: list[list[bytes]]


def _buckets(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[-1]), np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(33)).astype(np.int64) % FINE


def encode(texts, v: Vocabulary, ranks: pa.Array) -> Encoded:
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    flat, offsets = split(texts)
    lengths = np.diff(offsets) + 1
    ends = np.cumsum(lengths)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    total = int(lengths.sum())
    rank = np.full(total, -2, np.int64)
    inner = np.ones(total, bool)
    inner[ends - 1] = False
    rank[inner] = pc.fill_null(pc.index_in(flat, value_set=ranks), -1).to_numpy()
    where = np.flatnonzero(rank == -1)
    number = np.searchsorted(ends, where, "right")  # of the text; a word's place among all words is less by it
    unknown = [w.encode() for w in flat.take(pa.array(where - number)).to_pylist()]
    cuts = np.searchsorted(number, np.arange(len(texts) + 1)).tolist()
    rare = [unknown[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    cls = np.full(total, END, np.int64)
    known = rank >= 0
    cls[known] = v.classes[rank[known]]
    if unknown:
        distinct = {w: k for k, w in enumerate(dict.fromkeys(unknown))}
        cls[where] = v.rare(list(distinct))[np.fromiter(map(distinct.__getitem__, unknown), np.int64, len(unknown))]
    word = np.where(known & (rank < FEATURES), rank, FEATURES + cls)
    begin = WORDS - 1
    inside = np.arange(total) - np.repeat(starts, lengths)

    def back(a, k, first):
        x = np.full(total, first, np.int64)
        x[k:] = a[:-k] if k < total else a[:0]
        x[inside < k] = first
        return x

    before = [back(word, k, begin) for k in (1, 2, 3)]
    pair = ((before[0] * 0x9E3779B1 + before[1] * 0x85EBCA77) >> 7) % PAIRS
    features = np.stack([before[0], before[1] + WORDS, before[2] + 2 * WORDS, pair + 3 * WORDS]).T  # a feature's rows side by side
    at = np.flatnonzero(known)
    name = np.where(known, rank, len(v.words) + cls)  # every frequent word is a feature here
    one, two = (back(name, k, len(v.words) + CLASSES)[at] for k in (1, 2))
    own = cls[at]
    kind = lambda j: np.full(len(at), j, np.int64)
    fine = COARSE + np.stack([_buckets(kind(1), own, one), _buckets(kind(2), own, two), _buckets(kind(3), own, one, two)]).T
    return Encoded(cls, features, at, v.groups[rank[at]], fine, rank, starts, rare)


def _raised(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of each token, their exponentials, and the sums of these; shifted by each row's largest where they may leave the range of a float."""
    z = weights.take(features[:, 0], axis=0)
    for j in range(1, features.shape[1]):
        z += weights.take(features[:, j], axis=0)
    z += bias
    e = np.exp(np.minimum(z, 60))
    total = e @ np.ones(z.shape[1], z.dtype)
    odd = np.flatnonzero((total > 1e25) | (total < 1e-25))
    if len(odd):
        z[odd] -= z[odd].max(axis=1, keepdims=True)
        e[odd] = np.exp(z[odd])
        total[odd] = e[odd].sum(axis=1)
    return z, e, total


def log_softmax(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    z, _, total = _raised(weights, bias, features)
    return z - np.log(total)[:, None]


def log_chosen(weights: np.ndarray, bias: np.ndarray, features: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """log_softmax of one choice for each token."""
    z, _, total = _raised(weights, bias, features)
    return z[np.arange(len(chosen)), chosen] - np.log(total)


def _descend(weights: np.ndarray, squares: np.ndarray, seen: np.ndarray, bias: np.ndarray, features: np.ndarray, chosen: np.ndarray) -> None:
    """One adaptive gradient step for each so many tokens. bias: of all tokens, or a row for each."""
    for s in range(0, len(chosen), BATCH):
        f, c = features[s : s + BATCH], chosen[s : s + BATCH]
        _, g, total = _raised(weights, bias if bias.ndim == 1 else bias[s : s + BATCH], f)
        g /= total[:, None]
        g[np.arange(len(c)), c] -= 1
        place = np.arange(len(c))
        for j in range(f.shape[1]):
            both = f[:, j] * BATCH + place  # sorted as one number, tokens of a row stay in their order
            both.sort()
            ordered = both // BATCH
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            rows = ordered[first]
            d = np.add.reduceat(g.take(both % BATCH, axis=0), first, axis=0)
            n = np.diff(np.append(first, len(both)))
            d /= np.sqrt(n, dtype=np.float32)[:, None]  # frequent rows have many tokens in one step
            sq = squares.take(rows, axis=0)
            sq += d * d
            squares[rows] = sq
            np.sqrt(sq, out=sq)
            d *= RATE
            d /= sq
            weights[rows] -= d
            seen[rows] += n


def train_weights(train: DataFrame, v: Vocabulary, bias: np.ndarray, group_bias: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Each round takes the training texts of one hash slice: every task goes down the gradient from the weights it is given; a row's steps are averaged over the tasks, weighted by the tokens that used it."""
    weights = np.zeros((ROWS, CLASSES), np.float32)
    for r in range(rounds):
        given = weights

        def arrays(batches, given=given):
            own, squares, seen = given.copy(), np.ones_like(given), np.zeros(ROWS, np.float32)
            ranks = v.ranks()
            any_rows = False
            for b in batches:
                any_rows = any_rows or b.num_rows > 0
                for k in range(0, b.num_rows, 500):
                    e = encode(b.column(0).slice(k, 500), v, ranks)
                    _descend(own, squares, seen, bias, e.features, e.classes)
                    _descend(own, squares, seen, group_bias[e.classes[e.split]], e.fine, e.groups)
            if not any_rows:
                return None
            return np.concatenate(((own - given) * seen[:, None], seen[:, None]), axis=1).astype("<f4")

        part = train.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds)) == r).select("text")
        total = _summed(part, arrays, (ROWS, CLASSES + 1), "<f4")
        weights = weights + total[:, :-1] / np.maximum(total[:, -1:], 1)
    return weights.astype(np.float32)


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: np.ndarray
    group_bias: np.ndarray  # (classes, groups)
    log_mass: np.ndarray  # (classes, groups): log10 of each group's smoothed mass
    n: int
    distinct: int
    ends: int


def _masses(counts: DataFrame, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Each group's tokens and distinct words, both (classes, groups), and (h, n) of the rare words."""
    top = v.words
    own = set(top)

    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            keep = [k for k, w in enumerate(words) if w not in own and w != b" "]
            left = [words[k] for k in keep]
            n = b.column(1).take(pa.array(keep, pa.int64()))
            yield pa.record_batch([pa.array(np.array([xxhash.xxh64_intdigest(w, 42) for w in left], np.uint64).view(np.int64)), n, pa.array(v.rare(left), pa.int32())], ["h", "n", "class"])

    rare = durable(arrow_map(counts, run, "h bigint, n bigint, class int"))
    tokens, kinds = np.zeros((CLASSES, GROUPS)), np.zeros((CLASSES, GROUPS))
    for r in rare.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():  # CLASSES rows
        tokens[r["class"], 0] += r["n"]
        kinds[r["class"], 0] += r["k"]
    np.add.at(tokens, (v.classes, v.groups), v.counts)
    np.add.at(kinds, (v.classes, v.groups), 1)
    return tokens, kinds, rare


def fit(docs: DataFrame, remainder: int = 2, folds: int = 7) -> tuple[Model, DataFrame]:
    """The model of the texts whose crc32(doc_id) mod folds is not remainder, and the counts of its rare words."""
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    train = docs.select("doc_id", "text").where(F.coalesce(own != remainder, F.lit(True)))
    counts = durable(_counted(train))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.when(F.col("word") == F.expr("X'20'"), F.col("n"))).alias("ends")).first()
    train = _gathered(train, total["n"] or 0)
    v = vocabulary(train, counts)
    tokens, kinds, rare = _masses(counts, v)
    release(counts)
    ends = total["ends"] or 0
    tokens[END, 0], kinds[END, 0] = ends, 1
    masses = tokens + kinds
    # a rare class holds one word never seen, too; classes without words have only that share
    masses[(np.arange(CLASSES) % 3 == 2) & (np.arange(CLASSES) != END), 0] += 1
    mass = masses.sum(axis=1)
    bias = np.log(np.maximum(mass, 1e-3) / max(mass.sum(), 1)).astype(np.float32)
    # groups without words are never chosen
    group_bias = np.where(masses > 0, np.log(np.maximum(masses, 1e-3) / np.maximum(mass, 1)[:, None]), -1e9).astype(np.float32)
    weights = train_weights(train, v, bias, group_bias) if total["n"] else np.zeros((ROWS, CLASSES), np.float32)
    return Model(v, weights, bias, group_bias, np.log10(np.maximum(masses, 1.0)), total["n"] or 0, total["k"] or 0, ends), rare


def scored(docs: DataFrame, model: Model, counts: DataFrame, remainder: int = 2, folds: int = 7) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of docs.

    A null text is an empty one: its end alone. A row without doc_id is not held out. Repeated rows
    score alike, an empty table gives an empty result, further columns are ignored. Word hashes
    have 64 bits.
    """
    v, n, distinct = model.vocabulary, model.n, model.distinct
    unit = float(np.log10(n + distinct + 1))
    logs = np.log10(v.counts + 1.0)
    end = float(np.log10(model.ends + 1.0))
    weights, bias, group_bias, log_mass = model.weights, model.bias, model.group_bias, model.log_mass

    def run(batches):
        ranks = v.ranks()
        for b in batches:
            for k in range(0, b.num_rows, 500):
                e = encode(b.column(1).slice(k, 500), v, ranks)
                gain = np.empty(len(e.classes))
                for s in range(0, len(gain), BATCH):
                    f, c = e.features[s : s + BATCH], e.classes[s : s + BATCH]
                    gain[s : s + BATCH] = log_chosen(weights, bias, f, c) / np.log(10) - log_mass[c, 0]
                for s in range(0, len(e.split), BATCH):
                    at, g = e.split[s : s + BATCH], e.groups[s : s + BATCH]
                    c = e.classes[at]
                    gain[at] += log_chosen(weights, group_bias[c], e.fine[s : s + BATCH], g) / np.log(10) + log_mass[c, 0] - log_mass[c, g]
                known = np.full(len(gain), end)
                known[e.ranks == -1] = 0
                at = e.ranks >= 0
                known[at] = logs[e.ranks[at]]
                tokens = np.diff(np.append(e.starts, len(gain)))
                rare = [Counter(ws) for ws in e.rare]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum([len(c) for c in rare]))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(np.array([xxhash.xxh64_intdigest(w, 42) for c in rare for w in c], np.uint64).view(np.int64)), pa.array([x for c in rare for x in c.values()], pa.int32())], ["h", "n"]),
                )
                seen = (e.ranks != -1).astype(np.int64)
                if not model.ends:
                    seen[e.ranks == -2] = 0
                yield pa.record_batch(
                    [b.column(0).slice(k, 500), pa.array(tokens, pa.int64()), pa.array(np.add.reduceat(seen, e.starts), pa.int64()), pa.array(np.add.reduceat(known, e.starts)), pa.array(np.add.reduceat(gain, e.starts)), lists],
                    ["doc_id", "n_tokens", "frequent", "known", "gain", "rare"],
                )

    local = arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, n_tokens bigint, frequent bigint, known double, gain double, rare array<struct<h:bigint,n:int>>")
    rows = durable(local.withColumn("row", F.monotonically_increasing_id()))  # written, so that the numbers stay
    found = rows.select("row", F.inline("rare")).join(counts.select("h", F.col("n").alias("c")), "h")
    sums = found.groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    base = F.col("known") + F.coalesce("rare_logs", F.lit(0.0))
    return rows.select("doc_id", "n_tokens", "frequent", "known", "gain", "row").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce(own == remainder, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("frequent") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (base - F.col("n_tokens") * unit).alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )
