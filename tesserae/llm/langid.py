"""Language of texts: sparse multinomial logistic regression on TF-IDF weights of character n-grams.

N-grams of 1 to 4 letters, with one blank for whatever lies between words, are hashed into BUCKETS
by numpy over a whole text at a time. Document frequencies come from all training texts; the
regression is fitted on a bounded sample of them by follow-the-regularised-leader with an
elastic net, which leaves most weights at zero, and its temperature on texts of the sample that it did
not learn from.
"""

from __future__ import annotations

import functools
import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import HASHES, arrow_map, durable, hash_order, release

#: About so many training texts at most, those with the least hashes, fit the weights; every tenth of them the temperature.
SAMPLE = 8_000
CALIBRATE = 10
BUCKETS = 1 << 16  # 16 bits of a hash
ORDERS = 4
UNKNOWN = "und"
_MIX = np.uint32(0x9E3779B1)
_BLANK = 32


@dataclass(frozen=True)
class Rates:
    """Of the follow-the-regularised-leader steps."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    passes: int = 2


@functools.cache
def _letters() -> np.ndarray:
    """Each code point, or a blank where it's no letter."""
    return np.array([i if chr(i).isalpha() else _BLANK for i in range(0x110000)], np.uint32)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets, ascending, and how many of its n-grams each holds; none if it has no letter."""
    codes = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    if not len(codes) or codes.max() == _BLANK == codes.min():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.concatenate(([_BLANK], codes, [_BLANK])).astype(np.uint32)
    codes = codes[np.concatenate(([True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)))]
    sizes = [max(0, len(codes) - n) for n in range(ORDERS)]
    found, begin = np.empty(sum(sizes), np.uint16), 0
    rolled = np.zeros(len(codes), np.uint32)
    for n, size in enumerate(sizes, 1):
        rolled = rolled[:size] * _MIX
        rolled += codes[n - 1 : n - 1 + size]
        rolled += np.uint32(n)
        mixed = rolled ^ (rolled >> np.uint32(15))
        mixed *= np.uint32(0x85EBCA6B)
        found[begin : begin + size] = mixed >> np.uint32(16)
        begin += size
    found.sort(kind="stable")  # by digits, in time of the text's length
    first = np.concatenate(([0], np.flatnonzero(found[1:] != found[:-1]) + 1))
    return found[first].astype(np.int64), np.diff(np.append(first, len(found)))


def weighed(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of length one; logarithmic frequencies, so that a very long text is like a shorter one."""
    x = (1 + np.log(n)) * idf[at]
    return x / max(math.sqrt(float(x @ x)), 1e-12)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Weights by follow-the-regularised-leader: a weight is zero until its gradients' sum exceeds l1. The last row is the bias."""

    def __init__(self, classes: int, rates: Rates = Rates()):
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))
        self.rates = rates

    def weights(self, at) -> np.ndarray:
        r, z = self.rates, self.z[at]
        return np.where(np.abs(z) <= r.l1, 0.0, (np.sign(z) * r.l1 - z) / ((r.beta + np.sqrt(self.n[at])) / r.alpha + r.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One step; at: the text's buckets and the bias."""
        w = self.weights(at)
        g = softmax(x @ w)
        g[label] -= 1
        g = x[:, None] * g
        old = self.n[at]
        new = old + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.rates.alpha * w
        self.n[at] = new


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """What logits are divided by so that the labels are likeliest: golden section over its logarithm, between 1/20 and 20."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / math.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).sum()) + 1e-3 * t * t  # where all labels are right, no temperature would be too low

    low, high, step = -math.log(20), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


@dataclass
class Model:
    """langs in order; for buckets with a weight their number, inverse document frequencies and weights, the bias last."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return weighed(at, n, self.idf) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        at, n = grams(text or "")
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, n) / self.temperature)
        return self.langs[int(p.argmax())], float(p.max())


def train(rows: list[tuple[np.ndarray, np.ndarray, int, bool]], idf: np.ndarray, classes: int, rates: Rates = Rates()) -> tuple[np.ndarray, float]:
    """Weights and temperature from rows (buckets, counts, label, calibrates); few rows calibrate on what they learn from."""
    leader = Leader(classes, rates)
    learning = [r for r in rows if not r[3]] or rows
    shuffler = np.random.default_rng(13)
    texts = [(np.append(at, BUCKETS), np.append(weighed(at, n, idf), 1.0), y) for at, n, y, _ in learning]
    for _ in range(rates.passes):
        for k in shuffler.permutation(len(texts)):
            leader.learn(*texts[k])
    weights = leader.weights(slice(None))
    held = [r for r in rows if r[3]] or rows
    logits = np.array([weighed(at, n, idf) @ weights[at] + weights[-1] for at, n, *_ in held]).reshape(-1, classes)
    return weights, temperature(logits, np.array([y for _, _, y, _ in held], np.int64))


def _training(docs: DataFrame, remainder: int, folds: int) -> DataFrame:
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null").where(own != remainder)


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Of all texts: in how many each bucket occurs, and their number. BUCKETS numbers reach the driver."""

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                total[grams(text)[0]] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], ["at", "n"])

    found = arrow_map(texts.select("text"), run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS + 1 rows
    total = np.zeros(BUCKETS + 1, np.int64)
    total[found.column("at").to_numpy()] = found.column("n").to_numpy()  # -1 is the last
    return total[:-1], int(total[-1])


def fit(docs: DataFrame, remainder: int = 0, folds: int = 5, sample: int = SAMPLE, rates: Rates = Rates()) -> Model:
    """Learns from texts with a lang whose crc32(doc_id) mod folds is not remainder.

    Document frequencies cover all of them, the weights at most ``sample`` (of which a tenth sets the temperature), drawn by a hash of
    id, text and lang, so that reruns agree; of more, those with a hash so low that the sample has ``sample`` rows less four standard deviations on average. Rows with a null doc_id, text or lang teach
    nothing; repeated rows count as often as they stand there for frequencies, once in the sample. Without training rows nothing is
    predicted. The fit is one task, as the sample is bounded.
    """
    rows = _training(docs, remainder, folds)
    df, total = frequencies(rows)
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    idf = np.log((1 + total) / (1 + df)) + 1
    if not langs:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    number = {x: k for k, x in enumerate(langs)}
    key = hash_order("doc_id", F.md5("text"), "lang", seed=13)
    most = HASHES if total <= sample else int(HASHES * max(1.0, sample - 4 * math.sqrt(sample)) / total)  # four deviations under the bound
    drawn = durable(rows.withColumn("key", key).where(F.col("key") < most).groupBy("key").agg(F.first("text").alias("text"), F.first("lang").alias("lang")))

    def run(batches):
        taken = []
        for b in batches:
            for key, text, lang in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at, n = grams(text)
                if len(at):
                    taken.append((key, at.astype(np.int32), n.astype(np.int32), number[lang]))
        taken.sort(key=lambda r: r[0])
        weights, t = train([(at, n, y, k % CALIBRATE == 0) for k, (_, at, n, y) in enumerate(taken)], idf, len(langs), rates)
        at = np.flatnonzero(weights.any(axis=1))
        yield pa.record_batch([pa.array([pickle.dumps((at, weights[at], t))], pa.binary())], ["model"])

    ((packed,),) = arrow_map(drawn.repartition(1), run, "model binary").collect()
    release(drawn)
    at, some, t = pickle.loads(packed)
    weights = np.zeros((BUCKETS + 1, len(langs)))
    weights[at] = some
    return Model(langs, idf, weights, t)


def predicted(docs: DataFrame, model: Model, remainder: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row for each row of docs, whole texts; score: the calibrated probability.

    Only the text decides. Null texts and those without a letter are ``und`` with score 0. A null
    doc_id is not held out. Rows are independent: repeated rows are judged alike, an empty table gives an empty result,
    further columns are ignored. A very long text is held by one task, with some numbers for each letter.
    """
    used = np.flatnonzero(model.weights.any(axis=1))
    packed = (model.langs, model.idf.astype(np.float32), used, model.weights[used], model.temperature)

    def run(batches):
        langs, idf, at, some, t = packed
        weights = np.zeros((BUCKETS + 1, len(langs)))
        weights[at] = some
        own = Model(langs, idf.astype(float), weights, t)
        for b in batches:
            found = [own.predict(x) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, lang_pred string, score double")
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return out.select("doc_id", F.coalesce(own == remainder, F.lit(False)).alias("held_out"), "lang_pred", "score")
