"""Toxicity from a learned lexicon, matched with spelling errors and weighed by context.

The lexicon's words and stems make a trie. The Levenshtein automata of all of them are run over
it together: a state is a set of (trie node, errors so far), made into a deterministic automaton
as words demand it, so that a word costs a few dictionary lookups. A hit inside quotation marks
or beside a reporting word counts for less than one aimed at a reader.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release
from tesserae.llm.encode import bounded

#: At most so many labelled rows, the first in the order of a hash, teach the lexicon.
SAMPLE = 12_000
#: A term is in so many toxic texts of the sample at least, and raises the log odds of a text to so much.
SUPPORT, TELLING = 3, 1.2
#: Distinct terms that a task counts before it hands them on.
HELD = 500_000
#: Stems have from 4 letters to 8; terms with at least 5 letters are found with an error.
STEMS, FUZZY = range(4, 9), 5
WINDOW = 6
QUOTED, REPORTED, AIMED = 0.45, 0.6, 1.15
_REPORTING = frozenset("said says wrote writes called quote quoted quotes quoting word term insult slur means definition reads replied cited".split())
_ADDRESS = frozenset("you your you're youre yourself u ur".split())
_LEET = str.maketrans("013457@$", "oieastas")
_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)
_MARKS = "\"“”„«»‹›"


def core(word: str) -> str:
    """A word without the punctuation around it, digits and signs that stand for letters replaced."""
    x = word.strip("\"“”„«»‹›'’‘()[]{}.,;:!?*_~-…")
    if not x.isalpha() and any(c.isalpha() for c in x):
        x = x.translate(_LEET)
        m = _CORE.search(x)
        x = m[0] if m else ""
    return x


def terms_of(word: str) -> list[str]:
    """What may be learned from a word: itself (marked with $) and its stems."""
    return [f"{word}$", *(word[:k] for k in STEMS if k < len(word))]


class Automaton:
    """Words and stems (terms) with up to one error for those of FUZZY letters or more."""

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]
        for term in terms:
            node = 0
            for c in term.removesuffix("$"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][c]
            self.ends[node].append(term)
        self.reach = self._longest()
        self.start = self._closed({(0, 0)})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def _longest(self) -> list[bool]:
        """Whether a term below the node may have an error."""
        ok = [any(len(t.removesuffix("$")) >= FUZZY for t in e) for e in self.ends]
        for node in range(len(ok) - 1, -1, -1):  # children come after their parents
            ok[node] = ok[node] or any(ok[c] for c in self.children[node].values())
        return ok

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        for node, errors in list(items):
            if not errors:
                items |= {(c, 1) for c in self.children[node].values() if self.reach[c]}  # a letter left out
        return frozenset(items)

    def step(self, state: frozenset, letter: str) -> frozenset:
        key = (state, letter)
        if (found := self.steps.get(key)) is None:
            items: set[tuple[int, int]] = set()
            for node, errors in state:
                if (child := self.children[node].get(letter)) is not None:
                    items.add((child, errors))
                if not errors:
                    if self.reach[node]:
                        items.add((node, 1))  # a letter too many
                    items |= {(c, 1) for c in self.children[node].values() if self.reach[c]}  # another letter
            if len(self.steps) > 400_000:
                self.steps.clear()
            found = self.steps[key] = self._closed(items)
        return found

    def hits(self, word: str) -> dict[str, int]:
        """Each term found and its errors."""
        found: dict[str, int] = {}

        def note(term: str, errors: int) -> None:
            if not errors or len(term.removesuffix("$")) >= FUZZY:
                found[term] = min(found.get(term, 1), errors)

        state = self.start
        for c in word:
            state = self.step(state, c)
            if not state:
                return found
            for node, errors in state:
                for term in self.ends[node]:
                    if term[-1] != "$":
                        note(term, errors)
        for node, errors in state:
            for term in self.ends[node]:
                if term[-1] == "$":
                    note(term, errors)
        return found


@dataclass(frozen=True)
class Model:
    """weights: log-likelihood ratios by term, and by ``~term`` where it is found with an error; prior and none are log odds."""

    weights: dict[str, float]
    prior: float
    none: float

    @property
    def automaton(self) -> Automaton:
        kept = bounded("toxic automata")
        key = tuple(sorted(x for x in self.weights if x[0] != "~"))
        if key not in kept:
            kept.clear()
            kept[key] = Automaton(dict.fromkeys(key, 0.0))
            bounded("toxic words").clear()
        return kept[key]

    def features(self, word: str, automaton: Automaton) -> tuple[str, ...]:
        """The word's terms: those found exactly, or else those found with an error."""
        known = bounded("toxic words")
        if (found := known.get(word)) is None:
            hits = automaton.hits(core(word))
            found = known[word] = tuple(sorted(t for t, e in hits.items() if not e)) or tuple(sorted(f"~{t}" for t in hits))
        return found


def context(words: list[str], at: int) -> float:
    """How much a hit counts, by the words around it."""
    word = words[at]
    before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
    opened = sum(w.count(m) for w in before for m in _MARKS) % 2 == 1 and any(m in w for w in (word, *after) for m in _MARKS)
    factor = 1.0
    if opened or (word[0] in _MARKS + "'‘" and any(m in w for w in (word[1:], *after) for m in _MARKS + "'’")):
        factor *= QUOTED
    near = {core(w) for w in (*before, *after)}
    if near & _REPORTING:
        factor *= REPORTED
    elif near & _ADDRESS:
        factor *= AIMED
    return factor


def found_in(text: str, model: Model, automaton: Automaton) -> dict[str, float]:
    """Each feature of a text and the largest weight that context gives a place of it."""
    words = text.lower().split()
    hit = {w: f for w in set(words) if (f := model.features(w, automaton))}
    out: dict[str, float] = {}
    if hit:
        for at, w in enumerate(words):
            for f in hit.get(w, ()):
                out[f] = max(out.get(f, 0.0), context(words, at))
    return out


def score(text: str | None, model: Model, automaton: Automaton) -> float:
    found = found_in(text or "", model, automaton)
    if not found:
        z = model.none
    else:  # terms of a text are not independent: each further one counts half as much
        gains = sorted((model.weights.get(f, 0.0) * c for f, c in found.items()), reverse=True)
        z = model.prior + sum(g / 2**min(k, 60) for k, g in enumerate(gains))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _counted(sample: DataFrame, emit) -> DataFrame:
    """(term, n): sums over the sample of what emit(text, toxic) yields."""

    def run(batches):
        total: Counter = Counter()

        def out():
            return pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"])

        for b in batches:
            for x, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total.update(emit(x or "", toxic))
                if len(total) > HELD:
                    yield out()
                    total.clear()
        yield out()

    return arrow_map(sample.select("text", "toxic"), run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def terms_in(text: str) -> set[str]:
    return {t for w in {core(w) for w in text.lower().split()} if w for t in terms_of(w)}


def _ratio(a, b, positives: int, negatives: int, log=math.log):
    """A term's log-likelihood ratio if it is in a toxic texts and b others."""
    return log((a + 0.5) / (positives + 1)) - log((b + 0.5) / (negatives + 1))


def choose(toxic: Counter, clean: Counter, texts: list[set[str]], negatives: int) -> dict[str, float]:
    """Terms with their log-likelihood ratios. texts: the terms of each toxic text.

    A greedy cover: each term in turn is the one that explains most toxic texts which none before
    it explains; words before stems, longer before shorter. Precise words with much support are
    added, for one text often has several of the lexicon's words.
    """
    positives = len(texts)

    def ratio(t: str) -> float:
        return _ratio(toxic[t], clean[t], positives, negatives)

    odds = math.log((positives + 0.5) / (negatives + 0.5))
    precision = {t: toxic[t] / (toxic[t] + clean[t]) for t in toxic if toxic[t] >= SUPPORT and ratio(t) + odds >= TELLING}
    left = [x & precision.keys() for x in texts]
    fresh = Counter(t for x in left for t in x)
    chosen: list[str] = []
    while fresh:
        best = max(fresh, key=lambda t: (fresh[t] * precision[t] ** 4, t[-1] == "$", len(t), t))
        if fresh[best] < SUPPORT:
            break
        chosen.append(best)
        for x in left:
            if best in x:
                fresh.subtract(x)
                x.clear()
        fresh = +fresh
    stems = {t for t in chosen if t[-1] != "$"}
    much = max(8, 0.1 * max([toxic[t] for t in chosen], default=0))
    more = [t for t in precision if t[-1] == "$" and toxic[t] >= much and precision[t] >= 0.97 and not any(t[:k] in stems for k in STEMS)]
    return {t: ratio(t) for t in {*chosen, *more}}


def _keys(text: str) -> list[int]:
    """The least hashes of a text's word shingles under three seeds: near copies mostly agree in one."""
    words = text.lower().split()
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    return [min(xxhash.xxh64_intdigest(x, seed) for x in shingles) >> 1 for seed in (1, 2, 3)]


def fit(docs: DataFrame, labels: DataFrame, remainder: int = 1, folds: int = 3, sample: int = SAMPLE) -> Model:
    """Learns from labelled rows whose crc32(doc_id) mod folds is not remainder, at most ``sample`` of them.

    Null labels and labels of rows without text count for nothing; of several labels of a row the
    largest counts; of near copies one row. Without toxic labels the lexicon is empty and every
    score the same.
    """
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    chosen = (
        labels.where("toxic is not null and doc_id is not null")
        .where(own != remainder)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null").join(F.broadcast(chosen), "doc_id")

    def keyed(batches):
        for b in batches:
            keys = [_keys(x) for x in b.column(0).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array([k[i] for k in keys], pa.int64()) for i in range(3))], ["text", "toxic", "a", "b", "c"])

    rows = durable(arrow_map(texts.select("text", "toxic"), keyed, "text string, toxic int, a bigint, b bigint, c bigint").dropDuplicates(["toxic", "a"]).dropDuplicates(["toxic", "b"]).dropDuplicates(["toxic", "c"]))
    count = dict(rows.groupBy("toxic").count().collect())
    positives, negatives = count.get(1, 0), count.get(0, 0)
    odds = math.log((positives + 0.5) / (negatives + 0.5))
    of_toxic = _counted(rows.where("toxic = 1"), lambda text, _: terms_in(text)).where(F.col("n") >= SUPPORT)
    of_clean = _counted(rows.where("toxic = 0"), lambda text, _: terms_in(text)).withColumnRenamed("n", "clean")
    both = of_toxic.join(of_clean, "term", "left").select("term", "n", F.coalesce("clean", F.lit(0)).alias("clean"))
    telling = both.where(_ratio(F.col("n"), F.col("clean"), positives, negatives, F.log) + odds >= TELLING - 1e-9).collect()  # of the bounded sample's terms
    toxic, clean = Counter({r["term"]: r["n"] for r in telling}), Counter({r["term"]: r["clean"] for r in telling})

    def listed(batches):
        for b in batches:
            yield pa.record_batch([pa.array([sorted(terms_in(x) & toxic.keys()) for x in b.column(0).to_pylist()], pa.list_(pa.string()))], ["terms"])

    each = [set(r["terms"]) for r in arrow_map(rows.where("toxic = 1").select("text"), listed, "terms array<string>").collect()]  # of the bounded sample
    weights = choose(toxic, clean, each, negatives)
    first = Model(weights, odds, odds)

    def of_found(text: str, label: int):
        found = found_in(text, first, first.automaton)
        return [f"{label}{f}" for f in found] if all(f[0] == "~" for f in found) and found else ([] if found else [f"{label}"])

    seen = Counter({r["term"]: r["n"] for r in _counted(rows, of_found).collect()})  # at most three for each chosen term
    release(rows)
    for t in list(weights):
        if len(t.removesuffix("$")) >= FUZZY:  # without examples a misspelling counts for a little less than the term
            a, b = seen[f"1~{t}"], seen[f"0~{t}"]
            weights[f"~{t}"] = 0.8 * weights[t] if not a + b else min(0.8 * weights[t], _ratio(a, b, positives, negatives))
    none = math.log((seen["1"] + 0.5) / (seen["0"] + 0.5)) if count else 0.0
    return Model(weights, odds if count else 0.0, min(none, odds) if count else 0.0)


def scored(docs: DataFrame, model: Model, remainder: int = 1, folds: int = 3, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of docs, whole texts, null as empty.

    Only the text makes the score. A null doc_id is not held out. Rows are independent: repeated
    rows score alike, an empty table gives an empty result, further columns are ignored.
    """

    def run(batches):
        automaton = model.automaton
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([score(x, model, automaton) for x in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    out = arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, score double")
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return out.select("doc_id", F.coalesce(own == remainder, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
