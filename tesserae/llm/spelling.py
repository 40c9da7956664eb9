"""Spelling variants: words one letter apart, and the frequent form that each rare one stands for.

A symmetric-delete join: every word emits itself and its distinct single deletions. Words that
differ by one inserted, deleted or replaced code point share one of these keys, and exactly one; words
that share a key are compared exactly. A key is shared by as many words as one letter can be put
into it, which the alphabet bounds, however often the words occur.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release

#: Distinct words that a task counts before it hands them on.
HELD = 400_000
#: Runs of letters, in Latin-1.
_RUNS = {}


def _runs(least: int) -> re.Pattern:
    return _RUNS.setdefault(least, re.compile(b"[a-z\xc0-\xff]{%d,}" % least))


def words_of(text: str, doc_id: int | None, least: int, every: int) -> tuple[list[bytes], list[tuple[bytes, bytes, int]]]:
    """The text's runs of ``least`` letters or more in Latin-1, and of them (run, what it becomes, how often) for runs with a planted slip.

    Every character beyond Latin-1 stands between runs, so one byte is one code point.
    """
    found = _runs(least).findall(text.encode("latin-1", "replace").lower())
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    slips = []
    for w in set(found):
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), prefix)
        if not h % every:
            at = h % len(w)
            slips.append((w, w[:at] + w[at + 1 :], found.count(w)))
    return found, slips


def counted(docs: DataFrame, least: int = 7, twice: int = 2, every: int = 31) -> DataFrame:
    """(word, n): distinct words of at least ``least`` code points and ``twice`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Of a run whose
    crc32(doc_id:run) ``every`` divides, one letter is left out; a null doc_id is empty there.
    Null texts have no words. Whole texts are read, one at a time.
    """

    def run(batches):
        total: Counter = Counter()

        def out():
            kept = {w: n for w, n in total.items() if n and len(w) >= least}
            batch = pa.record_batch([pa.array([w.decode("latin-1") for w in kept], pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                found, slips = words_of(text, doc_id, least, every)
                total.update(found)
                for w, slipped, n in slips:
                    total[w] -= n
                    total[slipped] += n
                if len(total) > HELD:
                    yield out()
        yield out()

    parts = arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= twice)


def pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every two words that are one edit apart, both ways round. words: (word, n), distinct.

    Keys are shuffled as 64-bit hashes; a clash costs one more comparison.
    """
    deleted = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word"))))
    keys = F.transform(F.array_distinct(F.concat(F.array("word"), deleted)), lambda k: F.xxhash64(k))
    emitted = words.where(F.length("word") > 0).select(F.explode(F.array_distinct(keys)).alias("key"), "word", "n")
    other = emitted.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = emitted.join(other, "key").where("word <> other and abs(length(word) - length(other)) <= 1").where(F.levenshtein("word", "other", 1) == 1)
    return near.select("word", "n", "other", "other_n")


def roots(forms: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(word, root) for each (word, form): the end of the chain, by pointer doubling.

    Every link leads to a word at least ``factor`` times as frequent, so chains are short and never closed;
    k rounds reach 2 ** k links. Each round is written: a lost executor costs one.
    """
    at = durable(forms.select("word", F.col("form").alias("root")))
    for _ in range(most_rounds):
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        new = durable(at.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
        moved = bool(new.where("moved").limit(1).count())
        release(at)
        at = new
        if not moved:
            return at.select("word", "root")
    raise ValueError("forms lead round in a circle")


def variants(docs: DataFrame, least: int = 7, twice: int = 2, every: int = 31, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each distinct word, of whatever documents.

    n_near: words one edit away. form: of these the most frequent (ties: the least in code-point order) if it
    has ``factor`` times the word's n, else null. root: where forms lead from the word, itself without one.
    No documents, none with text, or no word twice: an empty result. Repeated rows count as often as they stand there.
    """
    words = durable(counted(docs, least, twice, every))
    near = pairs(words).withColumn("inverse", -F.col("other_n")).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("inverse", "other")).alias("best"))
    near = durable(near.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.inverse")).alias("other_n")))
    found = words.join(near, "word", "left")
    ok = F.col("other_n") >= factor * F.col("n")
    found = durable(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(ok, F.col("other")).alias("form"), F.when(ok, F.col("other_n")).alias("form_n")))
    release(words, near)
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
