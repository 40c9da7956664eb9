"""Quality rules on repetition: how much of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import WORD, arrow_map
from tesserae.session import ship

_WORD = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Fixed limits of the checks; shares are of the characters in words."""

    least_words: int = 10
    most_repeated_words_percent: int = 20
    #: n: the largest share of characters inside n-grams found twice or more.
    ngrams: dict[int, float] = field(default_factory=lambda: {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20})
    #: The largest share of lines equal to an earlier one, where they are more than ``few``, and of characters in such lines.
    lines: float = 0.30
    few: int = 2
    line_chars: float = 0.30
    #: The largest share of words equal to the word before.
    stutter: float = 0.25
    #: The largest share of words that are made of symbols or hold one.
    symbols: float = 0.25


RULES = Rules()
_P = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str]) -> np.ndarray:
    """A well mixed 64-bit code for each distinct word of a text."""
    seen: dict[str, int] = {}
    x = np.array([seen.setdefault(w, len(seen)) for w in words], np.uint64) + np.uint64(1)
    x *= _P
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def covered(codes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of n words whose content is in the text twice or more."""
    m = len(codes)
    inside = np.zeros(m, bool)
    if m <= n:
        return inside
    rolled = codes[: m - n + 1].copy()
    for k in range(1, n):
        rolled *= _P
        rolled += codes[k : m - n + 1 + k]
    order = np.argsort(rolled, kind="stable")
    ordered = rolled[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return inside
    again = np.zeros(len(rolled), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(m + 1, np.int32)
    edges[: len(again)] += again
    edges[n : n + len(again)] -= again
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None, rules: Rules = RULES) -> tuple[int, int, int, int, int, bool, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of one text."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    chars = int(lengths.sum())
    symbols = sum(map(text.count, _SYMBOLS))
    seen: set[str] = set()
    lines = again = again_chars = 0
    for line in text.split("\n"):
        if not _WORD.search(line):
            continue
        lines += 1
        if line in seen:
            again += 1
            again_chars += sum(map(len, _WORD.findall(line)))
        seen.add(line)
    codes = _codes(words)
    five = covered(codes, 5)
    repeated = int(five.sum())
    failed = n < rules.least_words or 100 * repeated > rules.most_repeated_words_percent * n
    kept = not failed and again <= max(rules.few, rules.lines * lines) and again_chars <= rules.line_chars * chars and symbols <= rules.symbols * n
    kept = kept and int((codes[1:] == codes[:-1]).sum()) <= rules.stutter * n
    if kept and repeated:  # longer n-grams repeat only where shorter ones do
        kept = all(int(lengths[five if k == 5 else covered(codes, k)].sum()) <= most * chars for k, most in rules.ngrams.items())
    return n, chars, symbols, again, repeated, failed, kept


_TYPES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"


def measured(docs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), a row for each row of docs.

    A null text has no words, as an empty one; both fail. Rows are independent: repeated rows are
    judged alike, an empty table gives an empty result, columns beyond doc_id and text are
    ignored. A text is held by one task, which sorts as many numbers as it has words.
    """

    def run(batches):
        for b in batches:
            found = list(zip(*[measure(x, rules) for x in b.column(1).to_pylist()], strict=True)) or [[]] * 7
            yield pa.record_batch([b.column(0), *(pa.array(c, pa.int64()) for c in found[:5]), *(pa.array(c, pa.bool_()) for c in found[5:])], ["doc_id", *(x.split()[0] for x in _TYPES.split(", "))])

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, f"doc_id bigint, {_TYPES}")


def keep(docs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The rows of docs whose text passes, all columns as they are. No shuffle."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([measure(x, rules)[6] for x in b.column(at).to_pylist()], pa.bool_()))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
