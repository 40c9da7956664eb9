"""Looking for many terms in many texts: an Aho-Corasick automaton for whole words, trigram postings for parts of keys and texts."""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms of one automaton, and their characters: about 100 bytes of memory for each. What is more is looked for in further passes.
TERMS, CHARACTERS = 1 << 16, 1 << 20
#: Passes over the texts at most; ``passes`` says how many a set of terms takes.
PASSES = 8

_WORDS = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Mc", "Me", "Nd", "Pc"}


@functools.cache
def is_word(c: str) -> bool:
    """What counts as part of a word: letters, marks, digits, connectors and joiners."""
    return unicodedata.category(c) in _WORDS or c in "‌‍" or "Ⓐ" <= c <= "ⓩ"


@functools.cache
def _cases() -> dict[int, int]:
    """Letters by the one without case, a code point for a code point, so that places stay."""
    out = {}
    for i in range(0x20000):
        up = chr(i).upper()
        low = (up if len(up) == 1 else chr(i)).lower()
        if len(low) == 1 and ord(low) != i:
            out[i] = ord(low)
    return out


@functools.cache
def _odd() -> re.Pattern:
    """Letters that ``str.lower`` doesn't treat as ``_cases`` does, or only by what stands beside them."""
    return re.compile("[" + "".join(re.escape(chr(i)) for i in range(0x20000) if chr(i).lower() != chr(_cases().get(i, i)) or chr(i) == "Σ") + "]")


def folded(text: str) -> str:
    """Letter by letter only where a text has an odd one: that takes ten times as long as finding the terms."""
    return text.lower() if text.isascii() or not _odd().search(text) else text.translate(_cases())


class Terms:
    """An automaton of terms with failure links, through which a text goes once, whatever the number of terms."""

    def __init__(self, terms: Iterable[str]):
        import ahocorasick

        self.found: dict[str, list[str]] = {}
        for t in terms:
            self.found.setdefault(folded(t), []).append(t)
        self.automaton = ahocorasick.Automaton()
        for f in self.found:
            self.automaton.add_word(f, f)
        self.automaton.make_automaton()

    def counts(self, text: str) -> dict[str, int]:
        """How often each term stands in the text between word boundaries, its own overlaps not counted twice."""
        low, n = folded(text), {}
        ends: dict[str, int] = {}
        if not self.found:
            return n
        last = len(low) - 1
        for end, f in self.automaton.iter(low):
            start = end - len(f) + 1
            if (start > 0 and is_word(low[start - 1])) == is_word(f[0]) or (end < last and is_word(low[end + 1])) == is_word(f[-1]):
                continue
            if start > ends.get(f, -1):
                ends[f] = end
                n[f] = n.get(f, 0) + 1
        return {t: k for f, k in n.items() for t in self.found[f]}


_built: dict[str, Terms] = {}


def built(terms: list[str]) -> Terms:
    """The terms' automaton, once for a worker."""
    key = hashlib.sha256("\0".join(terms).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = Terms(terms)
    return _built[key]


def passes(terms: DataFrame) -> int:
    """How many automata the distinct terms need."""
    n, size = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("term")), F.lit(0))).first()
    return max(1, -(-n // TERMS), -(-size // CHARACTERS))


def standing(texts: DataFrame, patterns: DataFrame, parts: int) -> DataFrame:
    """(term): the terms that stand in one of the texts, as they are and anywhere in it. texts: one column; patterns: (term), distinct; parts: ``passes(patterns)``.

    Each text is read where it lies, once a part; what leaves a task are terms found, each once for a batch of texts.
    """
    shard = F.pmod(F.xxhash64("term"), F.lit(parts))
    listed = [sorted(r["term"] for r in patterns.where(shard == k).select("term").collect()) for k in range(parts)]  # of a size that is checked

    def run(own: list[str]):
        def find(batches):
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for t in own:
                automaton.add_word(t, t)
            automaton.make_automaton()
            for b in batches:
                seen = {t for x in b.column(0).to_pylist() if x is not None for _, t in automaton.iter(x)}
                yield pa.record_batch([pa.array(sorted(seen), pa.string())], ["term"])

        return find

    out = [texts.mapInArrow(run(own), "term string") for own in listed if own] or [patterns.select("term").where("false")]
    return functools.reduce(DataFrame.union, out).distinct()


def counted(texts: DataFrame, key: str, text: str, terms: DataFrame, parts: int, keep: bool = False) -> DataFrame:
    """(key, term, n): how often each term stands in each text, without regard to case; with keep the text, too. terms: (term), distinct; parts: ``passes(terms)``.

    No text is moved: a pass reads every text where it lies, with one part of the terms, of which
    TERMS or so travel with the tasks. A null text has none.
    """
    from tesserae.session import ship

    ship(texts.sparkSession)
    shard = F.pmod(F.xxhash64("term"), F.lit(parts))
    listed = [sorted(r["term"] for r in terms.where(shard == k).select("term").collect()) for k in range(parts)]  # of a size that is checked
    rows = texts.select(key, text).where(F.col(text).isNotNull())
    found = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))
    schema = f"{key} {texts.schema[key].dataType.simpleString()}, {f'{text} string, ' if keep else ''}found array<struct<term:string,n:bigint>>"

    def run(own: list[str]):
        def find(batches):
            automaton = built(own)
            for b in batches:
                each = [[{"term": t, "n": n} for t, n in automaton.counts(x).items()] for x in b.column(1).to_pylist()]
                some = pa.record_batch([b.column(0), *([b.column(1)] if keep else []), pa.array(each, found)], [key, *([text] if keep else []), "found"])
                yield some.filter(pa.array([bool(x) for x in each], pa.bool_()))

        return find

    out = [rows.mapInArrow(run(own), schema) for own in listed if own] or [rows.select(key, *([text] if keep else []), F.array().cast("array<struct<term:string,n:bigint>>").alias("found"))]
    return functools.reduce(DataFrame.union, out).select(key, *([text] if keep else []), F.inline("found")).select(key, "term", "n", *([text] if keep else []))


# ---------------------------------------------------------------- trigrams


def grams(c: Column, n: int = 3) -> Column:
    """The distinct n-grams of a text; none if it is shorter."""
    last = F.length(c) - (n - 1)
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(c, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def postings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(gram, key): in which rows each trigram stands. Save it with a snapshot, partitioned or bucketed by gram, and it serves all later searches."""
    return rows.where(F.col(text).isNotNull()).select(F.explode(grams(F.col(text))).alias("gram"), key)


def containing(patterns: DataFrame, rows: DataFrame, key: str, text: str, index: DataFrame | None = None) -> DataFrame:
    """(pattern, key): every row whose text contains the pattern, as it is. patterns: (pattern), distinct; an empty one is in no text.

    A pattern of three characters or more meets the postings of its trigrams; rows that have all of
    them are then searched. Of a pattern's trigrams those in most rows are left to that search: the rarest
    one is looked up first, so that a pattern costs what its rarest trigram has. Shorter patterns meet
    one- and two-letter grams of the rows, which decide by themselves.
    """
    wanted = patterns.select("pattern").distinct().where("pattern <> ''")
    texts = rows.select(key, text).where(F.col(text).isNotNull())
    index = postings(texts, key, text) if index is None else index
    long = wanted.where(F.length("pattern") >= 3)
    of = long.select("pattern", F.explode(grams(F.col("pattern"))).alias("gram"))
    sizes = index.join(of.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("rows"))
    # a gram that is nowhere makes its pattern found nowhere
    rarest = of.join(sizes, "gram", "left").groupBy("pattern").agg(F.min_by("gram", F.struct(F.coalesce("rows", F.lit(0)), "gram")).alias("gram"))
    met = index.join(rarest, "gram").select("pattern", key)
    hits = met.join(texts, key).where(F.contains(F.col(text), F.col("pattern"))).select("pattern", key)
    short = []
    for n in (1, 2):
        own = wanted.where(F.length("pattern") == n)
        short.append(texts.select(F.explode(grams(F.col(text), n)).alias("pattern"), key).join(own, "pattern", "left_semi").select("pattern", key))
    return hits.union(short[0]).union(short[1]).distinct()
