"""Texts that need a parser or positions: HTML, JSON inside prose, passages around a term."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tesserae.durable import written
from tesserae.functions.names import norm_search

#: How far a passage reaches to both sides, before it is cut at white space.
REACH = 200
#: Labels of a contents list that are no chapters.
NO_CHAPTERS = ("maps", "map", "glossary", "contents", "cover", "title page", "about the author", "copyright", "acknowledgments", "dedication", "prologue note", "table of contents")


class _Text(HTMLParser):
    """Text nodes outside scripts and styles."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def text_of(html: str | None, headers: tuple[str, ...] = ()) -> str | None:
    """The lines of a page, stripped and without blank ones; a running header as the first line goes."""
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    lines = [x for x in (y.strip() for y in "\n".join(p.parts).split("\n")) if x]
    return "\n".join(lines[1:] if lines and lines[0] in headers else lines)


def html_text(c: Column, headers: tuple[str, ...] = ()) -> Column:
    @F.pandas_udf(StringType())
    def parsed(s: pd.Series) -> pd.Series:
        return s.map(lambda x: text_of(x, headers))

    return parsed(c)


def heading(c: Column) -> Column:
    """The text of the first h1 to h6 that is no bare chapter mark."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", ""), r"(?U)\s+", " ")))
    named = F.filter(found, lambda x: (x != "") & ~F.rlike(x, F.lit(r"(?i)^(chapter\s*)?(\d+|prologue|epilogue)$")))
    return F.get(named, 0)


def without_number(c: Column) -> Column:
    """A text without CHAPTER N at its beginning."""
    return F.regexp_replace(c, r"(?i)^\s*chapter\s+\d+\s*", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))


def contents_entry(label: Column) -> Column:
    """(kind, number, title) of a line of a contents list; null if it is no chapter. An epilogue has no number yet."""
    blank = r"[\s :]+"
    low = F.lower(F.trim(label))
    title = lambda x: F.nullif(F.trim(x), F.lit(""))
    made = lambda kind, number, t: F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("number"), title(t).alias("title"))
    said = lambda word: F.regexp_extract(label, rf"(?i)^{word}\b(?:{blank}(.*))?$", 1)
    is_ = lambda pattern: F.rlike(label, F.lit(pattern))
    numbered = rf"(?i)^(?:chapter[\s ]+)?(\d+)(?:{blank}(.*))?$"
    return (
        F.when(low.isin(*NO_CHAPTERS), None)
        .when(is_(rf"(?i)^prologue\b(?:{blank}(.*))?$"), made("prologue", F.lit(0), said("prologue")))
        .when(is_(rf"(?i)^epilogue\b(?:{blank}(.*))?$"), made("epilogue", F.lit(None), said("epilogue")))
        .when(is_(numbered), made("chapter", F.regexp_extract(label, numbered, 1), F.regexp_extract(label, numbered, 2)))
    )


def numbered_chapters(labels: DataFrame, group: str, order: str, label: str = "label") -> DataFrame:
    """Chapters of contents lists, epilogues numbered after the last chapter in their order."""
    from pyspark.sql import Window

    w = Window.partitionBy(group)
    rows = labels.withColumn("entry", contents_entry(F.col(label))).where("entry is not null").select(group, order, "entry.*")
    last = F.max("number").over(w)
    tail = F.count(F.when(F.col("kind") == "epilogue", 1)).over(w.orderBy(order))
    return rows.withColumn("number", F.when(F.col("kind") == "epilogue", F.coalesce(last, F.lit(0)) + tail).otherwise(F.col("number")).cast("int"))


def first_object(text: str | None) -> str | None:
    """The first balanced JSON object in free text; braces inside strings count like any others."""
    if text is None:
        return None
    start, depth = -1, 0
    for k, c in enumerate(text):
        if c == "{":
            start, depth = (k if depth == 0 else start), depth + 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                return text[start : k + 1]
    return None


@F.pandas_udf(StringType())
def json_object(s: pd.Series) -> pd.Series:
    return s.map(first_object)


def passages_of(text: str | None, term: str | None, reach: int = REACH) -> list[str]:
    """The surroundings of each place where the term stands as words, cut at white space."""
    out = []
    for m in re.finditer(rf"\b{re.escape(term)}\b", text, re.IGNORECASE) if text and term else ():
        a, b = max(0, m.start() - reach), min(len(text), m.end() + reach)
        while 0 < a < m.start() and not text[a - 1].isspace():
            a += 1
        while m.end() < b < len(text) and not text[b].isspace():
            b -= 1
        out.append(text[a:b].strip())
    return out


@F.pandas_udf(ArrayType(StringType()))
def passages(text: pd.Series, term: pd.Series) -> pd.Series:
    return pd.Series([passages_of(t, w) for t, w in zip(text, term, strict=True)])


#: Chapters whose passages are one list, and characters of passages that a worker holds before it gives them away.
LISTED, HELD = 64, 1 << 22


def gathered(matches: DataFrame) -> DataFrame:
    """matches: (id, chapter_id, term, full_text). (id, chapters, matches, block, passages): passages of all terms, each once, in order of chapters.

    A frequent term has more passages than a row can hold: a list is that of a block of LISTED
    chapters, by their ids, and an id has a row for each of its blocks; chapters and matches are those of the whole id.
    """

    def run(batches):
        for b in batches:
            made: list[tuple] = []
            size = 0
            for r in zip(*(b.column(c).to_pylist() for c in ("id", "chapter_id", "term", "full_text")), strict=True):
                for k, p in enumerate(passages_of(r[3], r[2])):
                    made.append((*r[:3], k, p))
                    size += len(p)
                    if size >= HELD:
                        yield batch(made)
                        made, size = [], 0
            yield batch(made)

    def batch(made: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string()))], ["id", "chapter_id", "term", "k", "passage"])

    from tesserae.session import ship

    ship(matches.sparkSession)
    given = matches.select(F.col("id").cast("bigint"), F.col("chapter_id").cast("bigint"), "term", "full_text")
    rows = given.mapInArrow(run, "id bigint, chapter_id bigint, term string, k int, passage string")
    first = rows.groupBy("id", "chapter_id", "passage").agg(F.min(F.struct("term", "k")).alias("at"), F.count(F.lit(1)).alias("n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("chapter_id", "at", "passage"))), lambda s: s["passage"])
    block = F.floor(F.col("chapter_id") / LISTED).alias("block")
    parts = written(first.groupBy("id", block).agg(F.count_distinct("chapter_id").alias("own"), F.sum("n").alias("n"), listed.alias("passages")))
    totals = parts.groupBy("id").agg(F.sum("own").alias("chapters"), F.sum("n").alias("matches"))
    return parts.join(totals, "id").select("id", "chapters", "matches", "block", "passages")


def outcome(current: Column, passages_: Column, said: Column, quoted: Column, error: Column) -> Column:
    """What becomes of an answer drawn from passages: a quotation that stands in none of them is made up, and the answer doesn't count."""
    from tesserae.functions.origins import is_placeholder_value, is_unresolved

    q = norm_search(quoted)
    real = (q == "") | F.exists(passages_, lambda p: F.contains(norm_search(p), q))
    return (
        F.when(~is_placeholder_value(current), "kept_existing")
        .when(F.coalesce(F.size(passages_), F.lit(0)) <= 0, "no_passages")
        .when(error.isNotNull(), "error")
        .when(is_unresolved(said) | ~real, "not_stated")
        .otherwise("would_write")
    )
