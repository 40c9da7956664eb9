"""Read queries of a directory: search, roster, profile, factions, books, casts, graph, snapshots."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.names import strip
from tesserae.model import Directory
from tesserae.operators.search import containing, postings

SEARCH_LIMIT = 40


def nocase(c: Column) -> Column:
    """ASCII letters without case, as the roster is sorted."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def reading_order(d: Directory) -> DataFrame:
    """Chapters with their books' place in the series."""
    books = d.books.select("book_id", "series_order", F.col("title").alias("book_title"))
    return d.chapters.select("chapter_id", "book_id", "chapter_number", "title").join(books, "book_id")


def search(d: Directory, query: str | None, limit: int = SEARCH_LIMIT) -> DataFrame:
    """Characters one of whose keys contains the query, which is trimmed and lower-cased; % and _ in it are wildcards. An empty query finds nothing."""
    q = (query or "").strip().lower()
    found = d.aliases.where(F.lit(bool(q)) & F.col("alias_norm").ilike(f"%{q}%")).select("character_id")
    hits = d.characters.join(found, "character_id", "left_semi").select("character_id", "primary_name", "character_type")
    return hits.orderBy("primary_name", "character_id").limit(limit)


def alias_postings(d: Directory) -> DataFrame:
    """(gram, alias_norm): the trigrams of all keys; written with a snapshot, it answers searches without a scan of the aliases."""
    return postings(d.aliases.select("alias_norm").distinct().withColumn("key", F.col("alias_norm")), "key", "alias_norm").withColumnRenamed("key", "alias_norm")


def search_many(d: Directory, queries: DataFrame, index: DataFrame | None = None, limit: int = SEARCH_LIMIT) -> DataFrame:
    """(query, character_id, primary_name, character_type): what ``search`` finds for each distinct query, by name, all at once.

    Queries (query) are trimmed and lower-cased; % and _ are letters here. index: ``alias_postings``, saved. Keys meet queries
    by trigrams, and only those that contain the query meet characters.
    """
    q = queries.select("query", F.lower(F.trim("query")).alias("pattern")).where("pattern <> ''").distinct()
    keys = d.aliases.select("alias_norm").distinct().withColumn("key", F.col("alias_norm"))
    found = containing(q.select("pattern"), keys, "key", "alias_norm", None if index is None else index.withColumnRenamed("alias_norm", "key"))
    # who is among the first of a query is among the first of a key that contains it, so no key needs more than that
    owners = d.aliases.select("alias_norm", "character_id").distinct().join(d.characters.select("character_id", "primary_name", "character_type"), "character_id")
    own = F.row_number().over(Window.partitionBy("alias_norm").orderBy("primary_name", "character_id"))
    owners = owners.withColumn("k", own).where(F.col("k") <= limit).drop("k")
    named = found.withColumnRenamed("key", "alias_norm").join(owners, "alias_norm").drop("alias_norm").distinct()
    first = F.row_number().over(Window.partitionBy("pattern").orderBy("primary_name", "character_id"))
    return named.withColumn("k", first).where(F.col("k") <= limit).join(q, "pattern").select("query", "character_id", "primary_name", "character_type")


def counts_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def roster(d: Directory) -> DataFrame:
    """Every character with its number of appearances, none included, by name without case."""
    counted = d.characters.join(counts_by(d.appearances, "character_id", "n"), "character_id", "left")
    return counted.select("character_id", "primary_name", "character_type", "nationality", F.coalesce("n", F.lit(0)).alias("appearances")).orderBy(nocase(F.col("primary_name")), "character_id")


def edges_of(d: Directory) -> DataFrame:
    """Both ends' view of every relationship: (character_id, other_id, ...), a loop once."""
    r = d.relationships.select("character_a", "character_b", "relationship_type", "directed", "description", "first_chapter_id")
    ends = F.array_distinct(F.array("character_a", "character_b"))
    both = r.withColumn("character_id", F.explode(ends))
    return both.withColumn("other_id", F.when(F.col("character_a") == F.col("character_id"), F.col("character_b")).otherwise(F.col("character_a")))


def named_edges(d: Directory) -> DataFrame:
    """Relationships from each end with the other's name, "?" where there is no such row."""
    names = d.characters.select(F.col("character_id").alias("other_id"), F.col("primary_name").alias("other"))
    return edges_of(d).join(names, "other_id", "left").withColumn("other", F.coalesce("other", F.lit("?")))


def appearances_of(d: Directory) -> DataFrame:
    a = d.appearances.join(reading_order(d), "chapter_id")
    return a.select("character_id", "chapter_id", "series_order", "book_title", "chapter_number", "title", "name_used", "whereabouts", "notable_actions", "alliances_shown", "demeanor")


def mentions_of(d: Directory) -> DataFrame:
    return d.mentions.join(reading_order(d), "chapter_id").select("character_id", "chapter_id", "series_order", "book_title", "chapter_number", "title", "name_used", "context")


def memberships(d: Directory) -> DataFrame:
    f = d.factions.select("faction_id", "name", "faction_type")
    return d.character_factions.select("character_id", "faction_id", "role").join(f, "faction_id")


def listed(df: DataFrame, key: str, name: str, fields: list[str]) -> DataFrame:
    """One row for each key with its rows as a sorted array of structs."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def profiles(d: Directory, character_id: int | None = None) -> DataFrame:
    """Characters with aliases, appearances, mentions, relationships and factions nested in reading order: one plan, whatever the number of lists."""
    only = (lambda df: df) if character_id is None else (lambda df: df.where(F.col("character_id") == character_id))
    parts = [
        listed(only(d.aliases), "character_id", "aliases", ["alias_type", "alias_text"]),
        listed(only(appearances_of(d)), "character_id", "appearances", ["series_order", "chapter_number", "chapter_id", "name_used", "whereabouts"]),
        listed(only(mentions_of(d)), "character_id", "mentions", ["series_order", "chapter_number", "chapter_id", "context"]),
        listed(only(named_edges(d)), "character_id", "relationships", ["relationship_type", "other", "other_id", "directed", "description"]),
        listed(only(memberships(d)), "character_id", "factions", ["faction_type", "name", "role"]),
    ]
    out = only(d.characters)
    for p in parts:
        out = out.join(p, "character_id", "left")
    return out


def factions(d: Directory) -> DataFrame:
    """Factions with how many belong to them."""
    sized = d.factions.join(counts_by(d.character_factions, "faction_id", "n"), "faction_id", "left")
    return sized.select("faction_id", "name", "faction_type", F.coalesce("n", F.lit(0)).alias("members")).orderBy("faction_type", "name")


def faction_members(d: Directory, faction_id: int | None = None) -> DataFrame:
    """Members, leaders first, then by name."""
    rows = d.character_factions if faction_id is None else d.character_factions.where(F.col("faction_id") == faction_id)
    people = d.characters.select("character_id", "primary_name", "character_type")
    return rows.select("faction_id", "character_id", "role").join(people, "character_id").orderBy("faction_id", (F.col("role") == "leader").desc(), "primary_name", "character_id")


def books(d: Directory) -> DataFrame:
    """Books with their chapters nested in order."""
    chapters = listed(d.chapters, "book_id", "chapters", ["chapter_number", "chapter_id", "title", "word_count"])
    return d.books.join(chapters, "book_id", "left").select("book_id", "series_order", "slot", "label", "title", F.col("is_prequel").cast("boolean"), "chapters").orderBy("series_order")


def cast(d: Directory, chapter_id: int | None = None) -> DataFrame:
    """Who is in a chapter, and who is only spoken of."""
    people = d.characters.select("character_id", "primary_name", "character_type")
    seen = d.appearances.select("chapter_id", "character_id", F.lit("present").alias("how"), "name_used")
    told = d.mentions.select("chapter_id", "character_id", F.lit("mentioned").alias("how"), "name_used")
    rows = seen.unionByName(told)
    rows = rows if chapter_id is None else rows.where(F.col("chapter_id") == chapter_id)
    return rows.join(people, "character_id").orderBy("chapter_id", F.col("how").desc(), "primary_name", "character_id")


def graph_nodes(d: Directory, chapter_id: int | None = None) -> DataFrame:
    """Characters with their appearances and first faction by priority; those of one chapter only, if it is given (0 is as good as none)."""
    from tesserae.functions.values import PRIORITY

    people = d.characters.select("character_id", "primary_name", "character_type")
    if chapter_id:
        people = people.join(d.appearances.where(F.col("chapter_id") == chapter_id), "character_id", "left_semi")
    rank = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("faction_type"))
    first = memberships(d).groupBy("character_id").agg(F.min_by("name", F.struct(F.when(rank > 0, rank).otherwise(99), "faction_id")).alias("faction"))
    out = people.join(counts_by(d.appearances, "character_id", "n"), "character_id", "left").join(first, "character_id", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("character_id", "primary_name", "character_type", n.alias("appearances"), F.least(n * 3, F.lit(40)).alias("bonus"), "faction").withColumn("size", F.col("bonus") + 18).drop("bonus")


def graph_edges(d: Directory, chapter_id: int | None = None) -> DataFrame:
    """Relationships both of whose ends are among the nodes."""
    r = d.relationships.select("character_a", "character_b", "relationship_type", F.col("directed").cast("boolean"))
    if not chapter_id:
        return r
    own = d.appearances.where(F.col("chapter_id") == chapter_id).select("character_id").distinct()
    a, b = own.withColumnRenamed("character_id", "character_a"), own.withColumnRenamed("character_id", "character_b")
    return r.join(a, "character_a", "left_semi").join(b, "character_b", "left_semi").select(r.columns)


def snapshot_order(books_of_snapshots: DataFrame) -> DataFrame:
    """(slot, series_order) of snapshots by what is in them, not by their names. books_of_snapshots: the books of all, with the column snapshot."""
    return books_of_snapshots.groupBy("snapshot").agg(F.max("series_order").alias("at")).orderBy("at", "snapshot")


def select_snapshot(order: DataFrame, wanted: str | int | None) -> str | None:
    """The snapshot asked for, by slot or number; the earliest if there is none such, so that nothing later is shown by mistake. order: one row for each snapshot."""
    from tesserae.functions.names import slot_of_number

    key = slot_of_number(F.lit(str(wanted if wanted is not None else "")))
    rank = F.when(F.col("snapshot") == key, 0).otherwise(1)
    first = order.orderBy(rank, "at", "snapshot").limit(1).collect()
    return first[0]["snapshot"] if first else None


def select_snapshots(order: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, snapshot): for every request the snapshot it gets, by slot or number and without regard to case; the earliest where there is none such. order: as above."""
    from tesserae.functions.names import slot_of_number

    earliest = order.agg(F.min_by("snapshot", F.struct("at", "snapshot")).alias("earliest"))
    there = order.select("snapshot").distinct()
    asked = wanted.select("wanted").distinct().withColumn("key", slot_of_number(F.lower(F.coalesce("wanted", F.lit("")))))
    met = asked.join(there, F.col("snapshot") == F.col("key"), "left").crossJoin(F.broadcast(earliest))  # one row
    return met.select("wanted", F.coalesce("snapshot", "earliest").alias("snapshot"))


def resolve_book(d: Directory, wanted: str) -> DataFrame:
    """The book of a slot, of a number as a slot, or of a place in the series, in this order; no row if there is none."""
    from tesserae.functions.names import slot_of_number

    w = strip(F.lit(str(wanted)))
    number = F.when(F.rlike(w, F.lit("^[0-9]+$")), w.cast("int"))
    rank = F.when(F.col("slot") == slot_of_number(w), 1).when(F.col("series_order") == number, 2)
    return d.books.withColumn("rank", rank).where("rank is not null").orderBy("rank").limit(1).select("book_id", "series_order", "slot", "label", "title")


def chapters_between(d: Directory, book_id: int | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Chapters in reading order, of one book or of all, with either end of the range of numbers open; those without text are left out."""
    c = d.chapters.where("trim(full_text) <> ''")
    for wanted in ((F.col("book_id") == book_id) if book_id is not None else None, (F.col("chapter_number") >= first) if first is not None else None, (F.col("chapter_number") <= last) if last is not None else None):
        c = c if wanted is None else c.where(wanted)
    b = d.books.select("book_id", "series_order")
    return c.join(b, "book_id").select("chapter_id", "book_id", "series_order", "chapter_number", "title", "full_text").orderBy("series_order", "chapter_number")


def chapter_text(d: Directory, book: str, number: int) -> DataFrame:
    """The text of a chapter by its book (as ``resolve_book`` takes it) and number; no row if there is none."""
    return d.chapters.where(F.col("chapter_number") == number).join(resolve_book(d, book).select("book_id", "series_order"), "book_id").select("chapter_id", "series_order", "chapter_number", "title", "full_text")


def chapter_label(series_order: Column, chapter_number: Column, long: bool = False) -> Column:
    """b3_c7, or Bk 3 Ch 7; null if either number is."""
    n = [x.cast("string") for x in (series_order, chapter_number)]
    return F.concat(F.lit("Bk "), n[0], F.lit(" Ch "), n[1]) if long else F.concat(F.lit("b"), n[0], F.lit("_c"), n[1])


def shortened(texts: Column, most: int) -> Column:
    """The first texts of a list, and how many more there are."""
    n = F.size(texts)
    return F.when(n > most, F.concat(F.slice(texts, 1, most), F.array(F.concat(F.lit("... "), (n - most).cast("string"), F.lit(" more"))))).otherwise(texts)


def cut(text: Column, most: int) -> Column:
    """The first characters of a text, as long as a prompt or a report takes."""
    return F.left(text, F.lit(most))


def noted(rows: DataFrame, column: str, wanted: str, unwanted: str) -> DataFrame:
    """Rows whose note has one piece of text and not another, ASCII letters without case; rows without a note are in neither."""
    note = nocase(F.col(column))
    return rows.where(F.contains(note, nocase(F.lit(wanted))) & ~F.contains(note, nocase(F.lit(unwanted))))


def legend(nodes: DataFrame, most: int = 12) -> DataFrame:
    """The first groups of a graph's nodes, by name, each once."""
    return nodes.where("faction is not null").select("faction").distinct().orderBy("faction").limit(most)
