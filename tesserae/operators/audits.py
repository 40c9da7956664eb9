"""Audits of a directory. Each gives the rows to look at; suppression lists are anti joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.durable import written
from tesserae.functions import names as N
from tesserae.functions import values as V
from tesserae.model import POINTERS, PUBLIC, UNIQUE, Directory
from tesserae.operators import search
from tesserae.operators.ranks import medians, ranked
from tesserae.operators.read import counts_by, edges_of
from tesserae.operators.resolve import near_duplicates


def people(d: Directory) -> DataFrame:
    return d.characters.select("character_id", "primary_name", "character_type")


def dependents(d: Directory) -> DataFrame:
    """(character_id, appearances, relationships, factions), none included; a loop is one relationship."""
    out = people(d).select("character_id")
    for name, rows in (("appearances", d.appearances), ("relationships", edges_of(d)), ("factions", d.character_factions)):
        out = out.join(counts_by(rows, "character_id", name), "character_id", "left")
    return out.na.fill(0, ["appearances", "relationships", "factions"])


def generic_aliases(d: Directory) -> DataFrame:
    a = d.aliases.select("character_id", "alias_text", "alias_type", "is_primary")
    flagged = a.where(N.is_generic(F.col("alias_text")) | (~F.col("is_primary") & N.is_suspect(F.col("alias_text"))))
    return flagged.join(people(d), "character_id").select("character_id", "primary_name", "alias_text", "alias_type")


def _odd(d: Directory) -> DataFrame:
    n, kind = F.col("primary_name"), F.col("character_type")
    check = F.when(N.is_placeholder(n), "placeholder").when(N.is_collective(n, kind), "collective").when(N.is_title(n), "title")
    return people(d).withColumn("verdict", check).where("verdict is not null")


def odd_names(d: Directory) -> DataFrame:
    """Primary names that are titles, placeholders or species, with what hangs on them; a title with more than two appearances is to be renamed."""
    flagged = _odd(d)
    return flagged.join(dependents(d), "character_id").withColumn("rename", (F.col("verdict") == "title") & (F.col("appearances") > 2))


def collisions(d: Directory, acknowledged: bool = False) -> DataFrame:
    """Aliases that are another character's primary name, by what kind they are; or those that were looked at and kept. Of several owners of a name the last, as the report has it."""
    mine = d.aliases.where(~F.col("is_primary")).select("character_id", "alias_text", "alias_norm", "alias_type")
    owners = people(d).groupBy(N.norm(F.col("primary_name")).alias("alias_norm")).agg(F.max("character_id").alias("other_id"), F.max_by("primary_name", "character_id").alias("other"))
    met = mine.join(owners, "alias_norm").where("character_id <> other_id").join(people(d).select("character_id", "primary_name"), "character_id")
    known = d.acknowledged_collisions.select(F.col("owner_cid").alias("character_id"), F.col("other_cid").alias("other_id"), "alias_norm")
    bucket = F.when(F.col("alias_type") == "given_name", "possible-duplicate").otherwise(F.col("alias_type"))
    known = known.join(owners.select("other_id"), "other_id", "left_semi")  # what was looked at may name every character of a name; one is asked for
    kept = met.join(known.hint("merge"), ["character_id", "other_id", "alias_norm"], "left_semi" if acknowledged else "left_anti")
    return kept.select("character_id", F.col("primary_name").alias("owner"), F.col("alias_text").alias("alias"), bucket.alias("bucket"), "other_id", "other")


def all_collisions(d: Directory) -> DataFrame:
    """``collisions`` with every other owner of the name, each unless it was looked at and kept.

    There may be as many rows as a name has aliases and owners, multiplied. Owners come in lists of PAIRED of a name, and whom an alias
    is not to meet is told beside it, so that no pairs are moved.
    """
    rows = people(d).select(N.norm(F.col("primary_name")).alias("alias_norm"), F.col("primary_name").alias("other"), F.col("character_id").alias("other_id")).where("other_id is not null and alias_norm is not null")
    sizes = rows.groupBy("alias_norm").agg(F.ceil(F.count(F.lit(1)) / PAIRED).cast("int").alias("parts"))
    dealt = lambda df: df.join(sizes, "alias_norm").withColumn("part", F.pmod(F.xxhash64("other_id"), F.col("parts")).cast("int")).drop("parts")
    owners = dealt(rows.groupBy("alias_norm", "other", "other_id").agg(F.count(F.lit(1)).cast("int").alias("n"))).groupBy("alias_norm", "other", "n", "part").agg(F.collect_list("other_id").alias("ids"))
    known = d.acknowledged_collisions.select(F.col("owner_cid").alias("character_id"), F.col("other_cid").alias("other_id"), "alias_norm")
    known = dealt(known).groupBy("character_id", "alias_norm", "part").agg(F.collect_set("other_id").alias("known"))
    mine = d.aliases.where(~F.col("is_primary")).select("character_id", "alias_text", "alias_norm", "alias_type").join(people(d).select("character_id", "primary_name"), "character_id")
    each = mine.join(sizes, "alias_norm").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").join(known.hint("merge"), ["character_id", "alias_norm", "part"], "left")
    free = F.array_except("ids", F.array_union(F.coalesce("known", F.array().cast("array<bigint>")), F.array("character_id")))
    met = each.join(owners, ["alias_norm", "part"]).withColumn("free", free)
    every = F.when(F.col("n") == 1, F.col("free")).otherwise(F.flatten(F.transform("free", lambda x: F.array_repeat(x, F.col("n")))))  # an owner who is there twice
    bucket = F.when(F.col("alias_type") == "given_name", "possible-duplicate").otherwise(F.col("alias_type"))
    return met.select("character_id", F.col("primary_name").alias("owner"), F.col("alias_text").alias("alias"), bucket.alias("bucket"), F.explode(every).alias("other_id"), "other")


def similar_names(d: Directory, cutoff: float = V.NEAR) -> DataFrame:
    """Pairs of names alike but not equal, neither an alias of the other, not confirmed as distinct."""
    by = people(d).groupBy(N.norm(F.col("primary_name")).alias("name")).agg(F.max("character_id").alias("id"))
    pairs = near_duplicates(by.select("name"), cutoff)
    a, b = by.withColumnsRenamed({"name": "a", "id": "a_id"}), by.withColumnsRenamed({"name": "b", "id": "b_id"})
    met = pairs.join(a, "a").join(b, "b").withColumn("low", F.least("a_id", "b_id")).withColumn("high", F.greatest("a_id", "b_id"))
    known = d.distinct_pairs.select(F.col("cid_low").alias("low"), F.col("cid_high").alias("high"))
    mine = d.aliases.select(F.col("character_id").alias("a_id"), F.col("alias_norm").alias("b"))
    yours = d.aliases.select(F.col("character_id").alias("b_id"), F.col("alias_norm").alias("a"))
    free = met.join(known, ["low", "high"], "left_anti").join(mine, ["a_id", "b"], "left_anti").join(yours, ["b_id", "a"], "left_anti")
    first = F.row_number().over(Window.partitionBy("low", "high").orderBy("a"))
    return free.withColumn("k", first).where("k = 1").select("a_id", "a", "b_id", "b", "ratio")


def empty_shells(d: Directory) -> DataFrame:
    """Rows of type "other" to which nothing points, allowed names aside."""
    rows = people(d).where((F.col("character_type") == "other") & ~N.norm(F.col("primary_name")).isin(*V.ALLOWED))
    for used in (d.appearances, d.mentions, edges_of(d), d.character_factions):
        rows = rows.join(used.select("character_id"), "character_id", "left_anti")
    return rows


def reveals(d: Directory) -> DataFrame:
    """Disguises that are merged too early or not yet, with what is wrong: before its book a persona is a row of its own, from then on an alias."""
    at = d.books.agg(F.max("series_order").alias("book"))
    owners = people(d).groupBy(N.norm(F.col("primary_name")).alias("persona_norm")).agg(F.min("character_id").alias("row_id"), F.min_by("primary_name", "character_id").alias("row_name"))
    masks = d.aliases.where("alias_type = 'disguise'").select(F.col("character_id").alias("true_cid"), F.col("alias_norm").alias("persona_norm")).distinct().withColumn("masked", F.lit(True))
    m = d.disguise_map.crossJoin(F.broadcast(at)).join(owners, "persona_norm", "left").join(masks, ["true_cid", "persona_norm"], "left")
    apart, masked = F.col("row_id").isNotNull() & (F.col("row_id") != F.col("true_cid")), F.coalesce("masked", F.lit(False))
    past = F.coalesce(F.col("book") >= F.col("reveal_book"), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(past & apart, "separate past reveal"),
            F.when(past & ~masked, "alias missing"),
            F.when(~past & ~apart, "row missing"),
            F.when(~past & masked, "alias too early"),
        )
    )
    flagged = m.withColumn("problems", found).where(F.size("problems") > 0)
    return flagged.select("persona_norm", "true_cid", "reveal_book", "book", F.when(past, "merged").otherwise("separate").alias("expected"), F.array_join("problems", "; ").alias("problems"))


def article_duplicates(d: Directory) -> DataFrame:
    """A character's "the X" beside "X"."""
    a = d.aliases.select("character_id", "alias_norm", "alias_text")
    bare = a.select("character_id", F.concat(F.lit("the "), "alias_norm").alias("alias_norm"), F.col("alias_text").alias("bare_form"))
    return a.join(bare, ["character_id", "alias_norm"]).join(people(d), "character_id").select("character_id", "primary_name", F.col("alias_text").alias("the_form"), "bare_form")


def name_tokens(d: Directory) -> DataFrame:
    """(character_id, tokens): the words of primary and given names without ranks."""
    own = d.aliases.where(F.col("alias_type").isin("primary", "given_name"))
    words = own.select("character_id", N.words(N.strip_titles(F.col("alias_norm"))).alias("w"))
    return words.groupBy("character_id").agg(F.array_distinct(F.flatten(F.collect_list("w"))).alias("tokens"))


def rank_duplicates(d: Directory) -> DataFrame:
    """Aliases that are the name itself with a rank."""
    a = d.aliases.where(F.col("alias_type").isin(*V.DROPPABLE)).join(name_tokens(d), "character_id")
    return a.where(N.is_rank_decorated(F.col("alias_norm"), F.col("tokens"))).join(people(d), "character_id").select("character_id", "primary_name", "alias_text", "alias_type")


def alias_cleanup(d: Directory) -> DataFrame:
    """What is to become of every alias that may go."""
    siblings = d.aliases.groupBy("character_id").agg(F.collect_set("alias_norm").alias("siblings"))
    none = F.array().cast("array<string>")
    a = d.aliases.where(F.col("alias_type").isin(*V.DROPPABLE)).join(name_tokens(d), "character_id", "left").join(siblings, "character_id")
    verdict = N.alias_verdict(F.col("alias_norm"), F.col("alias_type"), F.col("notes"), F.coalesce("tokens", none), F.col("siblings"))
    return a.withColumn("v", verdict).select("character_id", "alias_norm", "alias_type", "v.action", "v.rule")


#: Characters of one name and kind that a task pairs at once.
PAIRED = 4096


def _fuller(d: Directory) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What makes pairs of fuller names, none of it larger than the directory.

    shorts (short_id, short, kind, taken): characters whose name others begin with; taken: names of those that they have as aliases.
    longs (long_id, long, long_norm, short, kind): characters with each such name that is no alias of theirs. apart (short_id, long_id): pairs
    confirmed as distinct, either way round, and everybody with themselves. Distinct names meet by a name's first words. What is as large as the directory
    is joined by sorting: the planner takes lists for short ones, and would send it to the driver.
    """
    rows = people(d)
    w = rows.select("primary_name").distinct().withColumn("w", N.words(N.match_key(F.col("primary_name")))).where(F.size("w") > 0)
    begins = w.where(F.size("w") > 1).select(F.col("primary_name").alias("long"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.array_join(F.slice(F.col("w"), F.lit(1), k), " "))).alias("key"))
    pairs = begins.join(w.select(F.col("primary_name").alias("short"), F.array_join("w", " ").alias("key")), "key").select("long", "short").where(N.is_fuller(F.col("long"), F.col("short")))
    pairs = written(pairs.withColumn("short_norm", N.norm(F.col("short"))).withColumn("long_norm", N.norm(F.col("long"))))
    own = lambda name, id_: rows.select(F.col("primary_name").alias(name), F.col("character_id").alias(id_), F.col("character_type").alias("kind")).where("kind is not null")
    a = d.aliases.select(F.col("character_id"), "alias_norm")
    linked = a.select(F.col("character_id").alias("long_id"), F.col("alias_norm").alias("short_norm"))
    longs = own("long", "long_id").join(pairs, "long").join(linked, ["long_id", "short_norm"], "left_anti").select("long_id", "long", "long_norm", "short", "kind")
    taken = a.join(pairs.select(F.col("long_norm").alias("alias_norm")).distinct(), "alias_norm", "left_semi").groupBy(F.col("character_id").alias("short_id")).agg(F.collect_set("alias_norm").alias("taken"))
    shorts = own("short", "short_id").join(pairs.select("short").distinct(), "short", "left_semi").join(taken.hint("merge"), "short_id", "left")
    shorts = shorts.select("short_id", "short", "kind", F.coalesce("taken", F.array().cast("array<string>")).alias("taken"))
    known = d.distinct_pairs.where("cid_low < cid_high").select(F.col("cid_low").alias("short_id"), F.col("cid_high").alias("long_id"))
    apart = known.union(known.select("long_id", "short_id")).union(rows.select("character_id", "character_id")).distinct()
    return shorts, longs, apart


def fuller_names(d: Directory) -> DataFrame:
    """(short_id, short, long_id, long): names that begin with another character's whole name, of the same type, not linked by an alias.

    There may be as many pairs as two names have characters, multiplied. They are made in parts of
    PAIRED characters by one join; whom a pair is not to have is told beside it, so that no pairs are moved.
    """
    shorts, longs, apart = _fuller(d)
    sizes = shorts.groupBy("short", "kind").agg(F.ceil(F.count(F.lit(1)) / PAIRED).cast("int").alias("parts"))
    dealt = shorts.join(sizes, ["short", "kind"]).withColumn("part", F.pmod(F.xxhash64("short_id"), F.col("parts")).cast("int")).drop("parts")
    kept = longs.join(apart.groupBy("long_id").agg(F.collect_set("short_id").alias("apart")), "long_id")
    each = kept.join(sizes, ["short", "kind"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    met = each.join(dealt, ["short", "kind", "part"]).where(~F.array_contains("taken", F.col("long_norm")) & ~F.array_contains("apart", F.col("short_id")))
    return met.select("short_id", "short", "long_id", "long")


def fuller_counts(d: Directory) -> DataFrame:
    """(character_id, n): how many rows of ``fuller_names`` have the character as the short one, counted by names instead of pairs."""
    shorts, longs, apart = _fuller(d)
    shorts = shorts.hint("merge")
    free = ~F.array_contains("taken", F.col("long_norm"))
    sized = longs.groupBy("short", "kind", "long_norm").agg(F.count(F.lit(1)).alias("n"))
    every = shorts.join(sized, ["short", "kind"]).where(free).select("short_id", "n")
    less = longs.join(apart.hint("merge"), "long_id").join(shorts, ["short_id", "short", "kind"]).where(free).select("short_id", F.lit(-1).cast("bigint").alias("n"))
    return every.union(less).groupBy(F.col("short_id").alias("character_id")).agg(F.sum("n").alias("n")).where("n > 0")


def book_problems(d: Directory, file_slot: str | None = None) -> DataFrame:
    """(problem, slot): slots that are ill-formed or used twice, empty labels, a file named after another book than its last."""
    b = d.books.select("series_order", "slot", "label")
    bad = F.col("slot").isNull() | ~N.slot_valid(F.coalesce("slot", F.lit("")))
    twice = F.row_number().over(Window.partitionBy("slot").orderBy("series_order")) > 1
    marked = b.select("slot", "label", "series_order", F.when(bad, "bad slot").when(twice, "duplicate slot").alias("of_slot"), F.when(F.trim(F.coalesce("label", F.lit(""))) == "", "empty label").alias("of_label"))
    rows = marked.select(F.explode(F.array_compact(F.array("of_slot", "of_label"))).alias("problem"), "slot")
    if file_slot is not None:
        last = b.agg(F.max_by("slot", "series_order").alias("slot")).where(F.col("slot") != file_slot)
        rows = rows.union(last.select(F.lit("file named after another book"), "slot"))
    return rows


def broken_keys(d: Directory, tables: list[str] | None = None) -> DataFrame:
    """(name, key, rows): keys that several rows have."""
    out = []
    for t in tables or UNIQUE:
        for k in UNIQUE[t]:
            twice = getattr(d, t).groupBy(*k).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
            out.append(twice.select(F.lit(f"{t}({', '.join(k)})").alias("name"), F.concat_ws("|", *[F.col(c).cast("string") for c in k]).alias("key"), "rows"))
    return reduce(DataFrame.unionByName, out)


def broken_pointers(d: Directory) -> DataFrame:
    """(name, value, rows): values that point to no row. Every table is read once for all its pointers, and only distinct values meet what they point to."""
    targets = sorted({(t, k) for *_, t, k in POINTERS})
    of: dict[str, list] = {}
    for i, (t, c, target, key) in enumerate(POINTERS):  # by numbers: names would make every row of a task's counts larger
        of.setdefault(t, []).append(F.struct(F.lit(i).alias("i"), F.lit(targets.index((target, key))).alias("target"), F.col(c).alias("value")))
    count = lambda df: df.groupBy("i", "target", "value").agg(F.count(F.lit(1)).alias("rows"))
    used = reduce(DataFrame.unionByName, [count(getattr(d, t).select(F.explode(F.array(*own)).alias("x")).select("x.*").where("value is not null")) for t, own in of.items()])
    there = reduce(DataFrame.unionByName, [getattr(d, t).select(F.lit(n).alias("target"), F.col(k).alias("value")) for n, (t, k) in enumerate(targets)])
    counted = used.join(there, ["target", "value"], "left_anti")
    return counted.select(F.element_at(F.array(*[F.lit(f"{t}.{c}") for t, c, *_ in POINTERS]), F.col("i") + 1).alias("name"), "value", "rows")


def primaries(d: Directory) -> DataFrame:
    """Characters with no primary alias or several."""
    n = d.aliases.groupBy("character_id").agg(F.count_if("is_primary").alias("n"))
    return people(d).join(n, "character_id", "left").select("character_id", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def _named(d: Directory) -> DataFrame:
    """(character_id, name, k): primary names and aliases as they are written, which comes first by k."""
    own = people(d).select("character_id", F.col("primary_name").alias("name"), F.lit(0).alias("k"))
    return own.union(d.aliases.select("character_id", "alias_text", F.when(F.col("is_primary"), 1).otherwise(2)))


def _stripped(named: DataFrame) -> DataFrame:
    """(name, term): every name once, and without white space at its ends."""
    once = written(named.select("name").distinct())  # otherwise the filter would go first, and strip every row's
    return once.withColumn("term", N.strip(F.col("name"))).where("term <> ''")


def terms(named: DataFrame, stripped: DataFrame) -> DataFrame:
    """(character_id, term): names of ``stripped`` that a character has, each once without regard to case."""
    rows = named.join(stripped, "name")
    return rows.groupBy("character_id", F.lower("term").alias("low")).agg(F.min_by("term", F.struct("k", "term")).alias("term")).drop("low")


def _occurs(text: Column, term: Column) -> Column:
    """How often a term stands in a text as words; the plain test comes first, for it is cheap."""
    quoted = F.concat(F.lit(r"(?iU)\b\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\b"))
    there = F.contains(F.replace(F.lower(text), F.lit("’"), F.lit("'")), F.replace(F.lower(term), F.lit("’"), F.lit("'")))
    return F.when(there, F.regexp_count(text, quoted)).otherwise(0)


def mentions_found(chapters: DataFrame, wanted: DataFrame, text: bool = False) -> DataFrame:
    """(chapter_id, term, n): terms that stand in a text, n times; with text the full_text, too. wanted: distinct terms, of which those without a word are nowhere.

    Every text is read once, where it lies, by an automaton of all terms. More terms than PASSES automata hold
    meet the chapters by their longest words, so that a term costs only chapters that
    have that word; it is then counted in the text itself, of which a chapter's terms share one copy.
    """
    parts = lambda c: F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: w != "")
    head = lambda c: F.array_max(F.transform(parts(c), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    once = written(wanted.select("term").distinct())  # otherwise the filter would go first, and take every row apart
    t = written(once.withColumn("head", head(F.col("term"))).where("head is not null"))
    c = chapters.select("chapter_id", "full_text").where("full_text is not null")
    more = ["full_text"] if text else []
    if (n := search.passes(t)) <= search.PASSES:
        return search.counted(c, "chapter_id", "full_text", t, n, text)
    found = lambda ts: F.filter(F.transform(ts, lambda x: F.struct(x.alias("term"), _occurs(F.col("full_text"), x).cast("bigint").alias("n"))), lambda s: s["n"] > 0)
    words = c.select("chapter_id", F.explode(F.array_distinct(F.split(F.lower("full_text"), r"(?U)\W+"))).alias("head"))
    wanted_there = words.join(t, "head").groupBy("chapter_id").agg(F.collect_set("term").alias("terms"))
    return c.join(wanted_there, "chapter_id").select("chapter_id", *more, F.explode(found("terms")).alias("x")).select("chapter_id", "x.term", "x.n", *more)


def mention_gaps(d: Directory, threshold: int = 1) -> DataFrame:
    """(character_id, chapter_id, kind, reliable, total): characters a text names but nobody noted, and notes that no text supports.

    missing: named threshold times or more by terms that are no common words; missing_noisy: by
    any terms; phantom: noted, but neither a term nor the name used stands in the text.

    Names are looked for as they are, each once; only of those that stand somewhere it is asked whose they are.
    Notes meet the terms of their chapter, and then the hits, once for both kinds of gap.
    """
    named = _named(d)
    stripped = _stripped(named)
    used = d.appearances.select("character_id", "chapter_id", F.coalesce("name_used", F.lit("")).alias("name_used"))
    found = written(mentions_found(d.chapters, stripped.select("term").union(used.select("name_used").where("name_used <> ''"))))  # read three times, the texts once
    low = lambda df: df.withColumn("low", F.lower("term"))
    stands = written(low(found.select("term").distinct()).select("low").distinct())
    of = terms(named, written(low(stripped).join(stands, "low", "left_semi").drop("low"))).withColumn("sure", ~N.is_noisy(F.col("term")))
    hits = found.join(of, "term").groupBy("character_id", "chapter_id").agg(F.sum(F.when(F.col("sure"), F.col("n")).otherwise(0)).alias("reliable"), F.sum("n").alias("total"))
    there = d.chapters.select("chapter_id").distinct().join(found.groupBy("chapter_id").agg(F.collect_set("term").alias("terms")), "chapter_id", "left")
    noted = used.join(there, "chapter_id").select("character_id", "chapter_id", F.coalesce(F.array_contains("terms", F.col("name_used")), F.lit(False)).alias("said"))
    kind = F.when(F.col("said").isNull() & (F.col("reliable") >= threshold), "missing").when(F.col("said").isNull() & (F.col("total") >= threshold), "missing_noisy").when(F.col("total").isNull() & ~F.col("said"), "phantom")
    rows = hits.join(noted, ["character_id", "chapter_id"], "full").withColumn("kind", kind).where("kind is not null")
    return rows.select("character_id", "chapter_id", "kind", F.coalesce("reliable", F.lit(0)).alias("reliable"), F.coalesce("total", F.lit(0)).alias("total"))


def evidence(claims: DataFrame, texts: DataFrame) -> DataFrame:
    """claims (id, evidence) with verified: the evidence stands in one of the texts (id, text), both normalised; an empty one always does."""
    e = N.norm_search(F.col("evidence"))
    met = claims.join(texts, "id", "left").withColumn("ok", (e == "") | F.coalesce(F.contains(N.norm_search(F.col("text")), e), F.lit(False)))
    return met.groupBy("id", "evidence").agg(F.bool_or("ok").alias("verified"))


def evidence_anywhere(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """claims (id, evidence) with verified: the evidence stands in any of the documents (key, text), both normalised; an empty one always does.

    All claims at once are looked for by an automaton, which reads every text where it lies. More than
    PASSES automata hold meet the texts instead: a word with others on both sides must stand in the text as it is, so
    a claim of three words or more meets the texts that have its longest such word, and is looked for there. Shorter ones
    are looked for by their trigrams in the distinct words, or pairs of words, of all texts.
    """
    e = claims.select("id", "evidence", N.norm_search(F.col("evidence")).alias("e"))
    said = written(e.where("e <> ''").select(F.col("e").alias("term")).distinct())
    if (n := search.passes(said)) <= search.PASSES:
        found = search.standing(documents.where("text is not null").select(N.norm_search(F.col("text")).alias("t")), said, n).withColumnRenamed("term", "e")
    else:
        found = _evidence_met(e, documents)
    return e.join(found.withColumn("ok", F.lit(True)), "e", "left").groupBy("id", "evidence").agg(F.bool_or((F.col("e") == "") | F.coalesce("ok", F.lit(False))).alias("verified"))


def _evidence_met(e: DataFrame, documents: DataFrame) -> DataFrame:
    """(e): normalised claims that stand in a document, where there are too many for automata."""
    e = e.withColumn("words", F.split("e", " "))
    inner = F.slice("words", 2, F.greatest(F.size("words") - 2, F.lit(0)))
    head = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    long = e.where(F.size("words") > 2).withColumn("head", head)
    t = documents.where("text is not null").select("key", N.norm_search(F.col("text")).alias("t"))
    listed = long.groupBy("head").agg(F.collect_set(F.struct("e")).alias("sought"))
    there = t.select("key", F.explode(F.array_distinct(F.split("t", " "))).alias("head")).join(listed, "head").groupBy("key").agg(F.flatten(F.collect_list("sought")).alias("sought"))
    hits = t.join(there, "key").select(F.explode(F.filter("sought", lambda s: F.contains(F.col("t"), s["e"]))).alias("x")).select("x.e")
    short = written(e.where((F.size("words") <= 2) & (F.col("e") != "")).select(F.col("e").alias("pattern"), F.size("words").alias("n")).distinct())
    parts = F.split("t", " ")
    last = F.size(parts) - 1
    pairs = F.zip_with(F.slice(parts, 1, last), F.slice(parts, 2, last), lambda x, y: F.concat_ws(" ", x, y))

    def seen(c: Column, n: int) -> DataFrame:
        distinct = t.select(F.explode(F.array_distinct(c)).alias("w")).distinct()
        return search.containing(short.where(F.col("n") == n).select("pattern"), distinct.withColumn("key", F.xxhash64("w")), "key", "w").select(F.col("pattern").alias("e"))

    return hits.union(seen(parts, 1)).union(seen(pairs, 2)).distinct()


def leaks(df: DataFrame, name: str, marks=V.PATH_MARKS) -> DataFrame:
    """(name, column, rows): text columns with a mark of a local path; all columns in one pass."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return df.sparkSession.createDataFrame([], "name string, column string, rows bigint")
    hit = lambda c: reduce(lambda a, b: a | b, [F.contains(F.lower(F.col(c)), F.lit(m.lower())) for m in marks])
    one = df.agg(*[F.count_if(hit(c)).alias(c) for c in texts])
    return one.unpivot([], texts, "column", "rows").where("rows > 0").select(F.lit(name).alias("name"), "column", "rows")


def export_problems(private: Directory, shown: Directory) -> DataFrame:
    """(name, column, rows) of a public snapshot that keeps too little or too much: counts that differ, private columns, sources, marks of paths."""
    out = []
    for t, columns in PUBLIC.items():
        p = getattr(shown, t)
        out.append(leaks(p, t))
        a, b = (x.agg(F.count(F.lit(1)).alias(n)) for x, n in ((getattr(private, t), "a"), (p, "b")))
        out.append(a.crossJoin(F.broadcast(b)).where("a <> b").select(F.lit(t).alias("name"), F.lit("count").alias("column"), F.abs(F.col("a") - F.col("b")).alias("rows")))
        for c in sorted(set(p.columns) - set(columns)):
            out.append(private.spark.createDataFrame([(t, f"private {c}", 0)], "name string, column string, rows bigint"))
    b = shown.books
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    checks = {"source_file": F.col("source_file").isNotNull(), "slot": blank("slot"), "label": blank("label")}
    for c, wrong in checks.items():
        out.append(b.where(wrong).agg(F.count(F.lit(1)).alias("rows")).where("rows > 0").select(F.lit("books").alias("name"), F.lit(c).alias("column"), "rows"))
    return reduce(DataFrame.unionByName, out)


def token_trend(rows: DataFrame, group: str, order: str, value: str, climb: float = 0.15) -> DataFrame:
    """(group, n, total, first, second, change, climbing): medians of the halves of an ordered series; fewer than four have none.

    The halves are told apart and their medians found by ranks, so a series may be of any length.
    """
    given = ranked(rows.where(F.col(value).isNotNull()).select(group, order, value), [group], [order], "k", "n")
    halves = given.withColumn("half", F.when(F.col("k") <= F.floor(F.col("n") / 2), 1).otherwise(2))
    middle = medians(halves.select(group, "half", value), [group, "half"], value)
    side = lambda k: F.max(F.when(F.col("half") == k, F.col("median")))
    out = middle.groupBy(group).agg(F.sum("n").alias("n"), side(1).alias("first"), side(2).alias("second"))
    total = rows.groupBy(group).agg(F.sum(value).alias("total"))
    out = out.join(total.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).select(group, "n", "total", "first", "second")
    enough = (F.col("n") >= 4) & (F.col("first") > 0)
    out = out.withColumn("change", F.when(enough, F.col("second") / F.col("first") - 1))
    return out.withColumn("climbing", F.coalesce(F.col("change") > climb, F.lit(False)))


#: What a full audit runs, by the names of its report.
CHECKS = {
    "generic aliases": generic_aliases,
    "odd names": odd_names,
    "collisions": collisions,
    "collisions kept": lambda d: collisions(d, acknowledged=True),
    "similar names": similar_names,
    "empty shells": empty_shells,
    "reveals": reveals,
    "article duplicates": article_duplicates,
    "rank duplicates": rank_duplicates,
    "fuller names": fuller_names,
    "book problems": book_problems,
    "broken keys": broken_keys,
    "broken pointers": broken_pointers,
    "primary aliases": primaries,
}
#: Checks whose rows are many times the directory's, or bear what their number doesn't hang on, by what counts them without making them.
COUNTED = {"fuller names": fuller_counts, "odd names": lambda d: _odd(d).select(F.lit(1).cast("bigint").alias("n"))}


def summary(d: Directory, checks: list[str] | None = None) -> DataFrame:
    """(name, rows): how many rows each check flags, in one plan."""
    rows = lambda name: COUNTED[name](d).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")) if name in COUNTED else CHECKS[name](d).agg(F.count(F.lit(1)).alias("rows"))
    one = lambda name: rows(name).select(F.lit(name).alias("name"), "rows")
    return reduce(DataFrame.unionByName, [one(name) for name in checks or CHECKS])


def dossier(d: Directory, character_id: int | None = None) -> DataFrame:
    """(character_id, primary_name, appearances, relationships, factions, neighbours, sources, findings): one character, or each, as an auditor reads it.

    neighbours: names at the other ends, each once; sources: labels of the chapters that anchor the
    character and the memberships; findings: the audits that name the character.
    """
    from tesserae.operators import read

    only = (lambda df: df) if character_id is None else (lambda df: df.where(F.col("character_id") == character_id))
    near = only(read.named_edges(d)).groupBy("character_id").agg(F.array_sort(F.collect_set("other")).alias("neighbours"))
    where_ = read.reading_order(d).select("chapter_id", "series_order", "chapter_number")
    anchors = only(d.characters).select("character_id", F.col("first_chapter_id").alias("chapter_id")).union(only(d.character_factions).select("character_id", "first_chapter_id")).where("chapter_id is not null")
    label = read.chapter_label(F.col("series_order"), F.col("chapter_number"))
    sources = anchors.hint("merge").join(where_, "chapter_id").groupBy("character_id").agg(F.transform(F.array_sort(F.collect_set(F.struct("series_order", "chapter_number", label.alias("label")))), lambda s: s["label"]).alias("sources"))
    named = {
        "generic alias": generic_aliases(d), "odd name": odd_names(d), "collision": collisions(d), "article duplicate": article_duplicates(d),
        "rank duplicate": rank_duplicates(d), "primary aliases": primaries(d), "empty shell": empty_shells(d), "fuller name": fuller_counts(d),
    }
    found = reduce(DataFrame.union, [only(df).select("character_id", F.lit(k).alias("finding")) for k, df in named.items()])
    findings = found.groupBy("character_id").agg(F.array_sort(F.collect_set("finding")).alias("findings"))
    out = only(d.characters).select("character_id", "primary_name").join(dependents(d), "character_id", "left")
    for x in (near, sources, findings):
        out = out.join(x, "character_id", "left")
    none = F.array().cast("array<string>")
    return out.select("character_id", "primary_name", "appearances", "relationships", "factions", *[F.coalesce(c, none).alias(c) for c in ("neighbours", "sources", "findings")])
