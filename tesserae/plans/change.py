"""Other changes of a directory: deletion, restoring, carrying over, reverting, cleaning, seeding, migrating.

Each is a plan (a table) and the next version made from it; nothing is changed in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.durable import written
from tesserae.functions import ages, origins
from tesserae.functions import names as N
from tesserae.functions import values as V
from tesserae.model import Directory
from tesserae.operators import audits
from tesserae.operators.read import reading_order
from tesserae.operators.write import new_ids

#: Where characters are pointed to.
ENDS = {
    "aliases": ["character_id"], "appearances": ["character_id"], "mentions": ["character_id"], "relationships": ["character_a", "character_b"], "character_factions": ["character_id"],
    "distinct_pairs": ["cid_low", "cid_high"], "acknowledged_collisions": ["owner_cid", "other_cid"], "disguise_map": ["true_cid"], "characters": ["character_id"],
}


def _without(df: DataFrame, ids: DataFrame, columns: list[str], how: str = "left_anti") -> DataFrame:
    """Rows no column of which is one of the ids; or with left_semi those some column of which is."""
    if how == "left_anti":
        return reduce(lambda x, c: x.join(ids.select(F.col("character_id").alias(c)), c, "left_anti"), columns, df).select(df.columns)
    marked = reduce(lambda x, c: x.join(ids.select(F.col("character_id").alias(c), F.lit(True).alias(f"__{c}")), c, "left"), columns, df)
    return marked.where(" or ".join(f"__{c}" for c in columns)).select(df.columns)


def deletion_counts(d: Directory, ids: DataFrame) -> DataFrame:
    """(name, rows): what deleting the characters takes along, table by table."""
    ids = ids.distinct()
    one = lambda t: _without(getattr(d, t), ids, ENDS[t], "left_semi").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("name"), "rows")
    return reduce(DataFrame.unionByName, [one(t) for t in ENDS])


def delete(d: Directory, ids: DataFrame) -> Directory:
    return d.having(**{t: _without(getattr(d, t), ids.distinct(), c) for t, c in ENDS.items()})


def delete_aliases(d: Directory, doomed: DataFrame) -> Directory:
    """Without the aliases (character_id, alias_norm); refuses as a whole if one of them is primary."""
    key = ["character_id", "alias_norm"]
    if d.aliases.where("is_primary").join(doomed, key, "left_semi").limit(1).count():
        raise ValueError("primary aliases are not deleted")
    return d.having(aliases=d.aliases.join(doomed, key, "left_anti"))


def chapter_keys(d: Directory) -> DataFrame:
    return reading_order(d).select("chapter_id", "series_order", "chapter_number")


def translated(source: Directory, target: Directory) -> DataFrame:
    """(chapter_id, new_id): chapters of one snapshot in another, by place in the series; null where it lacks them."""
    new = chapter_keys(target).withColumnRenamed("chapter_id", "new_id")
    return chapter_keys(source).join(new, ["series_order", "chapter_number"], "left").select("chapter_id", "new_id")


def restore_gaps(source: Directory, target: Directory, ids: DataFrame) -> DataFrame:
    """(kind, value): what the characters need that the target lacks; a restore goes ahead only if there is nothing."""
    chapters = translated(source, target).where("new_id is null").select("chapter_id")
    used = [_without(getattr(source, t), ids, ENDS[t], "left_semi").select("chapter_id") for t in ("appearances", "mentions")]
    lost = reduce(DataFrame.union, used).distinct().join(chapters, "chapter_id", "left_semi").select(F.lit("chapter").alias("kind"), F.col("chapter_id").cast("string").alias("value"))
    groups = _without(source.character_factions, ids, ["character_id"], "left_semi").join(source.factions.select("faction_id", "name_norm"), "faction_id").select("name_norm").distinct()
    groups = groups.join(target.factions.select("name_norm"), "name_norm", "left_anti").select(F.lit("faction").alias("kind"), F.col("name_norm").alias("value"))
    edges = _without(source.relationships, ids, ENDS["relationships"], "left_semi")
    others = edges.select(F.explode(F.array("character_a", "character_b")).alias("character_id")).distinct().join(ids, "character_id", "left_anti")
    others = others.join(source.characters.select("character_id", "primary_name"), "character_id").select("primary_name").join(target.characters.select("primary_name"), "primary_name", "left_anti")
    names = source.characters.join(ids, "character_id", "left_semi").select("primary_name").join(target.characters.select("primary_name"), "primary_name", "left_semi")
    return lost.union(groups).union(others.select(F.lit("character"), "primary_name")).union(names.select(F.lit("name taken"), "primary_name"))


def restore(source: Directory, target: Directory, ids: DataFrame) -> Directory:
    """The target with the characters of the source under new ids; refuses if something they need is missing."""
    ids = ids.distinct()
    if restore_gaps(source, target, ids).limit(1).count():
        raise ValueError("the target lacks what the characters need")
    last = target.characters.agg(F.coalesce(F.max("character_id"), F.lit(0)).alias("last")).first()["last"]
    own = source.characters.join(ids, "character_id", "left_semi")
    new = new_ids(own.select(F.col("character_id").alias("old")), "id", last, "old", ["old"])
    rest = source.characters.join(ids, "character_id", "left_anti").select(F.col("character_id").alias("old"), "primary_name").join(target.characters.select(F.col("character_id").alias("id"), "primary_name"), "primary_name")
    people = new.union(rest.select("old", "id"))
    chapters = translated(source, target)
    groups = source.factions.select(F.col("faction_id").alias("old"), "name_norm").join(target.factions.select(F.col("faction_id").alias("id"), "name_norm"), "name_norm").select("old", "id")

    def moved(df: DataFrame, c: str, ids: DataFrame, how: str = "inner") -> DataFrame:
        a, b = ids.columns
        return df.join(ids.select(F.col(a).alias(c), F.col(b).alias("__id")), c, how).withColumn(c, F.col("__id")).drop("__id")

    out = {"characters": moved(moved(own, "character_id", new), "first_chapter_id", chapters, "left")}
    for t in ("aliases", "appearances", "mentions", "character_factions", "relationships"):
        rows = _without(getattr(source, t), ids, ENDS[t], "left_semi")
        for c in ENDS[t]:
            rows = moved(rows, c, people)
        if "chapter_id" in rows.columns:
            rows = moved(rows, "chapter_id", chapters)
        if "faction_id" in rows.columns:
            rows = moved(rows, "faction_id", groups)
        out[t] = rows
    return target.having(**{t: getattr(target, t).unionByName(df.select(getattr(target, t).columns)) for t, df in out.items()})


def carry_forward(found: DataFrame, d: Directory, most: int) -> DataFrame:
    """found: (primary_name, nationality, db_file). With action and character_id: what the target can take over from snapshots up to book ``most``."""
    n = F.regexp_extract("db_file", r"(?i)_book(\d+)", 1)
    book = F.when(n != "", n.cast("int"))
    index = d.characters.select(N.norm_search(F.col("primary_name")).alias("key"), "character_id", F.col("nationality").alias("current"))
    index = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("character_id").alias("character_id"), F.min_by("current", "character_id").alias("current"))
    met = found.withColumn("key", N.norm_search(F.col("primary_name"))).withColumn("book", book).join(index, "key", "left")
    same = N.norm_search(F.col("current")) == N.norm_search(N.strip(F.col("nationality")))
    action = (
        F.when(F.col("book").isNull(), "skipped_no_book_number")
        .when(F.col("book") > most, "filtered_by_book")
        .when(F.col("n").isNull(), "not_found")
        .when(F.col("n") > 1, "ambiguous")
        .when(origins.is_placeholder_value(F.col("current")), "would_write")
        .when(same, "already_matches")
        .otherwise("conflict")
    )
    return met.withColumn("action", action).select("primary_name", "nationality", "db_file", "action", F.when(F.col("action").isin("would_write", "already_matches", "conflict"), F.col("character_id")).alias("character_id"))


def carried(d: Directory, plan: DataFrame) -> Directory:
    """The origins that would be written, written; only where there is still a placeholder."""
    new = plan.where("action = 'would_write'").groupBy("character_id").agg(F.min(N.strip(F.col("nationality"))).alias("__new"))
    c = d.characters.join(new, "character_id", "left")
    value = F.when(F.col("__new").isNotNull() & origins.is_placeholder_value(F.col("nationality")), F.col("__new")).otherwise(F.col("nationality"))
    return d.having(characters=c.withColumn("nationality", value).select(d.characters.columns))


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def main_series(d: Directory) -> DataFrame:
    """Characters that appear in a book that is no prequel."""
    books = d.books.where("not coalesce(is_prequel, false)").select("book_id")
    return d.appearances.join(d.chapters.select("chapter_id", "book_id"), "chapter_id").join(books, "book_id", "left_semi").select("character_id").distinct()


def prequel_fills(d: Directory, seed: Directory) -> DataFrame:
    """(character_id, field, value): traits that expire, filled on characters of the main series since the seed."""
    traits = list(V.GUARDED_TRAITS)
    rows = lambda x, name: x.characters.select("character_id", *traits).unpivot(["character_id"], traits, "field", name)
    met = rows(d, "value").join(rows(seed, "before"), ["character_id", "field"]).where(_empty("before") & ~_empty("value"))
    return met.join(main_series(d), "character_id", "left_semi").select("character_id", "field", "value")


def prequel_memberships(d: Directory, seed: Directory) -> DataFrame:
    """(character_id, faction_id): memberships that can be left, new since the seed, of its characters in the main series."""
    own = d.character_factions.select("character_id", "faction_id").join(d.factions.where(F.coalesce("faction_type", F.lit("other")).isin(*V.GUARDED_FACTIONS)).select("faction_id"), "faction_id", "left_semi")
    own = own.join(seed.characters.select("character_id"), "character_id", "left_semi").join(main_series(d), "character_id", "left_semi")
    return own.join(seed.character_factions.select("character_id", "faction_id"), ["character_id", "faction_id"], "left_anti").select("character_id", "faction_id")


def revert_prequel(d: Directory, seed: Directory) -> Directory:
    undo = prequel_fills(d, seed).groupBy("character_id").agg(F.collect_set("field").alias("__undo"))
    c = d.characters.join(undo, "character_id", "left")
    for t in V.GUARDED_TRAITS:
        c = c.withColumn(t, F.when(F.array_contains("__undo", F.lit(t)), None).otherwise(F.col(t)))
    left = d.character_factions.join(prequel_memberships(d, seed), ["character_id", "faction_id"], "left_anti")
    return d.having(characters=c.select(d.characters.columns), character_factions=left.select(d.character_factions.columns))


def trait_changes(d: Directory) -> DataFrame:
    """(character_id, field, before, after): ages and origins that are not in their normal form."""
    a, n = F.col("age"), F.col("nationality")
    rows = d.characters.select("character_id", F.explode(F.array(F.struct(F.lit("age").alias("field"), a.alias("before"), ages.normalized(a).alias("after")), F.struct(F.lit("nationality").alias("field"), n.alias("before"), origins.normalized(n).alias("after")))).alias("x"))
    return rows.select("character_id", "x.*").where("not (before <=> after)")


def normal_traits(d: Directory) -> Directory:
    return d.having(characters=d.characters.withColumn("age", ages.normalized(F.col("age"))).withColumn("nationality", origins.normalized(F.col("nationality"))))


def clean_aliases(d: Directory) -> Directory:
    """Without the aliases that the rules drop or collapse."""
    doomed = audits.alias_cleanup(d).where("action in ('DROP', 'COLLAPSE')").select("character_id", "alias_norm")
    return d.having(aliases=d.aliases.join(doomed, ["character_id", "alias_norm"], "left_anti").select(d.aliases.columns))


def promotions(d: Directory) -> DataFrame:
    """(character_id, primary_name, chosen, blocked): the one fullest form of the name among the given names, if it has all of its words; blocked where another character has that name."""
    given = d.aliases.where("alias_type = 'given_name'").select("character_id", "alias_text")
    met = d.characters.select("character_id", "primary_name").join(given, "character_id")
    met = met.withColumn("mine", N.adopted_tokens(F.col("primary_name"))).withColumn("clean", N.adopted(F.col("alias_text"))).withColumn("theirs", N.adopted_tokens(F.col("alias_text")))
    met = met.where((F.size("theirs") > F.size("mine")) & N.subset(F.col("mine"), F.col("theirs"))).withColumn("key", N.norm(F.col("clean")))
    met = met.where((F.col("key") != "") & (F.col("key") != N.norm(N.adopted(F.col("primary_name"))))).groupBy("character_id", "primary_name", "key").agg(F.min_by(F.struct("clean", F.size("theirs").alias("size")), "alias_text").alias("c"))
    best = F.rank().over(Window.partitionBy("character_id").orderBy(F.desc("c.size")))
    top = met.withColumn("k", best).where("k = 1").groupBy("character_id", "primary_name").agg(F.count(F.lit(1)).alias("n"), F.first("c.clean").alias("chosen")).where("n = 1")
    taken = d.characters.groupBy(F.col("primary_name").alias("chosen")).agg(F.min("character_id").alias("low"), F.max("character_id").alias("high"))
    other = (F.col("low") != F.col("character_id")) | (F.col("high") != F.col("character_id"))
    return top.join(taken, "chosen", "left").select("character_id", "primary_name", "chosen", F.coalesce(other, F.lit(False)).alias("blocked"))


def fuller_used(d: Directory) -> DataFrame:
    """(character_id, name_used, n): fuller forms of a name that chapters used, which are no alias yet."""
    used = d.appearances.groupBy("character_id", "name_used").agg(F.count(F.lit(1)).alias("n")).join(d.characters.select("character_id", "primary_name"), "character_id")
    fuller = used.where((F.lower(F.trim("name_used")) != F.lower(F.trim("primary_name"))) & N.is_fuller(F.col("name_used"), F.col("primary_name")))
    known = d.aliases.select("character_id", F.col("alias_norm").alias("key"))
    return fuller.withColumn("key", N.norm(F.col("name_used"))).join(known, ["character_id", "key"], "left_anti").select("character_id", "name_used", "n")


def overlapping_groups(d: Directory, public_pattern: str, covert: str) -> DataFrame:
    """(character_id, public, action): members of a covert group whose notes tell their former public group: it is to be added where it is missing, and the note cleared."""
    f = d.factions.select("faction_id", "name")
    m = d.character_factions.select("character_id", "faction_id", "notes").join(f, "faction_id")
    hidden = m.where(N.norm(F.col("name")) == N.norm(F.lit(covert))).withColumn("public", F.initcap(F.regexp_extract(F.coalesce("notes", F.lit("")), public_pattern, 1))).where("public <> ''")
    held = m.select("character_id", N.norm(F.col("name")).alias("held"), F.lit(True).alias("there"))
    met = hidden.withColumn("held", F.concat(F.lower("public"), F.lit(" ajah"))).join(held, ["character_id", "held"], "left")
    return met.select("character_id", "public", F.when(F.col("there"), "clear_note").otherwise("add").alias("action"))


def seed_pairs(d: Directory, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """wanted: (a, b, note) names. The next distinct_pairs, sorted and each once, and the names that nobody has."""
    ids = d.characters.select(N.norm(F.col("primary_name")).alias("key"), "character_id").groupBy("key").agg(F.max("character_id").alias("id"))
    w = wanted.withColumn("ka", N.norm(F.col("a"))).withColumn("kb", N.norm(F.col("b")))
    met = w.join(ids.withColumnsRenamed({"key": "ka", "id": "ia"}), "ka", "left").join(ids.withColumnsRenamed({"key": "kb", "id": "ib"}), "kb", "left")
    good = met.where("ia is not null and ib is not null and ia <> ib").select(F.least("ia", "ib").alias("cid_low"), F.greatest("ia", "ib").alias("cid_high"))
    new = good.distinct().join(d.distinct_pairs.select("cid_low", "cid_high"), ["cid_low", "cid_high"], "left_anti")
    skipped = met.where("ia is null").select(F.col("a").alias("name")).union(met.where("ib is null").select("b")).distinct()
    return d.distinct_pairs.unionByName(new, allowMissingColumns=True), skipped


def seed_collisions(d: Directory, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """wanted: (owner, other, alias, note) names. The next acknowledged_collisions, each once, and the names that nobody has."""
    ids = d.characters.select(N.norm(F.col("primary_name")).alias("key"), "character_id").groupBy("key").agg(F.max("character_id").alias("id"))
    w = wanted.withColumn("ka", N.norm(F.col("owner"))).withColumn("kb", N.norm(F.col("other"))).withColumn("alias_norm", N.norm(F.col("alias")))
    met = w.join(ids.withColumnsRenamed({"key": "ka", "id": "owner_cid"}), "ka", "left").join(ids.withColumnsRenamed({"key": "kb", "id": "other_cid"}), "kb", "left")
    keys = ["owner_cid", "other_cid", "alias_norm"]
    good = written(met.where("owner_cid is not null and other_cid is not null and owner_cid <> other_cid and alias_norm <> ''").select(*keys).distinct())
    known = reduce(lambda k, c: k.join(good.select(c).distinct(), c, "left_semi"), keys[:2], d.acknowledged_collisions.select(*keys))  # of what may be very much only what can be met
    new = good.join(known, keys, "left_anti")
    skipped = met.where("owner_cid is null").select(F.col("owner").alias("name")).union(met.where("other_cid is null").select("other")).distinct()
    return d.acknowledged_collisions.unionByName(new, allowMissingColumns=True), skipped


def seed_disguises(d: Directory, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """wanted: (persona, true_name, reveal_book) names. The next disguise_map, each persona of a character once, and true names that nobody has; a persona may have a row of its own."""
    ids = d.characters.select(N.norm(F.col("primary_name")).alias("key"), "character_id").groupBy("key").agg(F.max("character_id").alias("id"))
    w = wanted.withColumn("persona_norm", N.norm(F.col("persona"))).withColumn("kt", N.norm(F.col("true_name")))
    met = w.join(ids.withColumnsRenamed({"key": "kt", "id": "true_cid"}), "kt", "left").join(ids.withColumnsRenamed({"key": "persona_norm", "id": "persona_cid"}), "persona_norm", "left")
    keys = ["persona_norm", "true_cid"]
    good = met.where("true_cid is not null and persona_norm <> ''").groupBy(*keys).agg(F.min("persona").alias("persona_name"), F.min("true_name").alias("true_name"), F.min("reveal_book").cast("int").alias("reveal_book"), F.max("persona_cid").alias("persona_cid"))
    new = good.join(d.disguise_map.select(*keys), keys, "left_anti")
    return d.disguise_map.unionByName(new, allowMissingColumns=True), met.where("true_cid is null").select(F.col("true_name").alias("name")).distinct()


def with_slots(books: DataFrame) -> DataFrame:
    """Books of an older version with slot, label and is_prequel filled in."""
    out = books
    for c, kind in (("slot", "string"), ("label", "string"), ("is_prequel", "boolean")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(kind))
    n = F.col("series_order").cast("string")
    return out.withColumn("slot", F.coalesce("slot", F.concat(F.lit("book"), n))).withColumn("label", F.coalesce("label", F.concat(F.lit("Book "), n))).withColumn("is_prequel", F.coalesce("is_prequel", F.lit(False)))


def without_display_name(d: Directory) -> Directory:
    """A dropped column's values as given names, where they are new."""
    if "display_name" not in d.characters.columns:
        return d
    shown = d.characters.where("trim(display_name) <> ''").select("character_id", F.trim("display_name").alias("alias_text"), N.norm(F.col("display_name")).alias("alias_norm"), F.lit("given_name").alias("alias_type"), F.lit(False).alias("is_primary"))
    new = shown.join(d.aliases.select("character_id", "alias_norm"), ["character_id", "alias_norm"], "left_anti")
    return d.having(characters=d.characters.drop("display_name"), aliases=d.aliases.unionByName(new.select(*[c for c in new.columns if c in d.aliases.columns]), allowMissingColumns=True))


def next_snapshot(d: Directory, slot: str, order: int, label: str) -> Directory:
    """The directory with another book after the last; refuses a slot that is there and an order that is not larger."""
    import re

    if not re.fullmatch("[a-z0-9]+", slot):
        raise ValueError("slots are lower-case letters and digits")
    b = d.books.agg(F.max("series_order").alias("last"), F.max("book_id").alias("id"), F.bool_or(F.col("slot") == slot).alias("there")).first()
    if b["there"] or (b["last"] is not None and order <= b["last"]):
        raise ValueError("the slot exists or the order is not increasing")
    row = d.spark.createDataFrame([((b["id"] or 0) + 1, order, slot, label)], "book_id bigint, series_order int, slot string, label string")
    return d.having(books=d.books.unionByName(row, allowMissingColumns=True))


def mutation_counts(before: Directory, after: Directory) -> DataFrame:
    """(name, before, after) of tables whose row counts differ."""
    one = lambda d, t, c: getattr(d, t).agg(F.count(F.lit(1)).alias(c)).select(F.lit(t).alias("name"), c)
    out = [one(before, t, "before").join(one(after, t, "after"), "name") for t in ENDS]
    return reduce(DataFrame.unionByName, out).where("before <> after")
