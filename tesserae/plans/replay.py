"""Replaying review decisions in their order, as a set.

Decisions are made one after another, and a name that one of them creates is there for those that
follow: a second creation of the name is a merge into the first, and a merge may name it. What a
decision comes to depends on earlier creations alone, and of these on the first of each name, so
two steps say it of all decisions: the first creation of every name that the directory lacks,
and then everything else by its place before or after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.durable import written
from tesserae.functions import ages, names, origins
from tesserae.model import Directory
from tesserae.operators.resolve import confident, resolve
from tesserae.operators.write import insert_ignore, insert_replace, new_ids

_PERSON = """name_used_in_text:string, character_type:string, notes:string,
  stable_traits:struct<nationality:string, physical_traits:string, age:string, filiations:string, personality:string>,
  factions:array<struct<name:string, faction_type:string, role:string, notes:string>>, aliases_observed:array<struct<alias_text:string, alias_type:string, notes:string>>"""
#: Both shapes of a payload: a character's fields at the top, or a character with its surroundings.
PAYLOAD = f"""struct<{_PERSON}, character:struct<{_PERSON}>,
  appearance:struct<character:string, whereabouts:string, notable_actions:string, alliances_shown:array<string>, demeanor:string>,
  relationships:array<struct<character_a:string, character_b:string, relationship_type:string, directed:boolean, description:string>>>"""
TRAITS = ("physical_traits", "filiations", "personality")
#: Columns of decisions that may be left out.
OPTIONAL = {"target": "string", "target_cid": "bigint", "rename": "string", "seq": "bigint", "notes_prefix": "string", "alias_text": "string", "alias_type": "string", "alias_notes": "string"}


def _name_in(payload: Column) -> Column:
    return F.coalesce(F.get_json_object(payload, "$.character.name_used_in_text"), F.get_json_object(payload, "$.name_used_in_text"))


def outcomes(queue: DataFrame, decisions: DataFrame, characters: DataFrame) -> DataFrame:
    """(review_id, seq, kind, chapter_id, action, character_id, created_by, name): what each decision comes to, in the order of seq, then review_id.

    Decisions: (review_id, action) and any of OPTIONAL. Open items only; of several decisions for one item the first
    counts. create: under ``rename`` or the item's name; a merge if that character is there, or was
    created before (created_by tells by which item). merge: into target_cid, or the character called
    target, there or created before; else "unresolved", and the item stays open. Other actions but dismiss are "unknown".
    Names are compared normalised; a name of several characters is the one with the largest id's.
    """
    asked = decisions.select("review_id", "action", *[F.col(c).cast(t).alias(c) if c in decisions.columns else F.lit(None).cast(t).alias(c) for c, t in OPTIONAL.items()])
    asked = asked.withColumn("seq", F.coalesce("seq", F.col("review_id").cast("bigint")))
    first = F.row_number().over(Window.partitionBy("review_id").orderBy("seq", "action", "target_cid", "target", "rename"))
    asked = asked.withColumn("k", first).where("k = 1").drop("k")
    chapter = "chapter_id" if "chapter_id" in queue.columns else "cast(null as bigint) as chapter_id"
    items = queue.where("not coalesce(resolved, false)").selectExpr("review_id", "kind", "payload", chapter).withColumn("name", _name_in(F.col("payload"))).drop("payload")
    met = items.join(asked, "review_id").withColumn("name", F.when(F.col("action") == "create", F.coalesce("rename", "name")).otherwise(F.col("name")))
    key = names.norm(F.when(F.col("action") == "merge", F.col("target")).otherwise(F.col("name")))
    ids = characters.groupBy(names.norm(F.col("primary_name")).alias("key")).agg(F.max("character_id").alias("id"))
    met = met.withColumn("key", F.when(key != "", key)).join(ids, "key", "left")
    own = F.struct("seq", "review_id")
    made = met.where("action = 'create' and id is null and key is not null").groupBy("key").agg(F.min(own).alias("first"))
    met = met.join(made, "key", "left").withColumn("earlier", F.col("first").isNotNull() & (F.col("first") < own)).withColumn("creates", F.col("first") == own)
    there = F.coalesce(F.when(F.col("action") == "merge", F.col("target_cid")), F.col("id"))
    action = (
        F.when(F.col("action") == "dismiss", "dismiss")
        .when(~F.col("action").isin("create", "merge") | F.col("action").isNull(), "unknown")
        .when(there.isNotNull() | F.col("earlier"), "merge")
        .when(F.col("creates"), "create")
        .otherwise("unresolved")
    )
    merges = F.col("done") == "merge"
    out = met.withColumn("done", action)
    return out.select(
        "review_id", "seq", "kind", "chapter_id", F.col("done").alias("action"), F.when(merges, there).alias("character_id"), F.when(merges & there.isNull(), F.col("first.review_id")).alias("created_by"),
        "name", "notes_prefix", "alias_text", "alias_type", "alias_notes",
    )


def apply(d: Directory, decisions: DataFrame, now: Column | None = None) -> Directory:
    """The directory after all decisions: characters made and enriched, aliases, groups, appearances and relationships of the items, items closed.

    Each character takes what its items say in their order: the finer origin, the later age, the
    first account of each trait. An alias, a membership or a relationship that is there stays; an
    appearance takes the place of one in the same chapter; of the exclusive groups the first held stays. A relationship is kept
    where both names are the item's own, or known by then. Unresolved and unknown ones change
    nothing. Longer forms of names are adopted afterwards (``change.promotions``).
    """
    now = F.current_timestamp() if now is None else now
    found = written(outcomes(d.review_queue, decisions, d.characters).where("action in ('create', 'merge', 'dismiss')"))
    last = d.characters.agg(F.coalesce(F.max("character_id"), F.lit(0)).alias("last")).first()["last"]
    made = written(new_ids(found.where("action = 'create'").select("review_id"), "made", last, "review_id", ["review_id"]))
    by = found.where("action <> 'dismiss'").withColumn("maker", F.when(F.col("action") == "create", F.col("review_id")).otherwise(F.col("created_by")))
    cid = by.join(made.withColumnRenamed("review_id", "maker"), "maker", "left").withColumn("cid", F.coalesce("made", "character_id")).drop("made", "character_id", "maker")
    known = d.characters.select(F.col("character_id").alias("cid")).union(made.select("made"))
    payloads = d.review_queue.select("review_id", F.from_json("payload", PAYLOAD).alias("p"))
    flat = F.struct(*[F.col(f"p.{c}").alias(c) for c in ("name_used_in_text", "character_type", "notes", "stable_traits", "factions", "aliases_observed")])
    told = written(cid.join(known, "cid", "left_semi").join(payloads, "review_id").withColumn("c", F.coalesce("p.character", flat)).withColumn("looks", F.col("p.appearance")).withColumn("edges", F.col("p.relationships")).drop("p"))
    out = {"characters": _characters(d, told, now)}
    out["aliases"], seen = _aliases(d, told)
    out["factions"], out["character_factions"] = _groups(d, told, now)
    a = told.where("chapter_id is not null").select(
        F.col("cid").alias("character_id"), "chapter_id", F.when(F.col("looks").isNotNull(), F.col("looks.character")).otherwise(F.col("name")).alias("name_used"), F.col("looks.whereabouts").alias("whereabouts"),
        F.when(F.col("looks").isNotNull(), F.col("looks.notable_actions")).otherwise(F.concat_ws(" ", "notes_prefix", "c.notes")).alias("notable_actions"),
        F.nullif(F.array_join("looks.alliances_shown", ", "), F.lit("")).alias("alliances_shown"), F.col("looks.demeanor").alias("demeanor"), "seq", "review_id",
    )
    ordered = F.row_number().over(Window.partitionBy("character_id", "chapter_id").orderBy(F.desc("seq"), F.desc("review_id")))
    latest = a.withColumn("k", ordered).where("k = 1").select(*[c for c in a.columns if c in d.appearances.columns])
    out["appearances"] = insert_replace(d.appearances, latest, ["character_id", "chapter_id"], [F.col("name_used")])
    stale = latest.select("character_id", "chapter_id")
    out["mentions"] = d.mentions.join(stale, ["character_id", "chapter_id"], "left_anti").select(d.mentions.columns)
    out["relationships"] = _edges(d, told, seen)
    closed = found.select("review_id", F.lit(True).alias("__done"))
    out["review_queue"] = d.review_queue.join(closed, "review_id", "left").withColumn("resolved", F.coalesce("__done", "resolved")).select(d.review_queue.columns)
    return d.having(**out)


def _in_order(column: str) -> Column:
    """A group's values that are not null, by seq and item."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct("seq", "review_id", column)))), lambda x: x[column])


def _characters(d: Directory, told: DataFrame, now: Column) -> DataFrame:
    s = told.select("cid", "seq", "review_id", "action", "name", "chapter_id", names.character_type(F.col("c.character_type")).alias("kind"), *[F.nullif(names.strip(F.col(f"c.stable_traits.{t}")), F.lit("")).alias(t) for t in ("nationality", "age", *TRAITS)])
    old = d.characters.select(F.col("character_id").alias("cid"), F.col("nationality").alias("now_nationality"), F.col("age").alias("now_age"))
    at = F.struct("seq", "review_id")
    met = s.join(old, "cid", "left")
    creator = F.col("action") == "create"
    one = met.groupBy("cid").agg(
        F.max(F.when(creator, F.col("name"))).alias("__name"),
        F.max(F.when(creator, F.col("kind"))).alias("__kind"),
        F.max("now_nationality").alias("now_nationality"),
        F.max("now_age").alias("now_age"),
        *[_in_order(t).alias(f"__all_{t}") for t in ("nationality", "age")],
        *[F.min_by(t, F.when(F.col(t).isNotNull(), at)).alias(f"__{t}") for t in TRAITS],
    )
    place = F.aggregate("__all_nationality", F.col("now_nationality"), lambda have, said: origins.refined(have, said)["value"])
    kind_of = F.coalesce(place, F.when(F.col("__name").isNotNull(), origins.category(F.col("__name"), F.col("__kind"))))
    new = one.select("cid", "__name", "__kind", kind_of.alias("__nationality"), F.aggregate("__all_age", F.col("now_age"), lambda have, said: ages.refined(have, said)).alias("__age"), *[f"__{t}" for t in TRAITS], F.lit(True).alias("__told"))
    both = d.characters.join(new.withColumnRenamed("cid", "character_id"), "character_id", "full_outer")
    fresh = F.col("primary_name").isNull()
    is_told = F.coalesce("__told", F.lit(False))
    value = {
        "primary_name": F.coalesce("primary_name", "__name"),
        "character_type": F.when(fresh, F.col("__kind")).otherwise(F.col("character_type")),
        "nationality": F.when(is_told, F.col("__nationality")).otherwise(F.col("nationality")),
        "age": F.when(is_told, F.col("__age")).otherwise(F.col("age")),
        "created_at": F.when(fresh, now).otherwise(F.col("created_at")) if "created_at" in d.characters.columns else None,
        "updated_at": F.when(is_told, now).otherwise(F.col("updated_at")) if "updated_at" in d.characters.columns else None,
        **{t: F.coalesce(t, f"__{t}") for t in TRAITS if t in d.characters.columns},
    }
    return both.select(*[value[c].alias(c) if value.get(c) is not None else F.col(c) for c in d.characters.columns])


def _aliases(d: Directory, told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The aliases, and (alias_norm, cid, seq, review_id): who is known by what from which decision on (seq null: before all)."""
    made = told.where("action = 'create'").select("cid", "seq", "review_id", F.lit(0).alias("k"), F.col("name").alias("text"), F.lit("primary").alias("kind"), F.lit(None).cast("string").alias("notes"))
    named = told.where("alias_text is not null").select("cid", "seq", "review_id", F.lit(1).alias("k"), F.col("alias_text").alias("text"), F.col("alias_type").alias("kind"), F.col("alias_notes").alias("notes"))
    seen = told.select("cid", "seq", "review_id", F.posexplode("c.aliases_observed").alias("k", "a")).select("cid", "seq", "review_id", F.col("k") + 2, F.col("a.alias_text"), F.col("a.alias_type"), F.col("a.notes"))
    rows = made.union(named).union(seen).withColumn("text", names.strip(F.col("text"))).withColumn("alias_norm", names.norm(F.col("text")))
    rows = rows.where((F.col("alias_norm") != "") & ((F.col("kind") == "primary") | ~names.is_generic(F.col("alias_norm"))))
    first = F.row_number().over(Window.partitionBy("cid", "alias_norm").orderBy("seq", "review_id", "k"))
    new = rows.withColumn("n", first).where("n = 1").join(d.aliases.select(F.col("character_id").alias("cid"), "alias_norm"), ["cid", "alias_norm"], "left_anti")
    new = written(new)
    added = new.select(F.col("cid").alias("character_id"), F.col("text").alias("alias_text"), "alias_norm", F.coalesce("kind", F.lit("epithet")).alias("alias_type"), "notes", F.coalesce(F.col("kind") == "primary", F.lit(False)).alias("is_primary"))
    if "alias_id" in d.aliases.columns:
        last = d.aliases.agg(F.coalesce(F.max("alias_id"), F.lit(0)).alias("last")).first()["last"]
        added = new_ids(added, "alias_id", last, "character_id", ["character_id", "alias_norm"])
    known = d.aliases.select("alias_norm", F.col("character_id").alias("cid"), F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("review_id"))
    known = known.unionByName(new.select("alias_norm", "cid", "seq", F.col("review_id").cast("bigint").alias("review_id")))
    return d.aliases.unionByName(added.select(*[c for c in added.columns if c in d.aliases.columns]), allowMissingColumns=True), known


def _groups(d: Directory, told: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    said = told.select("cid", "seq", "review_id", "chapter_id", F.posexplode("c.factions").alias("k", "f")).select("cid", "seq", "review_id", "chapter_id", "k", names.strip(F.col("f.name")).alias("name"), names.faction_type(F.col("f.faction_type")).alias("faction_type"), F.col("f.role").alias("role"), F.col("f.notes").alias("notes"))
    said = said.withColumn("name_norm", names.norm(F.col("name"))).where("name_norm <> ''")
    said = said.withColumn("exclusive", names.is_group_ajah(F.col("name"), F.col("faction_type")) & ~names.is_black(F.col("name")))
    at = F.struct("seq", "review_id", "k")
    held = d.character_factions.join(d.factions, "faction_id").where((F.col("faction_type") == "ajah") & ~names.is_black(F.col("name"))).groupBy(F.col("character_id").alias("cid")).agg(F.collect_set("name_norm").alias("held"))
    firsts = said.where("exclusive").join(held, "cid", "left").where("held is null or size(held) = 1 and array_contains(held, name_norm)").groupBy("cid").agg(F.min_by("name_norm", at).alias("chosen"))
    said = written(said.join(firsts, "cid", "left").where("not exclusive or name_norm <=> chosen"))
    new = said.groupBy("name_norm").agg(F.min_by("name", at).alias("name"), F.min_by("faction_type", at).alias("faction_type")).join(d.factions, "name_norm", "left_anti")
    last = d.factions.agg(F.coalesce(F.max("faction_id"), F.lit(0)).alias("last")).first()["last"]
    new = written(new_ids(new, "faction_id", last, "name_norm", ["name_norm"]).withColumn("created_at", now))
    factions = d.factions.unionByName(new.select(*[c for c in new.columns if c in d.factions.columns]), allowMissingColumns=True)
    rows = said.join(factions.select("name_norm", "faction_id"), "name_norm")
    leads = rows.groupBy(F.col("cid").alias("character_id"), "faction_id").agg(F.max(F.coalesce(F.col("role") == "leader", F.lit(False))).alias("leads"), F.min_by(F.struct(F.coalesce("role", F.lit("member")).alias("role"), "notes", "chapter_id"), at).alias("x"))
    joined = leads.select("character_id", "faction_id", F.col("x.role").alias("role"), F.col("x.notes").alias("notes"), F.col("x.chapter_id").alias("first_chapter_id"))
    members = insert_ignore(d.character_factions, joined, ["character_id", "faction_id"], [F.col("role")])
    members = members.join(leads.select("character_id", "faction_id", "leads"), ["character_id", "faction_id"], "left").withColumn("role", F.when(F.col("leads"), "leader").otherwise(F.col("role")))
    return factions, members.select(d.character_factions.columns)


def _edges(d: Directory, told: DataFrame, known: DataFrame) -> DataFrame:
    """relationships with those of the items whose two names are characters: the item's own names, names known by then, or what the ladder finds in the old roster."""
    said = told.select("cid", "seq", "review_id", "chapter_id", "name", "c", F.posexplode("edges").alias("k", "e"))
    own = F.array_distinct(F.concat(F.array(names.norm(F.col("name"))), F.transform(F.coalesce("c.aliases_observed", F.array()), lambda a: names.norm(a["alias_text"]))))
    said = written(said.select("cid", "seq", F.col("review_id").cast("bigint").alias("review_id"), "chapter_id", "k", "e", own.alias("own")))
    ends_ = said.select("cid", "seq", "review_id", "k", "own", F.explode(F.array(F.struct(F.lit("a").alias("side"), names.strip(F.col("e.character_a")).alias("text")), F.struct(F.lit("b").alias("side"), names.strip(F.col("e.character_b")).alias("text")))).alias("x"))
    ends_ = ends_.select("cid", "seq", "review_id", "k", "own", "x.side", "x.text", names.norm(F.col("x.text")).alias("alias_norm")).where("alias_norm <> ''")
    others = ends_.where(~F.array_contains("own", F.col("alias_norm")))
    k = known.select("alias_norm", F.col("cid").alias("kid"), F.col("seq").alias("kseq"), F.col("review_id").alias("krid"))
    before = F.col("kseq").isNull() | (F.struct("kseq", "krid") < F.struct("seq", "review_id"))
    exact = others.join(k, "alias_norm").where(before).groupBy("review_id", "k", "side").agg(F.count_distinct("kid").alias("n"), F.max("kid").alias("kid")).where("n = 1")
    ladder = confident(resolve(others.select(F.col("text").alias("name")).distinct(), d.aliases)).select(F.col("name").alias("text"), F.col("cid").alias("found"))
    met = ends_.join(exact.select("review_id", "k", "side", "kid"), ["review_id", "k", "side"], "left").join(ladder, "text", "left")
    met = met.select("review_id", "k", "side", F.when(F.array_contains("own", F.col("alias_norm")), F.col("cid")).otherwise(F.coalesce("kid", "found")).alias("who"))
    both = met.groupBy("review_id", "k").agg(F.max(F.when(F.col("side") == "a", F.col("who"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("who"))).alias("b")).where("a <> b")
    directed = F.coalesce("e.directed", F.lit(False))
    rows = said.join(both, ["review_id", "k"]).select(
        F.when(directed, F.col("a")).otherwise(F.least("a", "b")).alias("character_a"), F.when(directed, F.col("b")).otherwise(F.greatest("a", "b")).alias("character_b"),
        F.coalesce("e.relationship_type", F.lit("other")).alias("relationship_type"), directed.alias("directed"), F.col("e.description").alias("description"), F.col("chapter_id").alias("first_chapter_id"), "seq", "review_id", "k",
    )
    key = ["character_a", "character_b", "relationship_type"]
    first = F.row_number().over(Window.partitionBy(*key).orderBy("seq", "review_id", "k"))
    new = rows.withColumn("__k", first).where("__k = 1").select(*[c for c in rows.columns if c in d.relationships.columns])
    return insert_ignore(d.relationships, new, key, [F.col("character_a")])
