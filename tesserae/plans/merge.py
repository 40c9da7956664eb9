"""Merging characters: what becomes of every row of the duplicates, for any number of pairs at once.

pairs: (keep, drop). A plan is a table to look at, for pairs whose kept ones stay; ``resolved`` makes
such pairs of any that lead on to others (chains and trees), and ``apply`` the next version of the directory.
Of several that go into one character, what went into another of them comes right after it, as if
the merges had been made one by one from the ends of the chains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.names import norm_search
from tesserae.functions.origins import is_placeholder_value
from tesserae.model import Directory
from tesserae.operators.read import reading_order
from tesserae.operators.write import new_ids
from tesserae.plans.chains import ends

TRAITS = ["nationality", "physical_traits", "age", "filiations", "associations", "personality", "description"]


def problems(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, drop, problem): pairs that can't be merged: of unknown characters, of different types, of one with itself, of one that goes twice."""
    of = lambda c: d.characters.select(F.col("character_id").alias(c), F.col("character_type").alias(f"{c}_type"), F.lit(True).alias(f"{c}_known"))
    times = pairs.distinct().groupBy("drop").agg(F.count(F.lit(1)).alias("times"))
    met = pairs.distinct().join(of("keep"), "keep", "left").join(of("drop"), "drop", "left").join(times, "drop", "left")
    problem = (
        F.when(F.col("keep").eqNullSafe(F.col("drop")), "merged with itself")
        .when(F.col("keep_known").isNull() | F.col("drop_known").isNull(), "unknown character")
        .when(~F.col("keep_type").eqNullSafe(F.col("drop_type")), F.concat(F.lit("types differ: "), F.coalesce("keep_type", F.lit("none")), F.lit(" and "), F.coalesce("drop_type", F.lit("none"))))
        .when(F.col("times") > 1, "merged twice")
    )
    return met.select("keep", "drop", problem.alias("problem")).where("problem is not null")


def resolved(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, drop, path): every duplicate with the character that stays in the end; nothing is merged if a pair can't be.

    ValueError on ``problems`` and on circles. Chains of any length; a path is as long as its chain.
    """
    wrong = problems(d, pairs).orderBy("keep", "drop").limit(5).collect()
    if wrong:
        raise ValueError("no merge: " + "; ".join(f"{r['drop']} into {r['keep']}: {r['problem']}" for r in wrong))
    return ends(pairs.select("keep", "drop").distinct(), "drop", "keep").select("keep", "drop", "path")


def _path(pairs: DataFrame) -> Column:
    """Where a duplicate stands among those of its kept character."""
    return F.col("path") if "path" in pairs.columns else F.array("drop")


def _of_drop(d: Directory, pairs: DataFrame, table: str) -> DataFrame:
    placed = pairs.select("keep", F.col("drop").alias("character_id"), _path(pairs).alias("path"))
    return getattr(d, table).join(placed, "character_id")


def _of_keep(d: Directory, pairs: DataFrame, table: str) -> DataFrame:
    return getattr(d, table).join(pairs.select(F.col("keep").alias("character_id")), "character_id", "left_semi").withColumnRenamed("character_id", "keep")


def places(d: Directory) -> DataFrame:
    """(chapter_id, place): the place in reading order, to be compared."""
    return reading_order(d).select("chapter_id", F.struct("series_order", "chapter_number").alias("place"))


def traits(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, field, action, kept, dropped, differs): the kept one's value stays, a placeholder is filled, two placeholders stay."""
    rows = d.characters.select("character_id", *TRAITS).unpivot(["character_id"], TRAITS, "field", "value")
    a = rows.withColumnsRenamed({"character_id": "keep", "value": "kept"})
    b = rows.withColumnsRenamed({"character_id": "drop", "value": "dropped"})
    met = pairs.join(a, "keep").join(b, ["drop", "field"])
    mine, theirs = is_placeholder_value(F.col("kept")), is_placeholder_value(F.col("dropped"))
    action = F.when(~mine, "keep").when(~theirs, "fill").otherwise("both_placeholder")
    differs = ~mine & ~theirs & (norm_search(F.col("kept")) != norm_search(F.col("dropped")))
    return met.select("keep", "drop", "field", action.alias("action"), "kept", "dropped", differs.alias("differs"))


def anchors(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, action, first_chapter_id): the earlier first chapter in reading order; none loses."""
    c = d.characters.select("character_id", "first_chapter_id").join(places(d), F.col("first_chapter_id") == F.col("chapter_id"), "left").drop("chapter_id")
    a = c.withColumnsRenamed({"character_id": "keep", "first_chapter_id": "mine", "place": "my_place"})
    b = c.withColumnsRenamed({"character_id": "drop", "first_chapter_id": "theirs", "place": "their_place"})
    met = pairs.join(a, "keep").join(b, "drop")
    earlier = F.col("their_place").isNotNull() & (F.col("my_place").isNull() | (F.col("their_place") < F.col("my_place")))
    return met.select("keep", "drop", F.when(earlier, "update").otherwise("keep").alias("action"), F.when(earlier, F.col("theirs")).otherwise(F.col("mine")).alias("first_chapter_id"))


def aliases(d: Directory, pairs: DataFrame, kind: str = "epithet") -> DataFrame:
    """(keep, alias_text, alias_norm, alias_type, action): the dropped one's aliases and former name, inserted where the key is new; a primary one becomes ``kind``."""
    own = _of_drop(d, pairs, "aliases").select("keep", "alias_text", "alias_norm", F.when(F.col("alias_type") == "primary", kind).otherwise(F.col("alias_type")).alias("alias_type"), F.concat("path", F.array(F.lit(-1).cast("bigint"))).alias("k"))
    former = _of_drop(d, pairs, "characters").select("keep", F.col("primary_name").alias("alias_text"), norm_search(F.col("primary_name")).alias("alias_norm"), F.lit(kind).alias("alias_type"), F.concat("path", F.array(F.lit((1 << 63) - 1).cast("bigint"))).alias("k"))
    there = _of_keep(d, pairs, "aliases").select("keep", "alias_norm").distinct().withColumn("there", F.lit(True))
    rows = own.union(former).join(there, ["keep", "alias_norm"], "left")
    first = F.row_number().over(Window.partitionBy("keep", "alias_norm").orderBy("k", "alias_text"))
    return rows.withColumn("action", F.when(F.col("there").isNull() & (first == 1), "insert").otherwise("skip")).select("keep", "alias_text", "alias_norm", "alias_type", "action")


def appearances(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, drop, chapter_id, action): moved, or in conflict where the kept one, or another that goes into it first, is in the chapter."""
    there = _of_keep(d, pairs, "appearances").select("keep", "chapter_id").withColumn("there", F.lit(True))
    rows = _of_drop(d, pairs, "appearances").select("keep", F.col("character_id").alias("drop"), "chapter_id", "path")
    first = F.row_number().over(Window.partitionBy("keep", "chapter_id").orderBy("path")) == 1
    return rows.join(there, ["keep", "chapter_id"], "left").select("keep", "drop", "chapter_id", F.when(F.col("there").isNull() & first, "reassign").otherwise("conflict").alias("action"))


def mentions(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, owner, chapter_id, action): moved or kept, or dropped where the merged character is in the chapter or mentioned already."""
    mine = _of_keep(d, pairs, "mentions").select("keep", F.col("keep").alias("owner"), "chapter_id", F.array().cast("array<bigint>").alias("path"))
    theirs = _of_drop(d, pairs, "mentions").select("keep", F.col("character_id").alias("owner"), "chapter_id", "path")
    present = _of_keep(d, pairs, "appearances").select("keep", "chapter_id").union(_of_drop(d, pairs, "appearances").select("keep", "chapter_id")).distinct().withColumn("present", F.lit(True))
    rows = mine.union(theirs).join(present, ["keep", "chapter_id"], "left")
    first = F.row_number().over(Window.partitionBy("keep", "chapter_id").orderBy("path"))
    action = F.when(F.col("present") | (first > 1), "drop").when(F.col("owner") == F.col("keep"), "keep").otherwise("reassign")
    return rows.withColumn("action", action).select("keep", "owner", "chapter_id", "action")


def relationships(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, character_a, character_b, relationship_type, directed, other_id, side, action): moved, a loop, or a duplicate of an edge that is there or moved before."""
    r = d.relationships.select("character_a", "character_b", "relationship_type", "directed")
    a = r.join(pairs.select(F.col("drop").alias("character_a"), "keep"), "character_a").select("keep", "character_a", "character_b", "relationship_type", "directed", F.col("character_b").alias("other_id"), F.lit("a").alias("side"))
    b = r.join(pairs.select(F.col("drop").alias("character_b"), "keep"), "character_b").where("character_a <> character_b").select("keep", "character_a", "character_b", "relationship_type", "directed", F.col("character_a").alias("other_id"), F.lit("b").alias("side"))
    # what is there: directed edges by their direction, undirected ones either way
    ways = F.explode(F.array(F.struct(F.col("character_a").alias("keep"), F.col("character_b").alias("other_id"), F.lit("a").alias("way")), F.struct(F.col("character_b").alias("keep"), F.col("character_a").alias("other_id"), F.lit("b").alias("way"))))
    there = r.select(ways.alias("e"), "relationship_type").select("e.*", "relationship_type").join(pairs.select("keep"), "keep", "left_semi")
    there = there.groupBy("keep", "other_id", "relationship_type").agg(F.collect_set("way").alias("ways"))
    rows = a.union(b).join(there, ["keep", "other_id", "relationship_type"], "left")
    exists = F.when(F.col("directed"), F.array_contains("ways", F.col("side"))).otherwise(F.col("ways").isNotNull())
    loop, exists = F.col("other_id") == F.col("keep"), F.coalesce(exists, F.lit(False))
    free = rows.withColumn("action", F.when(loop, "self_loop").when(exists, "duplicate"))
    first = F.row_number().over(Window.partitionBy("keep", "other_id", "relationship_type", "action").orderBy("character_a", "character_b"))
    action = F.when(F.col("action").isNotNull(), F.col("action")).when(first == 1, "reassign").otherwise("duplicate")
    return free.withColumn("action", action).select("keep", "character_a", "character_b", "relationship_type", "directed", "other_id", "side", "action")


def factions(d: Directory, pairs: DataFrame) -> DataFrame:
    """(keep, drop, faction_id, role, action, first_chapter_id): moved, or a duplicate whose earlier first chapter the kept membership takes."""
    placed = lambda df, p: df.join(places(d), F.col("first_chapter_id") == F.col("chapter_id"), "left").drop("chapter_id").withColumnsRenamed({"place": p})
    mine = placed(_of_keep(d, pairs, "character_factions").select("keep", "faction_id", "first_chapter_id"), "my_place").withColumnRenamed("first_chapter_id", "mine").withColumn("there", F.lit(True))
    theirs = placed(_of_drop(d, pairs, "character_factions").select("keep", F.col("character_id").alias("drop"), "faction_id", "role", "first_chapter_id", "path"), "their_place").withColumnRenamed("first_chapter_id", "theirs")
    met = theirs.join(mine, ["keep", "faction_id"], "left")
    earlier = F.col("their_place").isNotNull() & (F.col("my_place").isNull() | (F.col("their_place") < F.col("my_place")))
    action = F.when(F.col("there").isNull(), "reassign").when(earlier, "duplicate_earlier").otherwise("duplicate")
    return met.select("keep", "drop", "faction_id", "role", action.alias("action"), F.when(F.col("there").isNull() | earlier, F.col("theirs")).otherwise(F.col("mine")).alias("first_chapter_id"))


def _renamed(df: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Ids of dropped characters replaced."""
    for c in columns:
        df = df.join(pairs.select(F.col("drop").alias(c), F.col("keep").alias("__new")), c, "left").withColumn(c, F.coalesce("__new", c)).drop("__new")
    return df


def suppressions(d: Directory, pairs: DataFrame) -> Directory:
    """Confirmed pairs and collisions point to the kept characters; a pair of a character with itself goes."""
    p = _renamed(d.distinct_pairs, pairs, ["cid_low", "cid_high"]).where("cid_low <> cid_high")
    low, high = F.least("cid_low", "cid_high"), F.greatest("cid_low", "cid_high")
    p = p.withColumn("__l", low).withColumn("cid_high", high).withColumn("cid_low", F.col("__l")).dropDuplicates(["cid_low", "cid_high"])
    k = _renamed(d.acknowledged_collisions, pairs, ["owner_cid", "other_cid"]).where("owner_cid <> other_cid").dropDuplicates(["owner_cid", "other_cid", "alias_norm"])
    m = _renamed(d.disguise_map, pairs, ["true_cid"])
    return d.having(distinct_pairs=p.select(d.distinct_pairs.columns), acknowledged_collisions=k.select(d.acknowledged_collisions.columns), disguise_map=m.select(d.disguise_map.columns))


def _edges(d: Directory, pairs: DataFrame) -> DataFrame:
    """relationships after the merge: between kept characters, no loops, no edge for which another of its type stands already.

    What stood there stays. Moved edges follow in order; an undirected one needs a free pair, a directed one its
    own direction, and a duplicate gives one edge a type to the same other. Edges of one pair and
    type come together in one row, in one pass over all edges; there are as many as went into the two characters.
    """
    r = d.relationships
    for c, to, path in (("character_a", "__a", "__pa"), ("character_b", "__b", "__pb")):
        r = r.join(pairs.select(F.col("drop").alias(c), F.col("keep").alias(to), F.col("path").alias(path)), c, "left").withColumn(to, F.coalesce(to, c))
    moved, directed = F.col("__pa").isNotNull() | F.col("__pb").isNotNull(), F.coalesce("directed", F.lit(False))
    turned = moved & ~directed & (F.col("__a") > F.col("__b"))
    rest = F.struct(*[c for c in d.relationships.columns if c not in ("character_a", "character_b", "relationship_type")])
    order = F.when(moved, F.coalesce("__pa", "__pb")).otherwise(F.array().cast("array<bigint>"))
    ends_ = (F.when(turned, F.col("__b")).otherwise(F.col("__a")).alias("__x"), F.when(turned, F.col("__a")).otherwise(F.col("__b")).alias("__y"))
    edge = F.struct(order.alias("__order"), F.col("character_a").alias("__was_a"), F.col("character_b").alias("__was_b"), moved.alias("__moved"), *ends_, directed.alias("__way"), rest.alias("__rest"))
    rows = r.where(~moved | (F.col("__a") != F.col("__b"))).select(F.least("__a", "__b").alias("__low"), F.greatest("__a", "__b").alias("__high"), "relationship_type", edge.alias("edge"))
    groups = rows.groupBy("__low", "__high", "relationship_type").agg(F.collect_list("edge").alias("edges"))

    def taken(kept, e):
        own = F.exists(kept, lambda k: k["__moved"] & (k["__order"] == e["__order"]))
        slot = F.exists(kept, lambda k: (k["__x"] == e["__x"]) & (k["__y"] == e["__y"]))
        free = ~own & F.when(e["__way"], ~slot).otherwise(F.size(kept) == 0)
        return F.when(free, F.concat(kept, F.array(e))).otherwise(kept)

    still = F.filter("edges", lambda e: ~e["__moved"])
    after = F.aggregate(F.array_sort(F.filter("edges", lambda e: e["__moved"])), still, taken)
    made = groups.select("relationship_type", F.explode(F.when(F.exists("edges", lambda e: e["__moved"]), after).otherwise(F.col("edges"))).alias("e"))
    return made.select(F.col("e.__x").alias("character_a"), F.col("e.__y").alias("character_b"), "relationship_type", "e.__rest.*").select(d.relationships.columns)


def _memberships(d: Directory, pairs: DataFrame) -> DataFrame:
    """character_factions after the merge: the kept one's membership or the first that goes into it, with the earliest first chapter of all."""
    f = d.character_factions
    named = f.join(pairs.select(F.col("drop").alias("character_id"), "keep", "path"), "character_id", "left")
    mine = f.join(pairs.select(F.col("keep").alias("character_id")).distinct(), "character_id", "left_semi")
    order = F.array().cast("array<bigint>")
    rows = named.where("keep is not null").select("keep", "path", *[c for c in f.columns if c != "character_id"]).unionByName(mine.select(F.col("character_id").alias("keep"), order.alias("path"), *[c for c in f.columns if c != "character_id"]))
    placed = rows.join(places(d), F.col("first_chapter_id") == F.col("chapter_id"), "left").drop("chapter_id")
    rest = [c for c in f.columns if c not in ("character_id", "faction_id", "first_chapter_id")]
    one = placed.groupBy("keep", "faction_id").agg(F.min_by(F.struct(*rest, "first_chapter_id"), "path").alias("x"), F.min_by("first_chapter_id", F.when(F.col("place").isNotNull(), F.struct("place", "path"))).alias("earliest"))
    made = one.select(F.col("keep").alias("character_id"), "faction_id", *[F.col(f"x.{c}").alias(c) for c in rest], F.coalesce("earliest", "x.first_chapter_id").alias("first_chapter_id"))
    theirs = pairs.select(F.explode(F.array("keep", "drop")).alias("character_id")).distinct()
    return f.join(theirs, "character_id", "left_anti").select(f.columns).unionByName(made.select(f.columns))


def apply(d: Directory, pairs: DataFrame, kind: str = "epithet") -> Directory:
    """The directory with all pairs merged, chains to their ends; ValueError, and no merge at all, where ``resolved`` finds a fault."""
    return merged(d, resolved(d, pairs), kind)


def merged(d: Directory, pairs: DataFrame, kind: str = "epithet") -> Directory:
    """The directory with resolved pairs (keep, drop, path) merged."""
    gone = pairs.select(F.col("drop").alias("character_id"))
    rest = lambda df: df.join(gone, "character_id", "left_anti")
    fills = traits(d, pairs).where("action = 'fill'").join(pairs.select("drop", "path"), "drop")
    filled = fills.groupBy(F.col("keep").alias("character_id")).pivot("field", TRAITS).agg(F.min_by("dropped", "path"))
    filled = filled.select("character_id", *[F.col(t).alias(f"__{t}") for t in TRAITS])
    placed = anchors(d, pairs).join(places(d), F.col("first_chapter_id") == F.col("chapter_id"), "left")
    earliest = F.coalesce(F.min_by("first_chapter_id", F.when(F.col("place").isNotNull(), F.col("place"))), F.min("first_chapter_id"))
    first = placed.groupBy(F.col("keep").alias("character_id")).agg(earliest.alias("__first"), F.lit(True).alias("__kept"))
    c = rest(d.characters).join(filled, "character_id", "left").join(first, "character_id", "left")
    new = {t: F.coalesce(f"__{t}", t) for t in TRAITS} | {"first_chapter_id": F.when(F.col("__kept"), F.col("__first")).otherwise(F.col("first_chapter_id"))}
    characters = c.select(*[new.get(x, F.col(x)).alias(x) for x in d.characters.columns])
    more = aliases(d, pairs, kind).where("action = 'insert'").select(F.col("keep").alias("character_id"), "alias_text", "alias_norm", "alias_type", F.lit(False).alias("is_primary"))
    last = d.aliases.agg(F.coalesce(F.max("alias_id"), F.lit(0)).alias("last")).first()["last"] if "alias_id" in d.aliases.columns else 0
    if "alias_id" in d.aliases.columns:
        more = new_ids(more, "alias_id", last, "character_id", ["character_id", "alias_norm"])
    out = {"characters": characters, "aliases": rest(d.aliases).unionByName(more.select(*[x for x in more.columns if x in d.aliases.columns]), allowMissingColumns=True)}
    moved = appearances(d, pairs).where("action = 'reassign'").select(F.col("drop").alias("character_id"), "chapter_id", "keep")
    out["appearances"] = rest(d.appearances).unionByName(d.appearances.join(moved, ["character_id", "chapter_id"]).withColumn("character_id", F.col("keep")).select(d.appearances.columns))
    verdict = mentions(d, pairs).select(F.col("owner").alias("character_id"), "chapter_id", "keep", "action")
    told = d.mentions.join(verdict, ["character_id", "chapter_id"], "left").where("action is null or action <> 'drop'")
    out["mentions"] = told.withColumn("character_id", F.coalesce("keep", "character_id")).select(d.mentions.columns)
    out["relationships"] = _edges(d, pairs)
    out["character_factions"] = _memberships(d, pairs)
    return suppressions(d.having(**out), pairs)
