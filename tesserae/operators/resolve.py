"""Entity resolution against a roster, set-based: all names at once against frozen aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import values as V
from tesserae.functions.names import distinctive, match_key, norm, subset, tokens
from tesserae.functions.similarity import may_be_similar, ratio


def exact_index(aliases: DataFrame) -> DataFrame:
    """(alias_norm, cid): of several owners the one with the largest id, which stands for the row read last."""
    return aliases.groupBy("alias_norm").agg(F.max("character_id").alias("cid"))


def stripped_index(aliases: DataFrame) -> DataFrame:
    """(key, cid) of keys without ranks that one character alone has."""
    keyed = aliases.select(match_key(F.col("alias_norm")).alias("key"), "character_id").where("key <> ''")
    return keyed.groupBy("key").agg(F.min("character_id").alias("cid"), F.max("character_id").alias("other")).where("cid = other").select("key", "cid")


def exact(names: DataFrame, aliases: DataFrame, name: str = "name", out: str = "exact_cid") -> DataFrame:
    """names with the character that has the name, or that alone has it without ranks."""
    n = names.withColumn("__n", norm(F.col(name))).withColumn("__k", match_key(F.col(name)))
    a = exact_index(aliases).withColumnsRenamed({"alias_norm": "__n", "cid": "__a"})
    b = stripped_index(aliases).withColumnsRenamed({"key": "__k", "cid": "__b"})
    return n.join(a, "__n", "left").join(b, "__k", "left").withColumn(out, F.coalesce("__a", "__b")).drop("__n", "__k", "__a", "__b")


def token_candidates(names: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """(name, cid, shared, score): characters with an alias whose words are all in the name, or have all of it, and share a telling word.

    Found by the telling words themselves, so names meet only aliases they share one with.
    """
    mine = names.select(name).distinct().withColumn("t", tokens(norm(F.col(name))))
    theirs = aliases.select("character_id", "alias_norm").distinct().withColumn("u", tokens(F.col("alias_norm")))
    a = mine.withColumn("w", F.explode(distinctive(F.col("t"))))
    b = theirs.withColumn("w", F.explode(distinctive(F.col("u"))))
    met = a.join(b, "w").where(subset(F.col("t"), F.col("u")) | subset(F.col("u"), F.col("t"))).dropDuplicates([name, "character_id", "alias_norm"])
    both = F.array_intersect("t", "u")
    scored = met.withColumn("d", F.size(distinctive(both))).withColumn("s", F.size(both) / F.greatest(F.size("t"), F.size("u")))
    return scored.groupBy(name, F.col("character_id").alias("cid")).agg(F.max("d").alias("shared"), F.max("s").alias("score"))


def fuzzy(names: DataFrame, aliases: DataFrame, name: str = "name", least: float = V.FUZZY) -> DataFrame:
    """(name, cid, ratio): the most similar alias's character, at ``least`` or above; ties go to the smallest id.

    Names meet by segments that a similar pair must share; the UDF comes last.
    """
    n = names.select(name).distinct().withColumn("n", norm(F.col(name))).where("n <> ''")
    a = aliases.groupBy("alias_norm").agg(F.min("character_id").alias("cid"))
    met = may_be_similar(n.select("n").distinct(), a.select("alias_norm"), least).toDF("n", "alias_norm")
    close = n.join(met, "n").join(a, "alias_norm")
    scored = close.withColumn("ratio", ratio(F.col("n"), F.col("alias_norm"))).where(F.col("ratio") >= least)
    best = F.row_number().over(Window.partitionBy(name).orderBy(F.desc("ratio"), "cid"))
    return scored.withColumn("k", best).where("k = 1").select(name, "cid", "ratio")


def pointer(names: DataFrame, aliases: DataFrame, name: str = "name", hint: str = "pointer") -> DataFrame:
    """(name, pointer, pointer_cid, similarity): whom a hint names, and how similar the name is to that character's aliases."""
    hinted = exact(names.select(name, hint).where(F.col(hint).isNotNull() & (F.col(hint) != "")).distinct(), aliases, hint, "pointer_cid").where("pointer_cid is not null")
    theirs = aliases.select(F.col("character_id").alias("pointer_cid"), "alias_norm")
    return hinted.join(theirs, "pointer_cid").groupBy(name, hint, "pointer_cid").agg(F.max(ratio(norm(F.col(name)), F.col("alias_norm"))).alias("similarity"))


def resolve(names: DataFrame, aliases: DataFrame, name: str = "name", hint: str = "pointer") -> DataFrame:
    """names with (cid, method, candidates): who it is, and why.

    The ladder: the exact name; one character that shares two telling words; several: ambiguous;
    the hinted character, if it is a candidate or similar enough; several that share one word:
    ambiguous; none. candidates are ids with scores where it is ambiguous.
    """
    if hint not in names.columns:
        names = names.withColumn(hint, F.lit(None).cast("string"))
    c = token_candidates(names, aliases, name)
    scored = lambda n: F.array_sort(F.collect_list(F.when(n, F.struct("cid", "score"))))
    strong, weak = F.col("shared") >= 2, F.col("shared") == 1
    ladder = c.groupBy(name).agg(scored(strong).alias("strong"), scored(weak).alias("weak"), F.collect_set("cid").alias("all"))
    p = pointer(names, aliases, name, hint)
    met = exact(names, aliases, name).join(ladder, name, "left").join(p, [name, hint], "left")
    size = lambda col: F.coalesce(F.size(col), F.lit(0))
    hinted = F.col("pointer_cid").isNotNull() & (F.coalesce(F.array_contains("all", F.col("pointer_cid")), F.lit(False)) | (F.col("similarity") >= V.POINTER))
    method = (
        F.when(F.col("exact_cid").isNotNull(), "exact")
        .when(size("strong") == 1, "token_subset")
        .when(size("strong") > 1, "ambiguous")
        .when(hinted, "llm_pointer")
        .when(size("weak") > 1, "ambiguous")
        .otherwise("none")
    )
    cid = F.when(F.col("method") == "exact", F.col("exact_cid")).when(F.col("method") == "token_subset", F.col("strong")[0]["cid"]).when(F.col("method") == "llm_pointer", F.col("pointer_cid"))
    candidates = F.when(F.col("method") == "ambiguous", F.when(size("strong") > 1, F.col("strong")).otherwise(F.col("weak")))
    return met.withColumn("method", method).withColumn("cid", cid).withColumn("candidates", candidates).select(*names.columns, "cid", "method", "candidates", "pointer_cid", "similarity")


def confident(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("method").isin("exact", "token_subset", "llm_pointer"))


def near_duplicates(names: DataFrame, cutoff: float = V.NEAR, top: int = 4) -> DataFrame:
    """(a, b, ratio) of distinct names, b among a's ``top`` most similar (a itself counts as one) at the cutoff or above.

    names: (name): normalised and distinct. Pairs meet by segments that a similar pair must share.
    """
    met = may_be_similar(names.select("name"), names.select("name"), cutoff).where("a <> b")
    # the probe comes second, as it does where the closest are looked up
    close = met.withColumn("probe", ratio(F.col("b"), F.col("a"))).where(F.col("probe") >= cutoff)
    k = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("probe"), F.desc("b")))
    return close.withColumn("k", k).where(F.col("k") < top).select("a", "b", ratio(F.col("a"), F.col("b")).alias("ratio"))
