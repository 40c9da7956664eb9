"""Cleaning aliases with a trace of every decision, and writing that is checked against the plan as it happens.

The decisions are made once and written as the trace; the new tables follow from it. What a table
should hold is counted while it is written, by observed metrics, and a snapshot whose counts aren't the
plan's is never put in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tesserae import model
from tesserae.durable import written
from tesserae.functions import names as N
from tesserae.functions import values as V
from tesserae.model import Directory
from tesserae.operators import audits
from tesserae.operators.write import new_ids
from tesserae.plans import change

ACTIONS = ("PROMOTE", "PROMOTE_BLOCKED", "DROP", "COLLAPSE", "REVIEW", "KEEP")


def promoted(d: Directory, chosen: DataFrame | None = None) -> Directory:
    """The directory with each free promotion made (chosen: ``change.promotions``, written).

    The chosen form is the name and the primary alias; the former name stays as a given name; other
    given names of the same form, with a rank or an article, are titles.
    """
    chosen = change.promotions(d) if chosen is None else chosen
    p = chosen.where("not blocked").select("character_id", F.col("chosen").alias("__name"), N.norm(F.col("chosen")).alias("__norm"), N.norm(F.col("primary_name")).alias("__was"))
    c = d.characters.join(p.select("character_id", "__name"), "character_id", "left").withColumn("primary_name", F.coalesce("__name", "primary_name")).select(d.characters.columns)
    a = d.aliases.join(p, "character_id", "left")
    is_new, is_old = F.col("alias_norm") == F.col("__norm"), F.col("alias_norm") == F.col("__was")
    form = N.norm(N.adopted(F.col("alias_text"))) == F.col("__norm")
    decorated = form & ((F.col("alias_type") == "given_name") | F.col("is_primary"))
    kind = F.when(F.col("__norm").isNull(), F.col("alias_type")).when(is_new, "primary").when(is_old, "given_name").when(decorated, "title").otherwise(F.col("alias_type"))
    first = F.when(F.col("__norm").isNull(), F.col("is_primary")).when(is_new, True).when(is_old | decorated, False).otherwise(F.col("is_primary"))
    kept = a.withColumn("__kind", kind).withColumn("is_primary", first).withColumn("alias_type", F.col("__kind")).select(d.aliases.columns)
    missing = p.join(d.aliases.select("character_id", F.col("alias_norm").alias("__norm")), ["character_id", "__norm"], "left_anti")
    new = missing.select("character_id", F.col("__name").alias("alias_text"), F.col("__norm").alias("alias_norm"), F.lit("primary").alias("alias_type"), F.lit(True).alias("is_primary"))
    if "alias_id" in d.aliases.columns:
        last = d.aliases.agg(F.coalesce(F.max("alias_id"), F.lit(0)).alias("last")).first()["last"]
        new = new_ids(new, "alias_id", last, "character_id", ["character_id"])
    return d.having(characters=c, aliases=kept.unionByName(new.select(*[x for x in new.columns if x in d.aliases.columns]), allowMissingColumns=True))


def _promoted_once(d: Directory, chosen: DataFrame) -> Directory:
    """``promoted`` with its names and aliases written, as the rules read them several times."""
    after = promoted(d, chosen)
    return after.having(characters=written(after.characters), aliases=written(after.aliases))


def trace(d: Directory, chosen: DataFrame | None = None, after: Directory | None = None) -> DataFrame:
    """(character_id, primary_name, alias_text, alias_norm, alias_type, action, rule, note): what the cleaning decides of every name and alias, and why.

    PROMOTE and PROMOTE_BLOCKED for names that a fuller form is to replace; DROP, COLLAPSE, REVIEW or
    KEEP for every alias of a kind that may go, judged by what the character is called after the promotion.
    """
    chosen = written(change.promotions(d)) if chosen is None else chosen
    after = _promoted_once(d, chosen) if after is None else after
    owner = d.characters.select(F.col("primary_name").alias("chosen"), F.col("character_id").alias("owner")).join(chosen.where("blocked").select("chosen").distinct(), "chosen", "left_semi")
    least = owner.groupBy("chosen").agg(F.min("owner").alias("least"))  # of all who have a name the two smallest tell who is the first that is another
    next_ = owner.join(least, "chosen").where("owner > least").groupBy("chosen").agg(F.min("owner").alias("next"))
    first = F.when(F.col("least") != F.col("character_id"), F.col("least")).otherwise(F.col("next"))
    others = chosen.where("blocked").join(least, "chosen").join(next_, "chosen", "left").select("character_id", first.alias("owner"))
    ups = chosen.join(others, "character_id", "left").select(
        "character_id", F.when(F.col("blocked"), F.col("primary_name")).otherwise(F.col("chosen")).alias("primary_name"), F.col("chosen").alias("alias_text"), N.norm(F.col("chosen")).alias("alias_norm"), F.lit("primary").alias("alias_type"),
        F.when(F.col("blocked"), "PROMOTE_BLOCKED").otherwise("PROMOTE").alias("action"), F.lit("promotion").alias("rule"),
        F.when(F.col("blocked"), F.concat(F.lit("name of character "), F.col("owner").cast("string"))).otherwise(F.concat(F.lit("from "), F.col("primary_name"))).alias("note"),
    )
    verdicts = audits.alias_cleanup(after).select("character_id", "alias_norm", "alias_type", "action", "rule")
    notes = F.coalesce("notes", F.lit("")) if "notes" in d.aliases.columns else F.lit("")
    texts = after.aliases.select("character_id", "alias_norm", "alias_text", notes.alias("note"))
    named = verdicts.join(texts, ["character_id", "alias_norm"]).join(after.characters.select("character_id", "primary_name"), "character_id")
    return ups.unionByName(named.select(ups.columns))


@dataclass
class Applied:
    """A planned change: the tables after it, the written trace, and how many decisions of each kind there are."""

    directory: Directory
    trace: DataFrame
    counts: dict[str, int]
    before: Observation

    def problems(self, found: dict[str, dict[str, int]]) -> list[str]:
        """found: what ``model.save`` observed of each table as it was written."""
        out = []
        planned = self.before.get["rows"] - self.counts["DROP"] - self.counts["COLLAPSE"]
        if found["aliases"]["rows"] != planned:
            out.append(f"{found['aliases']['rows']} aliases were written, {planned} were planned")
        if found["aliases"]["flagged"] != found["characters"]["rows"]:
            out.append(f"{found['aliases']['flagged']} primary aliases of {found['characters']['rows']} characters")
        return out


def cleaned(d: Directory) -> Applied:
    """Promotions made and doomed aliases gone. The trace is written first, and counted while it is; nothing is decided twice."""
    chosen = written(change.promotions(d))
    after = _promoted_once(d, chosen)
    counting = Observation()
    metrics = [F.count_if(F.col("action") == a).alias(a) for a in ACTIONS]
    decisions = written(trace(d, chosen, after).observe(counting, *metrics))
    doomed = decisions.where("action in ('DROP', 'COLLAPSE')").select("character_id", "alias_norm")
    before = Observation()
    aliases = after.aliases.observe(before, F.count(F.lit(1)).alias("rows")).join(doomed, ["character_id", "alias_norm"], "left_anti").select(d.aliases.columns)
    return Applied(after.having(aliases=aliases), decisions, {a: counting.get[a] for a in ACTIONS}, before)


def clean(spark, source: str, target: str, log: str | None = None) -> dict[str, int]:
    """A snapshot cleaned into a new one: planned, written, checked as it is written, put in place. The counts of its decisions; the trace is added to the CSV log.

    NotAsPlanned, and no snapshot, if the counts of what was written are not the plan's.
    """
    from tesserae.sources.files import append_log

    applied = cleaned(model.load(spark, source))
    model.save(applied.directory, target, flag={"aliases": F.col("is_primary")}, check=applied.problems)
    if log:
        append_log(applied.trace.orderBy("character_id", "alias_norm"), log)
    return applied.counts


def proposals(d: Directory, answers: DataFrame, db_file: str, made: Column | None = None) -> DataFrame:
    """One row to be written as JSON for each character with an answer (character_id, nationality, basis, evidence, action, error_msg, downgraded), with who it is and what is there now.

    A file of rows is a bundle that ``files.proposals`` reads again: every row bears the bundle's version, time and source, so
    that bundles of any size are written by all tasks at once.
    """
    made = F.current_timestamp() if made is None else made
    now = d.characters.select("character_id", "primary_name", F.col("nationality").alias("current_nationality"))
    met = answers.join(now, "character_id")
    fields = [c if c in met.columns else F.lit(None).cast(t).alias(c) for c, t in (("character_id", "bigint"), ("primary_name", "string"), ("nationality", "string"), ("basis", "string"), ("evidence", "string"), ("action", "string"), ("error_msg", "string"), ("downgraded", "boolean"), ("current_nationality", "string"))]
    return met.select(F.lit(1).alias("schema_version"), F.date_format(made, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at_iso"), F.lit(db_file).alias("db_file"), F.array(F.struct(*fields)).alias("results"))
