"""The directory: its tables, their schemas, and snapshots of them on storage.

A snapshot is a folder with a Parquet folder for each table. It is written beside its place and
renamed, so readers see all of it or nothing. Later snapshots hold later books; what a reader is
not to know yet is not in the snapshot at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "books": "book_id bigint, series_order int, slot string, label string, title string, source_file string, is_prequel boolean",
    "chapters": "chapter_id bigint, book_id bigint, chapter_number int, title string, full_text string, word_count int, extracted boolean",
    "characters": "character_id bigint, primary_name string, character_type string, nationality string, physical_traits string, age string, filiations string, associations string, personality string, description string, first_chapter_id bigint, created_at timestamp, updated_at timestamp",
    "aliases": "alias_id bigint, character_id bigint, alias_text string, alias_norm string, alias_type string, notes string, is_primary boolean, first_chapter_id bigint",
    "appearances": "character_id bigint, chapter_id bigint, name_used string, whereabouts string, notable_actions string, alliances_shown string, demeanor string",
    "mentions": "character_id bigint, chapter_id bigint, name_used string, context string",
    "relationships": "character_a bigint, character_b bigint, relationship_type string, directed boolean, description string, first_chapter_id bigint",
    "factions": "faction_id bigint, name string, name_norm string, faction_type string, description string, created_at timestamp",
    "character_factions": "character_id bigint, faction_id bigint, role string, notes string, first_chapter_id bigint",
    "review_queue": "review_id bigint, chapter_id bigint, kind string, payload string, note string, resolved boolean, created_at timestamp",
    "distinct_pairs": "cid_low bigint, cid_high bigint, note string, created_at timestamp",
    "acknowledged_collisions": "owner_cid bigint, other_cid bigint, alias_norm string, note string, created_at timestamp",
    "disguise_map": "persona_norm string, true_cid bigint, persona_name string, true_name string, reveal_book int, persona_cid bigint, note string",
}
#: Keys that are unique, and the tables whose rows point to others: (table, column, target, key).
UNIQUE = {
    "books": [("book_id",), ("series_order",), ("slot",)],
    "chapters": [("chapter_id",), ("book_id", "chapter_number")],
    "characters": [("character_id",), ("primary_name",)],
    "aliases": [("character_id", "alias_norm")],
    "appearances": [("character_id", "chapter_id")],
    "mentions": [("character_id", "chapter_id")],
    "relationships": [("character_a", "character_b", "relationship_type")],
    "factions": [("faction_id",), ("name",), ("name_norm",)],
    "character_factions": [("character_id", "faction_id")],
    "distinct_pairs": [("cid_low", "cid_high")],
    "acknowledged_collisions": [("owner_cid", "other_cid", "alias_norm")],
    "disguise_map": [("persona_norm", "true_cid")],
}
POINTERS = [
    ("chapters", "book_id", "books", "book_id"),
    ("aliases", "character_id", "characters", "character_id"),
    ("appearances", "character_id", "characters", "character_id"),
    ("appearances", "chapter_id", "chapters", "chapter_id"),
    ("mentions", "character_id", "characters", "character_id"),
    ("mentions", "chapter_id", "chapters", "chapter_id"),
    ("relationships", "character_a", "characters", "character_id"),
    ("relationships", "character_b", "characters", "character_id"),
    ("character_factions", "character_id", "characters", "character_id"),
    ("character_factions", "faction_id", "factions", "faction_id"),
]
#: What a public snapshot keeps of each table; the queue and the suppression lists stay private.
PUBLIC = {
    "books": ["book_id", "series_order", "slot", "label", "title", "source_file", "is_prequel"],
    "chapters": ["chapter_id", "book_id", "chapter_number", "title", "word_count"],
    "characters": ["character_id", "primary_name", "character_type", "nationality", "physical_traits", "age", "filiations", "associations", "personality", "description", "first_chapter_id"],
    "aliases": ["alias_id", "character_id", "alias_text", "alias_norm", "alias_type", "is_primary", "first_chapter_id"],
    "appearances": ["character_id", "chapter_id", "name_used", "whereabouts", "notable_actions", "alliances_shown", "demeanor"],
    "mentions": ["character_id", "chapter_id", "name_used", "context"],
    "relationships": ["character_a", "character_b", "relationship_type", "directed", "description", "first_chapter_id"],
    "factions": ["faction_id", "name", "name_norm", "faction_type", "description"],
    "character_factions": ["character_id", "faction_id", "role", "first_chapter_id"],
}


@dataclass(frozen=True)
class Directory:
    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self.tables:  # a table that an older snapshot lacks is an empty one
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.tables[name]

    def having(self, **tables: DataFrame) -> Directory:
        """A new version with these tables in place of the old ones."""
        return replace(self, tables=self.tables | tables)


class NotAsPlanned(RuntimeError):
    """What was written is not what the plan says."""


def _paths(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def load(spark: SparkSession, path: str) -> Directory:
    """A snapshot, lazily; it is never written to again."""
    files, root = _paths(spark, path)
    there = {s.getPath().getName() for s in files.listStatus(root)}
    return Directory(spark, {t: spark.read.parquet(f"{path}/{t}") for t in SCHEMAS if t in there})


def save(directory: Directory, path: str, flag: dict[str, Column] | None = None, check: Callable[[dict[str, dict[str, int]]], list[str]] | None = None) -> None:
    """All tables at once: written to a folder beside it and renamed. A snapshot that is there already stays.

    While a table is written its rows are counted, and those where its ``flag`` holds. check is given these counts, {table: {"rows", "flagged"}},
    before the snapshot is put in place; where it names problems the folder goes and NotAsPlanned is raised.
    """
    spark = directory.spark
    files, target = _paths(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    aside = f"{path}.writing-{uuid.uuid4().hex[:8]}"
    found = {}
    for name, df in directory.tables.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if((flag or {}).get(name, F.lit(False))).alias("flagged")).write.parquet(f"{aside}/{name}")
        found[name] = seen.get
    if problems := check(found) if check else []:
        files.delete(_paths(spark, aside)[1], True)
        raise NotAsPlanned("; ".join(problems))
    if not files.rename(_paths(spark, aside)[1], target):
        raise OSError(f"{aside} can't be renamed to {path}")


def public(directory: Directory) -> Directory:
    """The tables and columns that are shown, with no source files."""
    out = {}
    for name, columns in PUBLIC.items():
        df = getattr(directory, name)
        picked = [F.lit(None).cast("string").alias(c) if c == "source_file" else F.coalesce(c, F.lit(False)).alias(c) if c == "is_prequel" else F.col(c) for c in columns if c in df.columns]
        out[name] = df.select(*picked)
    return Directory(directory.spark, out)
