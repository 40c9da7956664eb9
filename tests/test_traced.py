"""Cleaning with a trace, and writing that is checked as it happens."""

import json

import pytest
from pyspark.sql import functions as F

from tesserae import model
from tesserae.model import SCHEMAS
from tesserae.operators import audits
from tesserae.plans import traced
from tesserae.sources import files
from tests.test_reconcile import directory, table


def made(spark):
    people = [(1, "Agelmar", "human"), (2, "Verin", "human"), (3, "Verin Mathwin", "human"), (4, "Loial", "other")]
    c = [(*p, *[None] * 10) for p in people]
    a = [
        (1, 1, "Agelmar", "agelmar", "primary", None, True, None), (2, 1, "Lord Agelmar Jagad", "lord agelmar jagad", "given_name", None, False, None), (3, 1, "the Gate", "the gate", "epithet", None, False, None),
        (4, 1, "Gate", "gate", "epithet", None, False, None), (5, 2, "Verin", "verin", "primary", None, True, None), (6, 2, "Verin Mathwin", "verin mathwin", "given_name", None, False, None),
        (7, 3, "Verin Mathwin", "verin mathwin", "primary", None, True, None), (8, 3, "Lady Verin", "lady verin", "title", None, False, None), (9, 4, "Loial", "loial", "primary", None, True, None), (10, 4, "the Builder", "the builder", "epithet", "n", False, None),
    ]
    return directory(spark, characters=c, aliases=a)


def test_the_trace(spark):
    assert table_of(traced.trace(made(spark))) == sorted([
        (1, "Agelmar Jagad", "Agelmar Jagad", "PROMOTE", "promotion", "from Agelmar"), (1, "Agelmar Jagad", "Lord Agelmar Jagad", "DROP", "rank_decorated", ""), (1, "Agelmar Jagad", "the Gate", "KEEP", "", ""),
        (1, "Agelmar Jagad", "Gate", "COLLAPSE", "article_dup", ""), (2, "Verin", "Verin Mathwin", "PROMOTE_BLOCKED", "promotion", "name of character 3"), (3, "Verin Mathwin", "Lady Verin", "DROP", "rank_decorated", ""), (4, "Loial", "the Builder", "KEEP", "", "n"),
    ])


def table_of(df):
    return sorted((r["character_id"], r["primary_name"], r["alias_text"], r["action"], r["rule"], r["note"]) for r in df.collect())


def test_cleaned_and_checked(spark, tmp_path):
    source, target, log = str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "log")
    model.save(made(spark), source)
    counts = traced.clean(spark, source, target, log)
    assert counts == {"PROMOTE": 1, "PROMOTE_BLOCKED": 1, "DROP": 2, "COLLAPSE": 1, "REVIEW": 0, "KEEP": 2}
    d = model.load(spark, target)
    assert table(d, "characters", "character_id", "primary_name") == [(1, "Agelmar Jagad"), (2, "Verin"), (3, "Verin Mathwin"), (4, "Loial")]
    assert table(d, "aliases", "character_id", "alias_norm", "alias_type", "is_primary") == sorted([
        (1, "agelmar jagad", "primary", True), (1, "agelmar", "given_name", False), (1, "the gate", "epithet", False), (2, "verin", "primary", True), (2, "verin mathwin", "given_name", False),
        (3, "verin mathwin", "primary", True), (4, "loial", "primary", True), (4, "the builder", "epithet", False),
    ], key=repr)
    assert audits.primaries(d).count() == 0
    assert files.table_with_header(spark, log, ["character_id", "action", "rule", "note"]).count() == sum(counts.values())


def test_what_is_not_as_planned_is_not_there(spark, tmp_path):
    target = str(tmp_path / "b")
    applied = traced.cleaned(made(spark))
    lost = applied.directory.having(aliases=applied.directory.aliases.where("alias_norm <> 'the gate'"))
    with pytest.raises(model.NotAsPlanned, match="7 aliases were written, 8 were planned"):
        model.save(lost, target, flag={"aliases": F.col("is_primary")}, check=applied.problems)
    assert not list(tmp_path.iterdir())
    twice = traced.cleaned(made(spark))
    with pytest.raises(model.NotAsPlanned, match="primary"):
        model.save(twice.directory.having(characters=twice.directory.characters.where("character_id <> 4")), target, flag={"aliases": F.col("is_primary")}, check=twice.problems)
    model.save(traced.cleaned(made(spark)).directory, target)
    assert model.load(spark, target).aliases.count() == 8


def test_proposals_come_back(spark, tmp_path):
    answers = spark.createDataFrame([(1, "Shienar", "text", "of Shienar", "would_write"), (9, "Tear", "text", "", "would_write")], "character_id bigint, nationality string, basis string, evidence string, action string")
    df = traced.proposals(made(spark), answers, "x_book3.db", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    df.write.json(str(tmp_path / "p"))
    line = json.loads(next((tmp_path / "p").glob("*.json")).read_text().splitlines()[0])
    assert (line["schema_version"], line["generated_at_iso"], line["results"][0]["primary_name"]) == (1, "2026-01-02T03:04:05Z", "Agelmar")
    back = files.proposals(spark, str(tmp_path / "p")).collect()
    assert [(r["db_file"], r["character_id"], r["nationality"], r["current_nationality"]) for r in back] == [("x_book3.db", 1, "Shienar", None)]


def test_nothing_to_clean(spark, tmp_path):
    d = model.Directory(spark, {t: spark.createDataFrame([], s) for t, s in SCHEMAS.items()})
    model.save(d, str(tmp_path / "a"))
    assert set(traced.clean(spark, str(tmp_path / "a"), str(tmp_path / "b")).values()) == {0}
