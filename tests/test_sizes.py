"""Plans whose work grows with the tables: what is counted by names is not made pair by pair, and texts are read once a row."""

from pyspark.sql import functions as F

from tesserae.functions import ages, names, origins
from tesserae.operators import audits, read
from tesserae.plans import change, merge, traced
from tests.test_reconcile import directory, table


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def crowd(spark):
    """Ten characters of each of three names, some of them confirmed as distinct or linked by aliases."""
    people = [(k, ("Rand Thor", "Rand Thor Smith", "Rand")[k % 3], "human" if k % 2 else "other") for k in range(30)]
    also = [(1, "rand thor"), (4, "rand"), (3, "rand thor smith"), (5, "nobody")]
    rows = [(k, n, n.lower(), "primary", True) for k, n, _ in people] + [(k, n, n, "nickname", False) for k, n in also]
    d = directory(spark).having(
        characters=spark.createDataFrame(people, "character_id bigint, primary_name string, character_type string"),
        aliases=spark.createDataFrame(rows, "character_id bigint, alias_text string, alias_norm string, alias_type string, is_primary boolean"),
        distinct_pairs=spark.createDataFrame([(0, 4), (0, 10), (7, 9), (9, 7)], "cid_low bigint, cid_high bigint"),
    )
    linked, apart, kind = set(also), {(0, 4), (0, 10), (7, 9)}, {k: t for k, _, t in people}
    want = {
        (s, b) for s, x, _ in people for b, y, _ in people
        if y.startswith(x + " ") and kind[s] == kind[b] and (b, x.lower()) not in linked and (s, y.lower()) not in linked and (min(s, b), max(s, b)) not in apart
    }
    return d, want


def test_known_collisions_are_those_of_owners(spark):
    d, _ = crowd(spark)
    view = d.aliases.select("alias_norm", F.col("character_id").alias("owner_cid")).join(d.characters.select(F.lower("primary_name").alias("alias_norm"), F.col("character_id").alias("other_cid")), "alias_norm")
    df = audits.collisions(d.having(acknowledged_collisions=view))
    assert "LeftSemi" in plan(df) and not df.collect()


def test_fuller_names_are_paired_in_parts(spark, monkeypatch):
    monkeypatch.setattr(audits, "PAIRED", 2)
    d, want = crowd(spark)
    df = audits.fuller_names(d)
    got = [(r["short_id"], r["long_id"]) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_fuller_names_are_counted_by_names(spark):
    d, want = crowd(spark)
    assert {r["character_id"]: r["n"] for r in audits.fuller_counts(d).collect()} == {s: sum(x == s for x, _ in want) for s in {x for x, _ in want}}
    assert [r["rows"] for r in audits.summary(d, ["fuller names"]).collect()] == [len(want)]


def test_ages_are_read_once(spark):
    c = spark.createDataFrame([("about 40", "killed two years ago"), ("young", "Sixty-three"), (None, "ten years old")], "a string, b string")
    df = c.select(ages.refined(ages.normalized(F.col("a")), F.col("b")).alias("x"))
    assert plan(df).lower().count("regexp_replace") < 8 and [r["x"] for r in df.collect()] == ["about 40", "about 63", "child"]


def test_phrases_are_dealt_before_they_are_read(spark):
    from tesserae.queries import QUERIES

    assert "RepartitionByExpression [k" in plan(QUERIES["age_phrases"](spark, "/root/testdata/sf0.001"))


def test_origins_are_read_once(spark):
    c = spark.createDataFrame([("Two Rivers", "Andor"), ("Maule (presumably)", "Andor"), (None, "unknown")], "a string, b string")
    df = c.select(origins.refined(F.col("a"), F.col("b")).alias("x"))
    assert plan(df).lower().count("regexp_replace") < 40
    assert [r["x"]["conflict"] for r in df.collect()] == [False, True, False]


def test_promotions_meet_a_name_once(spark):
    d, _ = crowd(spark)
    more = spark.createDataFrame([(2, "Rand Thor", "rand thor", "given_name", False), (5, "Rand Smith Jones", "rand smith jones", "given_name", False)], d.aliases.schema)
    df = change.promotions(d.having(aliases=d.aliases.union(more)))
    assert "min(character_id" in plan(df)
    assert {r["character_id"]: (r["chosen"], r["blocked"]) for r in df.collect()} == {2: ("Rand Thor", True), 5: ("Rand Smith Jones", False)}


def test_names_are_read_once_and_a_block_names_the_first(spark):
    c = spark.createDataFrame([("the Lord Agelmar of House Jagad",)], "x string")
    assert plan(c.select(names.adopted(F.col("x")).alias("x"))).lower().count("regexp_replace") < 20
    d, _ = crowd(spark)
    more = spark.createDataFrame([(2, "Rand Thor", "rand thor", "given_name", False)], d.aliases.schema)
    d = d.having(aliases=d.aliases.union(more).withColumn("notes", F.lit(None).cast("string")))
    df = traced.trace(d)
    assert {r["note"] for r in df.where("action = 'PROMOTE_BLOCKED'").collect()} == {"name of character 0"}


def test_searches_take_only_the_first_of_a_key(spark):
    d, _ = crowd(spark)
    df = read.search_many(d, spark.createDataFrame([("rand",), ("smith",), ("hor",)], "query string"), limit=3)
    assert "windowspecdefinition(alias_norm" in plan(df)
    got = {}
    for r in df.collect():
        got.setdefault(r["query"], []).append(r["character_id"])
    assert {q: sorted(x) for q, x in got.items()} == {"rand": [2, 5, 8], "smith": [1, 3, 4], "hor": [0, 3, 6]}


def test_passages_are_listed_by_blocks(spark, monkeypatch):
    from tesserae.functions import texts

    monkeypatch.setattr(texts, "LISTED", 2)
    monkeypatch.setattr(texts, "HELD", 10)
    rows = [(7, k, "the", f"the {k} and " + "x " * 300 + f"the end {k}") for k in range(5)]
    got = texts.gathered(spark.createDataFrame(rows, "id bigint, chapter_id bigint, term string, full_text string")).orderBy("block").collect()
    assert [(r["block"], r["chapters"], r["matches"], len(r["passages"])) for r in got] == [(0, 5, 10, 4), (1, 5, 10, 4), (2, 5, 10, 2)]
    assert [p[:5] for r in got for p in r["passages"]][::2] == [f"the {k}" for k in range(5)]


def test_names_of_many_are_dealt_in_parts(spark):
    from tesserae.queries import QUERIES

    shown = plan(QUERIES["seeded_collisions"](spark, "/root/testdata/sf0.001"))
    assert "pmod(hash(" in shown and "LeftSemi" in shown


def test_dossiers_name_those_with_fuller_names(spark):
    d, want = crowd(spark)
    df = audits.dossier(d.having(characters=d.characters.withColumn("first_chapter_id", F.lit(None).cast("bigint"))))
    assert "taken" in plan(df) and "parts" not in plan(df)  # by counts of names, no pairs are made
    assert {r["character_id"] for r in df.collect() if "fuller name" in r["findings"]} == {s for s, _ in want}


def test_pointers_of_a_table_are_followed_at_once(spark):
    d, _ = crowd(spark)
    d = d.having(appearances=spark.createDataFrame([(1, 11), (1, 99), (77, 99)], "character_id bigint, chapter_id bigint"))
    df = audits.broken_pointers(d)
    assert plan(df).count("LeftAnti") == 6  # one a table, for ten pointers
    assert {tuple(r) for r in df.collect()} == {("appearances.chapter_id", 99, 2), ("appearances.character_id", 77, 1)}


def test_a_summary_follows_pointers_at_once(spark):
    d, _ = crowd(spark)
    df = audits.summary(d, ["broken pointers"])
    assert plan(df).count("LeftAnti") == 6 and df.collect()[0]["rows"] == 0


def test_edges_of_a_merge_are_read_once(spark):
    d, _ = crowd(spark)
    rows = [(1, 2, "ally", False, "x", 1), (3, 2, "ally", False, "y", 1), (3, 1, "rival", True, "z", 1), (4, 5, "ally", True, "s", 1), (4, 5, "ally", True, "s", 1)]
    d = d.having(relationships=spark.createDataFrame(rows, "character_a bigint, character_b bigint, relationship_type string, directed boolean, description string, first_chapter_id bigint"))
    df = merge._edges(d, spark.createDataFrame([(1, 3, [3])], "keep bigint, drop bigint, path array<bigint>"))
    assert plan(df).count("Join ") == 2
    assert sorted(tuple(r) for r in df.collect()) == [rows[0], rows[3], rows[4]]


def test_counts_of_a_merge_make_only_what_is_counted(spark, monkeypatch):
    from tesserae import queries

    made, once = [], queries._once
    monkeypatch.setattr(queries, "_once", lambda s, f, *tables: made.extend(tables) or once(s, f, *tables))
    queries.QUERIES["merge_applied_counts"](spark, "/root/testdata/sf0.001")
    assert set(made) == {"characters", "appearances", "character_factions"}


def test_gaps_move_no_texts_and_meet_notes_once(spark, monkeypatch):
    from tesserae.queries import QUERIES

    seen, found = [], audits.mentions_found
    monkeypatch.setattr(audits, "mentions_found", lambda chapters, wanted, **k: seen.append(plan(chapters)) or found(chapters, wanted, **k))
    df = QUERIES["mention_gap"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and "Join" not in seen[0] and "Window" not in seen[0]
    shown = plan(df)
    assert "LeftAnti" not in shown and shown.count("Join ") == 5  # whose names, hits twice, terms of a chapter, notes of a chapter


def test_terms_are_taken_apart_once_each(spark, monkeypatch):
    made, old = [], audits.written
    monkeypatch.setattr(audits, "written", lambda df: made.append(plan(df)) or old(df))
    audits.mentions_found(spark.createDataFrame([(1, "a b")], "chapter_id bigint, full_text string"), spark.createDataFrame([("a",), ("a",), ("-",)], "term string"))
    assert not any("Aggregate" in x and "split" in x for x in made)


def test_gaps_with_notes_given_twice_and_names_in_other_cases(spark):
    people = [(1, "Rand", "human"), (2, " the Red\t", "human"), (3, None, "human"), (4, "Loial", "other"), (None, "Egwene", "human")]
    rows = [(1, "RAND", False), (1, "rand ", True), (2, "The red", False), (3, "", False), (3, "Mat", False), (9, "loial", False), (4, None, False)]
    text = {11: "rand and RAND, the red", 12: "Mat met Loial.", 13: None, 14: "Egwene, Perrin", None: "Mat"}
    notes = [(1, 11, "Rand"), (1, 12, "nobody"), (1, 12, "mat"), (1, 12, "Mat"), (2, 12, "Perrin"), (2, 12, None), (3, 13, "Mat"), (4, 99, "Loial"), (4, None, "Mat"), (4, 14, "Perrin"), (4, 14, "x"), (None, 14, "y"), (2, 14, ""), (2, 14, "")]
    d = directory(spark).having(
        characters=spark.createDataFrame(people, "character_id bigint, primary_name string, character_type string"),
        aliases=spark.createDataFrame(rows, "character_id bigint, alias_text string, is_primary boolean"),
        chapters=spark.createDataFrame(list(text.items()), "chapter_id bigint, full_text string"),
        appearances=spark.createDataFrame(notes, "character_id bigint, chapter_id bigint, name_used string"),
    )
    order = lambda rows: sorted(rows, key=str)
    want = [
        (2, 11, "missing", 1, 1), (3, 12, "missing_noisy", 0, 1), (4, 12, "missing", 1, 1), (9, 12, "missing", 1, 1), (3, None, "missing_noisy", 0, 1), (None, 14, "missing", 1, 1),
        (1, 12, "phantom", 0, 0), (2, 12, "phantom", 0, 0), (2, 12, "phantom", 0, 0), (3, 13, "phantom", 0, 0), (4, 14, "phantom", 0, 0), (None, 14, "phantom", 0, 0), (2, 14, "phantom", 0, 0), (2, 14, "phantom", 0, 0),
    ]
    assert order(tuple(r) for r in audits.mention_gaps(d).collect()) == order(want)


def test_notes_and_texts_are_those_of_the_directory(spark):
    from tesserae.sources.analogue import view

    for short, whole in (("noted", "appearances"), ("texts", "chapters")):
        a = view(spark, "/root/testdata/sf0.001", short)
        b = view(spark, "/root/testdata/sf0.001", whole).select(a.columns)
        assert a.count() and not a.exceptAll(b).count() and not b.exceptAll(a).count()


def test_reports_send_no_large_table_to_the_driver(spark, monkeypatch):
    from tesserae import durable, queries

    monkeypatch.setattr(durable, "SENT", 0)  # all are large
    made, old = [], queries.written
    monkeypatch.setattr(queries, "written", lambda df: made.append(df) or old(df))
    df = queries.QUERIES["audit_report"](spark, "/root/testdata/sf0.001")
    shown = df._jdf.queryExecution().sparkPlan().toString()
    assert len(made) == 2  # no table is made that no count needs
    assert "SortMergeJoin [character_id" in shown and "BroadcastHashJoin [character_id" not in shown
    d, _ = crowd(spark)
    shown = audits.fuller_counts(d)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in "".join(x for x in shown.splitlines() if "_id" in x)


def test_odd_names_are_counted_by_themselves(spark):
    d, _ = crowd(spark)
    d = d.having(characters=d.characters.withColumn("primary_name", F.when(F.col("character_id") == 4, "the Girl").otherwise(F.col("primary_name"))))
    df = audits.summary(d, ["odd names"])
    assert "Join" not in plan(df) and df.collect()[0]["rows"] == audits.odd_names(d).count() == 1


def test_anchors_of_dossiers_are_joined_by_sorting(spark):
    d, _ = crowd(spark)
    shown = audits.dossier(d.having(characters=d.characters.withColumn("first_chapter_id", F.lit(11).cast("bigint"))))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [chapter_id" in shown


def test_collisions_with_every_owner(spark, monkeypatch):
    monkeypatch.setattr(audits, "PAIRED", 2)
    d, _ = crowd(spark)
    d = d.having(
        characters=d.characters.union(spark.createDataFrame([(40, "RAND", "human"), (40, "RAND", "human"), (41, None, "human")], d.characters.schema)),
        acknowledged_collisions=spark.createDataFrame([(1, 0, "rand thor"), (1, 27, "rand thor"), (1, 27, "rand thor"), (4, 40, "rand"), (4, 2, "other"), (3, None, "rand thor smith")], "owner_cid bigint, other_cid bigint, alias_norm string"),
    )
    people = d.characters.collect()
    known = {tuple(r) for r in d.acknowledged_collisions.collect()}
    want = sorted(
        (a["character_id"], p["character_id"], p["primary_name"]) for a in d.aliases.where("not is_primary").collect() for p in people
        if p["primary_name"] and p["primary_name"].lower() == a["alias_norm"] and p["character_id"] != a["character_id"] and (a["character_id"], p["character_id"], a["alias_norm"]) not in known
    )
    got = audits.all_collisions(d)
    assert sorted((r["character_id"], r["other_id"], r["other"]) for r in got.collect()) == want and len(want) > 20
