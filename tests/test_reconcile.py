"""Three chapters, told one after another."""

import json

import pytest

from tesserae.model import SCHEMAS, Directory
from tesserae.plans import reconcile as R


def directory(spark, **tables):
    made = {t: spark.createDataFrame(tables.get(t, []), s) for t, s in SCHEMAS.items()}
    if "books" not in tables:
        made["books"] = spark.createDataFrame([(1, 4, "book4", "Book 4", "t", None, False)], SCHEMAS["books"])
        made["chapters"] = spark.createDataFrame([(10 + k, 1, k, f"Ch {k}", "", 0, False) for k in range(1, 6)], SCHEMAS["chapters"])
    return Directory(spark, made)


def said(spark, *chapters):
    full = [{"title": "x", "appearances": None, "mentions": None, "relationships": None} | c for c in chapters]
    return spark.read.schema(R.EXTRACTION).json(spark.sparkContext.parallelize([json.dumps(c) for c in full]))


def person(name, new=True, hint=None, origin=None, aliases=(), factions=(), confidence="high", kind="human", **traits):
    return {
        "name_used_in_text": name, "is_new_character": new, "likely_matches_existing": hint, "confidence": confidence, "character_type": kind,
        "stable_traits": {"nationality": origin, **traits}, "aliases_observed": [dict(zip(("alias_text", "alias_type", "notes"), a, strict=False)) for a in aliases],
        "factions": [dict(zip(("name", "faction_type", "role"), f, strict=False)) for f in factions],
    }


def table(d, name, *columns):
    return sorted((tuple(r[c] for c in columns) for r in getattr(d, name).collect()), key=repr)


def test_gates_and_origins(spark):
    one = {
        "chapter_id": 11,
        "characters": [person("Rand al'Thor", origin="Andoran", aliases=[("the Dragon Reborn", "epithet"), ("my lord", "title")]), person("the weaselly man"), person("Trollocs", kind="trolloc")],
        "appearances": [{"character": "Rand al'Thor", "whereabouts": "Two Rivers"}, {"character": "the weaselly man", "notable_actions": "skulks"}],
    }
    two = {"chapter_id": 12, "characters": [person("Rand al'Thor", False, origin="Emond's Field, Two Rivers, Andor")]}
    three = {"chapter_id": 13, "characters": [person("Rand al'Thor", False, origin="Tear")]}
    first = R.reconcile(directory(spark), said(spark, one), auto=True)
    assert table(first, "characters", "primary_name", "nationality") == [("Rand al'Thor", "Andor")]
    assert table(first, "aliases", "alias_norm", "is_primary") == [("rand al'thor", True), ("the dragon reborn", False)]
    assert table(first, "appearances", "character_id", "chapter_id") == [(1, 11)]
    queue = {r["kind"]: json.loads(r["payload"]) for r in first.review_queue.collect()}
    assert set(queue) == {"rejected_placeholder", "rejected_collective"}
    assert queue["rejected_placeholder"]["appearance"]["notable_actions"] == "skulks"
    assert first.chapters.where("extracted").count() == 1
    last = R.reconcile(first, said(spark, three, two), auto=True)  # told in reading order, however they come
    assert table(last, "characters", "nationality") == [("Emond's Field, Two Rivers, Andor",)]
    assert [r["kind"] for r in last.review_queue.orderBy("review_id").collect()][-1] == "origin_conflict"
    assert last.review_queue.count() == 3


def test_names_factions_and_edges(spark):
    one = {
        "chapter_id": 11,
        "characters": [
            person("Agelmar", aliases=[("Lord Agelmar", "title"), ("the Gate", "epithet"), ("Gate", "epithet")], factions=[("White Tower", "order", "Leader"), ("Green Ajah", "ajah"), ("Blue Ajah", "ajah"), ("Black Ajah", "ajah")], age="forty"),
            person("Verin Mathwin", aliases=[("the Owl", "title", "wrongly named")], age="young"),
            person("Verin Mathwin", hint="Verin", aliases=[("Verin", "given_name")]),
        ],
        "appearances": [{"character": "Agelmar", "alliances_shown": ["a", "b"]}],
        "relationships": [{"character_a": "Verin Mathwin", "character_b": "Agelmar", "relationship_type": "ally", "directed": False}, {"character_a": "Agelmar", "character_b": "Agelmar", "relationship_type": "ally"}, {"character_a": "Nobody", "character_b": "Agelmar"}],
        "mentions": [{"character": "Agelmar", "context": "x"}, {"character": "Verin Sedai", "context": "y"}, {"character": "Nobody", "context": "z"}],
    }
    two = {
        "chapter_id": 12,
        "characters": [person("Agelmar Jagad", False, hint="Agelmar", age="young lad"), person("Verin", True), person("Verin Mathwinn"), person("Verin Mathwim", confidence="low"), person("Moiraine Damodred", False), person("Lord", False)],
    }
    d = R.reconcile(directory(spark), said(spark, one, two), auto=True)
    people = {r["primary_name"]: r for r in d.characters.collect()}
    assert people["Agelmar Jagad"]["age"] == "about 40" and people["Verin Mathwin"]["age"] == "young"
    assert set(people) == {"Agelmar Jagad", "Verin Mathwin", "Verin Mathwinn"}
    a, v = people["Agelmar Jagad"]["character_id"], people["Verin Mathwin"]["character_id"]
    assert table(d, "aliases", "character_id", "alias_norm", "alias_type")[:5] == sorted([(a, "agelmar", "given_name"), (a, "agelmar jagad", "primary"), (a, "the gate", "epithet"), (v, "verin", "given_name"), (v, "verin mathwin", "primary")], key=repr)
    groups = {r["faction_id"]: r["name"] for r in d.factions.collect()}
    assert sorted((groups[f], r) for c, f, r in table(d, "character_factions", "character_id", "faction_id", "role") if c == a) == [("Black Ajah", "member"), ("Green Ajah", "member"), ("White Tower", "leader")]
    assert table(d, "relationships", "character_a", "character_b", "relationship_type", "directed") == [(a, v, "ally", False)]
    assert table(d, "appearances", "character_id", "alliances_shown") == [(a, "a, b")]
    assert table(d, "mentions", "character_id", "chapter_id", "name_used") == [(v, 11, "Verin Sedai")]
    kinds = [r["kind"] for r in d.review_queue.orderBy("review_id").collect()]
    assert kinds == ["namesake_alias", "possible_duplicate", "possible_duplicate", "ambiguous_character", "ambiguous_character"]


def test_prequels_leave_what_passes(spark):
    books = [(1, 4, "book4", "Book 4", "t", None, False), (2, 5, "newspring", "New", "n", None, True)]
    chapters = [(11, 1, 1, "x", "", 0, False), (21, 2, 1, "y", "", 0, False)]
    one = {"chapter_id": 11, "characters": [person("Moiraine Damodred")], "appearances": [{"character": "Moiraine Damodred"}]}
    two = {"chapter_id": 21, "characters": [person("Moiraine Damodred", False, age="young", origin="Cairhienin", personality="shy", factions=[("Accepted", "order"), ("House Damodred", "house")]), person("Tamra Ospenya", age="old", factions=[("Hall", "order")])]}
    d = R.reconcile(directory(spark, books=books, chapters=chapters), said(spark, two, one))
    assert table(d, "characters", "primary_name", "age", "nationality", "personality") == [("Moiraine Damodred", None, "Cairhien", None), ("Tamra Ospenya", "older", None, None)]
    assert table(d, "factions", "name") == [("Hall",), ("House Damodred",)]


def test_decisions(spark):
    one = {"chapter_id": 11, "characters": [person("Rand al'Thor"), person("the weaselly man"), person("Lord Wanderer", False)]}
    d = R.reconcile(directory(spark), said(spark, one))
    items = {json.loads(r["payload"])["character"]["name_used_in_text"]: r["review_id"] for r in d.review_queue.collect()}
    rows = [(items["the weaselly man"], "dismiss", None, None), (items["Lord Wanderer"], "merge", "rand  al’Thor", None)]
    got = R.decided(d.review_queue, spark.createDataFrame(rows, "review_id bigint, action string, target string, target_cid bigint"), d)
    assert {(r["name"], r["action"], r["character_id"]) for r in got.collect()} == {("the weaselly man", "dismiss", None), ("Lord Wanderer", "merge", 1)}


def test_backfill_adds_only_what_resolves(spark):
    one = {"chapter_id": 11, "characters": [person("Rand al'Thor")]}
    d = R.reconcile(directory(spark), said(spark, one))
    late = {"chapter_id": 12, "characters": [], "appearances": [{"character": "Rand al'Thor", "whereabouts": "inn"}, {"character": "Nobody"}]}
    assert table(R.backfill(d, said(spark, late)), "appearances", "character_id", "chapter_id", "whereabouts") == [(1, 12, "inn")]


def test_rosters_and_files(spark):
    one = {"chapter_id": 11, "characters": [person("Rand al'Thor", aliases=[("the Dragon Reborn", "epithet")])]}
    d = R.reconcile(directory(spark), said(spark, one))
    assert [r["line"] for r in R.roster_text(d).collect()] == ["Rand al'Thor [human; unknown; factions: none; aliases: the Dragon Reborn]"]
    assert R.chapters_in_order(["x/b4_c10.json", "b4_c2.json", "b3_c11.json", "b4.json", "xb4_c1.json.bak"]) == ["b3_c11.json", "b4_c2.json", "x/b4_c10.json"]


@pytest.mark.parametrize("entries,want", [([], 0), ([{"name": {"norm": ""}}], 0)])
def test_dedupe_of_nothing(entries, want):
    assert len(R.dedupe(entries)) == want


def test_times(spark):
    """Who is told of is changed now; all others, and all creations, keep their times."""
    from datetime import datetime

    from pyspark.sql import functions as F

    old, now = datetime(2020, 1, 2, 3, 4, 5, 123456), datetime(2030, 1, 1)
    people = [(k, n, "human", None, None, None, None, None, None, None, None, old, old) for k, n in ((1, "Rand al'Thor"), (2, "Verin Mathwin"))]
    aliases = [(k, k, n, n.lower(), "primary", None, True, None) for k, n in ((1, "Rand al'Thor"), (2, "Verin Mathwin"))]
    one = {"chapter_id": 11, "characters": [person("Verin Mathwin", False, physical_traits="stout"), person("Nynaeve", kind="human")]}
    out = R.reconcile(directory(spark, characters=people, aliases=aliases), said(spark, one), auto=True, now=F.lit(now))
    assert table(out, "characters", "character_id", "created_at", "updated_at") == [(1, old, old), (2, old, now), (3, now, now)]
    none = {"chapter_id": 12, "characters": []}
    assert table(R.reconcile(out, said(spark, none)), "characters", "created_at", "updated_at") == table(out, "characters", "created_at", "updated_at")


def test_of_a_name_that_many_have_few_are_held(spark):
    """The fold holds the ends of a crowd, names all of it in its notes, and tells rows of one chapter as one."""
    from pyspark.sql import functions as F

    people = [(k, "Rand Thor", "human", None, None, None, None, None, None, None, None, None, None) for k in range(1, 41)]
    aliases = [(k, k, "Rand Thor", "rand thor", "primary", None, True, None) for k in range(1, 41)]
    d = directory(spark, characters=people, aliases=aliases)
    rows = [{"chapter_id": 11, "characters": [person(n, False, physical_traits=t)]} for n, t in (("Old Rand Thor", None), ("Rand Thor", None), ("rand thor", "tall"))]
    told = said(spark, *rows).withColumn("part", F.when(F.col("characters")[0]["name_used_in_text"] == "rand thor", 2).otherwise(1))
    entries = R._entries(told)
    assert sorted(r["x"]["stable_traits"]["physical_traits"] or "" for r in entries.collect()) == ["", "tall"]
    assert R.Met(d, R._names(R._texts(told)["name"]), entries, 2).people.count() == 4
    out = R.reconcile(d, told)
    assert table(out, "review_queue", "kind", "note") == [("ambiguous_character", f"Old Rand Thor shares words with {list(range(1, 41))}")]
    assert table(out.having(characters=out.characters.where("physical_traits is not null")), "characters", "character_id", "physical_traits") == [(40, "tall")]
    assert out.characters.count() == out.aliases.count() == 40


def test_the_fold_meets_few_names_and_misses_none():
    """Against plain scans of all keys: who has the name's words, and whose key is the most similar; and that only few keys are looked at."""
    import difflib
    import random

    from tesserae.functions import values as V

    told = lambda n: {"text": n, "norm": n, "key": n, "bare": n.split(), "ranked": False, "plain": n.split(), "generic": False, "clean": n, "clean_norm": n, "clean_tokens": n.split()}
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcdeé'") for _ in range(dice.randint(1, 9)))
    names = sorted({" ".join([word(), *dice.sample(["red", "widget", "of", "the"], dice.randint(0, 3))]) for _ in range(400)} | {"a" * 300, "a" * 299 + "b", "red", "of the"})
    empty = {t: [] for t in ("more norms", "more keys", "taken", "last", "characters", "aliases", "factions", "character_factions", "appearances")}
    fold = R.Fold(empty | {"more norms": [{"n": names[5]}]}, R.Told([]))
    for c, n in enumerate(names):
        fold.put(c % 300, n, {"alias_type": "nickname", "name": told(n)})
    fold.drop(3, names[3])
    telling = lambda ws: sum(len(t) > 1 and t not in V.STOPWORDS for t in ws)
    looked = 0
    for name in names[::3] + [n[:-1] + "x" for n in names[::2]] + ["widget red", "the", "x", "a" * 301]:
        mine, want, more = set(name.split()), {}, {}
        for n, owners in fold.norms.items():
            both = mine & set(n.split())
            if telling(both) and both in (mine, set(n.split())):
                for c in owners:
                    d, s = want.get(c, (0, 0.0))
                    want[c] = max(d, telling(both)), max(s, len(both) / max(len(mine), len(n.split())))
                more |= {n: telling(both)} if n in fold.more_norms else {}
        assert fold.candidates(told(name)) == (want, more)
        ratios = [(difflib.SequenceMatcher(None, name, n).ratio(), -min(o)) for n, o in fold.norms.items() if o]
        r, c = max(ratios)
        assert fold.closest(told(name)) == ((-c, r) if r >= V.FUZZY else (None, 0.0))
        looked += len(list(fold.lettered.near(name, V.FUZZY))) if len(name) < 300 else 0
    assert looked < 30 * len(names)
