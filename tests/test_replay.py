"""Decisions in their order, against the same told one by one in plain Python."""

import json
import random

import pytest

from tesserae.model import SCHEMAS
from tesserae.plans import replay
from tests.test_reconcile import directory, table

DECISIONS = "review_id bigint, action string, target string, target_cid bigint, rename string, seq bigint"


def person(name, **more):
    return {"name_used_in_text": name, **more}


def told(spark, items, people=("Rand al'Thor", "Mat Cauthon"), **tables):
    c = [(k, n, "human", *[None] * 10) for k, n in enumerate(people, 1)]
    a = [(k, k, n, n.lower(), "primary", None, True, None) for k, n in enumerate(people, 1)]
    queue = [(k, ch, "possible_duplicate", json.dumps(p), "", done, None) for k, ch, p, done in items]
    return directory(spark, characters=c, aliases=a, review_queue=queue, **tables)


def one_by_one(items, decisions, people):
    """(review_id, action, who): a character's id, or the item that made them."""
    known = {n.lower(): k for k, n in enumerate(people, 1)}
    names = {k: p.get("character", p)["name_used_in_text"] for k, _, p, done in items if not done}
    out, seen = [], set()
    for k, action, target, cid, rename, _ in sorted(decisions, key=lambda x: (x[5] if x[5] is not None else x[0], x[0])):
        if k not in names or k in seen:
            continue
        seen.add(k)
        norm = lambda x: " ".join((x or "").lower().split())
        if action == "create":
            n = norm(rename or names[k])
            if n in known:
                out.append((k, "merge", known[n]))
            else:
                known[n] = f"made by {k}"
                out.append((k, "create", None))
        elif action == "merge":
            who = cid or known.get(norm(target))
            out.append((k, "merge" if who else "unresolved", who))
        else:
            out.append((k, action, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_order_against_one_by_one(spark, seed):
    r = random.Random(seed)
    people = ("Rand al'Thor", "Mat Cauthon")
    pool = ["Rand al'Thor", "Nobody New", "nobody  new", "Egwene", "Min", "Elayne"]
    items = [(k, 11, person(r.choice(pool)) if k % 2 else {"character": person(r.choice(pool))}, r.random() < 0.1) for k in range(60)]
    decisions = [
        (k, r.choice(["create", "create", "merge", "merge", "dismiss"]), r.choice([*pool, None]), r.choice([None, None, None, 2]), r.choice([None, None, "Min", "Bela"]), r.choice([None, r.randrange(60)]))
        for k in r.sample(range(70), 60)
    ]
    decisions = [(k, a, t, c, n if a == "create" else None, s) for k, a, t, c, n, s in decisions]
    d = told(spark, items, people)
    found = replay.outcomes(d.review_queue, spark.createDataFrame(decisions, DECISIONS), d.characters).collect()
    who = lambda x: x["character_id"] if x["character_id"] is not None else f"made by {x['created_by']}" if x["created_by"] is not None else None
    assert sorted(((x["review_id"], x["action"], who(x)) for x in found), key=repr) == one_by_one(items, decisions, people)


def test_what_decisions_do(spark):
    egwene = person("Egwene", character_type="human", stable_traits={"nationality": "Andoran", "age": "young", "physical_traits": " "}, aliases_observed=[{"alias_text": "Egwene al'Vere", "alias_type": "given_name"}, {"alias_text": "the Girl"}], factions=[{"name": "Green Ajah", "faction_type": "ajah"}])
    later = person("egwene", stable_traits={"nationality": "Two Rivers, Andor", "age": "about 40", "physical_traits": "dark"}, factions=[{"name": "Blue Ajah", "faction_type": "ajah"}, {"name": "Black Ajah", "faction_type": "ajah"}, {"name": "Green Ajah", "role": "leader"}])
    last = person("Egwene", stable_traits={"nationality": "Tear", "age": "young", "physical_traits": "tall"})
    edges = [{"character_a": "Egwene al'Vere", "character_b": "Rand al'Thor", "relationship_type": "ally"}, {"character_a": "Egwene", "character_b": "Moiraine", "relationship_type": "ally"}, {"character_a": "Egwene", "character_b": "egwene", "relationship_type": "ally"}]
    items = [
        (1, 11, {"character": egwene, "appearance": {"character": "Egwene", "whereabouts": "inn", "alliances_shown": ["a", "b"]}, "relationships": edges}, False),
        (2, 12, {"character": later, "relationships": [{"character_a": "egwene", "character_b": "Moiraine", "relationship_type": "rival", "directed": True}]}, False),
        (3, 13, last, False),
        (4, 11, {"character": person("Moiraine"), "relationships": edges[1:2]}, False),
        (5, 12, person("a shadow"), False),
        (6, 12, person("Egwene"), True),
    ]
    decisions = [(1, "create", None, None, None, 1), (2, "merge", "Egwene", None, None, 2), (3, "create", None, None, None, 4), (4, "create", None, None, "Moiraine Damodred", 3), (5, "dismiss", None, None, None, 5), (6, "create", None, None, None, 6)]
    mention = [(1, 11, "x", None), (3, 11, "y", None)]
    out = replay.apply(told(spark, items, mentions=mention), spark.createDataFrame(decisions, DECISIONS))
    by = {r["primary_name"]: r for r in out.characters.collect()}
    assert set(by) == {"Rand al'Thor", "Mat Cauthon", "Egwene", "Moiraine Damodred"}
    e, m = by["Egwene"]["character_id"], by["Moiraine Damodred"]["character_id"]
    assert sorted((e, m)) == [3, 4]
    assert (by["Egwene"]["nationality"], by["Egwene"]["age"], by["Egwene"]["physical_traits"]) == ("Two Rivers, Andor", "about 40", "dark")
    assert by["Egwene"]["created_at"] is not None and by["Rand al'Thor"]["updated_at"] is None
    assert table(out, "aliases", "character_id", "alias_norm", "is_primary")[2:] == sorted([(e, "egwene", True), (e, "egwene al'vere", False), (m, "moiraine damodred", True)], key=repr)
    assert table(out, "appearances", "character_id", "chapter_id", "name_used", "whereabouts", "alliances_shown") == sorted([(e, 11, "Egwene", "inn", "a, b"), (e, 12, "egwene", None, None), (e, 13, "Egwene", None, None), (m, 11, "Moiraine Damodred", None, None)], key=repr)
    # Moiraine is not there yet when the first two items are decided, and her own name was changed
    assert table(out, "relationships", "character_a", "character_b", "relationship_type", "directed") == [(1, e, "ally", False)]
    groups = {r["faction_id"]: r["name"] for r in out.factions.collect()}
    assert sorted((groups[g], role) for c, g, role in table(out, "character_factions", "character_id", "faction_id", "role")) == [("Black Ajah", "member"), ("Green Ajah", "leader")]
    assert [r["resolved"] for r in out.review_queue.orderBy("review_id").collect()] == [True] * 6
    gone = {(e, 11)} & {(r["character_id"], r["chapter_id"]) for r in out.mentions.collect()}
    assert not gone


def test_names_made_later_are_not_known_before(spark):
    items = [(1, 11, {"character": person("Rand al'Thor"), "relationships": [{"character_a": "Rand al'Thor", "character_b": "Bela", "relationship_type": "other"}]}, False), (2, 11, person("Bela"), False)]
    d = told(spark, items)
    for first, edges in ((1, []), (3, [(1, 3, "other")])):
        out = replay.apply(d, spark.createDataFrame([(1, "merge", None, 1, None, first), (2, "create", None, None, None, 2)], DECISIONS))
        assert table(out, "relationships", "character_a", "character_b", "relationship_type") == edges


def test_unresolved_items_stay_open(spark):
    items = [(1, 11, person("X"), False), (2, 11, person("Y"), False), (3, 11, person(None), False)]
    out = replay.apply(told(spark, items), spark.createDataFrame([(1, "merge", "nobody", None, None, None), (2, "explode", None, None, None, None), (3, "create", None, None, None, None)], DECISIONS))
    assert [r["resolved"] for r in out.review_queue.orderBy("review_id").collect()] == [False] * 3
    assert out.characters.count() == 2


def test_nothing_to_decide(spark):
    d = told(spark, [])
    out = replay.apply(d, spark.createDataFrame([], DECISIONS))
    assert {t: getattr(out, t).count() for t in SCHEMAS} == {t: getattr(d, t).count() for t in SCHEMAS}
