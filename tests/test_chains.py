"""Merges that lead on to others, against merges made one by one in plain Python."""

import random

import pytest

from tesserae.model import SCHEMAS
from tesserae.operators import audits
from tesserae.plans import chains, merge
from tests.test_reconcile import directory, table

TREE = [(1, 2), (2, 3), (3, 4), (1, 5), (2, 6), (7, 8), (8, 9)]  # keep, drop


def people(n=12):
    r = random.Random(5)
    told = []
    for k in range(1, n + 1):
        trait = lambda: r.choice([None, "unknown", f"said {k}", f"other {k}"])
        told.append((k, f"Name {k}", "human", trait(), trait(), trait(), trait(), None, trait(), trait(), r.choice([None, 11, 12, 13, 14]), None, None))
    return told


def made(spark, seed=1):
    r = random.Random(seed)
    c = people()
    ids, chapters = [x[0] for x in c], [11, 12, 13, 14, 15]
    aliases = [(k, k, f"Name {k}", f"name {k}", "primary", None, True, None) for k in ids] + [(100 + k, k, w.title(), w, "epithet", None, False, None) for k in ids for w in r.sample(["red", "blue", "name 3", "name 8"], 2)]
    pairs = [(k, x) for k in ids for x in chapters]
    appearances = [(k, x, f"as {k}", None, None, None, None) for k, x in r.sample(pairs, 25)]
    there = {(k, x) for k, x, *_ in appearances}
    mentions = [(k, x, f"of {k}", None) for k, x in r.sample(pairs, 25) if (k, x) not in there]
    edges = {(a, b, r.choice(["ally", "rival"])) for a in ids for b in ids if a < b and r.random() < 0.4}
    relationships = [(a, b, t, False, f"{a}-{b}", None) for a, b, t in edges]
    groups = [(k, f"G{k}", f"g{k}", "other", None, None) for k in range(1, 4)]
    members = [(k, g, f"role {k}", None, r.choice([None, 11, 13])) for k in ids for g in (1, 2, 3) if r.random() < 0.5]
    rows = {"characters": c, "aliases": aliases, "appearances": appearances, "mentions": mentions, "relationships": relationships, "factions": groups, "character_factions": members}
    return rows, directory(spark, **rows)


def in_order(pairs):
    """Leaf first, so that what went into a duplicate is there when the duplicate goes; smaller ids first."""
    below = {}
    for keep, drop in pairs:
        below.setdefault(keep, []).append(drop)

    def visit(keep):
        for drop in sorted(below.get(keep, [])):
            yield from visit(drop)
            yield keep, drop

    for root in sorted(set(below) - {d for _, d in pairs}):
        yield from visit(root)


def one_by_one(rows, pairs):
    people_ = {r[0]: dict(zip([x.split()[0] for x in SCHEMAS["characters"].split(", ")], r, strict=True)) for r in rows["characters"]}
    looks = {(k, x): n for k, x, n, *_ in rows["appearances"]}
    said = {(k, x): n for k, x, n, *_ in rows["mentions"]}
    names = {}
    for _, k, text, norm, kind, *_ in rows["aliases"]:
        names.setdefault(k, {})[norm] = kind
    members = {(k, g): (role, first) for k, g, role, _, first in rows["character_factions"]}
    edges = {(a, b, t) for a, b, t, *_ in rows["relationships"]}
    blank = lambda v: v is None or v.strip() == "" or v.lower().startswith("unknown")
    for keep, drop in pairs:
        mine, theirs = people_[keep], people_.pop(drop)
        for t in merge.TRAITS:
            if blank(mine[t]) and not blank(theirs[t]):
                mine[t] = theirs[t]
        if theirs["first_chapter_id"] is not None and (mine["first_chapter_id"] is None or theirs["first_chapter_id"] < mine["first_chapter_id"]):
            mine["first_chapter_id"] = theirs["first_chapter_id"]
        for norm, kind in names.pop(drop).items():
            names[keep].setdefault(norm, "epithet" if kind == "primary" else kind)
        for (k, x), n in list(looks.items()):
            if k == drop:
                looks.setdefault((keep, x), n)
                del looks[k, x]
        for (k, x), n in list(said.items()):
            if k == drop:
                del said[k, x]
                said.setdefault((keep, x), n)
        for k, x in list(said):
            if (k, x) in looks:
                del said[k, x]
        for (k, g), (role, first) in list(members.items()):
            if k == drop:
                del members[k, g]
                old = members.get((keep, g))
                if old is None:
                    members[keep, g] = role, first
                elif first is not None and (old[1] is None or first < old[1]):
                    members[keep, g] = old[0], first
        edges = {(min(x), max(x), t) for a, b, t in edges if len(x := {keep if v == drop else v for v in (a, b)}) == 2}
    return people_, looks, said, names, members, edges


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_against_merges_one_by_one(spark, seed):
    rows, d = made(spark, seed)
    out = merge.apply(d, spark.createDataFrame(TREE, "keep bigint, drop bigint"))
    people_, looks, said, names, members, edges = one_by_one(rows, list(in_order(TREE)))
    assert table(out, "characters", "character_id", "first_chapter_id", *merge.TRAITS) == sorted(((k, p["first_chapter_id"], *(p[t] for t in merge.TRAITS)) for k, p in people_.items()), key=repr)
    assert table(out, "appearances", "character_id", "chapter_id", "name_used") == sorted(((*k, n) for k, n in looks.items()), key=repr)
    assert table(out, "mentions", "character_id", "chapter_id") == sorted(said, key=repr)
    assert table(out, "character_factions", "character_id", "faction_id", "role", "first_chapter_id") == sorted(((*k, *v) for k, v in members.items()), key=repr)
    assert table(out, "aliases", "character_id", "alias_norm", "alias_type") == sorted(((k, n, t) for k, x in names.items() for n, t in x.items()), key=repr)
    assert table(out, "relationships", "character_a", "character_b", "relationship_type") == sorted(edges, key=repr)
    assert audits.broken_pointers(out).count() == 0


def test_directed_edges_of_several_duplicates(spark):
    c = [(k, f"N{k}", "human", *[None] * 10) for k in range(1, 7)]
    edges = [(2, 5, "ally", True, "first", None), (5, 3, "ally", True, "back", None), (3, 5, "ally", True, "again", None), (4, 5, "ally", False, "either way", None), (1, 6, "ally", False, "stays", None), (6, 2, "ally", True, "loses", None)]
    d = directory(spark, characters=c, relationships=edges)
    out = merge.apply(d, spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "keep bigint, drop bigint"))
    assert table(out, "relationships", "character_a", "character_b", "description") == [(1, 5, "first"), (1, 6, "stays"), (5, 1, "back"), (6, 1, "loses")]


def test_faults_stop_everything(spark):
    rows, d = made(spark)
    wolf = spark.createDataFrame([(20, "Hopper", "wolf", *[None] * 10)], SCHEMAS["characters"])
    d = d.having(characters=d.characters.union(wolf))
    for pairs, said in (
        ([(1, 20)], "types differ: human and wolf"),
        ([(1, 99)], "unknown character"),
        ([(3, 3)], "itself"),
        ([(1, 2), (4, 2)], "twice"),
        ([(1, 2), (2, 3), (3, 1)], "round"),
        ([(1, 2), (2, 1), (2, 5)], "round"),
    ):
        with pytest.raises(ValueError, match=said):
            merge.apply(d, spark.createDataFrame(pairs, "keep bigint, drop bigint"))
    same = merge.apply(d, spark.createDataFrame([], "keep bigint, drop bigint"))
    assert table(same, "characters", "character_id") == table(d, "characters", "character_id")


def test_long_chains(spark):
    links = spark.createDataFrame([(k, k - 1) for k in range(1, 300)], "low bigint, high bigint")
    found = sorted((r["low"], r["high"], tuple(r["path"])) for r in chains.ends(links, "low", "high").collect())
    assert found == [(k, 0, tuple(range(1, k + 1))) for k in range(1, 300)]
