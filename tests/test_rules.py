"""The rules on golden cases: phrase in, verdict out."""

import pytest
from pyspark.sql import functions as F

from tesserae.functions import ages, names, origins


def ask(spark, rule, cases, schema="x string"):
    rows = [c if isinstance(c, tuple) else (c,) for c in cases]
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(rule(*[F.col(f"`{c}`") for c in df.columns])).collect()]


def yes(spark, rule, good, bad, schema="x string"):
    assert ask(spark, rule, good, schema) == [True] * len(good)
    assert ask(spark, rule, bad, schema) == [False] * len(bad)


def test_norm(spark):
    cases = {"  Rand  al’Thor\t": "rand al'thor", None: "", "": "", "ÉLAN  x": "élan x", "‘a’": "‘a'"}
    assert ask(spark, names.norm, cases) == list(cases.values())
    assert ask(spark, names.norm_search, ["‘A’  b"]) == ["'a' b"]
    assert ask(spark, lambda c: names.norm(names.norm(c)) == names.norm(c), cases) == [True] * len(cases)


def test_generic_suspect_and_noisy(spark):
    yes(spark, names.is_generic, ["Aes Sedai", "the girl", "girl", "my lord", "What", "sister", "the man", "mistress"], ["Rand al'Thor", "Verin Sedai", "Else", "the Dragon Reborn"])
    yes(spark, names.is_suspect, ["what"], ["Else", "what now"])
    yes(spark, names.is_noisy, ["Red", " la ", "deep"], ["Verin", "redder"])


def test_titles(spark):
    cases = {
        "lord of fal dara": "of fal dara", "verin mathwin aes sedai": "verin mathwin", "mistress mathwin": "mathwin", "the high lady alteima": "alteima",
        "agelmar dai shan": "agelmar", "verin sedai": "verin", "agelmar jagad": "agelmar jagad", "": "", "lord lord x": "lord x", "the the x": "the x",
    }
    assert ask(spark, names.strip_titles, cases) == list(cases.values())
    keys = {"Verin Sedai": "verin", "Lord Agelmar": "agelmar", "the High Lady Alteima": "alteima", "Agelmar Jagad": "agelmar jagad"}
    assert ask(spark, names.match_key, keys) == list(keys.values())


ALIAS = "x string, t array<string>"


def test_rank_decoration(spark):
    verin, agelmar = ["verin", "mathwin"], ["agelmar", "jagad"]
    good = [(x, verin) for x in ("verin sedai", "verin aes sedai", "verin mathwin aes sedai", "mistress mathwin")]
    good += [("lord agelmar", agelmar), ("agelmar dai shan", agelmar), ("high lady alteima", ["alteima"])]
    bad = [("lord of fal dara", agelmar), ("the amyrlin seat", ["siuan", "sanche"]), ("mother", ["siuan", "sanche"]), ("faile", ["zarine", "bashere"]), ("faile", ["faile", "aybara"])]
    bad += [("queen of andor", ["queen", "morgase"]), ("lews therin", ["rand", "al'thor", "lews", "therin", "telamon"])]
    yes(spark, names.is_rank_decorated, good, bad, ALIAS)


def test_descriptions(spark):
    good = [("stout little verin", ["verin", "mathwin"]), ("the stout verin", ["verin"])]
    bad = [("the dragon reborn", ["rand", "al'thor"]), ("lord agelmar", ["agelmar", "jagad"]), ("stout verin of cairhien", ["verin", "mathwin"]), ("the a", ["verin"])]
    yes(spark, names.is_description, good, bad, ALIAS)


def test_misnomers(spark):
    good = ["mistakenly called the Amyrlin", "wrongly named", "incorrectly identified", "called in error", "not actually her name", "the text corrects this", "confused with her sister"]
    yes(spark, names.is_misnomer, good, [None, "", "a title she holds", "her given name"])


def test_primary_names(spark):
    yes(spark, names.is_placeholder, ["the weaselly man", "a serving woman", "the woman with the dagger", "the innkeeper", "the gleeman"], ["Rand al'Thor", "the Dark One", "Narg", None, ""])
    kind = "x string, k string"
    yes(spark, names.is_collective, [("Trollocs", "trolloc"), ("the Myrddraal", "myrddraal")], [("Narg", "trolloc"), ("Bela", "horse"), ("Trollocs", None)], kind)
    cases = [("the weaselly man", "human"), ("Trollocs", "trolloc"), ("the Amyrlin Seat", "human"), ("Rand al'Thor", "human")]
    assert ask(spark, names.rejection, cases, kind) == ["placeholder", "collective", "title", None]
    assert ask(spark, names.character_type, [None, "", " Wolf ", "dragon"]) == ["human", "human", "wolf", "other"]
    assert ask(spark, names.faction_type, [None, "AJAH", "x"]) == ["other", "ajah", "other"]


def test_origins(spark):
    yes(spark, origins.is_unresolved, [None, "", "  ", "unknown", "Unknown", "unknown (not Two Rivers)", "unclear", "n/a"], ["Andor", "Two Rivers, Andor", "Aiel"])
    yes(spark, origins.is_placeholder_value, [None, " ", "Unknown x"], ["unclear", "n/a"])
    full = "Emond's Field, Two Rivers, Andor"
    cases = {
        "unknown": None, "": None, "Andor (presumably)": "Andor", "Andoran": "Andor", "Cairhienin": "Cairhien", "Tairen": "Tear", "Aiel": "Aiel", "(maybe)": None,
        "Emond's Field, Two Rivers, Andoran": full, "Two Rivers": "Two Rivers, Andor", "Emond's Field": full, "Maule": "Maule, Tear", "Two Rivers, Andor": "Two Rivers, Andor",
        full: full, "Sea Folk": "Atha'an Miere", " , Tear ,": "Tear",
    }
    assert ask(spark, origins.normalized, cases) == list(cases.values())
    assert all(ask(spark, lambda c: origins.normalized(origins.normalized(c)).eqNullSafe(origins.normalized(c)), cases))
    pair = "x string, k string"
    assert ask(spark, origins.category, [("Narg", "trolloc"), ("a Myrddraal", "myrddraal"), ("the Dark One", "other"), ("Machin Shin", "other"), ("Rand al'Thor", "human")], pair) == ["Shadow", "Shadow", "Time", "Time", None]
    refine = [
        (None, "Andor", "Andor", False), ("unknown", "Andoran", "Andor", False), ("Andor", full, full, False), (full, "Andor", full, False), ("Two Rivers, Andor", "Two Rivers", "Two Rivers, Andor", False),
        ("Two Rivers", full, full, False), ("Andor", "Tear", "Andor", True), ("Andor", "unknown", "Andor", False),
    ]
    got = ask(spark, origins.refined, [r[:2] for r in refine], pair)
    assert [(g["value"], g["conflict"]) for g in got] == [r[2:] for r in refine]


def test_ages(spark):
    cases = {
        "middle years": "middle years", "Middle years": "middle years", "middle-aged": "middle years", "old; much older than the other students": "older", "Older (gray-haired)": "older", "aging": "older",
        "elderly (pensioner)": "elderly", "ancient, imprisoned for three thousand years": "elderly", "young": "young", "young man": "young", "youngish": "young", "youngest of the four Wisdoms": "young",
        "young woman, old enough to dance the Spring Pole": "young", "in her late twenties": "young", "girl": "child", "Five years old": "child", "Nine": "child", "Adult": "adult",
        "ageless Aes Sedai features": "ageless", "fourteen": "about 14", "nineteen": "about 19", "Nearly twenty": "about 20", "Over seventy": "about 70", "sixty-three": "about 63", "about 40": "about 40",
        "older than Mat (ca. 30)": "about 30", "19 years old": "about 19", "500": None,
    }
    assert ask(spark, ages.normalized, cases) == list(cases.values())
    none = ["alive", "deceased", "deceased, killed twenty years ago", "Unknown", "long dead (historical)", "older than Aviendha", "same age as Perrin", "Of an age with Edorion", "not much older than Rand"]
    none += ["Has been a peddler for twenty years", "Aes Sedai for 130 years", "over forty years as a Darkfriend", "", None]
    assert ask(spark, ages.normalized, none) == [None] * len(none)
    steps = [("young", "grown man", "adult"), ("older", "young lad", "older"), ("young", "19 years old", "about 19"), ("about 19", "young", "about 19"), ("adult", "ageless", "ageless"), ("ageless", "young novice", "ageless"), (None, "alive", None), ("middle years", "elderly", "elderly")]
    bands = ["child", "young", "adult", "middle years", "older", "elderly"]
    steps += [(a, b, b) for a, b in zip(bands, bands[1:], strict=False)]
    assert ask(spark, ages.refined, [s[:2] for s in steps], "a string, b string") == [s[2] for s in steps]
    assert ask(spark, ages.rank, [None, "ageless", "about 12", "about 25", "about 41", "about 70", "about 71", "elderly", "x"]) == [-1, 7, 0, 1, 3, 4, 5, 5, -1]


def test_canonical_names(spark):
    cases = {
        "High Lady Suroth Sabelle Meldarath": "Suroth Sabelle Meldarath", "the High Lady Alteima": "Alteima", "Lord Agelmar": "Agelmar", "Lord Captain Commander Pedron Niall": "Pedron Niall",
        "Elayne of House Trakand": "Elayne Trakand", "Edorion of House Selorna": "Edorion Selorna", "Agelmar Jagad": "Agelmar Jagad", "Sulwin of the Wandering People": "Sulwin of the Wandering People",
        "Loial son of Arent son of Halan": "Loial son of Arent son of Halan",
    }
    assert ask(spark, names.adopted, cases) == list(cases.values())
    fuller = [("Rodel Ituralde", "Ituralde"), ("Rand al'Thor", "Rand"), ("Agelmar Jagad", "Lord Agelmar")]
    no = [("Ituralde", "Rodel Ituralde"), ("the sul'dam with red panels", "Red"), ("Rand al'thor x", "Rand"), ("a b c d e", "a"), (None, "x"), ("X", ""), ("Rand", "rand")]
    yes(spark, names.is_fuller, fuller, no, "a string, b string")


def test_alias_verdicts(spark):
    schema = "n string, k string, note string, t array<string>, s array<string>"
    own = ["verin", "mathwin"]
    cases = [
        ("verin sedai", "title", None, own, [], "DROP", "rank_decorated"), ("x", "title", "wrongly named", own, [], "DROP", "corrected_misnomer"), ("stout verin", "epithet", None, own, [], "DROP", "descriptor_epithet"),
        ("dragon", "title", None, own, ["the dragon"], "COLLAPSE", "article_dup"), ("the gleeman", "epithet", None, own, [], "REVIEW", "generic_role"), ("brown sister", "title", None, own, [], "REVIEW", "generic_role"),
        ("mother", "title", None, own, [], "REVIEW", "empty_residue"), ("the dragon reborn", "title", None, own, [], "KEEP", ""),
    ]
    got = ask(spark, names.alias_verdict, [c[:5] for c in cases], schema)
    assert [(g["action"], g["rule"]) for g in got] == [c[5:] for c in cases]


def test_groups_slots_and_colours(spark):
    held = "h array<string>, n string"
    yes(spark, names.ajah_conflict, [(["Green Ajah"], "Blue Ajah")], [(["Green Ajah"], "Black Ajah"), (["Green Ajah", "Black Ajah"], "Green Ajah"), ([], "Blue Ajah")], held)
    assert ask(spark, names.slot_of_number, ["9", " 12 ", "newspring"]) == ["book9", "book12", "newspring"]
    yes(spark, names.slot_valid, ["book10", "newspring"], ["Book1", "a-b", "", "a b", "../x", "book1\n"])
    got = ask(spark, names.order_and_label, ["book10", "newspring"])
    assert [tuple(g) for g in got] == [(10, "Book 10"), (None, None)]

    def colour(key):
        h = 0
        for c in key:
            h = (h * 31 + ord(c) + 2**31) % 2**32 - 2**31
        from tesserae.functions.values import NO_COLOUR, PALETTE

        return PALETTE[abs(h) % 12] if key else NO_COLOUR

    keys = ["", "White Tower", "a", "The Children of the Light and more"]
    assert ask(spark, names.hash_colour, keys) == [colour(k) for k in keys]


@pytest.mark.parametrize("text", ["Lord Lord Agelmar", "the Verin Sedai Sedai"])
def test_keys_settle(spark, text):
    once = ask(spark, names.match_key, [text])[0]
    assert ask(spark, names.match_key, [once])[0] in (once, ask(spark, names.strip_titles, [once])[0])
