"""Many terms in many texts, parts of keys, exact ranks and medians, against plain scans."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tesserae.operators import audits, ranks, read, search
from tests.test_reconcile import directory

TEXTS = [
    "Rand al’Thor and Rand, RAND; Randal. rand_x rand-x ’tis Rand's", "the dragon The Dragon THE DRAGON Reborn thedragon", "ÉCLAIR éclair Éclairs, straße STRASSE", "a b a b a b a", "x", "", None,
    "İstanbul istanbul ISTANBUL Kelvin K", "日本語 日本 語", "end of rand",
]
TERMS = ["Rand", "the Dragon", "éclair", "a b a", "'tis", "x", "-", "istanbul", "k", "日本", "rand-x", "dragon", "al’Thor", "al'Thor"]


def plain(text, term):
    """Java's rule in Python: a boundary on both sides, letters without case, its own overlaps once."""
    if not text or not any(search.is_word(c) for c in term):
        return 0
    low, t, n, at = search.folded(text), search.folded(term), 0, 0
    side = lambda i: 0 <= i < len(low) and search.is_word(low[i])
    while (at := low.find(t, at)) >= 0:
        if side(at - 1) != side(at) and side(at + len(t)) != side(at + len(t) - 1):
            n += 1
            at += len(t)
        else:
            at += 1
    return n


@pytest.mark.parametrize("terms,most", [(1 << 16, 8), (3, 8), (3, 1)])
def test_terms_in_texts(spark, monkeypatch, terms, most):
    """In one pass, in several, and by the longest words."""
    monkeypatch.setattr(search, "TERMS", terms)
    monkeypatch.setattr(search, "PASSES", most)
    c = spark.createDataFrame(list(enumerate(TEXTS)), "chapter_id bigint, full_text string").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in [*TERMS, "Rand"]], "term string")
    got = {(r["chapter_id"], r["term"]): r["n"] for r in audits.mentions_found(c, wanted).collect()}
    expected = {(k, t): n for k, x in enumerate(TEXTS) for t in TERMS if (n := plain(x, t))}
    if most == 1:  # letters with more than one form are told apart by the engine's own rule there
        expected = {k: n for k, n in expected.items() if k[1] not in ("k", "istanbul")}
        got = {k: n for k, n in got.items() if k[1] not in ("k", "istanbul")}
    assert got == expected
    kept = audits.mentions_found(c, wanted, text=True).collect()
    assert all(r["full_text"] == TEXTS[r["chapter_id"]] for r in kept) and len(kept) >= len(expected)


def test_texts_are_folded_at_once(monkeypatch):
    cases = search._cases()
    texts = [*(x for x in TEXTS if x), "ΟΔΟΣ ΟΔΟΣ", "ſo µ ı İ ς", "x\u0130", *(f"x{chr(i)}y" for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).lower() != chr(i))]
    assert [search.folded(x) for x in texts] == [x.translate(cases) for x in texts]
    monkeypatch.setattr(search, "_cases", lambda: 1 / 0)
    assert search.folded("ÉCLAIR Straße 日本") == "éclair straße 日本"  # not letter by letter


def test_no_text_is_moved(spark):
    c = spark.createDataFrame(list(enumerate(TEXTS)), "chapter_id bigint, full_text string")
    wanted = spark.createDataFrame([(t,) for t in TERMS], "term string")
    plan = audits.mentions_found(c, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("most", [8, 0])
def test_evidence_by_automaton_and_by_words(spark, monkeypatch, most):
    monkeypatch.setattr(search, "PASSES", most)
    r = random.Random(2)
    words = ["red", "blue", "green", "rot", "been"]
    texts = [" ".join(r.choice(words) for _ in range(12)) for _ in range(8)] + [None, "’Twas  BLUE"]
    claims = ["", " ", "ed bl", "red", "reen been", "lue gre", "'twas blue", "ed blue gr", "zz", "e", "n b", "rot rot rot rot rot", *(" ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(30))]
    norm = lambda x: re.sub(r"\s+", " ", x.lower().replace("’", "'").replace("‘", "'")).strip()
    c = spark.createDataFrame(list(enumerate(claims)), "id int, evidence string")
    t = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    got = {r["id"]: r["verified"] for r in audits.evidence_anywhere(c, t).collect()}
    assert got == {k: any(norm(e) in norm(x) for x in texts if x is not None) for k, e in enumerate(claims)}


def test_parts_of_keys(spark):
    r = random.Random(3)
    rows = [(k, "".join(r.choice("abé ") for _ in range(r.randint(0, 9)))) for k in range(300)] + [(300, None)]
    patterns = [x for x in {"".join(r.choice("abé ") for _ in range(r.randint(1, 5))) for _ in range(60)}] + ["", "zzzz", "z"]
    df = spark.createDataFrame(rows, "key bigint, text string")
    p = spark.createDataFrame([(x,) for x in patterns], "pattern string")
    want = sorted((x, k) for x in patterns if x for k, t in rows if t is not None and x in t)
    for index in (None, search.postings(df, "key", "text")):
        assert sorted((x["pattern"], x["key"]) for x in search.containing(p, df, "key", "text", index).collect()) == want


def test_searches_at_once(spark):
    names = ["Rand al'Thor", "Mat Cauthon", "Matrim", "Perrin Aybara"]
    d = directory(spark, characters=[(k, n, "human", *[None] * 10) for k, n in enumerate(names)], aliases=[(k, k, n, n.lower(), "primary", None, True, None) for k, n in enumerate(names)] + [(9, 2, "Mat", "mat", "epithet", None, False, None)])
    asked = ["mat", " MAT ", "al'th", "", "r", "nobody"]
    got = sorted((x["query"], x["primary_name"]) for x in read.search_many(d, spark.createDataFrame([(q,) for q in asked], "query string"), read.alias_postings(d)).collect())
    assert got == sorted((q, x["primary_name"]) for q in asked for x in read.search(d, q).collect())


def test_ranks_of_any_groups(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.choice([None, *range(50)]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(5)
    got = sorted(((x["g"], x["v"], x["k"], x["rank"], x["n"]) for x in ranks.ranked(df, ["g"], ["v", "k"], total="n", tasks=7).collect()), key=repr)
    want = []
    for g in ("a", "b", None):
        own = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        want += [(*x, i, len(own)) for i, x in enumerate(own, 1)]
    assert got == sorted(want, key=repr)
    of_all = ranks.ranked(df.select("k"), [], ["k"])
    assert sorted((x["k"], x["rank"]) for x in of_all.collect()) == [(k, k + 1) for k in range(500)]
    numbered = ranks.numbered(df, ["g"], "k", width=64)
    for g in ("a", "b", None):
        assert sorted((x["k"], x["rank"]) for x in numbered.where(F.col("g").eqNullSafe(g)).collect()) == [(k, i) for i, k in enumerate(sorted(k for h, _, k in rows if h == g), 1)]


def test_medians(spark):
    r = random.Random(5)
    rows = [(r.choice("abc"), r.choice([None, r.random(), 0.5])) for _ in range(301)] + [("lone", 2.0), ("empty", None)]
    got = {x["g"]: (x["n"], x["median"]) for x in ranks.medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    values = {g: [v for h, v in rows if h == g and v is not None] for g in "abc"} | {"lone": [2.0]}
    assert got == {g: (len(v), pytest.approx(statistics.median(v), abs=0)) for g, v in values.items()}


def test_one_large_group_lies_in_many_tasks(spark, monkeypatch):
    """A million rows of one group: no task ranks more than its share."""
    kept = []
    monkeypatch.setattr(ranks, "written", lambda df, f=ranks.written: kept.append(f(df)) or kept[-1])
    df = spark.range(1_000_000).select(F.lit("one").alias("g"), F.xxhash64("id").alias("v"))
    got = ranks.medians(df, ["g"], "v", tasks=16).first()
    largest = kept[0].groupBy(F.shiftright("__id", 33)).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert largest[1] == 16 and largest[0] < 1.5 * 1_000_000 / 16
    assert got["n"] == 1_000_000 and got["median"] == df.agg(F.median("v")).first()[0]
