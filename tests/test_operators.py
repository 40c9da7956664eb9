"""Operators that have no SQL, against plain Python on small tables."""

import difflib
import io
import json
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tesserae import model
from tesserae.functions import similarity, texts
from tesserae.operators import audits, read, resolve, write
from tesserae.plans import change, merge
from tesserae.sources import files
from tesserae.streaming import chapters as streaming
from tests.test_reconcile import directory, table

ALIASES = [
    (1, "rand al'thor"), (1, "the dragon reborn"), (2, "mat cauthon"), (2, "matrim cauthon"), (3, "verin mathwin"), (4, "lord agelmar"), (5, "elayne trakand"), (6, "morgase trakand"),
    (7, "lewin"), (8, "adan"), (9, "master luhhan"), (10, "mistress luhhan"), (11, "perrin aybara goldeneyes"), (12, "loial son of arent"),
]


@pytest.fixture(scope="module")
def aliases(spark):
    return spark.createDataFrame(ALIASES, "character_id bigint, alias_norm string")


def resolved(spark, aliases, *cases):
    rows = [(c, None) if isinstance(c, str) else c for c in cases]
    got = resolve.resolve(spark.createDataFrame(rows, "name string, pointer string"), aliases).collect()
    by = {r["name"]: r for r in got}
    return [(by[n]["cid"], by[n]["method"], sorted(x["cid"] for x in by[n]["candidates"] or [])) for n, _ in rows]


def test_the_ladder(spark, aliases):
    cases = [
        ("Rand al’Thor", None), ("Verin Mathwin Sedai", None), ("Agelmar", None), ("Luhhan", None), ("Perrin Aybara", None), ("Dannil Lewin", None), ("Adan Smith", "Adan"),
        ("Trakand", None), ("the Lord", None), ("Mat", "Mat Cauthon"), ("Egwene", "Rand al'Thor"), ("Matrim Cauthon the Gambler", None),
    ]
    want = [
        (1, "exact", []), (3, "exact", []), (4, "exact", []), (None, "ambiguous", [9, 10]), (11, "token_subset", []), (None, "none", []), (8, "llm_pointer", []),
        (None, "ambiguous", [5, 6]), (None, "none", []), (2, "llm_pointer", []), (None, "none", []), (2, "token_subset", []),
    ]
    assert resolved(spark, aliases, *cases) == want


def test_fuzzy_against_all_pairs(spark, aliases):
    names = ["Rand al'Thorr", "Elaine Trakand", "Matrim Cauton", "nobody", "lewn", "Verin Mathwim"]
    got = {r["name"]: (r["cid"], r["ratio"]) for r in resolve.fuzzy(spark.createDataFrame([(n,) for n in names], "name string"), aliases).collect()}
    want = {}
    for n in names:
        best = max(((difflib.SequenceMatcher(None, n.lower(), a).ratio(), -c) for c, a in ALIASES))
        if best[0] >= 0.86:
            want[n] = (-best[1], best[0])
    assert got == want


def test_near_duplicates_against_the_library(spark):

    r = random.Random(5)
    names = set()
    for _ in range(60):
        x = "".join(r.choice("abcde ") for _ in range(r.randint(4, 16))).strip()
        names |= {x, x[:-1] + r.choice("abc"), x + "e"}
    names = sorted(n for n in names if n)
    got = {(r["a"], r["b"]): r["ratio"] for r in resolve.near_duplicates(spark.createDataFrame([(n,) for n in names], "name string"), 0.88, len(names)).collect()}
    want = {}
    for a in names:
        for b in names:
            if a != b and difflib.SequenceMatcher(None, b, a).ratio() >= 0.88:
                want[a, b] = difflib.SequenceMatcher(None, a, b).ratio()
    assert got == want


def test_bounds_lose_nothing(spark):
    pairs = [("ravhin", "rahvin"), ("abc", "abcd"), ("aab", "baa"), ("x", "x"), ("the gate", "gate")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select(similarity.ratio("a", "b").alias("r"), *[f(F.col("a"), F.col("b"), 0.8).alias(n) for n, f in (("l", similarity.lengths_allow), ("c", similarity.letters_allow))]).collect():
        assert r["r"] < 0.8 or (r["l"] and r["c"])


def people(spark):
    c = [(k, n, t) for k, n, t in ((1, "Rand al'Thor", "human"), (2, "Red", "human"), (3, "Lan Mandragoran", "human"), (4, "élan", "human"), (5, "Spray", "other"))]
    d = directory(spark)
    characters = spark.createDataFrame([{"character_id": k, "primary_name": n, "character_type": t} for k, n, t in c], model.SCHEMAS["characters"])
    alias = [(k, n, n.lower(), "primary", True) for k, n, _ in c] + [(1, "Lord Dragon", "lord dragon", "title", False), (3, "Lan", "lan", "given_name", False)]
    a = spark.createDataFrame([{"alias_id": i, "character_id": x[0], "alias_text": x[1], "alias_norm": x[2], "alias_type": x[3], "is_primary": x[4]} for i, x in enumerate(alias)], model.SCHEMAS["aliases"])
    text = {11: "Rand al'Thor met Lan. The red flag; RED. Élan vital, lanolin.", 12: "lord dragon and LAN!", 13: None, 14: "Spray (Lan) the-red", 15: "nothing"}
    ch = spark.createDataFrame([(k, 1, k - 10, "x", t, 0, False) for k, t in text.items()], model.SCHEMAS["chapters"])
    app = spark.createDataFrame([{"character_id": a, "chapter_id": b, "name_used": n} for a, b, n in ((1, 11, "Rand"), (1, 15, "nothing"), (2, 15, "x"), (3, 12, "Lan"))], model.SCHEMAS["appearances"])
    return d.having(characters=characters, aliases=a, chapters=ch, appearances=app), text


def test_mention_gaps_against_a_plain_scan(spark):
    d, text = people(spark)
    names = {}
    for r in d.aliases.collect():
        names.setdefault(r["character_id"], {}).setdefault(r["alias_text"].lower(), r["alias_text"])
    there = {(r["character_id"], r["chapter_id"]): r["name_used"] for r in d.appearances.collect()}
    noisy = lambda t: len(t) < 4 or t.lower() in ("red",)
    count = lambda t, x: len(re.findall(rf"\b{re.escape(t)}\b", x or "", re.IGNORECASE))
    want = set()
    for c, own in names.items():
        for k, x in text.items():
            total = sum(count(t, x) for t in own.values())
            sure = sum(count(t, x) for t in own.values() if not noisy(t))
            if (c, k) in there:
                if not total and not count(there[c, k], x):
                    want.add((c, k, "phantom", 0, 0))
            elif sure:
                want.add((c, k, "missing", sure, total))
            elif total:
                want.add((c, k, "missing_noisy", 0, total))
    assert {tuple(r) for r in audits.mention_gaps(d).collect()} == want


def test_empty_shells_and_dossiers(spark):
    d, _ = people(spark)
    assert table(d.having(characters=audits.empty_shells(d)), "characters", "primary_name") == [("Spray",)]
    p = {r["character_id"]: r for r in read.profiles(d).collect()}
    assert [a["alias_text"] for a in p[1]["aliases"]] == ["Rand al'Thor", "Lord Dragon"] and [a["chapter_id"] for a in p[1]["appearances"]] == [11, 15]
    assert [r["character_id"] for r in read.search(d, "LAN").collect()] == [3, 4]
    assert read.search(d, "  ").count() == 0 and read.search(d, "r%thor").count() == 1


def test_snapshots(spark, tmp_path):
    d, _ = people(spark)
    model.save(d, f"{tmp_path}/book1")
    again = model.load(spark, f"{tmp_path}/book1")
    assert table(again, "aliases", "alias_norm") == table(d, "aliases", "alias_norm")
    with pytest.raises(FileExistsError):
        model.save(d, f"{tmp_path}/book1")
    shown = model.public(d)
    assert audits.export_problems(d, shown).count() == 0
    assert "full_text" not in shown.chapters.columns and shown.review_queue.count() == 0
    leaky = shown.having(characters=shown.characters.withColumn("description", F.lit("see /home/x")).withColumn("secret", F.lit(1)))
    assert {(r["name"], r["column"]) for r in audits.export_problems(d, leaky).collect()} == {("characters", "description"), ("characters", "private secret")}


def test_merge_keeps_everything_once(spark):
    d = directory(spark)
    c = [{"character_id": k, "primary_name": n, "character_type": "human", "nationality": o, "first_chapter_id": f} for k, n, o, f in ((1, "Al", "unknown", 13), (2, "Al Meira", "Andor", 12), (3, "Bo", None, None))]
    a = [{"alias_id": k, "character_id": o, "alias_text": n, "alias_norm": n.lower(), "alias_type": t, "is_primary": t == "primary"} for k, (o, n, t) in enumerate(((1, "Al", "primary"), (2, "Al Meira", "primary"), (2, "Al", "nickname"), (2, "Ally", "nickname"), (3, "Bo", "primary")))]
    app = [{"character_id": o, "chapter_id": k} for o, k in ((1, 11), (2, 11), (2, 12))]
    men = [{"character_id": o, "chapter_id": k} for o, k in ((1, 12), (1, 14), (2, 14), (2, 15), (3, 11))]
    rel = [{"character_a": x, "character_b": y, "relationship_type": t, "directed": g} for x, y, t, g in ((1, 2, "ally", False), (1, 3, "ally", False), (2, 3, "ally", False), (2, 3, "rival", True), (3, 2, "rival", True), (2, 2, "self", True))]
    fac = [{"faction_id": k, "name": n, "name_norm": n.lower(), "faction_type": "other"} for k, n in ((1, "X"), (2, "Y"))]
    mem = [{"character_id": o, "faction_id": f, "first_chapter_id": k} for o, f, k in ((1, 1, 13), (2, 1, 11), (2, 2, 12))]
    of = lambda t, rows: spark.createDataFrame(rows, model.SCHEMAS[t])
    d = d.having(characters=of("characters", c), aliases=of("aliases", a), appearances=of("appearances", app), mentions=of("mentions", men), relationships=of("relationships", rel), factions=of("factions", fac), character_factions=of("character_factions", mem), distinct_pairs=of("distinct_pairs", [{"cid_low": 1, "cid_high": 2}, {"cid_low": 2, "cid_high": 3}]))
    pairs = spark.createDataFrame([(1, 2)], "keep bigint, drop bigint")
    m = merge.apply(d, pairs)
    assert table(m, "characters", "character_id", "nationality", "first_chapter_id") == [(1, "Andor", 12), (3, None, None)]
    assert table(m, "aliases", "character_id", "alias_norm", "alias_type") == sorted([(1, "al", "primary"), (1, "al meira", "epithet"), (1, "ally", "nickname"), (3, "bo", "primary")], key=repr)
    assert table(m, "appearances", "character_id", "chapter_id") == [(1, 11), (1, 12)]
    assert table(m, "mentions", "character_id", "chapter_id") == [(1, 14), (1, 15), (3, 11)]
    assert table(m, "relationships", "character_a", "character_b", "relationship_type") == [(1, 3, "ally"), (1, 3, "rival")]
    assert table(m, "character_factions", "character_id", "faction_id", "first_chapter_id") == [(1, 1, 11), (1, 2, 12)]
    assert table(m, "distinct_pairs", "cid_low", "cid_high") == [(1, 3)]
    gone = change.delete(d, spark.createDataFrame([(2,)], "character_id bigint"))
    assert {r["name"]: r["rows"] for r in change.deletion_counts(d, spark.createDataFrame([(2,)], "character_id bigint")).collect()}["relationships"] == 5
    assert gone.relationships.count() == 1 and gone.characters.count() == 2
    with pytest.raises(ValueError):
        change.delete_aliases(d, spark.createDataFrame([(1, "al")], "character_id bigint, alias_norm string"))
    assert change.delete_aliases(d, spark.createDataFrame([(2, "ally")], "character_id bigint, alias_norm string")).aliases.count() == 4
    lone = gone.having(relationships=gone.relationships.where("false"))
    with pytest.raises(ValueError):  # the name is taken
        change.restore(d, d, spark.createDataFrame([(3,)], "character_id bigint"))
    back = change.restore(d.having(mentions=d.mentions.where("character_id <> 2")), lone, spark.createDataFrame([(2,)], "character_id bigint"))
    assert table(back, "characters", "character_id", "primary_name") == [(1, "Al"), (3, "Bo"), (4, "Al Meira")]
    assert table(back, "appearances", "character_id", "chapter_id") == [(1, 11), (4, 11), (4, 12)] and back.relationships.count() == 5


def test_versions_and_seeds(spark):
    d, _ = people(spark)
    wanted = spark.createDataFrame([("Red", "rand  al’thor", "x"), ("Red", "Nobody", "y")], "a string, b string, note string")
    pairs, skipped = change.seed_pairs(d, wanted)
    assert [(r["cid_low"], r["cid_high"]) for r in pairs.collect()] == [(1, 2)] and [r["name"] for r in skipped.collect()] == ["Nobody"]
    grown = change.next_snapshot(d, "newspring", 5, "New Spring")
    assert table(grown, "books", "book_id", "series_order", "slot") == [(1, 4, "book4"), (2, 5, "newspring")]
    for slot, order in (("book4", 9), ("other", 4), ("A b", 9)):
        with pytest.raises(ValueError):
            change.next_snapshot(d, slot, order, "x")
    old = spark.createDataFrame([(1, 3, "t")], "book_id bigint, series_order int, title string")
    assert [(r["slot"], r["label"], r["is_prequel"]) for r in change.with_slots(old).collect()] == [("book3", "Book 3", False)]
    shown = d.having(characters=d.characters.withColumn("display_name", F.when(F.col("character_id") == 2, "Red Boy")))
    kept = change.without_display_name(shown)
    assert "display_name" not in kept.characters.columns and kept.aliases.where("alias_norm = 'red boy' and alias_type = 'given_name'").count() == 1
    fuller = d.having(aliases=d.aliases.unionByName(spark.createDataFrame([{"alias_id": 99, "character_id": 2, "alias_text": "Lord Red Ajax", "alias_norm": "lord red ajax", "alias_type": "given_name", "is_primary": False}], model.SCHEMAS["aliases"])))
    assert [(r["character_id"], r["chosen"], r["blocked"]) for r in change.promotions(fuller).collect()] == [(2, "Red Ajax", False)]
    assert change.clean_aliases(d).aliases.count() == d.aliases.count()
    used = d.having(appearances=d.appearances.where("character_id = 3").withColumn("name_used", F.lit("Al Lan Mandragoran")))
    assert [r["name_used"] for r in change.fuller_used(used).collect()] == ["Al Lan Mandragoran"]


def test_html_and_json():
    page = "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><h1>A &amp; B</h1><p>one <b>two</b></p>\n\n<p> </p><p>three</p></body></html>"
    assert texts.text_of(page).split("\n") == ["T", "A & B", "one", "two", "three"]
    assert texts.text_of("<p>Head</p><p>x</p>", ("Head",)) == "x" and texts.text_of(None) is None and texts.text_of("") == ""
    assert texts.first_object('```json\n{"a": {"b": 1}} tail {"c"}') == '{"a": {"b": 1}}'
    assert texts.first_object("none } {open") is None and texts.first_object(None) is None
    long = "word " * 100 + "the Target here " + "more " * 100
    (p,) = texts.passages_of(long, "target")
    assert p.startswith("word word") and p.endswith("more") and len(p) <= 407 and "Target" in p
    assert texts.passages_of("targets", "target") == [] and texts.passages_of(None, "x") == []


def test_contents_and_headings(spark):
    cases = {
        "Prologue: Lightnings": ("prologue", 0, "Lightnings"), "Prologue": ("prologue", 0, None), "Epilogue: An Answer": ("epilogue", None, "An Answer"), "4      The Gleeman": ("chapter", 4, "The Gleeman"),
        "Chapter 1: High Chasaline": ("chapter", 1, "High Chasaline"), "Chapter 12": ("chapter", 12, None), "1st Age": None, "Glossary": None, "Map": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = [r[0] and tuple(r[0]) for r in df.select(texts.contents_entry(F.col("x"))).collect()]
    assert got == list(cases.values())
    pages = spark.createDataFrame([("<h1>Chapter 3</h1><h2>The <i>Way</i></h2>",), ("<p>x</p>",)], "h string")
    assert [r[0] for r in pages.select(texts.heading(F.col("h"))).collect()] == ["The Way", None]


def test_outcomes(spark):
    rows = [("Andor", ["x"], "Tear", "x", None), (None, [], "Tear", "x", None), (None, ["x"], "Tear", "x", "boom"), (None, ["a b"], "Tear", "made up", None), ("unknown", ["He is  a ‘Tairen’"], "Tear", "a 'tairen'", None), (None, ["x"], "unclear", "", None)]
    df = spark.createDataFrame(rows, "c string, p array<string>, s string, q string, e string")
    assert [r[0] for r in df.select(texts.outcome(*map(F.col, "cpsqe"))).collect()] == ["kept_existing", "no_passages", "error", "not_stated", "would_write", "not_stated"]


def test_books_and_logs(spark, tmp_path):
    ncx = "".join(f'<navPoint><navLabel><text>{t}</text></navLabel><content src="{h}"/></navPoint>' for t, h in (("Prologue", "p.html"), ("1 The Road", "c.html#x"), ("Epilogue", "e.html"), ("Glossary", "g.html")))
    page = "<html><body><h1>{}</h1><p>CHAPTER 1</p><p>Text of {}</p></body></html>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="c"><rootfiles><rootfile full-path="O/b.opf"/></rootfiles></container>')
        z.writestr("O/b.opf", '<package xmlns="o"><manifest><item id="n" href="t.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine/></package>')
        z.writestr("O/t.ncx", f"<ncx><navMap>{ncx}</navMap></ncx>")
        for x in "pceg":
            z.writestr(f"O/{x}.html", page.format("A Storm", x))
    (tmp_path / "b").mkdir()
    (tmp_path / "b/one.epub").write_bytes(data.getvalue())
    got = files.book_chapters(files.books(spark, f"{tmp_path}/b")).orderBy("chapter_number").collect()
    assert [(r["chapter_number"], r["kind"], r["title"], r["word_count"]) for r in got] == [(0, "prologue", "A Storm", 7), (1, "chapter", "The Road", 7), (2, "epilogue", "A Storm", 7)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e/b4_c2.json").write_text(json.dumps({"_meta": {"chapter_id": 12}, "characters": [{"name_used_in_text": "X"}]}))
    (tmp_path / "e/b4_c3.json").write_text("{not json")
    (tmp_path / "e/notes.json").write_text("{}")
    rows = files.extractions(spark, f"{tmp_path}/e/*.json").collect()
    assert [(r["series_order"], r["chapter_number"], r["chapter_id"], r["characters"][0]["name_used_in_text"]) for r in rows] == [(4, 2, 12, "X")]
    (tmp_path / "p.json").write_text(json.dumps({"schema_version": 2, "results": []}))
    with pytest.raises(ValueError):
        files.proposals(spark, f"{tmp_path}/p.json")
    for _ in range(2):
        files.append_log(spark.createDataFrame([(1, "a")], "id int, what string"), f"{tmp_path}/log")
    assert files.table_with_header(spark, f"{tmp_path}/log", ["id"]).count() == 2
    with pytest.raises(ValueError):
        files.table_with_header(spark, f"{tmp_path}/log", ["nope"])


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", 1), (3, "d", 2), (3, "e", 3)], "k int, v string, n int")
    rows = lambda df: sorted(tuple(r) for r in df.select("k", "v").collect())
    assert rows(write.insert_ignore(old.select("k", "v"), new, ["k"], [F.col("n")])) == [(1, "a"), (2, "b"), (3, "d")]
    replaced = write.insert_replace(old, new.drop("n").withColumn("n", F.col("k")), ["k"], [F.col("v")])
    assert sorted((r["k"], r["v"], r["w"]) for r in replaced.collect()) == [(1, "a", "x"), (2, "c", None), (3, "e", None)]


def test_streamed_appearances(spark, aliases, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.json").write_text('{"chapter_id": 11, "name": "Rand al\'Thor", "pointer": null}\n{"chapter_id": 11, "name": "Nobody", "pointer": null}\n')
    stream = spark.readStream.schema("chapter_id bigint, name string, pointer string").json(str(inbox))
    q = streaming.watch(stream, aliases, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.processAllAvailable()
    (inbox / "2.json").write_text('{"chapter_id": 11, "name": "Rand al\'Thor", "pointer": null}\n{"chapter_id": 12, "name": "Adan", "pointer": null}\n')
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in streaming.told(spark, f"{tmp_path}/out").collect()) == [(1, 11, "Rand al'Thor"), (8, 12, "Adan")]


def test_passages_reads_documents_of_any_language(spark, tmp_path):
    from tesserae.queries import QUERIES

    rows = [(1, "the one", "en"), (2, "the two", "de"), (3, "the three", None), (4, "none here", "fr")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    (r,) = QUERIES["passages"](spark, str(tmp_path)).collect()
    assert (r["id"], r["chapters"], r["matches"], sorted(r["passages"])) == (2, 3, 3, ["the one", "the three", "the two"])


def test_pairs_that_may_be_similar(spark):
    """All pairs over the ratio are among those that meet by segments, and few others."""

    r = random.Random(4)
    words = ["".join(r.choice("abcdeilmnorst") for _ in range(r.randint(1, 14))) for _ in range(120)]
    names = set(words) | {"é", "aa", "aab"}
    for w in list(words):
        x = list(w)
        for _ in range(r.randint(1, 2)):
            x.insert(r.randrange(len(x) + 1), r.choice(["", "z", "é"]))
            if r.random() < 0.5:
                x.pop(r.randrange(len(x)))
        names.add("".join(x))
    names = sorted(n for n in names if n)
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for least in (0.86, 0.88):
        want = {(a, b) for a in names for b in names if difflib.SequenceMatcher(None, a, b).ratio() >= least}
        got = {(x["a"], x["b"]) for x in similarity.may_be_similar(df, df, least).collect()}
        assert want <= got and len(got) <= 0.05 * len(names) ** 2


def test_evidence_anywhere(spark):
    texts = ["The old  man‘s hat, and a stick", "Two words", None, "", "one"]
    claims = ["old MAN's hat,", "man's", "wo wor", "two word", "an's hat, and a st", "d man's hat, and a sti", "stick one", "hat a", "", "ne", "nothing here at all"]
    c = spark.createDataFrame(list(enumerate(claims)), "id int, evidence string")
    t = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    got = {r["evidence"]: r["verified"] for r in audits.evidence_anywhere(c, t).collect()}
    low = [" ".join((x or "").lower().replace("‘", "'").split()) for x in texts if x is not None]
    assert got == {x: any(" ".join(x.lower().split()) in y for y in low) for x in claims}


def test_new_ids_have_no_gaps(spark):
    from tesserae.operators.write import new_ids

    df = spark.createDataFrame([(k // 3, str(k)) for k in range(300)], "k bigint, x string")
    got = new_ids(df, "id", 10, "k", ["k", "x"], buckets=7)
    assert got.columns == ["k", "x", "id"]
    assert sorted(r["id"] for r in got.collect()) == list(range(11, 311))
    assert new_ids(df.where("false"), "id", 10, "k", ["k"]).count() == 0
