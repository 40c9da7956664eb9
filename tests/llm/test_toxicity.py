import math
import random
import zlib

import pytest

from tesserae.llm import toxicity as X
from tests.llm.cases import docs, prose

BAD = ["moronic", "scumbag", "trashy", "idiot"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    r = random.Random(3)
    terms = ["abcde$", "abcab$", "cabbage$", "abc$", "bcabc", "ddddd"]
    machine = X.Automaton(dict.fromkeys(terms, 1.0))
    for _ in range(4000):
        w = "".join(r.choice("abcdeg") for _ in range(r.randint(0, 9)))
        want = {}
        for t in terms:
            core = t.removesuffix("$")
            ends = [w] if t[-1] == "$" else [w[:k] for k in range(len(w) + 1)]
            d = min(distance(core, x) for x in ends)
            if d <= (1 if len(core) >= X.FUZZY else 0):
                want[t] = d
        assert machine.hits(w) == want, w


def table():
    r = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        words = prose(40, k).split()
        toxic = int(k % 4 == 0)
        if toxic:
            for w in r.sample(BAD, 2):
                words.insert(r.randrange(len(words)), w)
        rows.append((k, " ".join(words), "en", "a", 1))
        labels.append((k, toxic))
    return rows, labels + [(5000, None), (None, 1), (9999, 1)]


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = table()
    return X.fit(docs(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_held_out(spark, model):
    rows, labels = table()
    rows = rows + [(2000, None, None, None, None), (None, "", "en", "a", 1), (7, rows[7][1], "en", "a", 1)]
    truth = {i: t for i, t in labels if i is not None and t is not None}
    got = X.scored(docs(spark, rows, extra=True), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        if r["doc_id"] in truth:
            assert r["predicted"] == truth[r["doc_id"]]
    assert {f"{w}$" for w in BAD} <= set(model.weights)


def value(model, x):
    return X.score(x, model, model.automaton)


def test_spelling_and_context(model):
    clean = prose(20, 999)
    assert value(model, f"{clean} sc0umbag {clean}") >= 0.7  # one letter too many
    assert value(model, f"{clean} scumbg, {clean}") >= 0.7
    assert value(model, f"{clean} 1d10t! {clean}") >= 0.7
    assert value(model, clean) < 0.2 and value(model, None) < 0.2
    plain, quoted = value(model, f"{clean} you idiot {clean}"), value(model, f'{clean} the word "idiot" is an insult {clean}')
    assert plain > 0.7 > quoted


def plain_score(text, model):
    """Every word against every term by edit distance, and the formula."""
    words, found = (text or "").lower().split(), {}
    terms = [t for t in model.weights if t[0] != "~"]
    for at, word in enumerate(words):
        w, near = X.core(word), {}
        for t in terms:
            bare = t.removesuffix("$")
            d = min(distance(bare, x) for x in ([w] if t[-1] == "$" else [w[:k] for k in range(len(w) + 1)]))
            if d <= (1 if len(bare) >= X.FUZZY else 0):
                near[t] = d
        for t in [t for t, d in near.items() if not d] or [f"~{t}" for t in near]:
            found[t] = max(found.get(t, 0.0), X.context(words, at))
    gains = sorted((model.weights.get(f, 0.0) * c for f, c in found.items()), reverse=True)
    z = model.prior + sum(g / 2**k for k, g in enumerate(gains)) if found else model.none
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_against_a_plain_implementation(spark, model):
    r, rows = random.Random(8), []
    for k in range(60):
        words = prose(15, 5000 + k).split()
        for _ in range(k % 4):
            w = list(r.choice(BAD))
            if k % 3:
                w[r.randrange(len(w))] = r.choice(["z", "", "0", "ab"])
            words.insert(r.randrange(len(words)), r.choice(['"%s"', "%s!", "you %s", "said %s"]) % "".join(w))
        rows.append((k, " ".join(words), "en", "a", 1))
    got = {x["doc_id"]: x["score"] for x in X.scored(docs(spark, rows), model).collect()}
    assert got == pytest.approx({k: plain_score(x, model) for k, x, *_ in rows})
    assert len({round(x, 3) for x in got.values()}) > 5


def test_short_words_are_terms_too(spark):
    rows = [(k, prose(12, k) + (" xq " if k % 2 else " ab ") + prose(12, 300 + k), "en", "a", 1) for k in range(200)]
    m = X.fit(docs(spark, rows), spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id bigint, toxic int"))
    assert "xq$" in m.weights and value(m, "a xq b") >= 0.7 > value(m, "ab")


def test_without_labels(spark):
    m = X.fit(docs(spark), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r["score"] for r in X.scored(docs(spark), m).collect()} == {0.5}
    assert X.scored(docs(spark, []), m).count() == 0
