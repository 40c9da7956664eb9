import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import langid
from tests.llm.cases import docs, odd_rows, rows_of

SYLLABLES = {"aa": "ba ke lo ti mu", "bb": "schu für ach eng ol", "cc": "ção nha ria lho es"}


def prose(lang, n, r):
    s = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randint(1, 4))) for _ in range(n))


def labelled(n=240, seed=1):
    r = random.Random(seed)
    return [(k, prose(lang := ("aa", "bb", "cc")[k % 3], r.randint(3, 60), r), lang, "s", 0) for k in range(n)]


def plain_grams(text):
    """n-grams in words of Python integers."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    s = [32, *map(ord, " ".join(letters.split())), 32]
    found = Counter()
    for n in range(1, langid.ORDERS + 1):
        for i in range(len(s) - n + 1):
            h = 0
            for k, c in enumerate(s[i : i + n], 1):
                h = (h * 0x9E3779B1 + c + k) % 2**32
            h ^= h >> 15
            found[h * 0x85EBCA6B % 2**32 >> 16] += 1
    return found


@pytest.mark.parametrize("text", ["Hello, World!", "a", "  ça, va?\n\nOui…  日本語 🙂x", "straße ÀÉ", "x" * 5000])
def test_grams(text):
    at, n = langid.grams(text)
    assert dict(zip(at.tolist(), n.tolist(), strict=True)) == plain_grams(text)


def test_no_letter_no_grams():
    assert not any(len(langid.grams(x)[0]) for x in ("", " \n", "12 34 !?", "🙂"))


def plain_leader(rows, classes, r):
    """Follow the regularised leader, weight by weight."""
    z, n = {}, {}

    def w(i, k):
        a = z.get((i, k), 0.0)
        return 0.0 if abs(a) <= r.l1 else (math.copysign(r.l1, a) - a) / ((r.beta + math.sqrt(n.get((i, k), 0.0))) / r.alpha + r.l2)

    for x, y in rows:
        scores = [sum(v * w(i, k) for i, v in x.items()) for k in range(classes)]
        e = [math.exp(s - max(scores)) for s in scores]
        old = {(i, k): w(i, k) for i in x for k in range(classes)}
        for i, v in x.items():
            for k in range(classes):
                g = v * (e[k] / sum(e) - (k == y))
                before = n.get((i, k), 0.0)
                n[i, k] = before + g * g
                z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(n[i, k]) - math.sqrt(before)) / r.alpha * old[i, k]
    return {key: w(*key) for key in z}


def test_training_against_a_plain_implementation():
    r, rates = random.Random(2), langid.Rates()
    rows = [({i: r.random() for i in r.sample(range(30), 8)}, r.randrange(3)) for _ in range(60)]
    leader = langid.Leader(3, rates)
    for x, y in rows:
        leader.learn(np.array(list(x)), np.array(list(x.values())), y)
    expected = plain_leader(rows, 3, rates)
    found = leader.weights(np.arange(30))
    assert all(abs(found[i, k] - v) < 1e-9 for (i, k), v in expected.items())
    assert 0 < (found == 0).sum()  # the elastic net leaves zeros


def test_temperature_is_the_best():
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 3, 400)
    logits = 6 * (np.eye(3)[labels] + rng.normal(0, 0.8, (400, 3)))
    t = langid.temperature(logits, labels)

    def loss(t):
        return -np.log(langid.softmax(logits / t)[np.arange(400), labels]).sum()

    assert t > 1.5
    assert all(loss(t) <= loss(t * f) + 1e-3 for f in (0.8, 0.95, 1.05, 1.2))


def test_held_out_texts(spark):
    rows = labelled()
    df = docs(spark, rows)
    out = langid.predicted(df, langid.fit(df)).collect()
    lang = {k: x for k, _, x, *_ in rows}
    held = [r for r in out if r.held_out]
    assert 20 < len(held) < 80
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_frequencies_cover_all_texts(spark):
    rows = labelled(50)
    df, n = langid.frequencies(docs(spark, rows))
    expected = Counter(b for _, text, *_ in rows for b in plain_grams(text))
    assert n == 50
    assert {int(b): int(df[b]) for b in np.flatnonzero(df)} == expected


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = labelled(90)
    a = docs(spark, rows)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    b = a.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    one, two = (rows_of(langid.predicted(a, langid.fit(x)), "doc_id", "held_out", "lang_pred", "score") for x in (a, b))
    assert one == two


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    rows = odd_rows() + [(k + 1000, *r[1:]) for k, r in enumerate(labelled(60))]
    df = docs(spark, rows, extra=extra)
    out = langid.predicted(df, langid.fit(df))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = rows_of(out, "doc_id", "lang_pred")
    assert len(found) == len(rows)
    und = {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert {i for i, x in found if x == "und"} - {None} == und - {None}
    again = rows_of(langid.predicted(df, langid.fit(df)), *out.columns)
    assert again == rows_of(out, *out.columns)


def test_nothing_to_learn_from(spark):
    empty = docs(spark, [])
    assert langid.predicted(empty, langid.fit(empty)).count() == 0
    unlabelled = docs(spark, [(k, "some text", None, None, 0) for k in range(9)])
    assert {r.lang_pred for r in langid.predicted(unlabelled, langid.fit(unlabelled)).collect()} == {"und"}


def test_a_sample_of_more_rows(spark):
    """A sixth of the rows fit the weights, the same ones again; copies of one row are one."""
    rows = labelled(600) + labelled(1) * 300
    df = docs(spark, rows)
    one, two = langid.fit(df, sample=100), langid.fit(df.repartition(7), sample=100)
    assert one.langs == two.langs and np.allclose(one.weights, two.weights) and one.temperature == pytest.approx(two.temperature)
    lang = {k: x for k, _, x, *_ in rows}
    held = langid.predicted(df, one).where("held_out").collect()
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
