import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tesserae.llm import lm
from tests.llm.cases import docs, odd_rows, prose, rows_of


def table():
    """Two languages, so that a history says something about the next word."""
    one = [a + b for a in "bcdfg" for b in ("al", "an", "ar", "at", "as")]
    two = [a + b for a in "klmnp" for b in ("ou", "oi", "ue", "ie", "io")]
    return odd_rows()[:6] + odd_rows()[8:] + [(1000 + k, prose(80, k, (one, two)[k % 2]), "en", "a", 1) for k in range(120)]


def base(rows):
    tokens = [(i, (x or "").encode().lower().split() + [None]) for i, x, *_ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for i, t in tokens]


@pytest.mark.parametrize("extra", [False, True])
def test_base_and_gain(spark, monkeypatch, extra):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    d = docs(spark, table(), extra)
    got = lm.scored(d, *lm.fit(d)).collect()
    want = sorted(base(table()), key=repr)
    for r, w in zip(sorted(got, key=lambda r: repr((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"]))), want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(r["score"])
    held = [r for r in got if r["held_out"] and r["doc_id"] >= 1000]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)


def masses(model, rare, rows):
    """What each group's words weigh, by counting them one by one."""
    import xxhash

    v = model.vocabulary
    words = {w for _, x, *_ in rows for w in (x or "").encode().lower().split()}
    count = dict(rows_of(rare, "h", "n"))
    mass = np.zeros((lm.CLASSES, lm.GROUPS))
    for k, n in enumerate(v.counts):
        mass[v.classes[k], v.groups[k]] += n + 1
    other = sorted(words - {bytes(w) for w in v.words})
    for w, k in zip(other, v.rare(other).tolist(), strict=True):
        h = xxhash.xxh64_intdigest(w, 42)
        if c := count.get(h - (1 << 64) * (h >> 63)):
            mass[k, 0] += c + 1
    mass[2 : lm.END : 3, 0] += 1  # the word never seen
    mass[lm.END, 0] = model.ends + 1
    return mass


def softmax(z):
    z = np.exp(z - z.max())
    return z / z.sum()


def test_probabilities_of_a_history_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    model, rare = lm.fit(docs(spark, table()))
    mass = masses(model, rare, table())
    e = lm.encode([prose(50, 3), None], model.vocabulary, model.vocabulary.ranks())
    assert np.allclose(np.exp(lm.log_softmax(model.weights, model.bias, e.features)).sum(axis=1), 1, atol=1e-5)
    known = mass > 0
    assert np.allclose(np.log10(mass[known]), model.log_mass[known])
    # one place, with the groups of every class in turn
    some = known.any(axis=1)
    assert some[: lm.END : 3].any() and (known[: lm.END : 3].sum(axis=1) > 1).any()
    for c in np.flatnonzero(some):
        p = softmax(model.group_bias[c].astype(float))
        assert p[known[c]].sum() == pytest.approx(1) and not p[~known[c]].any()


def test_scores_word_by_word(spark, monkeypatch):
    """Every token by itself: its class, its group there, and its share of the group."""
    monkeypatch.setattr(lm, "FREQUENT", 40)
    rows = [r for r in table() if r[0] is not None][:60]
    d = docs(spark, rows)
    model, rare = lm.fit(d)
    v, mass = model.vocabulary, masses(model, rare, rows)
    rank = {bytes(w): k for k, w in enumerate(v.words)}
    counts = Counter(w for i, x, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in (x or "").encode().lower().split())
    bucket = lambda *parts: lm.COARSE + int(lm._buckets(*[np.array([p]) for p in parts])[0])

    def score(text):
        words = (text or "").encode().lower().split()
        cls = [int(v.classes[rank[w]]) if w in rank else int(v.rare([w])[0]) for w in words]
        word = [rank[w] if w in rank and rank[w] < lm.FEATURES else lm.FEATURES + c for w, c in zip(words, cls, strict=True)]
        name = [rank[w] if w in rank else len(v.words) + c for w, c in zip(words, cls, strict=True)]
        total = 0.0
        for k, w in enumerate([*words, None]):
            before = lambda a, n, first, k=k: a[k - n] if k >= n else first
            x, y, z = (before(word, n, lm.WORDS - 1) for n in (1, 2, 3))
            pair = ((x * 0x9E3779B1 + y * 0x85EBCA77) >> 7) % lm.PAIRS
            c = lm.END if w is None else cls[k]
            total += math.log10(softmax(sum(model.weights[f] for f in (x, y + lm.WORDS, z + 2 * lm.WORDS, pair + 3 * lm.WORDS)) + model.bias)[c])
            g = 0
            if w in rank:
                g = int(v.groups[rank[w]])
                x, y = (before(name, n, len(v.words) + lm.CLASSES) for n in (1, 2))
                fine = [bucket(1, c, x), bucket(2, c, y), bucket(3, c, x, y)]
                total += math.log10(softmax(sum(model.weights[f] for f in fine) + model.group_bias[c])[g])
            total += math.log10((model.ends if w is None else counts[w]) + 1) - math.log10(mass[c, g])
        return total

    want = sorted((i, score(x)) for i, x, *_ in rows)
    got = sorted((r["doc_id"], r["score"]) for r in lm.scored(d, model, rare).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-4, atol=1e-3)


def test_groups_share_the_counts():
    assert lm.grouped(np.array([90, 5, 3, 2]), 3).tolist() == [0, 1, 2, 2]
    assert lm.grouped(np.array([1] * 6), 3).tolist() == [0, 0, 1, 1, 2, 2]
    assert lm.grouped(np.array([5, 4]), 25).tolist() == [0, 1]
    assert lm.grouped(np.zeros(0, int), 25).tolist() == []


def test_nothing_to_learn(spark):
    none = docs(spark, [])
    assert lm.scored(none, *lm.fit(none)).count() == 0
    one = docs(spark, [(1, None, None, None, None)])
    r = lm.scored(one, *lm.fit(one)).first()
    assert (r["n_tokens"], math.isfinite(r["score"])) == (1, True)


def test_more_than_five_kinds_of_words_are_told_apart(spark):
    """Eight languages without common words."""
    tongues = [[a + b for a in ab for b in ("al", "or", "in", "us", "et")] for ab in ("bc", "df", "gh", "jk", "lm", "np", "rs", "tv")]
    rows = [(k, prose(120, k, tongues[k % 8]), "en", "a", 1) for k in range(160)]
    v = lm.fit(docs(spark, rows))[0].vocabulary
    assert len(set((v.classes // 3).tolist())) > 5
