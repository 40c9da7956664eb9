import random
import re
import zlib
from collections import Counter

import pytest

from tesserae.llm import spelling
from tests.llm.cases import docs, odd_rows, rows_of

NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def naive(rows, least=7, twice=2, every=31, factor=10):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= twice}
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in beside.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(beside[w]), n.get(form[w])) for w in n), key=repr)


def chained():
    """Words with slips of slips, so that forms make chains, and ties."""
    r = random.Random(4)
    base = ["governs", "éclairçie", "strasses", "millions", "million", "aaaaaaaa", "ÀÉÈabcdef"]
    rows = []
    for k, w in enumerate(base):
        one, two = w[:3] + "q" + w[4:], w[:3] + "qz" + w[5:]
        rows += [(k, " ".join([w] * 220 + [w.upper()] * 3), None, None, 0), (20 + k, " ".join([one] * 20 + [two] * 2), None, None, 0)]
        rows.append((40 + k, " ".join(w[: (i := r.randrange(len(w)))] + w[i + 1 :] for _ in range(9)), None, None, 0))
    return rows + [(60, "x1y2 <<governs>> govıerns ÿÿÿÿÿÿÿ÷ÿÿÿÿÿÿÿ×", None, None, 0)]


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_all_pairs(spark, extra):
    rows = odd_rows() + chained()
    found = rows_of(spelling.variants(docs(spark, rows, extra=extra)), *NAMES)
    assert found == naive(rows)
    assert any(form != root for _, form, root, *_ in found if form is not None)  # a chain


def test_every_pair_meets_once(spark):
    r = random.Random(7)
    words = list({"".join(r.choice("ab") for _ in range(r.randint(3, 7))) for _ in range(300)})
    df = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n bigint")
    assert rows_of(spelling.pairs(df), "word", "other") == sorted((a, b) for a in words for b in words if near(a, b))


def test_long_chains_and_circles(spark):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)], "word string, form string")
    assert rows_of(spelling.roots(chain), "word", "root") == sorted((f"w{k}", "w37") for k in range(37))
    with pytest.raises(ValueError):
        spelling.roots(spark.createDataFrame([("a", "b"), ("b", "a")], "word string, form string"), most_rounds=5)


def test_empty_tables_and_texts(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, None, None, None, None), (2, "", None, None, 0), (None, None, None, None, None)])).count() == 0


def test_tasks_hand_on_what_they_hold(spark, monkeypatch):
    rows = odd_rows() + chained()
    monkeypatch.setattr(spelling, "HELD", 5)
    assert rows_of(spelling.counted(docs(spark, rows)), "word", "n") == sorted((w, n) for w, _, _, n, *_ in naive(rows))
