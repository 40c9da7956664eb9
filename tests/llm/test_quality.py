import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesserae.llm import quality
from tests.llm.cases import docs, odd_rows, prose, rows_of

NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def naive(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    found = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    inside = {j for i in range(n - 4) if found[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), n < 10 or 100 * len(inside) > 20 * n


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t#é", max_size=80))
def test_measures(x):
    assert quality.measure(x)[:6] == naive(x)


def test_long_windows_against_brute_force():
    words = prose(300, 1, ["a", "b", "c"]).split()
    for n in (2, 5, 9):
        found = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        inside = {j for i in range(len(words) - n + 1) if found[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
        assert quality.covered(quality._codes(words), n).nonzero()[0].tolist() == sorted(inside)


@pytest.mark.parametrize("extra", [False, True])
def test_query(spark, extra):
    assert rows_of(quality.measured(docs(spark, extra=extra)), *NAMES) == sorted(((i, *naive(x)) for i, x, *_ in odd_rows()), key=repr)
    kept = quality.keep(docs(spark, extra=extra))
    assert kept.columns == docs(spark, extra=extra).columns
    assert rows_of(kept, "doc_id", "text") == sorted(((i, x) for i, x, *_ in odd_rows() if quality.measure(x)[6]), key=repr)


def test_verdicts():
    clean = prose(300, 3)
    assert quality.measure(clean)[6]
    assert not quality.measure("\n".join([prose(8, 4)] * 9))[6]
    assert not quality.measure(" ".join(w + " " + w for w in prose(80, 5).split()))[6]
    assert not quality.measure(" | ".join(prose(80, 6).split()))[6]
    assert not quality.measure(None)[6]


def test_empty_table(spark):
    assert quality.measured(docs(spark, [])).count() == 0
