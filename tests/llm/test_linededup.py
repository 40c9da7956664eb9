import functools
import random

import pytest

from tesserae.llm import linededup as L
from tests.llm.cases import docs, odd_rows, prose, rows_of
from tests.llm.test_simhash import grouped


def mangled(line, seed, n=2):
    r = random.Random(seed)
    x = list(line)
    for _ in range(n):
        x[r.randrange(len(x))] = "z"
    return "".join(x)


def rows():
    common = prose(60, 77)
    out = odd_rows()
    for k in range(12):
        out.append((300 + k, prose(20, 500 + k) + "\n" + mangled(common, k) + "\n" + prose(15, 700 + k), "en", "p", 1))
    out.append((320, common + "\n" + common.upper() + "  \n" + "short\nshort", "en", "p", 1))
    return out


@functools.cache
def grams(x, k):
    return {x[i : i + k] for i in range(len(x) - k + 1)}


def similar(a, b):
    if min(len(a), len(b)) < 0.6 * max(len(a), len(b)):
        return False  # shingles of k characters, at most as many as there are characters
    a, b = (grams(x, 8 if max(len(a), len(b)) >= 80 else 5) for x in (a, b))
    return bool(a and b) and len(a & b) >= 0.8 * len(a | b)


def removed_by_hand(table):
    """Documents are alike in doc_id and text; the order is doc_id (null last), line, key."""
    lines = []
    for i, x, *_ in {(r[0], r[1]): r for r in table}.values():
        for n, p in enumerate((x or "").split("\n") if x is not None else []):
            q = L.normal(p.encode())
            if any(c.isascii() and c.isalnum() or not c.isascii() for c in q.decode()):
                lines.append(((i is None, i or 0, n, x), q))
    first = {}
    for place, q in sorted(lines):
        first.setdefault(q, place)
    distinct = sorted(first)
    links = [(a, b) for a in range(len(distinct)) for b in range(a) if similar(distinct[a].decode(), distinct[b].decode())]
    of = grouped(range(len(distinct)), links)
    number = {q: of[k] for k, q in enumerate(distinct)}
    stays = {}
    for place, q in sorted(lines):
        stays.setdefault(number[q], place)
    gone = {}
    for place, q in lines:
        if place != stays[number[q]]:
            gone.setdefault((None if place[0] else place[1], place[3]), []).append(place[2])
    return gone


@functools.cache
def expected():
    return removed_by_hand(rows())


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("crowd", [2048, 3])
def test_against_brute_force(spark, monkeypatch, extra, crowd):
    monkeypatch.setattr(L, "CROWD", crowd)
    table = rows()
    gone = expected()
    got = {}
    for r in L.line_report(docs(spark, table, extra)).collect():
        assert r["n_removed"] == len(r["removed"])
        got.setdefault(r["doc_id"], []).append((r["n_lines"], r["removed"]))
    want = {}
    for i, x, *_ in table:
        want.setdefault(i, []).append((0 if x is None else x.count("\n") + 1, sorted(gone.get((i, x), []))))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert sum(len(g) for g in gone.values()) >= 14
    given = docs(spark, table, extra).selectExpr("*", "1 as __key", "2 as __REMOVED")
    clean = L.drop_lines(given)
    assert clean.columns == given.columns
    left = []
    for i, x, *_ in table:
        if not (cut := gone.get((i, x))):
            left.append((i, x))
        elif (y := "\n".join(p for n, p in enumerate(x.split("\n")) if n not in cut)).strip(" \t\n\r\x0b\x0c"):
            left.append((i, y))
    assert rows_of(clean, "doc_id", "text") == sorted(left, key=repr)


@pytest.mark.parametrize("size", [(20, 80), (80, 300)])
@pytest.mark.parametrize("letters", ["ascii", "cjk"])
def test_bands_find_pairs_at_the_threshold(size, letters):
    """Lines with one changed letter (short ones), or a few."""
    r, hits, pairs = random.Random(2), 0, 0
    for k in range(900):
        n = r.randrange(*size)
        a = prose(n, 900 + k)[:n].strip() if letters == "ascii" else "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(n))
        b = mangled(a, k, 1 + len(a) // 100)
        s = 8 if max(len(a), len(b)) >= 80 else 5
        if 0.8 <= len(grams(a, s) & grams(b, s)) / max(1, len(grams(a, s) | grams(b, s))) < 1:
            pairs += 1
            keys, starts = L.banded([a.encode(), b.encode()])
            hits += bool(set(keys[: starts[1]].tolist()) & set(keys[starts[1] :].tolist()))
    assert pairs > 100 and hits >= 0.985 * pairs


def test_short_near_copies(spark):
    """One changed letter in 50 to 79 characters, across the lengths at which shingles change."""
    table = []
    for k, n in enumerate((50, 60, 70, 79, 80, 90, 120)):
        line = prose(40, 300 + k)[:n].replace(" ", "x")
        table += [(10 * k, prose(30, k) + "\n" + line, "en", "a", 1), (10 * k + 1, line[: n // 2] + "#" + line[n // 2 + 1 :] + "\n" + prose(30, 50 + k), "en", "a", 1)]
    assert rows_of(L.line_report(docs(spark, table)), "doc_id", "removed") == sorted((i, [0] if i % 10 else []) for i, *_ in table)


def test_empty_table(spark):
    assert L.line_report(docs(spark, [])).count() == 0
    assert L.drop_lines(docs(spark, [])).count() == 0


def test_short_lines_that_are_equal(spark, tmp_path):
    """A menu of 31 bytes, ten CJK characters and a word go but once; rules, blanks and lines too short to be similar stay."""
    from tesserae.llm.queries import QUERIES

    menu = "Home | News | Contact | Sign in"
    assert len(menu) == 31
    cjk = "分享到微信朋友圈吧。"
    table = [(k, "\n".join((prose(20, 900 + k), (menu, f" {menu.upper()} ")[k % 2], cjk, "-----", "", "ok", f"item {k}")), "en", "a", 1) for k in range(6)]
    docs(spark, table).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(QUERIES["op3_line_dedup"](spark, str(tmp_path)), "doc_id", "n_lines", "removed")
    assert got == [(k, 7, [1, 2, 5] if k else []) for k in range(6)]
    left = rows_of(L.drop_lines(docs(spark, table)), "doc_id", "text")
    assert left[1] == (1, "\n".join((prose(20, 901), "-----", "", "item 1")))


def test_lines_that_met_before_are_not_compared_again():
    """Groups of any size, lines with bands among short and long lines, at any place: as a plain look at all earlier bands says."""
    import numpy as np

    rng = np.random.default_rng(5)
    lines = [list(1 + 100 * np.arange(10) + rng.integers(0, 2, 10)) + (list(5000 + 100 * np.arange(10) + rng.integers(0, 2, 10)) if k % 3 else []) for k in range(12)]
    groups = [(x, [v for v in lines if x in v][:n]) for x in sorted({int(x) for v in lines for x in v}) for n in (2, 3, 9)]
    band = np.array([x for x, g in groups for _ in g])
    cut = np.cumsum([0] + [len(g) for _, g in groups])
    own = [v for _, g in groups for v in g]
    start = np.cumsum([0] + [len(v) for v in own])[:-1]
    want = []
    for x, g in groups:
        for i, v in enumerate(g):
            before = lambda w: w[w.index(x) // 10 * 10 : w.index(x)]
            want.append(any(not any(p == q for p, q in zip(before(v), before(w), strict=True)) for j, w in enumerate(g) if j != i))
    got = L.first_met(band, cut, start, np.array([x for v in own for x in v]))
    assert got.tolist() == want and any(want) and not all(want)
