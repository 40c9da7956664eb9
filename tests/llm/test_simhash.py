import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tesserae.llm import components as connected
from tesserae.llm import simhash
from tesserae.llm.components import components
from tests.llm.cases import docs, odd_rows, prose, rows_of


def naive(text, shingle=4):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(ids, links):
    """The smallest id that links reach."""
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            if of[a] != low or of[b] != low:
                of[a] = of[b] = low
                changed = True
    return of


def test_fingerprints():
    for _, x, *_ in odd_rows():
        assert simhash.fingerprint(x) == naive(x)


def test_golay_code_covers():
    r = np.random.default_rng(1)
    words = r.integers(0, 1 << 23, 500)
    at, anchor, own = simhash.anchors(words, 1)
    d = np.bitwise_count(words[at] ^ anchor)
    assert (simhash._syndrome(anchor) == 0).all() and d.max() <= 4
    assert (np.bincount(at[own], minlength=500) == 1).all() and d[own].max() <= 3
    flipped = words ^ (1 << r.integers(0, 23, 500))  # a word one bit off is sent to the anchor of this one
    at2, anchor2, _ = simhash.anchors(flipped, 1)
    sent = set(zip(at2.tolist(), anchor2.tolist(), strict=True))
    assert all((k, a) in sent for k, a in zip(at[own].tolist(), anchor[own].tolist(), strict=True))


@pytest.mark.parametrize("homes", [4096, 3])
def test_links_against_brute_force(spark, homes):
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for x in list(fps):
        for _ in range(r.randint(0, 5)):  # up to 6 bits off, in chains
            for b in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(simhash._signed(x) for x in fps)
    want = grouped(fps, [(a, b) for k, a in enumerate(fps) for b in fps[:k] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    found = components(simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint").repartition(3), homes=homes))
    got = {x: x for x in fps} | {r["node"]: r["root"] for r in found.collect()}
    assert got == want


def near_copies():
    base = prose(400, 1).split()
    rows = odd_rows()
    for k in range(6):
        changed = list(base)
        changed[50 * k] = "changed"
        rows.append((200 - k, " ".join(changed), "en", "n", 1))
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_groups_and_survivors(spark, extra):
    rows = near_copies()
    fps = {naive(x) for _, x, *_ in rows}
    pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    of = grouped(fps, pairs)
    least = defaultdict(list)
    for i, x, *_ in rows:
        least[of[naive(x)]].append(i)
    want = sorted(((i, f"{naive(x):016x}", min((j for j in least[of[naive(x)]] if j is not None), default=None)) for i, x, *_ in rows), key=repr)
    got = simhash.grouped(docs(spark, rows, extra)).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) as f", "component_id")
    assert rows_of(got, "doc_id", "f", "component_id") == want
    kept = simhash.keep_one(docs(spark, rows, extra))
    assert kept.columns == docs(spark, rows, extra).columns
    by = defaultdict(list)
    for r in kept.collect():
        by[of[naive(r["text"])]].append(r["doc_id"])
    assert {k: len(v) for k, v in by.items()} == dict.fromkeys(least, 1)
    assert all(by[k][0] == min((j for j in least[k] if j is not None), default=None) for k in least)


def test_unique_ids_take_the_short_way(spark):
    rows = [(k, prose(100, k % 5), "en", "a", 1) for k in range(20)]
    assert rows_of(simhash.keep_one(docs(spark, rows)), "doc_id") == [(k,) for k in range(5)]


def test_empty_table(spark):
    assert simhash.grouped(docs(spark, [])).count() == 0
    assert simhash.keep_one(docs(spark, [])).count() == 0


@pytest.mark.parametrize("held", [500_000, 4])
def test_components_of_paths_stars_and_rings(spark, monkeypatch, held):
    monkeypatch.setattr(connected, "HELD", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(300 + k, 300 + (k + 1) % 17) for k in range(17)] + [(5, 5), (9, 9)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5))
    got = {r["node"]: r["root"] for r in found.collect()}
    want = grouped({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k not in (5, 9)}
    assert found.count() == len(got)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
