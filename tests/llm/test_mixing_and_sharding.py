import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tesserae.llm import common, mixing, sharding
from tests.llm.cases import docs, odd_rows, rows_of


def targets(sizes):
    """Share by weight, stop at twice a source's size, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    goal, left, open_ = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share, left = left, 0.0
        for s in list(open_):
            goal[s] += share * weight[s] / total
            if goal[s] >= 2 * sizes[s]:
                left += goal[s] - 2 * sizes[s]
                goal[s] = 2.0 * sizes[s]
                open_.discard(s)
    return goal


def words(x):
    return (x or "").encode().split()


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("bucket", [4096, 5])
def test_mix(spark, monkeypatch, extra, bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
    rows = odd_rows()
    got = mixing.mix(docs(spark, extra=extra)).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((i, len(words(x))) for i, x, *_ in rows), key=repr)
    sizes = defaultdict(int)
    for _, x, _, s, _ in rows:
        sizes[s] += len(words(x))
    goal, taken = targets(dict(sizes)), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 0.5
    again = mixing.mix(docs(spark).repartition(7)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in again) == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)


def test_mixture_gives_the_words_taken(spark):
    d = docs(spark, extra=True)
    mixed = mixing.mixture(d)
    assert mixed.columns == d.columns
    taken, got = Counter(), Counter()
    for r in mixing.mix(d).collect():
        taken[r["source"]] += r["taken"]
    for r in mixed.collect():
        got[r["source"]] += len(words(r["text"]))
    assert +got == +taken


@pytest.mark.parametrize("bucket", [4096, 4])
def test_copies_are_spread_and_told_apart(spark, monkeypatch, bucket):
    """Many rows alike, and texts that stand in two sources under one number: each source gets its own words."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    both = [(k, "some words " * 15, "en", s, 1) for k in range(31) for s in "ab"]
    rows = [(None, "all the same to me", "en", "a", 1)] * 40 + both + [(k, f"row {k} of others", "en", "cd"[k % 2], 1) for k in range(40, 90)]
    taken, got = Counter(), Counter()
    for r in mixing.mix(docs(spark, rows)).collect():
        taken[r["source"]] += r["taken"]
    for r in mixing.mixture(docs(spark, rows).selectExpr("*", "'x' as __id", "1 as __N")).collect():
        assert r["__id"] == "x"
        got[r["source"]] += len(words(r["text"]))
    sizes = Counter()
    for _, x, _, s, _ in rows:
        sizes[s] += len(words(x))
    assert got == taken and all(abs(taken[s] - g) <= 0.5 for s, g in targets(dict(sizes)).items())
    places = sharding.shard(docs(spark, rows)).collect()
    assert len(places) == len(rows) and max(Counter(r["shard"] for r in places).values()) == -(-len(rows) // 8)
    assert {(r["shard"], r["slot"]) for r in places} == {(s, k) for s, n in Counter(r["shard"] for r in places).items() for k in range(n)}


def test_nothing_to_mix_or_shard(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mixture(docs(spark, [])).count() == 0
    assert sharding.shard(docs(spark, [])).count() == 0
    only = mixing.mix(docs(spark, [(1, None, None, None, None), (2, " ", "en", "a", 1)])).collect()
    assert [(r["target"], r["taken"]) for r in only] == [(0.0, 0)] * 2


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("bucket", [4096, 5])
def test_shards(spark, monkeypatch, extra, bucket):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    rows = odd_rows()
    got = sharding.shard(docs(spark, extra=extra)).collect()
    want = sorted(((i, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for i, x, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    by = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        by[r["shard"]].append(r["slot"])
    assert set(by) <= set(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_every_shard_has_the_mixture(spark):
    rows = [(k, f"text {k}", "en", "big" if k % 3 else f"s{k % 4}", 1) for k in range(4800)]
    got = sharding.shard(docs(spark, rows)).groupBy("shard", "source").count().collect()
    total = Counter("big" if k % 3 else f"s{k % 4}" for k in range(4800))
    for r in got:
        assert abs(r["count"] - total[r["source"]] / 8) <= 1.5
    assert len(got) == 8 * len(total)


def test_many_small_sources_crowd_no_bucket(spark, monkeypatch):
    """Every row a source of its own: a bucket of the second ranking holds about as many rows as it should."""
    seen = []

    def watched(df, by, bucket, *more, f=common.ranked):
        if not by:
            seen.append(df.groupBy(bucket.alias("b")).count().agg(F.max("count"), F.count(F.lit(1))).first())
        return f(df, by, bucket, *more)

    monkeypatch.setattr(sharding, "ranked", watched)
    rows = spark.range(40_000).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "concat('host', id) as source", "1L as n_chars")
    got = sharding.shard(rows).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    assert seen[0][1] == 10 and seen[0][0] < 1.2 * sharding.ROWS_PER_BUCKET
    assert [(r["n"], r["last"], r["slots"]) for r in got] == [(5000, 4999, 5000)] * 8


def test_running_total_in_two_levels(spark):
    d = spark.range(1000).selectExpr("id % 3 as g", "id div 3 as k", "id as v")
    got = rows_of(common.running_total(d, ["g"], "k", "v", "s", width=10), "g", "k", "s")
    assert got == sorted(((g, k, sum(3 * j + g for j in range(k))) for g in range(3) for k in range(334) if 3 * k + g < 1000), key=repr)
