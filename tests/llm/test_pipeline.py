"""The stages against brute force on a small table."""

import pytest

import corpus_pipeline as C
from tesserae.llm import quality
from tests.llm.cases import DOCS, docs
from tests.llm.test_linededup import removed_by_hand, rows
from tests.llm.test_mixing_and_sharding import targets, words
from tests.llm.test_simhash import grouped, naive
from tests.llm.test_tokens_and_packing import check_places


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    docs(spark, rows()).write.parquet(f"{folder}/documents.parquet")
    out, d = [], spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, f) in enumerate(C.STAGES):
        f(spark, d, folder).write.parquet(f"{folder}/{k}")
        d = spark.read.parquet(f"{folder}/{k}")
        out.append(d)
    return folder, out


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_each_stage(spark, stages):
    folder, (good, lines, near, mixed, packed) = stages
    for d in (good, lines, near, mixed):
        assert d.columns == DOCS.names
    table = [r for r in rows() if quality.measure(r[1])[6]]
    assert pairs(good) == sorted(((r[0], r[1]) for r in table), key=repr)
    gone, left = removed_by_hand(table), []
    for i, x, _, s, _ in table:
        y = "\n".join(p for n, p in enumerate(x.split("\n")) if n not in gone.get((i, x), ()))
        if y.strip() or (i, x) not in gone:
            left.append((i, y, None, s, None))
    assert pairs(lines) == sorted(((r[0], r[1]) for r in left), key=repr)
    fps = {naive(r[1], 5) for r in left}
    of = grouped(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    best = {}
    for r in left:
        key = of[naive(r[1], 5)]
        rank = (r[0] is None, r[0] or 0)
        if key not in best or rank < best[key][0]:
            best[key] = rank, r
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in near.collect()) == sorted(rank for rank, _ in best.values())
    sizes = {}
    for r in near.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    goal, taken = targets(sizes), dict.fromkeys(sizes, 0)
    for r in mixed.collect():
        taken[r["source"]] += len(words(r["text"]))
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in sizes)
    check_places(packed.collect(), 2048)
    assert packed.where("piece = 0").count() == mixed.count()


def test_run_is_the_stages(spark, stages):
    folder, out = stages
    got = C.run(spark, folder)
    assert sorted(map(repr, got.drop("sequence_id", "offset").collect())) == sorted(map(repr, out[-1].drop("sequence_id", "offset").collect()))
    assert C.ORACLE_SQL is None and [f.__name__ for _, f in C.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]
