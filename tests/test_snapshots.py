"""The log of snapshots: races, going back, time travel, and comparisons that read only what differs."""

import threading

import pytest
from pyspark.sql import functions as F

from tesserae import snapshots
from tesserae.model import SCHEMAS, Directory
from tests.test_reconcile import directory, table


@pytest.fixture
def log(spark, tmp_path):
    return snapshots.Log(spark, str(tmp_path / "log root"))


def people(spark, n, kind="human"):
    rows = [(k, f"Name {k}", kind, None, None, None, None, None, None, None, None, None, None) for k in range(n)]
    return spark.createDataFrame(rows, SCHEMAS["characters"])


def small(spark, n=50):
    return Directory(spark, {t: getattr(directory(spark), t) for t in ("books", "chapters")} | {"characters": people(spark, n)})


def test_versions_and_time_travel(spark, log):
    assert log.latest() is None and log.load().characters.count() == 0
    assert log.commit(small(spark, 3), "first") == 0
    first = log.read(0).at
    assert log.commit(log.load().having(characters=people(spark, 5)), "second") == 1
    assert [log.load(v).characters.count() for v in (0, 1, None)] == [3, 5, 5]
    assert (log.at(first), log.at(first - 1)) == (0, None)
    assert log.load().mentions.count() == 0
    assert [(r["version"], r["note"], r["rows"]) for r in log.history().where("name = 'characters'").orderBy("version").collect()] == [(0, "first", 3), (1, "second", 5)]
    # tables that did not change are the same folders
    assert log.read(0).tables["chapters"]["path"] == log.read(1).tables["chapters"]["path"]
    assert table(log.load(), "chapters", *[c.split()[0] for c in SCHEMAS["chapters"].split(", ")]) == table(small(spark), "chapters", *[c.split()[0] for c in SCHEMAS["chapters"].split(", ")])


def test_of_two_writers_one_fails(spark, log):
    log.commit(small(spark), "base")
    d, results = log.load(), []
    gate = threading.Barrier(2)

    def write(n):
        entry = {t: log._written(t, getattr(d.having(characters=people(spark, n)), t), None) for t in d.tables}
        gate.wait()
        try:
            results.append((log._commit(0, entry, f"writer {n}"), n))
        except snapshots.Conflict:
            results.append((None, n))

    threads = [threading.Thread(target=write, args=(n,)) for n in (7, 8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted((v is None) for v, _ in results) == [False, True]
    winner = next(n for v, n in results if v == 1)
    assert log.versions() == [0, 1] and log.load().characters.count() == winner
    with pytest.raises(snapshots.Conflict):
        log.commit(d, "late", parent=0)
    assert log.versions() == [0, 1]


def test_going_back_and_sweeping(spark, log):
    log.commit(small(spark, 4))
    for n in (5, 6):
        log.commit(log.load().having(characters=people(spark, n)))
    assert log.roll_back(0) == 3
    assert (log.load().characters.count(), log.load(2).characters.count()) == (4, 6)
    lost = log._written("characters", people(spark, 9), None)["path"]  # a writer that never commits
    assert log.sweep(keep=2) == []
    gone = log.sweep(keep=2, age=-60)
    assert lost in gone and log.versions() == [2, 3] and len(gone) == 2
    assert (log.load().characters.count(), log.load(2).characters.count()) == (4, 6)


def test_a_comparison_reads_what_differs(spark, log):
    log.commit(small(spark, 200), buckets=16)
    new = people(spark, 201).withColumn("age", F.when(F.col("character_id") == 17, "old")).where("character_id <> 30")
    log.commit(log.load().having(characters=new), buckets=16)
    found = sorted((r["character_id"], r["change"]) for r in log.delta("characters", 0, 1).collect())
    assert found == [(17, "changed"), (30, "removed"), (200, "added")]
    differ, n = log.changed_buckets("characters", 0, 1)
    assert n == 16 and 1 <= len(differ) <= 3
    read = {r[0].split("/")[-2] for r in log._table("characters", log.read(0).tables["characters"], differ).select(F.input_file_name()).distinct().collect()}
    assert read <= {f"{snapshots.BUCKET}={k}" for k in differ}
    plan = log.delta("characters", 0, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"PartitionFilters: [{snapshots.BUCKET}") + plan.count(f"PartitionFilters: [isnotnull({snapshots.BUCKET}") == 2
    assert log.changed_buckets("chapters", 0, 1)[0] == [] and log.delta("chapters", 0, 1).count() == 0


def test_buckets_of_other_numbers(spark, log):
    log.commit(small(spark, 100), buckets=4)
    log.commit(log.load().having(characters=people(spark, 100).repartition(3)), buckets=16)
    assert log.changed_buckets("characters", 0, 1) == ([], 4)
    log.commit(log.load().having(characters=people(spark, 100).where("character_id <> 5")), buckets=8)
    assert [(r["character_id"], r["change"]) for r in log.delta("characters", 0, 2).collect()] == [(5, "removed")]
    assert [(r["character_id"], r["change"]) for r in log.delta("characters", 2, 1).collect()] == [(5, "added")]


def test_tables_that_come_and_go(spark, log):
    log.commit(small(spark, 2))
    queue = spark.createDataFrame([(1, 1, "k", None, None, False, None)], SCHEMAS["review_queue"])
    log.commit(log.load().having(review_queue=queue))
    assert [(r["change"]) for r in log.delta("review_queue", 0, 1).collect()] == ["added"]


def test_slots_of_file_names(spark):
    """One name beside the snapshots is a copy; names with more parts, and without a slot, are none."""
    from tesserae.sources.files import snapshot_slot

    names = ["x/abc_book1.db", "abc_old.db", "a/abc_test1.db", "abc_copy.db", "abc_newspring.db", "abc_backup.db", "abc.db", "abc_book1_cleanup.db", "abc_clean_book1.db", "abc_Book2.db", "abc_book3.db.bak", "abc_backup2.db"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", snapshot_slot(F.col("n")).alias("slot"))
    assert {r["n"]: r["slot"] for r in df.collect() if r["slot"] is not None} == {"x/abc_book1.db": "book1", "abc_old.db": "old", "a/abc_test1.db": "test1", "abc_copy.db": "copy", "abc_newspring.db": "newspring", "abc_backup2.db": "backup2"}
