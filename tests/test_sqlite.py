"""Snapshots in SQLite files against their Parquet twins."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from tesserae import model
from tesserae.model import SCHEMAS
from tesserae.operators import read
from tesserae.sources import sqlite

KINDS = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "string": "TEXT", "timestamp": "TEXT"}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def twins(spark, tmp_path_factory):
    """A directory in a file and in Parquet; the file lacks a column and some tables, and has one of its own."""
    folder = tmp_path_factory.mktemp("twins")
    r, path = random.Random(6), str(folder / "x y_book3.db")
    con, made = sqlite3.connect(path), {}
    for t in ("books", "characters", "aliases", "chapters"):
        fields = [x.strip().split() for x in SCHEMAS[t].split(",")]
        stored = [(c, k) for c, k in fields if not (t == "books" and c == "is_prequel")]
        con.execute(f"CREATE TABLE {t} ({', '.join(f'{c} {KINDS[k]}' for c, k in stored)})")
        rows = []
        for n in range(1000 if t == "aliases" else 40):
            value = {"bigint": n, "int": n % 7, "boolean": n % 2, "string": r.choice([None, "", "Ünïcode ’x’", f"text {n}", "Rand"]), "timestamp": f"2024-01-0{1 + n % 9} 10:11:12"}
            rows.append([value[k] for _, k in stored])
        con.executemany(f"INSERT INTO {t} VALUES ({', '.join('?' * len(stored))})", rows)
        df = spark.createDataFrame([tuple(x) for x in rows], ", ".join(f"{c} {'bigint' if k in ('int', 'boolean') else 'string' if k == 'timestamp' else k}" for c, k in stored))
        made[t] = df.select(*[F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in fields])
    con.execute("CREATE TABLE notes (k TEXT PRIMARY KEY, v BLOB, x REAL, y) WITHOUT ROWID")
    con.executemany("INSERT INTO notes VALUES (?, ?, ?, ?)", [("a", b"\0\1", 1.5, "7"), ("b", None, 2, 7)])
    con.execute("CREATE TABLE odd (n INTEGER, s TEXT COLLATE NOCASE)")
    con.executemany("INSERT INTO odd (rowid, n, s) VALUES (?, ?, ?)", [(-5, 1, "ABC"), (9, 2, "abc"), (10**12, 3, None)])
    con.commit()
    con.close()
    model.save(model.Directory(spark, made), str(folder / "parquet"))
    return path, model.load(spark, str(folder / "parquet"))


def test_equal_to_parquet(spark, twins):
    path, other = twins
    d = sqlite.load(spark, path, rows=300)
    assert set(d.tables) == {"books", "characters", "aliases", "chapters"}
    for t in SCHEMAS:
        assert getattr(d, t).dtypes == getattr(other, t).dtypes
        assert rows_of(getattr(d, t)) == rows_of(getattr(other, t))
    assert rows_of(read.search(d, "rand")) == rows_of(read.search(other, "rand"))


def test_partitions(spark, twins):
    path, _ = twins
    assert sqlite.table(spark, path, "aliases", rows=300).rdd.getNumPartitions() == 4
    assert sqlite.table(spark, path, "notes").collect() == [("a", bytearray(b"\0\1"), 1.5, "7"), ("b", None, 2.0, "7")]


def test_conditions_go_down(spark, twins):
    path, other = twins
    where = [("alias_text", "=", "Rand"), ("alias_id", ">", 250), ("alias_id", "in", list(range(200, 700))), ("alias_text", "prefix", "R"), ("alias_text", "is not null", None)]
    reader = sqlite.SnapshotReader(path, "aliases", [("alias_id", "bigint"), ("alias_text", "string")], 300, where)
    sql, values = reader.query(reader.partitions()[1])
    assert sql.count("?") == len(values) == 505 and '"alias_text" COLLATE BINARY = ?' in sql
    assert all(i > 250 for b in reader.read(reader.partitions()[1]) for i in b.column(0).to_pylist())
    df = sqlite.table(spark, path, "aliases", rows=300, where=where)
    wanted = "alias_id > 250 and alias_text = 'Rand' and alias_id between 200 and 699"
    assert rows_of(df.select("alias_id")) == rows_of(other.aliases.where(wanted).select("alias_id"))
    for condition, said in ((("alias_text", "is null", None), "alias_text is null"), (("alias_id", "<=", 20), "alias_id <= 20"), (("alias_text", "prefix", "text 1"), "alias_text like 'text 1%'"), (("alias_id", ">=", 990), "alias_id >= 990"), (("alias_id", "<", 3), "alias_id < 3")):
        assert rows_of(sqlite.table(spark, path, "aliases", where=[condition]).select("alias_id")) == rows_of(other.aliases.where(said).select("alias_id"))
    with pytest.raises(ValueError, match="no comparison"):
        sqlite.table(spark, path, "aliases", where=[("alias_id", "like", 3)])


def test_cases_and_gaps(spark, twins):
    path, _ = twins
    df = sqlite.table(spark, path, "odd", rows=10**11)
    assert rows_of(df.where("s = 'abc'").select("n")) == [(2,)]
    assert rows_of(sqlite.table(spark, path, "odd", where=[("s", "=", "abc")]).select("n")) == [(2,)]
    assert rows_of(sqlite.table(spark, path, "odd", where=[("s", ">=", "a")]).select("n")) == [(2,)]
    assert df.count() == 3  # a query's filter is that query's
    by_two = sqlite.SnapshotReader(path, "odd", [("n", "bigint")], 2)
    assert [(p.low, p.high) for p in by_two.partitions()] == [(-5, 9), (10, 10**12)]
    assert sqlite.table(spark, path, "odd", rows=2).count() == 3


def test_what_is_not_there(spark, twins):
    path, _ = twins
    assert sqlite.tables_of(path)["books"][-1] == ("source_file", "string")
    for name, columns in (("nothing", None), ("books", ["nothing"])):
        with pytest.raises(Exception, match="no (table|column)"):
            sqlite.table(spark, path, name, columns).collect()
    with pytest.raises(Exception, match="unable to open"):
        sqlite.load(spark, path + ".not")
