"""Snapshots kept as SQLite files, read as Spark tables: ranges of rowids are partitions; columns and conditions that are named go down to the file.

A file must be at a path that the driver and all executors see; it's opened read-only and is not to
be written to meanwhile. Spark can tell a Python source the filters of a query (pushFilters), but 4.1
keeps what one query has told for all later queries on the same DataFrame, which then lack rows; conditions are
therefore named where a table is opened.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tesserae.model import SCHEMAS, Directory

FORMAT = "sqlite_snapshot"
#: Rows of a partition, and of a batch.
PARTITION_ROWS, BATCH_ROWS = 250_000, 4096
#: Partitions beyond which rowids are taken for ones with gaps.
RANGES = 10_000
_COMPARED = ("=", ">", ">=", "<", "<=")
#: A condition: (column, comparison, value); comparisons are those above, "in" (a list), "is null", "is not null" and "prefix".
Condition = tuple[str, str, object]


def _open(path: str) -> sqlite3.Connection:
    from urllib.parse import quote

    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def spark_type(declared: str) -> str:
    """The type that a column's declaration stands for, by the file format's rules of affinity."""
    d = declared.upper()
    if "INT" in d:
        return "bigint"
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return "string"
    if "BLOB" in d:
        return "binary"
    if any(x in d for x in ("REAL", "FLOA", "DOUB")):
        return "double"
    return "string"


def tables_of(path: str) -> dict[str, list[tuple[str, str]]]:
    """Each table of a file and its columns with their types: what the file has, whatever its version."""
    with closing(_open(path)) as con:
        names = [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite~_%' ESCAPE '~' ORDER BY name")]
        return {n: [(c[1], spark_type(c[2] or "")) for c in con.execute(f"PRAGMA table_info({_quoted(n)})")] for n in names}


@dataclass
class Range(InputPartition):
    low: int | None
    high: int | None


class SnapshotSource(DataSource):
    """Options: path, table; columns (comma-separated, all by default); rows (of a partition); where (conditions as JSON)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _columns(self) -> list[tuple[str, str]]:
        found = tables_of(self.options["path"])
        if (table := self.options["table"]) not in found:
            raise ValueError(f"no table {table}; there are {sorted(found)}")
        there = dict(found[table])
        wanted = [c for c in self.options.get("columns", "").split(",") if c] or list(there)
        if lost := [c for c in wanted if c not in there]:
            raise ValueError(f"{table} has no column {', '.join(lost)}")
        return [(c, there[c]) for c in wanted]

    def schema(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self._columns())

    def reader(self, schema: StructType) -> DataSourceReader:
        return SnapshotReader(self.options["path"], self.options["table"], [(f.name, f.dataType.simpleString()) for f in schema.fields], int(self.options.get("rows", PARTITION_ROWS)), json.loads(self.options.get("where", "[]")))


class SnapshotReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[tuple[str, str]], rows: int, where: list[Condition] = ()):
        self.path, self.table, self.columns, self.rows = path, table, columns, rows
        self.conditions: list[str] = []
        self.values: list = []
        for column, how, value in where:
            c = f"{_quoted(column)} COLLATE BINARY"  # byte by byte, as Spark compares
            if how in _COMPARED:
                self._add(f"{c} {how} ?", value)
            elif how == "in":
                self._add(f"{c} IN ({', '.join('?' * len(value))})", *value)
            elif how == "prefix":
                self._add(f"substr({_quoted(column)}, 1, {len(value)}) = ? COLLATE BINARY", value)
            else:
                self._add(f"{_quoted(column)} {how.upper()}")

    def _add(self, condition: str, *values) -> None:
        self.conditions.append(condition)
        self.values += values

    def partitions(self) -> list[InputPartition]:
        with closing(_open(self.path)) as con:
            try:
                low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table WITHOUT ROWID is one partition
                return [Range(None, None)]
            if low is not None and (high - low) // self.rows >= RANGES:  # numbers with gaps: ranges of so many rows each
                ends, after = [], low - 1
                step = f"SELECT rowid FROM {_quoted(self.table)} WHERE rowid > ? ORDER BY rowid LIMIT 1 OFFSET {self.rows - 1}"
                while found := con.execute(step, (after,)).fetchone():
                    ends.append(after := found[0])
                return [Range(a + 1, b) for a, b in zip([low - 1, *ends], [*ends, high], strict=True) if a < b]
        if low is None:
            return []
        return [Range(a, min(high, a + self.rows - 1)) for a in range(low, high + 1, self.rows)]

    def query(self, part: Range) -> tuple[str, list]:
        where = [*(["rowid BETWEEN ? AND ?"] if part.low is not None else []), *self.conditions]
        names = ", ".join(_quoted(c) for c, _ in self.columns) or "NULL"
        bounds = [part.low, part.high] if part.low is not None else []
        return f"SELECT {names} FROM {_quoted(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else ""), bounds + self.values

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        types = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
        with closing(_open(self.path)) as con:
            cursor = con.execute(*self.query(part))
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [pa.array([self._value(r[i], t, c) for r in rows], types[t]) for i, (c, t) in enumerate(self.columns)]
                yield pa.RecordBatch.from_arrays(arrays, [c for c, _ in self.columns])

    def _value(self, v, kind: str, column: str):
        """A value as its column's type; the file lets any value be in any column."""
        if v is None:
            return None
        try:
            if kind == "string":
                return v.decode() if isinstance(v, bytes) else str(v)
            if kind == "binary":
                return v if isinstance(v, bytes) else str(v).encode()
            if kind == "double":
                return float(v)
            if isinstance(v, float) and v != int(v):
                raise ValueError
            return int(v)
        except (ValueError, OverflowError) as e:
            raise ValueError(f"{self.table}.{column}: {v!r} is no {kind}") from e


def _holds(condition: Condition) -> Column:
    column, how, value = condition
    c = F.col(column)
    found = {"=": lambda: c == value, ">": lambda: c > value, ">=": lambda: c >= value, "<": lambda: c < value, "<=": lambda: c <= value, "in": lambda: c.isin(*value), "prefix": lambda: c.startswith(value), "is null": c.isNull, "is not null": c.isNotNull}
    if how not in found:
        raise ValueError(f"no comparison {how!r}")
    return found[how]()


def table(spark: SparkSession, path: str, name: str, columns: list[str] | None = None, rows: int = PARTITION_ROWS, where: list[Condition] = ()) -> DataFrame:
    """A table of a file. columns: those to read, and ``where``: conditions that all rows meet, for a source of this kind isn't told which ones a query uses. Columns of conditions are among those read."""
    from tesserae.session import ship

    ship(spark)
    spark.dataSource.register(SnapshotSource)
    reader = spark.read.format(FORMAT).option("path", path).option("table", name).option("rows", str(rows)).option("where", json.dumps([list(c) for c in where]))
    out = (reader.option("columns", ",".join(columns)) if columns else reader).load()
    for c in where:  # a column may hold values of other types than the one declared
        out = out.where(_holds(c))
    return out


def load(spark: SparkSession, path: str, rows: int = PARTITION_ROWS) -> Directory:
    """The directory in a file: its tables as far as they are there, with the model's columns and types; columns that an older file lacks are null."""
    found = {}
    for name, columns in tables_of(path).items():
        if name not in SCHEMAS:
            continue
        there = [c for c, _ in columns]
        fields = [x.strip().split() for x in SCHEMAS[name].split(",")]
        df = table(spark, path, name, [c for c, _ in fields if c in there], rows)
        found[name] = df.select(*[(F.col(c).cast(t) if c in there else F.lit(None).cast(t)).alias(c) for c, t in fields])
    return Directory(spark, found)
