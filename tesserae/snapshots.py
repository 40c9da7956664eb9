"""A log of snapshots: numbered versions of a directory, committed one after another, each whole.

Under a root, ``data/`` holds table folders that are written once and never changed, and ``log/`` a
manifest for each version: which folders its tables are, how many rows and which digests they have. A
version exists when its manifest does, and manifests are put only where none is: of two
writers that build on one version the second gets ``Conflict`` and nothing of its own is seen. Tables that a
version doesn't change are the folders of the version before, so that keeping all versions (a backup before every write)
costs what changes. Going back is one more version, made of an old one's folders.

Rows lie in buckets by a hash of their key, and each bucket has a digest that doesn't depend on the
order of rows. Two versions are compared bucket by bucket, and only buckets whose digests differ are
read.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.model import SCHEMAS, UNIQUE, Directory

#: Rows that a bucket is to hold, and buckets at most; their number is a power of two, so that numbers of buckets can be compared.
BUCKET_ROWS, BUCKETS = 1 << 20, 4096
BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Somebody else has committed a version since the one that the change builds on."""


def key_of(table: str, columns: list[str]) -> list[str]:
    """What a table's rows are told apart by: its first unique key, or all columns."""
    for key in UNIQUE.get(table, []):
        if set(key) <= set(columns):
            return list(key)
    return list(columns)


def _hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def digests(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """(bucket, rows, digest): of each bucket the number of rows and a sum over hashes of whole rows, the same in any order."""
    whole = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    sums = [F.sum(F.pmod(F.shiftright(whole, k), F.lit(1 << 32)).cast("bigint")) for k in (0, 32)]
    return df.groupBy(F.pmod(_hash(key), F.lit(buckets)).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *[F.hex(s) for s in sums]).alias("digest"))


@dataclass(frozen=True)
class Version:
    version: int
    parent: int | None
    at: float
    note: str
    #: table -> {"path", "rows", "buckets", "digests": {bucket: [rows, digest]}, "schema"}
    tables: dict[str, dict] = field(default_factory=dict)


class Log:
    """The versions under a root that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._local = self._files.getScheme() == "file"

    # ------------------------------------------------ manifests

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/log")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int) -> Version:
        stream = self._files.open(self._path(self._manifest(version)))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def _manifest(self, version: int) -> str:
        return f"{self.root}/log/{version:020d}.json"

    def _put(self, version: int, text: str) -> bool:
        """The manifest whole, or False where there is one."""
        target = self._path(self._manifest(version))
        self._files.mkdirs(target.getParent())
        aside = self._path(f"{self.root}/log/.{version:020d}.{uuid.uuid4().hex}")
        store = self._files.getScheme() in ("s3a", "gs", "abfs", "abfss", "wasbs", "oss")
        if store and self._files.exists(target):
            return False
        out = self._files.create(target if store else aside, False)  # stores show an object when it is closed, and refuse to replace it
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if store:
            return True
        try:
            if not self._local:
                return self._files.rename(aside, target)  # fails where the target is
            os.link(aside.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            self._files.delete(aside, False)

    # ------------------------------------------------ reading

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def at(self, when: float) -> int | None:
        """The last version committed by then (seconds since 1970)."""
        return max((v for v in self.versions() if self.read(v).at <= when), default=None)

    def load(self, version: int | None = None) -> Directory:
        """A version, by default the latest; an empty directory where there is none."""
        version = self.latest() if version is None else version
        if version is None:
            return Directory(self.spark, {})
        manifest = self.read(version)
        return Directory(self.spark, {t: self._table(t, e) for t, e in manifest.tables.items()})

    def _table(self, name: str, entry: dict, buckets: list[int] | None = None) -> DataFrame:
        df = self.spark.read.schema(f"{entry['schema']}, {BUCKET} int").parquet(entry["path"])
        if buckets is not None:
            df = df.where(F.col(BUCKET).isin(buckets))
        out = df.drop(BUCKET)
        if buckets is None:
            out._tesserae_entry = entry
        return out

    def history(self) -> DataFrame:
        """(version, parent, note, name, rows, path): every table of every version."""
        rows = [(m.version, m.parent, m.note, t, e["rows"], e["path"]) for m in map(self.read, self.versions()) for t, e in sorted(m.tables.items())]
        return self.spark.createDataFrame(rows, "version bigint, parent bigint, note string, name string, rows bigint, path string")

    # ------------------------------------------------ writing

    def _written(self, name: str, df: DataFrame, buckets: int | None) -> dict:
        """A table's folder and what a manifest says of it; a table as it was loaded is the folder it was loaded from."""
        if entry := getattr(df, "_tesserae_entry", None):
            return entry
        key = key_of(name, df.columns)
        if buckets is None:
            n, buckets = df.count(), 1
            while buckets < BUCKETS and n > buckets * BUCKET_ROWS:
                buckets *= 2
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        placed = df.withColumn(BUCKET, F.pmod(_hash(key), F.lit(buckets)).cast("int"))
        placed.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        kept = self.spark.read.schema(f"{schema}, {BUCKET} int").parquet(path).drop(BUCKET)
        found = {str(r["bucket"]): [r["rows"], r["digest"]] for r in digests(kept, key, buckets).collect()}  # at most BUCKETS rows
        return {"path": path, "rows": sum(r for r, _ in found.values()), "buckets": buckets, "digests": found, "schema": schema}

    def commit(self, d: Directory, note: str = "", parent: int | None = -1, buckets: int | None = None) -> int:
        """The next version: every table of d. parent: the version that d builds on (None: none), the latest by default; Conflict if it isn't the latest any more.

        A writer that fails or loses leaves folders that no manifest names; ``sweep`` removes them.
        """
        base = self.latest() if parent == -1 else parent
        tables = {t: self._written(t, getattr(d, t), buckets) for t in SCHEMAS if t in d.tables}
        return self._commit(base, tables, note)

    def _commit(self, base: int | None, tables: dict[str, dict], note: str) -> int:
        version = 0 if base is None else base + 1
        text = json.dumps({"version": version, "parent": base, "at": time.time(), "note": note, "tables": tables})
        if (self.latest() or 0) > version or not self._put(version, text):
            raise Conflict(f"version {version} is there already")
        return version

    def roll_back(self, version: int, note: str | None = None) -> int:
        """A new version that is an old one again; what came in between stays in the log."""
        return self._commit(self.latest(), self.read(version).tables, f"back to {version}" if note is None else note)

    def sweep(self, keep: int = 10, age: float = 7 * 86_400) -> list[str]:
        """Remove manifests but the last ``keep``, and folders that none of those names and that are older than ``age`` seconds, so that no running writer's are."""
        every = self.versions()
        named = {e["path"] for v in every[-keep:] for e in self.read(v).tables.values()}
        for v in every[:-keep]:
            self._files.delete(self._path(self._manifest(v)), False)
        gone = []
        top = self._path(f"{self.root}/data")
        for table in self._files.listStatus(top) if self._files.exists(top) else []:
            for folder in self._files.listStatus(table.getPath()):
                path = f"{self.root}/data/{table.getPath().getName()}/{folder.getPath().getName()}"
                if path not in named and folder.getModificationTime() / 1000 < time.time() - age:
                    self._files.delete(folder.getPath(), True)
                    gone.append(path)
        return gone

    # ------------------------------------------------ comparing

    def changed_buckets(self, name: str, old: int, new: int) -> tuple[list[int], int]:
        """Buckets in which a table differs between two versions, and how many it is divided into for the comparison."""
        a, b = (self.read(v).tables.get(name) for v in (old, new))
        n = min(e["buckets"] for e in (a, b) if e) if a or b else 1

        def folded(e: dict | None) -> dict[int, list]:
            out: dict[int, list] = {}
            for k, (rows, digest) in (e or {"digests": {}})["digests"].items():
                out.setdefault(int(k) % n, []).append((int(k), rows, digest))
            return out

        if a and b and a["path"] == b["path"]:
            return [], n
        x, y = folded(a), folded(b)
        if a and b and a["buckets"] != b["buckets"]:  # sums of finer buckets make the coarser one's
            total = lambda parts: tuple(sum(int(d.split("-")[i], 16) for *_, d in parts) for i in (0, 1)) + (sum(r for _, r, _ in parts),)
            return sorted(k for k in {*x, *y} if total(x.get(k, [])) != total(y.get(k, []))), n
        return sorted(k for k in {*x, *y} if x.get(k) != y.get(k)), n

    def delta(self, name: str, old: int, new: int) -> DataFrame:
        """(key columns, change, before, after): rows that were added, removed or changed, as JSON; reads only buckets that differ."""
        buckets, n = self.changed_buckets(name, old, new)
        a, b = (self.read(v).tables.get(name) for v in (old, new))
        entry = b or a
        if entry is None:
            raise KeyError(name)
        columns = [f.name for f in self.spark.createDataFrame([], entry["schema"]).schema.fields]
        key = key_of(name, columns)

        def part(e: dict | None, said: str) -> DataFrame:
            if e is None:
                return self.spark.createDataFrame([], entry["schema"]).select(*key, F.lit(None).cast("string").alias(said))
            finer = [k for k in range(e["buckets"]) if k % n in set(buckets)]
            df = self._table(name, e, finer)
            return df.select(*key, F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias(said))

        x, y = part(a, "before"), part(b, "after")
        met = x.withColumnsRenamed({k: f"__{k}" for k in key})
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
        on = same[0]
        for s in same[1:]:
            on = on & s
        joined = y.join(met, on, "full_outer")
        change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") != F.col("after"), "changed")
        return joined.select(*[F.coalesce(k, f"__{k}").alias(k) for k in key], change.alias("change"), "before", "after").where("change is not null")
