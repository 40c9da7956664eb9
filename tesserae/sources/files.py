"""Reading and writing files around a directory: extractions, decisions, proposals, books, audit logs."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.durable import written
from tesserae.session import ship

DECISIONS = "review_id bigint, action string, target string, target_cid bigint, add_alias array<string>, note string"
PROPOSALS = "schema_version int, generated_at_iso string, db_file string, results array<struct<character_id:bigint, primary_name:string, nationality:string, basis:string, evidence:string, action:string, downgraded:boolean, current_nationality:string>>"


#: The one slot that is none: a copy beside the snapshots. Names with more parts, and those without a slot, are no snapshots either.
NO_SNAPSHOT = ("backup",)


def snapshot_slot(column):
    """The slot of a snapshot's file name, null for others."""
    slot = F.nullif(F.regexp_extract(column, r"(?:^|/)[a-z]+_([a-z0-9]+)\.(?:db|parquet)/?$", 1), F.lit(""))
    return F.when(~F.rlike(slot, F.lit(f"^(?:{'|'.join(NO_SNAPSHOT)})$")), slot)


def extractions(spark: SparkSession, path: str) -> DataFrame:
    """Extracted chapters b<order>_c<chapter>.json with both numbers; malformed files and others are left out."""
    from tesserae.plans.reconcile import EXTRACTION

    schema = "_meta struct<chapter_id:bigint, chapter_title:string, model:string, input_tokens:bigint, output_tokens:bigint, roster_size:int>, " + EXTRACTION.split(",", 2)[2].strip() + ", _corrupt_record string"
    files = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("file", F.input_file_name())
    name = r"b(\d+)_c(\d+)\.json$"
    good = files.where(F.col("_corrupt_record").isNull() & F.rlike("file", F.lit(name)))
    number = lambda k: F.regexp_extract("file", name, k).cast("int")
    return good.select(number(1).alias("series_order"), number(2).alias("chapter_number"), F.col("_meta.chapter_id").alias("chapter_id"), F.col("_meta.chapter_title").alias("title"), "_meta", "characters", "appearances", "mentions", "relationships")


def decisions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DECISIONS).option("multiLine", True).json(path)


def proposals(spark: SparkSession, path: str) -> DataFrame:
    """Proposed origins of files of version 1; others are refused."""
    df = spark.read.schema(PROPOSALS).option("multiLine", True).json(path)
    if df.where("schema_version is null or schema_version <> 1").limit(1).count():
        raise ValueError("proposals of another version")
    return df.select("db_file", F.inline("results"))


def table_with_header(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A CSV file with a header that has the columns required."""
    df = spark.read.csv(path, header=True)
    if lost := set(required) - set(df.columns):
        raise ValueError(f"{path} lacks {sorted(lost)}")
    return df


def append_log(df: DataFrame, path: str) -> None:
    """Rows added to a CSV log that is never rewritten."""
    df.write.mode("append").csv(path, header=True)


def as_json(df: DataFrame) -> DataFrame:
    """A row's JSON, as an answer to a reader."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def book_parts(data: bytes) -> list[tuple[str, str, str]]:
    """(label, href, html) of an EPUB's contents list, in its order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        opf = next(x.attrib["full-path"] for x in container.iter() if _local(x.tag) == "rootfile")
        package = ElementTree.fromstring(z.read(opf))
        root = posixpath.dirname(opf)
        items = {x.attrib["id"]: x.attrib for x in package.iter() if _local(x.tag) == "item"}
        ncx = next((a["href"] for a in items.values() if a.get("media-type") == "application/x-dtbncx+xml"), None)
        out = []
        if ncx:
            contents = z.read(posixpath.normpath(posixpath.join(root, ncx))).decode(errors="replace")
            pattern = r"<navLabel>\s*<text>(.*?)</text>\s*</navLabel>\s*<content[^>]*\bsrc=\"([^\"]+)\""
            for label, href in re.findall(pattern, contents, re.DOTALL):
                at = posixpath.normpath(posixpath.join(root, posixpath.dirname(ncx), href.split("#")[0]))
                if at in names:
                    out.append((re.sub(r"\s+", " ", label).strip(), at, z.read(at).decode(errors="replace")))
        else:  # no list: the spine, without labels
            for x in package.iter():
                if _local(x.tag) == "itemref" and (a := items.get(x.attrib.get("idref", ""))):
                    at = posixpath.normpath(posixpath.join(root, a["href"]))
                    if at in names:
                        out.append(("", at, z.read(at).decode(errors="replace")))
        return out


_LINK = re.compile(r"(?:href|src)\s*=\s*[\"']([^\"'#?]+)|url\(\s*[\"']?([^\"')#?]+)|@import\s+[\"']([^\"'#?]+)")


def package_links(data: bytes) -> list[tuple[str, list[str]]]:
    """(file, files of the package that it refers to) for each file of an EPUB: from pages and style sheets, by the paths they have inside."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = {n for n in z.namelist() if not n.endswith("/")}
        out = []
        for name in sorted(names):
            found = set()
            if name.rpartition(".")[2].lower() in ("html", "xhtml", "htm", "css", "svg", "xml"):
                for groups in _LINK.findall(z.read(name).decode(errors="replace")):
                    ref = unquote(next(g for g in groups if g).strip())
                    at = posixpath.normpath(posixpath.join(posixpath.dirname(name), ref))
                    if at in names and at != name:
                        found.add(at)
            out.append((name, sorted(found)))
        return out


def links(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, refers): every part of every EPUB of a folder and the parts it refers to; each file is opened by one task."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            rows = [(p, *part) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for part in package_links(c)]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(pa.string()))], ["file", "name", "refers"])

    return files.mapInArrow(run, "file string, name string, refers array<string>")


def volume_files(volumes: DataFrame, linked: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(file, volume, name, asset): what belongs to each volume of a file with several: its pages (file, volume, href), and all that they refer to, and what that refers to.

    Pages of other volumes don't come along, nor does what only they need: a shared style sheet
    belongs to both. Each round follows one more step of references, from what is new only, and is written.
    """
    pages = volumes.select("file", "volume", F.col("href").alias("name")).distinct()
    page = pages.select("file", "name").distinct()
    edges = linked.select("file", "name", F.explode("refers").alias("to")).join(page.withColumnRenamed("name", "to"), ["file", "to"], "left_anti")
    every = written(pages.withColumn("asset", F.lit(False)))
    new = every
    for _ in range(most_rounds):
        reached = new.join(edges, ["file", "name"]).select("file", "volume", F.col("to").alias("name")).distinct()
        new = written(reached.join(every, ["file", "volume", "name"], "left_anti").withColumn("asset", F.lit(True)))
        if new.isEmpty():
            return every
        every = written(every.unionByName(new))
    raise ValueError("references did not end")


def books(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, label, href, html) of all EPUB files of a folder; each file is parsed by one task."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            rows = [(p, k, *part) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k, part in enumerate(book_parts(c))]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()))], ["file", "position", "label", "href", "html"])

    return files.mapInArrow(run, "file string, position int, label string, href string, html string")


def book_chapters(parts: DataFrame, headers: tuple[str, ...] = ()) -> DataFrame:
    """Parts of books as chapters: numbered, titled, with their text and word count."""
    from tesserae.functions import texts as T

    numbered = T.numbered_chapters(parts, "file", "position").join(parts.select("file", "position", "html"), ["file", "position"])
    out = numbered.withColumn("full_text", T.without_number(T.html_text(F.col("html"), headers))).withColumn("title", F.coalesce("title", T.heading(F.col("html"))))
    return out.select("file", F.col("number").alias("chapter_number"), "kind", "title", "full_text", T.word_count(F.col("full_text")).alias("word_count"))


def split_omnibus(parts: DataFrame, starts: DataFrame) -> DataFrame:
    """Parts of a file with several books, by the positions (file, start, volume) where they begin."""
    from pyspark.sql import Window

    ends = starts.withColumn("stop", F.coalesce(F.lead("start").over(Window.partitionBy("file").orderBy("start")), F.lit(1 << 30)))
    return parts.join(ends, "file").where("position >= start and position < stop").withColumn("position", F.col("position") - F.col("start")).drop("start", "stop")
