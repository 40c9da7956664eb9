"""The registered directory queries and their SQL.

A query runs an operator on the supplied tables, or on the directory made of them; its SQL says
the same in plain relational terms for another engine. Names in braces are the directory's views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae import model, snapshots
from tesserae.durable import unsent, written
from tesserae.functions import ages, names, origins, texts
from tesserae.functions import values as V
from tesserae.operators import audits, read, resolve, write
from tesserae.plans import change, merge, reconcile, replay, traced
from tesserae.sources.analogue import directory, table, view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return register


def _once(spark, sf_dir, *tables: str) -> model.Directory:
    """The directory with tables that a plan reads many times made once, as a real one has them."""
    d = directory(spark, sf_dir)
    return d.having(**{t: written(getattr(d, t)) for t in tables})


def _apart(spark, sf_dir, *tables: str) -> model.Directory:
    """``_once`` for plans of many joins: a table is made from those before it, as are all views of it, and none that is large is sent to the driver."""
    made: dict[str, DataFrame] = {}
    for t in tables:
        df = written(view(spark, sf_dir, t, made))
        made[t] = unsent(df, df._tesserae_written)
    return directory(spark, sf_dir, made)


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _stripped(x: str) -> str:
    """strip_titles of a normalised text in SQL."""
    out = f"CASE WHEN ' ' || {x} || ' ' LIKE ' the %' THEN ' ' || substr(' ' || {x} || ' ', 6) ELSE ' ' || {x} || ' ' END"
    for rank in V.RANKS:
        out = f"replace({out}, ' {rank} ', ' ')"
    return f"trim({out})"


def _placeholder(x: str) -> str:
    bare = f"CASE WHEN {x} LIKE 'the %' THEN substr({x}, 5) ELSE {x} END"
    return f"({x} NOT IN ({_quoted(V.ALLOWED)}) AND {x} <> '' AND ({x} LIKE '% with %' OR list_last(string_split({x}, ' ')) IN ({_quoted(V.TAILS)}) OR {bare} IN ({_quoted(V.ROLES)})))"


def _rank_decorated(n: str, tokens: str) -> str:
    s = _stripped(n)
    return f"({s} <> {n} AND {s} <> '' AND len(list_filter(string_split({s}, ' '), lambda x: NOT list_contains({tokens}, x))) = 0)"


EDGES = """(SELECT character_a AS character_id, character_b AS other_id, relationship_type, directed FROM {relationships}
  UNION ALL SELECT character_b, character_a, relationship_type, directed FROM {relationships} WHERE character_a <> character_b)"""
TOKENS = f"(SELECT character_id, list_distinct(flatten(list(string_split({_stripped('alias_norm')}, ' ')))) AS tokens FROM {{aliases}} WHERE alias_type IN ('primary', 'given_name') GROUP BY character_id)"

# ---------------------------------------------------------------- reading


@query("SELECT character_id, primary_name, character_type FROM {characters} WHERE character_id IN (SELECT character_id FROM {aliases} WHERE alias_norm ILIKE '%ring h%') ORDER BY primary_name, character_id LIMIT 40")
def search_alias(spark, sf_dir):
    return read.search(directory(spark, sf_dir), "  RING h")


SOUGHT = "(SELECT DISTINCT substr(p_name, 2 + p_partkey % 3, 1 + p_partkey % 7) || CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE '' END AS query FROM part)"


@query(f"""SELECT query, character_id, primary_name, character_type FROM (
  SELECT query, c.character_id, primary_name, character_type, row_number() OVER (PARTITION BY lower(trim(query)), query ORDER BY primary_name, c.character_id) AS k
  FROM (SELECT DISTINCT query, character_id FROM {SOUGHT} q JOIN (SELECT DISTINCT character_id, alias_norm FROM {{aliases}}) a ON contains(alias_norm, lower(trim(query))) WHERE trim(query) <> '') h
  JOIN {{characters}} c ON c.character_id = h.character_id) x WHERE k <= 40""")
def search_many(spark, sf_dir):
    """Pieces of part names, from one letter to seven, all looked for at once."""
    p = table(spark, sf_dir, "part")
    piece = F.substring("p_name", (2 + F.col("p_partkey") % 3).cast("int"), (1 + F.col("p_partkey") % 7).cast("int"))
    wanted = p.select(F.concat(piece, F.when(F.col("p_partkey") % 5 == 0, " ").otherwise("")).alias("query")).distinct()
    return read.search_many(directory(spark, sf_dir), wanted)


@query("SELECT character_id, primary_name, character_type, nationality, (SELECT count(*) FROM {appearances} a WHERE a.character_id = c.character_id) AS appearances FROM {characters} c")
def roster_counts(spark, sf_dir):
    return read.roster(directory(spark, sf_dir))


@query("""SELECT a.character_id, a.chapter_id, b.series_order, c.chapter_number, a.name_used, a.whereabouts
FROM {appearances} a JOIN {chapters} c ON c.chapter_id = a.chapter_id JOIN {books} b ON b.book_id = c.book_id""")
def profile_appearances(spark, sf_dir):
    return read.appearances_of(directory(spark, sf_dir)).select("character_id", "chapter_id", "series_order", "chapter_number", "name_used", "whereabouts")


@query(f"SELECT e.character_id, e.other_id, e.relationship_type, e.directed, coalesce(primary_name, '?') AS other FROM {EDGES} e LEFT JOIN {{characters}} c ON c.character_id = e.other_id")
def profile_relationships(spark, sf_dir):
    return read.named_edges(directory(spark, sf_dir)).select("character_id", "other_id", "relationship_type", "directed", "other")


@query("""SELECT c.character_id, c.primary_name,
  (SELECT string_agg(alias_type || ':' || alias_text, ', ' ORDER BY alias_type, alias_text) FROM {aliases} a WHERE a.character_id = c.character_id) AS aliases,
  (SELECT string_agg(f.faction_type || ':' || f.name || ':' || cf.role, ', ' ORDER BY f.faction_type, f.name) FROM {character_factions} cf JOIN {factions} f ON f.faction_id = cf.faction_id WHERE cf.character_id = c.character_id) AS factions,
  (SELECT count(*) FROM {mentions} m WHERE m.character_id = c.character_id) AS mentions
FROM {characters} c""")
def profiles(spark, sf_dir):
    flat = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[f] for f in fields])), ", ")
    p = read.profiles(directory(spark, sf_dir))
    return p.select("character_id", "primary_name", flat("aliases", "alias_type", "alias_text").alias("aliases"), flat("factions", "faction_type", "name", "role").alias("factions"), F.coalesce(F.size("mentions"), F.lit(0)).cast("bigint").alias("mentions"))


@query("SELECT faction_id, name, faction_type, (SELECT count(*) FROM {character_factions} m WHERE m.faction_id = f.faction_id) AS members FROM {factions} f")
def factions(spark, sf_dir):
    return read.factions(directory(spark, sf_dir))


@query("SELECT m.faction_id, m.character_id, m.role, c.primary_name, c.character_type FROM {character_factions} m JOIN {characters} c ON c.character_id = m.character_id")
def faction_members(spark, sf_dir):
    return read.faction_members(directory(spark, sf_dir))


@query("""SELECT b.book_id, b.series_order, b.slot, b.label, b.is_prequel, (SELECT string_agg(chapter_number || '/' || chapter_id, ', ' ORDER BY chapter_number) FROM {chapters} c WHERE c.book_id = b.book_id) AS chapters FROM {books} b""")
def books_chapters_nested(spark, sf_dir):
    b = read.books(directory(spark, sf_dir))
    flat = F.array_join(F.transform("chapters", lambda x: F.concat_ws("/", x["chapter_number"].cast("string"), x["chapter_id"].cast("string"))), ", ")
    return b.select("book_id", "series_order", "slot", "label", "is_prequel", flat.alias("chapters"))


@query("""SELECT x.chapter_id, x.character_id, x.how, x.name_used, c.primary_name FROM (
  SELECT chapter_id, character_id, 'present' AS how, name_used FROM {appearances} UNION ALL SELECT chapter_id, character_id, 'mentioned', name_used FROM {mentions}) x
JOIN {characters} c ON c.character_id = x.character_id WHERE x.chapter_id = 7""")
def chapter_cast(spark, sf_dir):
    return read.cast(directory(spark, sf_dir), 7).select("chapter_id", "character_id", "how", "name_used", "primary_name")


NODES = """SELECT c.character_id, primary_name, character_type, coalesce(n, 0) AS appearances, f.faction, least(coalesce(n, 0) * 3, 40) + 18 AS size FROM {characters} c
LEFT JOIN (SELECT character_id, count(*) AS n FROM {appearances} GROUP BY character_id) a ON a.character_id = c.character_id
LEFT JOIN (SELECT character_id, name AS faction FROM (SELECT m.character_id, name, row_number() OVER (PARTITION BY m.character_id ORDER BY list_position(['ajah', 'house', 'order', 'clan', 'society', 'other'], faction_type), f.faction_id) AS k FROM {character_factions} m JOIN {factions} f ON f.faction_id = m.faction_id) y WHERE k = 1) f ON f.character_id = c.character_id"""


@query(NODES)
def graph_nodes(spark, sf_dir):
    return read.graph_nodes(directory(spark, sf_dir))


@query(NODES + " WHERE c.character_id IN (SELECT character_id FROM {appearances} WHERE chapter_id = 5)")
def graph_nodes_of_chapter(spark, sf_dir):
    return read.graph_nodes(directory(spark, sf_dir), 5)


@query("SELECT character_a, character_b, relationship_type, directed FROM {relationships}")
def graph_edges(spark, sf_dir):
    return read.graph_edges(directory(spark, sf_dir), 0)


@query("""SELECT character_a, character_b, relationship_type, directed FROM {relationships}
WHERE character_a IN (SELECT character_id FROM {appearances} WHERE chapter_id = 184) AND character_b IN (SELECT character_id FROM {appearances} WHERE chapter_id = 184)""")
def graph_edges_of_chapter(spark, sf_dir):
    return read.graph_edges(directory(spark, sf_dir), 184)


SNAPSHOTS = """(SELECT 'book9' AS snapshot, series_order FROM {books} WHERE series_order <= 9 UNION ALL SELECT 'newspring', series_order FROM {books} WHERE series_order <= 5
  UNION ALL SELECT 'book12', series_order FROM {books} WHERE series_order <= 12)"""


def _snapshots(spark, sf_dir):
    b = directory(spark, sf_dir).books
    made = [b.where(F.col("series_order") <= n).select(F.lit(s).alias("snapshot"), "series_order") for s, n in (("book9", 9), ("newspring", 5), ("book12", 12))]
    return made[0].union(made[1]).union(made[2])


@query(f"SELECT snapshot, max(series_order) AS at FROM {SNAPSHOTS} s GROUP BY snapshot")
def snapshot_order(spark, sf_dir):
    return read.snapshot_order(_snapshots(spark, sf_dir))


@query(f"""WITH w AS (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN (c_custkey % 15)::VARCHAR WHEN 1 THEN 'BOOK' || (c_custkey % 15) WHEN 2 THEN ' newspring ' ELSE c_name END AS wanted FROM customer),
k AS (SELECT wanted, CASE WHEN regexp_matches(trim(wanted), '^[0-9]+$') THEN 'book' || trim(wanted)::BIGINT ELSE lower(trim(wanted)) END AS key FROM w),
o AS (SELECT snapshot, max(series_order) AS latest FROM {SNAPSHOTS} s GROUP BY snapshot)
SELECT wanted, coalesce(snapshot, (SELECT arg_min(snapshot, latest) FROM o)) AS snapshot FROM k LEFT JOIN o ON snapshot = key""")
def snapshots_selected(spark, sf_dir):
    """Numbers, slots in capitals and names that are none, each with the snapshot it gets."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    number = (key % 15).cast("string")
    wanted = c.select(F.when(key % 4 == 0, number).when(key % 4 == 1, F.concat(F.lit("BOOK"), number)).when(key % 4 == 2, " newspring ").otherwise(F.col("c_name")).alias("wanted"))
    return read.select_snapshots(read.snapshot_order(_snapshots(spark, sf_dir)), wanted)


@query("SELECT character_id, alias_norm, notes FROM {aliases} WHERE notes ILIKE '%h%' AND notes NOT ILIKE '%WRONG%'")
def notes_filtered(spark, sf_dir):
    """Aliases by what their notes say and don't say; those without notes are in neither."""
    return read.noted(directory(spark, sf_dir).aliases, "notes", "H", "wrong").select("character_id", "alias_norm", "notes")


@query("SELECT doc_id, left(text, 400) AS head, length(text) > 400 AS is_cut FROM documents")
def texts_cut(spark, sf_dir):
    """Every text cut to what a prompt takes; the cut is the feature."""
    return table(spark, sf_dir, "documents").select("doc_id", read.cut(F.col("text"), 400).alias("head"), (F.length("text") > 400).alias("is_cut"))


def _log(spark, sf_dir) -> snapshots.Log:
    """Three versions: books up to the fifth, up to the ninth, and up to the twelfth with some chapters renamed and some gone."""
    from tesserae.durable import temporary

    d, log = directory(spark, sf_dir), snapshots.Log(spark, temporary(spark))
    chapters = d.chapters.withColumn("full_text", F.lit(None).cast("string"))
    for n, last in enumerate((5, 9, 12)):
        books = d.books.where(F.col("series_order") <= last)
        told = chapters.join(books.select("book_id"), "book_id", "left_semi").select(chapters.columns)
        if n == 2:
            told = told.where("chapter_id % 101 <> 7").withColumn("title", F.when(F.col("chapter_id") % 97 == 3, "Another title").otherwise(F.col("title")))
        log.commit(model.Directory(spark, {"books": books, "chapters": told}), f"up to {last}", buckets=16)
    return log


TOLD = "(SELECT chapter_id, series_order FROM {chapters} c JOIN {books} b ON b.book_id = c.book_id)"


@query(f"""SELECT version::BIGINT AS version, (version - 1)::BIGINT AS parent, 'up to ' || last AS note, name, rows FROM (SELECT * FROM (VALUES (0, 5), (1, 9), (2, 12)) v(version, last)) v, LATERAL (
  SELECT 'books' AS name, count(*) AS rows FROM {{books}} WHERE series_order <= last UNION ALL SELECT 'chapters', count(*) FROM {TOLD} t WHERE series_order <= last AND (version < 2 OR chapter_id % 101 <> 7)) x""")
def snapshot_versions(spark, sf_dir):
    """What the log says of three commits; the first has no parent, -1 here."""
    return _log(spark, sf_dir).history().select("version", F.coalesce("parent", F.lit(-1)).alias("parent"), "note", "name", "rows")


@query(f"""SELECT chapter_id, CASE WHEN series_order > 5 THEN 'added' WHEN chapter_id % 101 = 7 THEN 'removed' ELSE 'changed' END AS change FROM {TOLD} t
WHERE series_order BETWEEN 6 AND 12 AND chapter_id % 101 <> 7 OR series_order <= 5 AND (chapter_id % 101 = 7 OR chapter_id % 97 = 3)""")
def snapshot_delta(spark, sf_dir):
    """Chapters that differ between the first version and the last; only buckets whose digests differ are read."""
    return _log(spark, sf_dir).delta("chapters", 0, 2).select("chapter_id", "change")


@query("SELECT * FROM (VALUES ('newspring', 'newspring'), ('9', 'book9'), ('book12', 'book12'), ('nowhere', 'newspring'), ('', 'newspring')) t(wanted, snapshot)")
def snapshot_select(spark, sf_dir):
    order = read.snapshot_order(_snapshots(spark, sf_dir))
    wanted = ("newspring", "9", "book12", "nowhere", "")
    return spark.createDataFrame([(w, read.select_snapshot(order, w)) for w in wanted], "wanted string, snapshot string")


@query("SELECT book_id, series_order, slot, label, title FROM {books} WHERE slot = 'book7' UNION ALL SELECT book_id, series_order, slot, label, title FROM {books} WHERE slot = 'book3'")
def resolve_book(spark, sf_dir):
    d = directory(spark, sf_dir)
    return read.resolve_book(d, "7").union(read.resolve_book(d, " book3 "))


# ---------------------------------------------------------------- aggregates, windows, upserts


@query(f"""SELECT c.character_id, (SELECT count(*) FROM {{appearances}} a WHERE a.character_id = c.character_id) AS appearances,
  (SELECT count(*) FROM {EDGES} e WHERE e.character_id = c.character_id) AS relationships, (SELECT count(*) FROM {{character_factions}} f WHERE f.character_id = c.character_id) AS factions FROM {{characters}} c""")
def dependents_counts(spark, sf_dir):
    return audits.dependents(directory(spark, sf_dir))


@query("SELECT character_id, name_used, count(*) AS n FROM {appearances} GROUP BY character_id, name_used HAVING lower(trim(name_used)) <> lower(trim(max(whereabouts)))")
def group_name_used(spark, sf_dir):
    a = directory(spark, sf_dir).appearances
    g = a.groupBy("character_id", "name_used").agg(F.count(F.lit(1)).alias("n"), F.max("whereabouts").alias("w"))
    return g.where(F.lower(F.trim("name_used")) != F.lower(F.trim("w"))).select("character_id", "name_used", "n")


@query("""SELECT 'books(series_order)' AS name, series_order::VARCHAR AS key, count(*) AS rows FROM {books} GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'characters(primary_name)', primary_name, count(*) FROM {characters} GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'aliases(character_id, alias_norm)', character_id || '|' || alias_norm, count(*) FROM {aliases} GROUP BY 1, 2 HAVING count(*) > 1""")
def invariants_violations(spark, sf_dir):
    return audits.broken_keys(directory(spark, sf_dir), ["books", "characters", "aliases", "appearances", "relationships"])


@query("SELECT l_orderkey || '|' || l_linenumber AS key, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_line_numbers(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return n.select(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"), "rows")


LOST = "SELECT '{0}.{1}' AS name, {1} AS value, count(*) AS rows FROM {{{0}}} WHERE {1} % 50 = 0 GROUP BY 2"
HAVING_CHARACTERS = (("aliases", "character_id"), ("appearances", "character_id"), ("mentions", "character_id"), ("relationships", "character_a"), ("relationships", "character_b"), ("character_factions", "character_id"))


@query(" UNION ALL ".join(LOST.format(t, c) for t, c in HAVING_CHARACTERS))
def broken_pointers(spark, sf_dir):
    """Of a directory that lacks every fiftieth character."""
    d = directory(spark, sf_dir)
    return audits.broken_pointers(d.having(characters=d.characters.where("character_id % 50 <> 0")))


@query("SELECT c.character_id, count_if(is_primary AND c.character_id % 40 <> 0)::BIGINT AS n FROM {characters} c LEFT JOIN {aliases} a ON a.character_id = c.character_id GROUP BY c.character_id HAVING count_if(is_primary AND c.character_id % 40 <> 0) <> 1")
def primary_counts(spark, sf_dir):
    """Of a directory that lacks some primary aliases."""
    d = directory(spark, sf_dir)
    return audits.primaries(d.having(aliases=d.aliases.where("not (is_primary and character_id % 40 = 0)")))


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events),
m AS (SELECT event_type, count(*) AS n, median(value) FILTER (k <= n // 2) AS first, median(value) FILTER (k > n // 2) AS second FROM r GROUP BY event_type)
SELECT event_type, n, first, second, round(CASE WHEN n >= 4 AND first > 0 THEN second / first - 1 END, 9) AS change, coalesce(CASE WHEN n >= 4 AND first > 0 THEN second / first - 1 END > 0.15, false) AS climbing FROM m""")
def median_trend(spark, sf_dir):
    t = audits.token_trend(table(spark, sf_dir, "events"), "event_type", "event_id", "value")
    return t.select("event_type", "n", "first", "second", F.round("change", 9).alias("change"), "climbing")


@query("SELECT p_name, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands, count(DISTINCT p_type) AS types FROM part GROUP BY p_name")
def delimited_lists(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy("p_name").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ", ").alias("brands"), F.count_distinct("p_type").alias("types"))
    return p


@query("""SELECT text, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, bool_and(n_chars > 100) AS long, arg_min(CASE WHEN doc_id % 2 = 1 THEN source END, CASE WHEN doc_id % 2 = 1 THEN doc_id END) AS odd_source,
  string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY text""")
def dedupe_merge(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("text", "doc_id", F.col("doc_id").alias("first_id"), "lang", (F.col("n_chars") > 100).alias("long"), F.when(F.col("doc_id") % 2 == 1, F.col("source")).alias("odd_source"), F.array("lang").alias("langs"))
    m = write.collapsed(d, "text", "first_id", ["doc_id", "lang"], ["long"], ["odd_source"], {"langs": ""})
    return m.select("text", "doc_id", "lang", "long", "odd_source", F.array_join(F.array_sort("langs"), ",").alias("langs"))


@query("""SELECT character_id, chapter_id FROM (SELECT a.character_id, a.chapter_id, row_number() OVER (PARTITION BY a.character_id ORDER BY series_order, chapter_number) AS k
FROM {appearances} a JOIN {chapters} c ON c.chapter_id = a.chapter_id JOIN {books} b ON b.book_id = c.book_id) x WHERE k = 1""")
def earliest_anchor(spark, sf_dir):
    a = read.appearances_of(directory(spark, sf_dir))
    return a.groupBy("character_id").agg(F.min_by("chapter_id", F.struct("series_order", "chapter_number")).alias("chapter_id"))


@query("SELECT character_id, CASE WHEN count(*) FILTER (size = top) = 1 THEN arg_max(alias_norm, size) END AS winner FROM (SELECT character_id, alias_norm, len(string_split(alias_norm, ' ')) AS size, max(len(string_split(alias_norm, ' '))) OVER (PARTITION BY character_id) AS top FROM {aliases}) x GROUP BY character_id")
def unique_top_candidate(spark, sf_dir):
    a = directory(spark, sf_dir).aliases.select("character_id", "alias_norm", F.size(F.split("alias_norm", " ")).alias("size"))
    r = a.withColumn("k", F.rank().over(Window.partitionBy("character_id").orderBy(F.desc("size")))).where("k = 1")
    return r.groupBy("character_id").agg(F.when(F.count(F.lit(1)) == 1, F.max("alias_norm")).alias("winner"))


@query("SELECT character_id, faction FROM (" + NODES + ") n WHERE faction IS NOT NULL")
def primary_faction(spark, sf_dir):
    return read.graph_nodes(directory(spark, sf_dir)).select("character_id", "faction").where("faction is not null")


UPSERT_OLD = "(SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events WHERE event_id % 2 = 0 AND user_id % 3 <> 0) x WHERE k = 1)"


def _versions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    keys = ["user_id", "event_type"]
    none = e.where("false").select(*keys, "value")
    old = write.insert_ignore(none, e.where("event_id % 2 = 0 and user_id % 3 <> 0"), keys, [F.col("event_id")])
    return old, e.where("event_id % 2 = 1"), keys


@query(f"""SELECT * FROM {UPSERT_OLD} o UNION ALL SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events WHERE event_id % 2 = 1) n
WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM {UPSERT_OLD} o WHERE o.user_id = n.user_id AND o.event_type = n.event_type)""")
def upsert_ignore(spark, sf_dir):
    old, new, keys = _versions(spark, sf_dir)
    return write.insert_ignore(old, new, keys, [F.col("event_id")])


@query(f"""SELECT user_id, event_type, NULL::DOUBLE AS value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events WHERE event_id % 2 = 1) n WHERE k = 1
UNION ALL SELECT user_id, event_type, value, NULL FROM {UPSERT_OLD} o WHERE NOT EXISTS (SELECT 1 FROM events n WHERE event_id % 2 = 1 AND o.user_id = n.user_id AND o.event_type = n.event_type)""")
def upsert_replace(spark, sf_dir):
    old, new, keys = _versions(spark, sf_dir)
    wide = old.withColumn("props", F.lit(None).cast("string"))
    out = write.insert_replace(wide, new.select(*keys, "event_id", "props"), keys, [F.col("event_id")])
    return out.select("user_id", "event_type", "value", "props")


@query("SELECT character_id, coalesce(nationality, whereabouts) AS nationality FROM {characters} c LEFT JOIN (SELECT character_id AS id, min(whereabouts) AS whereabouts FROM {appearances} GROUP BY 1) a ON a.id = c.character_id")
def fill_once(spark, sf_dir):
    d = directory(spark, sf_dir)
    given = d.appearances.groupBy("character_id").agg(F.min("whereabouts").alias("nationality"))
    return write.fill_once(d.characters.select("character_id", "nationality"), given, ["character_id"], ["nationality"])


@query("""SELECT a.p_name AS a, b.p_name AS b, list_sort(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' ')))[1] AS shared,
  len(list_filter(string_split(a.p_name, ' '), lambda x: NOT list_contains(string_split(b.p_name, ' '), x))) = 0 AS inside
FROM (SELECT DISTINCT p_name FROM part) a JOIN (SELECT DISTINCT p_name FROM part) b ON a.p_name < b.p_name AND len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) > 0""")
def set_ops_tokens(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("t", names.tokens(names.norm(F.col("p_name"))))
    w = p.withColumn("w", F.explode("t"))
    met = w.selectExpr("p_name a", "t ta", "w").join(w.selectExpr("p_name b", "t tb", "w"), "w").where("a < b").dropDuplicates(["a", "b"])
    return met.select("a", "b", F.array_sort(F.array_intersect("ta", "tb"))[0].alias("shared"), names.subset(F.col("ta"), F.col("tb")).alias("inside"))


# ---------------------------------------------------------------- rules


@query(r"SELECT doc_id, length(n) AS n_norm, length(s) AS n_search, md5(n) AS digest FROM (SELECT doc_id, trim(regexp_replace(replace(lower(text), '’', ''''), '\s+', ' ', 'g')) AS n, trim(regexp_replace(replace(replace(lower(text), '’', ''''), '‘', ''''), '\s+', ' ', 'g')) AS s FROM documents)")
def norm_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", names.norm(F.col("text")).alias("n"), names.norm_search(F.col("text")).alias("s"))
    return d.select("doc_id", F.length("n").cast("bigint").alias("n_norm"), F.length("s").cast("bigint").alias("n_search"), F.md5("n").alias("digest"))


@query(f"SELECT DISTINCT alias_norm, {_stripped('alias_norm')} AS key FROM {{aliases}}")
def titles_stripped(spark, sf_dir):
    return directory(spark, sf_dir).aliases.select("alias_norm", names.match_key(F.col("alias_norm")).alias("key")).distinct()


@query(f"""SELECT a.character_id, a.alias_norm, a.alias_type,
  CASE WHEN notes = 'wrongly named' OR {_rank_decorated('a.alias_norm', 'tokens')} THEN 'DROP'
    WHEN a.alias_type IN ('title', 'epithet') AND a.alias_norm NOT LIKE 'the %' AND EXISTS (SELECT 1 FROM {{aliases}} s WHERE s.character_id = a.character_id AND s.alias_norm = 'the ' || a.alias_norm) THEN 'COLLAPSE'
    WHEN (CASE WHEN a.alias_norm LIKE 'the %' THEN substr(a.alias_norm, 5) ELSE a.alias_norm END) IN ({_quoted(V.ROLES)}) OR {_stripped('a.alias_norm')} = '' THEN 'REVIEW' ELSE 'KEEP' END AS action
FROM {{aliases}} a LEFT JOIN {TOKENS} t ON t.character_id = a.character_id WHERE a.alias_type IN ('title', 'epithet', 'nickname')""")
def alias_cleanup(spark, sf_dir):
    return audits.alias_cleanup(directory(spark, sf_dir)).select("character_id", "alias_norm", "alias_type", "action")


@query(f"SELECT a.character_id, c.primary_name, a.alias_text, a.alias_type FROM {{aliases}} a JOIN {{characters}} c ON c.character_id = a.character_id WHERE alias_norm IN ({_quoted(V.GENERIC)}) OR NOT is_primary AND alias_norm IN ({_quoted(V.SUSPECT)})")
def generic_aliases(spark, sf_dir):
    return audits.generic_aliases(directory(spark, sf_dir))


@query(f"""SELECT character_id, CASE WHEN {_placeholder('n')} THEN 'placeholder' WHEN n NOT IN ({_quoted(V.ALLOWED)}) AND character_type IN ('trolloc', 'myrddraal') AND (contains(n, character_type) OR n LIKE 'the %' OR n LIKE 'a %') THEN 'collective'
  WHEN n NOT IN ({_quoted(V.ALLOWED)}) AND n LIKE 'the %' THEN 'title' END AS verdict FROM (SELECT *, lower(primary_name) AS n FROM {{characters}}) c""")
def name_gates(spark, sf_dir):
    return directory(spark, sf_dir).characters.select("character_id", names.rejection(F.col("primary_name"), F.col("character_type")).alias("verdict"))


@query(f"""SELECT x.character_id, x.verdict, x.verdict = 'title' AND (SELECT count(*) FROM {{appearances}} a WHERE a.character_id = x.character_id) > 2 AS rename FROM (
  SELECT character_id, CASE WHEN {_placeholder('n')} THEN 'placeholder' WHEN character_type IN ('trolloc', 'myrddraal') AND (contains(n, character_type) OR n LIKE 'the %' OR n LIKE 'a %') THEN 'collective' WHEN n LIKE 'the %' THEN 'title' END AS verdict
  FROM (SELECT *, lower(primary_name) AS n FROM {{characters}}) c) x WHERE verdict IS NOT NULL""")
def odd_names(spark, sf_dir):
    return audits.odd_names(directory(spark, sf_dir)).select("character_id", "verdict", "rename")


ORIGIN = "CASE nationality WHEN 'unknown' THEN NULL WHEN 'Andoran' THEN 'Andor' WHEN 'Two Rivers' THEN 'Two Rivers, Andor' WHEN 'Maule (presumably)' THEN 'Maule, Tear' ELSE nationality END"


@query(f"SELECT character_id, {ORIGIN} AS origin, nationality IS NULL OR nationality = 'unknown' AS unresolved, CASE WHEN character_type = 'trolloc' THEN 'Shadow' END AS category FROM {{characters}}")
def origin_normalise(spark, sf_dir):
    n = F.col("nationality")
    return directory(spark, sf_dir).characters.select("character_id", origins.normalized(n).alias("origin"), origins.is_unresolved(n).alias("unresolved"), origins.category(F.col("primary_name"), F.col("character_type")).alias("category"))


@query(f"""SELECT character_id, CASE WHEN o IS NULL THEN 'Andor' WHEN o = 'Two Rivers, Andor' THEN o ELSE o END AS value, o IS NOT NULL AND o NOT IN ('Andor', 'Two Rivers, Andor') AS conflict
FROM (SELECT character_id, {ORIGIN} AS o FROM {{characters}}) x""")
def origin_refine(spark, sf_dir):
    r = origins.refined(F.col("nationality"), F.lit("Andoran"))
    return directory(spark, sf_dir).characters.select("character_id", "nationality").repartition("character_id").select("character_id", r.alias("r")).select("character_id", "r.value", "r.conflict")


@query("""SELECT character_id, CASE age WHEN 'young man' THEN 'young' WHEN 'about 40' THEN 'about 40' WHEN 'Sixty-three' THEN 'about 63' WHEN 'ageless' THEN 'ageless' END AS age,
  CASE age WHEN 'young man' THEN 'older' WHEN 'about 40' THEN 'older' WHEN 'Sixty-three' THEN 'about 63' WHEN 'ageless' THEN 'ageless' ELSE 'older' END AS refined FROM {characters}""")
def age_vocabulary(spark, sf_dir):
    a = ages.normalized(F.col("age"))
    return directory(spark, sf_dir).characters.select("character_id", "age").repartition("character_id").select("character_id", a.alias("age"), ages.refined(a, F.lit("older (gray-haired)")).alias("refined"))


def _listed(values) -> str:
    return "[" + _quoted(values) + "]"


def _numbers(d: dict[str, int]) -> str:
    return "MAP {" + ", ".join(f"'{k}': {n}" for k, n in d.items()) + "}"


_SMALL = [k for k, n in V.UNITS.items() if n < 10]
AGE_WORDS = ("young", "middle-aged", "old", "elderly", "Adult", "girl", "ageless", "immortal", "grey-haired", "well beyond thirty", "youngest of the four", "grown", "unknown", "novice", "little")
#: How a phrase is made of a word, a number, a number's word and a row's number; in SQL for both engines.
AGE_FORMS = (
    "word", "concat(word, ' man')", "concat(num, ' years old')", "concat('about ', num)", "concat(word, ', ', num)", "concat('older than ', word)", "concat('killed ', num, ' years ago')", "concat('Nearly ', told)",
    "concat(told, ' years old')", "concat('over ', told, ' years as a soldier')", "concat(word, ' (', told, ')')", "concat('not much older than the others, ', told)", "concat(told, ' or so')", "concat(word, '; ', word, ' woman')", "concat('same age as ', word, ', ', num)",
)


def _age_sql(x: str) -> str:
    """An age on the scale, of a lower-cased phrase."""
    units, small, tens = ("|".join(k) for k in (V.UNITS, _SMALL, V.TENS))
    first = rf"(?s)^.*?(?:\b({tens})(?:[- ]({small}))?\b|\b({units})\b)(.{{0,24}})"
    rest = f"regexp_replace({x}, '{V.COMPARATIVE}', ' ', 'g')"
    part = lambda k: f"regexp_extract({rest}, '{first}', {k})"
    word = f"CASE WHEN {part(1)} <> '' THEN {_numbers(V.TENS)}[{part(1)}] + coalesce({_numbers(V.UNITS)}[{part(2)}], 0) ELSE {_numbers(V.UNITS)}[{part(3)}] END"
    counts = rf"(regexp_matches({part(4)}, '^\s*(years?|yrs?)\b') AND NOT regexp_matches({part(4)}, '^\s*(years?|yrs?)[- ]old\b') OR regexp_matches({part(4)}, '^\s+[a-z]') AND NOT regexp_matches({part(4)}, '^\s+(or|and|years?|yrs?)\b'))"
    digits = rf"regexp_extract({rest}, '\b(\d{{1,3}})\b', 1)"
    number = f"CASE WHEN NOT regexp_matches({rest}, '{V.DURATION}') THEN CASE WHEN {digits} <> '' THEN {digits}::INT WHEN NOT {counts} THEN {word} END END"
    years = rf"regexp_extract({x}, '\b(\d{{1,3}}|{units})\s*(years?|yrs?)[- ]old\b', 1)"
    said = lambda n: f"CASE WHEN {n} <= 12 THEN 'child' ELSE 'about ' || ({n}) END"
    of_years = f"coalesce({_numbers(V.UNITS)}[{years}], try_cast({years} AS INT))"
    bands = " ".join(f"WHEN regexp_matches({rest}, '{pattern.replace('(?<!-)aged', '[^-]aged')}') THEN '{band}'" for band, pattern in V.BAND_PATTERNS)
    return rf"""CASE WHEN {x} = '' OR regexp_matches({x}, '{V.NO_AGE}') THEN NULL WHEN regexp_matches({x}, '\b(ageless|timeless)\b') THEN 'ageless' WHEN {years} <> '' THEN {said(of_years)}
      WHEN {number} BETWEEN 1 AND 120 THEN {said(number)} {bands} END"""


def _rank_sql(a: str) -> str:
    n = f"try_cast(regexp_extract({a}, '^about (\\d+)', 1) AS INT)"
    return f"CASE WHEN {a} IS NULL THEN -1 WHEN {a} = 'ageless' THEN 7 WHEN {a} LIKE 'about %' THEN CASE WHEN {n} <= 12 THEN 0 WHEN {n} <= 25 THEN 1 WHEN {n} <= 40 THEN 2 WHEN {n} <= 55 THEN 3 WHEN {n} <= 70 THEN 4 ELSE 5 END ELSE list_position({_listed(V.BANDS)}, {a}) - 1 END"


_AGED = f"CASE k % {len(AGE_FORMS)} " + " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(AGE_FORMS)) + " END"


@query(rf"""WITH w AS (SELECT p_partkey AS k, {_listed(AGE_WORDS)}[(p_partkey // 3) % {len(AGE_WORDS)} + 1] AS word, (p_size * 3 % 131)::VARCHAR AS num,
  CASE p_size % 3 WHEN 0 THEN {_listed(V.UNITS)}[p_partkey % {len(V.UNITS)} + 1] WHEN 1 THEN {_listed(V.TENS)}[p_partkey % {len(V.TENS)} + 1] ELSE {_listed(V.TENS)}[p_partkey % {len(V.TENS)} + 1] || '-' || {_listed(_SMALL)}[p_size % {len(_SMALL)} + 1] END AS told FROM part),
x AS (SELECT k, {_AGED} AS phrase FROM w), a AS (SELECT k, phrase, {_age_sql('lower(trim(phrase))')} AS age FROM x),
b AS (SELECT a.k, a.phrase, a.age, n.age AS new FROM a LEFT JOIN a n ON n.k = a.k + 1)
SELECT k, phrase, age, CASE WHEN new IS NULL THEN age WHEN age IS NULL THEN new WHEN {_rank_sql('new')} > {_rank_sql('age')} THEN new
  WHEN {_rank_sql('new')} = {_rank_sql('age')} AND new LIKE 'about %' AND age NOT LIKE 'about %' THEN new ELSE age END AS refined FROM b""")
def age_phrases(spark, sf_dir):
    """Phrases of words, numbers and both, read onto the scale, and refined by the next part's phrase."""
    p = table(spark, sf_dir, "part")
    at = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    key, size = F.col("p_partkey"), F.col("p_size")
    told = F.when(size % 3 == 0, at(V.UNITS, key % len(V.UNITS))).when(size % 3 == 1, at(V.TENS, key % len(V.TENS))).otherwise(F.concat(at(V.TENS, key % len(V.TENS)), F.lit("-"), at(_SMALL, size % len(_SMALL))))
    w = p.select(key.alias("k"), at(AGE_WORDS, F.floor(key / 3) % len(AGE_WORDS)).alias("word"), (size * 3 % 131).cast("string").alias("num"), told.alias("told"))
    x = w.select("k", F.expr(_AGED).alias("phrase")).repartition("k").withColumn("age", ages.normalized(F.col("phrase")))
    follows = x.select((F.col("k") - 1).alias("k"), F.col("phrase").alias("new"))
    both = x.join(follows, "k", "left")
    return both.select("k", "phrase", "age", ages.refined(F.col("age"), F.col("new")).alias("refined"))


_PLACES = (*V.DEMONYMS, *V.PARENTS, *V.PEOPLES, "Shayol Ghul", "unknown", "N/A", "not stated yet", "")
_ORIGIN_FORMS = ("a", "concat(a, ' (presumably)')", "concat(a, ', ', b)", "concat(a, ',, ', b, ' (?)')", "concat('  ', upper(substr(a, 1, 1)), substr(a, 2))", "concat(a, ', ', b, ', ', a)", "concat('(maybe) ', a)")
_ORIGIN = f"CASE k % {len(_ORIGIN_FORMS)} " + " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(_ORIGIN_FORMS)) + " END"
_NAMED = "MAP {" + ", ".join(f"'{k.replace(chr(39), chr(39) * 2)}': '{v.replace(chr(39), chr(39) * 2)}'" for k, v in (V.DEMONYMS | V.PEOPLES).items()) + "}"
_ABOVE = "(VALUES " + ", ".join(f"('{k.replace(chr(39), chr(39) * 2)}', '{v}')" for k, v in V.PARENTS.items()) + ") v(region, parent)"
_NOWHERE = "(o IS NULL OR trim(o) = '' OR " + " OR ".join(f"starts_with(lower(trim(o)), '{x}')" for x in V.UNRESOLVED) + ")"


@query(rf"""WITH RECURSIVE pl AS (SELECT {_listed(_PLACES)} AS l), w AS (SELECT p_partkey AS k, l[p_partkey % {len(_PLACES)} + 1] AS a, l[(p_partkey * 7 + p_size) % {len(_PLACES)} + 1] AS b FROM part, pl),
x AS (SELECT k, {_ORIGIN} AS o FROM w),
c AS (SELECT k, o, list_filter(list_transform(list_transform(string_split(o, ','), lambda p: trim(regexp_replace(p, '\([^)]*\)', '', 'g'))), lambda p: coalesce({_NAMED}[lower(p)], p)), lambda p: p <> '') AS parts FROM x),
up AS (SELECT region, parent, 1 AS depth FROM {_ABOVE} UNION ALL SELECT up.region, v.parent, depth + 1 FROM up JOIN {_ABOVE} ON v.region = lower(up.parent)),
ch AS (SELECT region, list(parent ORDER BY depth) AS above FROM up GROUP BY region),
f AS (SELECT k, o, parts, coalesce(above, []) AS above, list_transform(parts, lambda p: lower(p)) AS seen FROM c LEFT JOIN ch ON region = lower(parts[-1])),
g AS (SELECT *, coalesce(list_min(list_filter(range(1, len(above) + 1), lambda i: list_contains(seen, lower(above[i])))), len(above) + 1) AS first FROM f)
SELECT k, o AS phrase, {_NOWHERE} AS unresolved, CASE WHEN NOT {_NOWHERE} AND len(parts) > 0 THEN array_to_string(list_concat(parts, above[1:first - 1]), ', ') END AS origin FROM g""")
def origin_phrases(spark, sf_dir):
    """Places, peoples and hedges, alone and in lists, completed with the regions above them."""
    at = lambda i: F.element_at(F.array(*[F.lit(v) for v in _PLACES]), (i + 1).cast("int"))
    key = F.col("p_partkey")
    w = table(spark, sf_dir, "part").select(key.alias("k"), at(key % len(_PLACES)).alias("a"), at((key * 7 + F.col("p_size")) % len(_PLACES)).alias("b"))
    x = w.select("k", F.expr(_ORIGIN).alias("phrase"))
    return x.select("k", "phrase", origins.is_unresolved(F.col("phrase")).alias("unresolved"), origins.normalized(F.col("phrase")).alias("origin"))


_HASH = "list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(p_brand) + 1), lambda i: ascii(substr(p_brand, i, 1))::BIGINT)), lambda h, c: (h * 31 + c + 2147483648) & 4294967295 - 2147483648)"


@query(f"SELECT p_brand, ([{_quoted(V.PALETTE)}])[abs(h) % {len(V.PALETTE)} + 1] AS colour FROM (SELECT DISTINCT p_brand, {_HASH.replace('(h * 31 + c + 2147483648) & 4294967295 - 2147483648', '((h * 31 + c + 2147483648) & 4294967295) - 2147483648')} AS h FROM part) x")
def hash_colours(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_brand").distinct().select("p_brand", names.hash_colour(F.col("p_brand")).alias("colour"))


# ---------------------------------------------------------------- audits

OWNERS = "(SELECT lower(primary_name) AS alias_norm, max(character_id) AS other_id, arg_max(primary_name, character_id) AS other FROM {characters} GROUP BY 1)"


#: An alias with the last owner of its name only: what a report counts.
COLLIDED = f"""SELECT a.character_id, c.primary_name AS owner, a.alias_text AS alias, CASE WHEN a.alias_type = 'given_name' THEN 'possible-duplicate' ELSE a.alias_type END AS bucket, o.other_id, o.other
FROM {{aliases}} a JOIN {OWNERS} o ON o.alias_norm = a.alias_norm JOIN {{characters}} c ON c.character_id = a.character_id
WHERE NOT a.is_primary AND a.character_id <> o.other_id AND NOT EXISTS (SELECT 1 FROM {{acknowledged_collisions}} k WHERE k.owner_cid = a.character_id AND k.other_cid = o.other_id AND k.alias_norm = a.alias_norm)"""


@query("""SELECT a.character_id, c.primary_name AS owner, a.alias_text AS alias, CASE WHEN a.alias_type = 'given_name' THEN 'possible-duplicate' ELSE a.alias_type END AS bucket, o.character_id AS other_id, o.primary_name AS other
FROM {aliases} a JOIN {characters} o ON lower(o.primary_name) = a.alias_norm JOIN {characters} c ON c.character_id = a.character_id
WHERE NOT a.is_primary AND a.character_id <> o.character_id AND NOT EXISTS (SELECT 1 FROM {acknowledged_collisions} k WHERE k.owner_cid = a.character_id AND k.other_cid = o.character_id AND k.alias_norm = a.alias_norm)""")
def collisions_suppressed(spark, sf_dir):
    return audits.all_collisions(directory(spark, sf_dir))


@query()
def near_duplicates(spark, sf_dir):
    """No other engine here has the similarity; a test compares with the library on all pairs."""
    return audits.similar_names(directory(spark, sf_dir))


@query(f"""SELECT character_id, primary_name, character_type FROM {{characters}} c WHERE character_type = 'other' AND lower(primary_name) NOT IN ({_quoted(V.ALLOWED)})
AND NOT EXISTS (SELECT 1 FROM {{appearances}} x WHERE x.character_id = c.character_id AND x.character_id % 3 <> 0) AND NOT EXISTS (SELECT 1 FROM {{mentions}} x WHERE x.character_id = c.character_id)
AND NOT EXISTS (SELECT 1 FROM {{relationships}} x WHERE c.character_id IN (x.character_a, x.character_b) AND x.character_a % 3 <> 0 AND x.character_b % 3 <> 0) AND NOT EXISTS (SELECT 1 FROM {{character_factions}} x WHERE x.character_id = c.character_id)""")
def empty_shells(spark, sf_dir):
    """Of a directory that knows nothing more of every third character."""
    d = directory(spark, sf_dir)
    return audits.empty_shells(d.having(appearances=d.appearances.where("character_id % 3 <> 0"), relationships=d.relationships.where("character_a % 3 <> 0 and character_b % 3 <> 0")))


@query("""SELECT persona_norm, true_cid, reveal_book, book, CASE WHEN book >= reveal_book THEN 'merged' ELSE 'separate' END AS expected,
  concat_ws('; ', CASE WHEN book >= reveal_book AND apart THEN 'separate past reveal' END, CASE WHEN book >= reveal_book AND NOT masked THEN 'alias missing' END,
    CASE WHEN book < reveal_book AND NOT apart THEN 'row missing' END, CASE WHEN book < reveal_book AND masked THEN 'alias too early' END) AS problems
FROM (SELECT m.*, (SELECT max(series_order) FROM {books}) AS book, o.row_id IS NOT NULL AND o.row_id <> m.true_cid AS apart,
    EXISTS (SELECT 1 FROM {aliases} a WHERE a.character_id = m.true_cid AND a.alias_norm = m.persona_norm AND a.alias_type = 'disguise') AS masked
  FROM {disguise_map} m LEFT JOIN (SELECT lower(primary_name) AS persona_norm, min(character_id) AS row_id FROM {characters} GROUP BY 1) o ON o.persona_norm = m.persona_norm) x
WHERE CASE WHEN book >= reveal_book THEN apart OR NOT masked ELSE NOT apart OR masked END""")
def reveal_consistency(spark, sf_dir):
    return audits.reveals(directory(spark, sf_dir))


@query("SELECT a.character_id, c.primary_name, a.alias_text AS the_form, b.alias_text AS bare_form FROM {aliases} a JOIN {aliases} b ON b.character_id = a.character_id AND a.alias_norm = 'the ' || b.alias_norm JOIN {characters} c ON c.character_id = a.character_id")
def article_duplicates(spark, sf_dir):
    return audits.article_duplicates(directory(spark, sf_dir))


@query(f"SELECT a.character_id, c.primary_name, a.alias_text, a.alias_type FROM {{aliases}} a JOIN {TOKENS} t ON t.character_id = a.character_id JOIN {{characters}} c ON c.character_id = a.character_id WHERE a.alias_type IN ('title', 'epithet', 'nickname') AND {_rank_decorated('a.alias_norm', 'tokens')}")
def rank_duplicates(spark, sf_dir):
    return audits.rank_duplicates(directory(spark, sf_dir))


@query(f"""WITH r AS (SELECT character_id, primary_name, character_type, lower(primary_name) AS n, {_stripped('lower(primary_name)')} AS k FROM {{characters}})
SELECT s.character_id AS short_id, s.primary_name AS short, l.character_id AS long_id, l.primary_name AS long FROM r l JOIN r s ON s.character_type = l.character_type AND s.k <> '' AND l.k LIKE s.k || ' %'
WHERE s.n <> l.n AND NOT {_placeholder('l.n')} AND len(string_split(l.k, ' ')) BETWEEN 2 AND 4
AND NOT EXISTS (SELECT 1 FROM {{distinct_pairs}} p WHERE p.cid_low = least(s.character_id, l.character_id) AND p.cid_high = greatest(s.character_id, l.character_id))
AND NOT EXISTS (SELECT 1 FROM {{aliases}} a WHERE a.character_id = l.character_id AND a.alias_norm = s.n) AND NOT EXISTS (SELECT 1 FROM {{aliases}} a WHERE a.character_id = s.character_id AND a.alias_norm = l.n)""")
def fuller_names(spark, sf_dir):
    return audits.fuller_names(directory(spark, sf_dir))


@query("SELECT 'bad slot' AS problem, slot FROM (SELECT 'Book!' AS slot) UNION ALL SELECT 'empty label', 'book4' UNION ALL SELECT 'file named after another book', slot FROM {books} WHERE series_order = (SELECT max(series_order) FROM {books})")
def book_problems(spark, sf_dir):
    d = directory(spark, sf_dir)
    b = d.books.withColumn("slot", F.when(F.col("series_order") == 2, "Book!").otherwise(F.col("slot"))).withColumn("label", F.when(F.col("series_order") == 4, " ").otherwise(F.col("label")))
    return audits.book_problems(d.having(books=b), "book3")


@query(r"""SELECT chapter_id, term, count(*) AS n FROM (SELECT doc_id AS chapter_id, unnest(string_split_regex(lower(text), '[^\pL\pM0-9_]+')) AS w FROM documents) c
JOIN (SELECT unnest(['the', 'idiot', 'Erin', 'trash']) AS term) t ON w = lower(term) GROUP BY ALL""")
def term_counts(spark, sf_dir):
    c = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chapter_id"), F.col("text").alias("full_text"))
    return audits.mentions_found(c, spark.createDataFrame([(x,) for x in ("the", "idiot", "Erin", "trash")], "term string"))


@query()
def mention_gap(spark, sf_dir):
    """Words are told apart by Unicode rules that the other engine lacks; a test compares with a plain scan."""
    made: dict[str, DataFrame] = {}  # each from those before it, with the columns that are read
    for name, columns in (("characters", ["character_id", "primary_name", "character_type"]), ("aliases", ["character_id", "alias_text", "is_primary"]), ("noted", ["character_id", "chapter_id", "name_used"])):
        made[name] = written(view(spark, sf_dir, name, made).select(columns))
    extra = spark.sql("SELECT * FROM VALUES (1L, 'erin', false), (2L, 'trash', false), (3L, 'clown', false) AS x (character_id, alias_text, is_primary)")
    d = directory(spark, sf_dir)
    return audits.mention_gaps(d.having(characters=made["characters"], aliases=made["aliases"].union(extra), appearances=made["noted"], chapters=view(spark, sf_dir, "texts")))


SEARCHED = r"trim(regexp_replace(replace(replace(lower({0}), '’', ''''), '‘', ''''), '\s+', ' ', 'g'))"


@query(f"""WITH c AS (SELECT item_id AS id, text AS evidence, {SEARCHED.format('text')} AS e FROM benchmark UNION ALL SELECT 1000000 + item_id, substr(text, 9, 12), {SEARCHED.format('substr(text, 9, 12)')} FROM benchmark),
d AS (SELECT {SEARCHED.format('text')} AS t FROM documents)
SELECT id, evidence, e = '' OR EXISTS (SELECT 1 FROM d WHERE contains(t, e)) AS verified FROM c""")
def evidence_verify(spark, sf_dir):
    """Every benchmark passage, and a few letters of each, in any of all documents."""
    b = table(spark, sf_dir, "benchmark")
    claims = b.select(F.col("item_id").alias("id"), F.col("text").alias("evidence")).union(b.select(F.col("item_id") + 1_000_000, F.substring("text", 9, 12)))
    return audits.evidence_anywhere(claims, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text"))


@query("SELECT 'books' AS name, 'source_file' AS \"column\", count(*) AS rows FROM {books} UNION ALL SELECT 'characters', 'description', count(*) FROM {characters} WHERE description IS NOT NULL UNION ALL SELECT 'books', 'source_file', count(*) FROM {books}")
def export_verify(spark, sf_dir):
    d = directory(spark, sf_dir)
    from tesserae.model import public

    shown = public(d)
    return audits.export_problems(d, shown.having(books=d.books))


AUDITED = {
    "generic aliases": "SELECT count(*) FROM {aliases} WHERE alias_norm IN (" + _quoted(V.GENERIC) + ")",
    "article duplicates": "SELECT count(*) FROM {aliases} a JOIN {aliases} b ON b.character_id = a.character_id AND a.alias_norm = 'the ' || b.alias_norm",
    "primary aliases": "SELECT count(*) FROM (SELECT 1 FROM {characters} c LEFT JOIN {aliases} a ON a.character_id = c.character_id GROUP BY c.character_id HAVING count_if(is_primary) <> 1) x",
    "broken pointers": "SELECT 0::BIGINT",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS name, ({v}) AS rows" for k, v in AUDITED.items()))
def audit_summary(spark, sf_dir):
    """Over tables that are made once: each use of a view in a plan would send its small sides to the driver again."""
    return audits.summary(_once(spark, sf_dir, "characters", "aliases", "appearances"), list(AUDITED))


#: Checks of a full audit by the queries that show their rows.
REPORTED = {
    "generic aliases": "generic_aliases", "odd names": "odd_names", "collisions": "collisions_suppressed", "reveals": "reveal_consistency",
    "article duplicates": "article_duplicates", "rank duplicates": "rank_duplicates", "fuller names": "fuller_names",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS name, (SELECT count(*) FROM ({with_views(COLLIDED) if k == 'collisions' else ORACLES[q]}) x) AS rows" for k, q in REPORTED.items()))
def audit_report(spark, sf_dir):
    """How many rows seven checks of a full audit flag, over the tables that their counts need, which are made once."""
    return audits.summary(_apart(spark, sf_dir, "characters", "aliases"), list(REPORTED))


@query("SELECT 'nation' AS name, 'n_name' AS \"column\", count(*) AS rows FROM nation WHERE n_name LIKE '%NATION_1%' HAVING count(*) > 0")
def path_marks(spark, sf_dir):
    return audits.leaks(table(spark, sf_dir, "nation"), "nation", ("nation_1", "BOOKS/"))


# ---------------------------------------------------------------- resolution


def _wanted(spark, sf_dir):
    d = directory(spark, sf_dir)
    return d.characters.select(F.col("character_id").alias("id"), F.concat(F.when(F.col("character_id") % 2 == 0, F.lit("")).otherwise(F.lit("Dame ")), F.substring_index("primary_name", " ", 2)).alias("name"))


@query(f"""WITH q AS (SELECT character_id AS id, (CASE WHEN character_id % 2 = 0 THEN '' ELSE 'dame ' END) || array_to_string(string_split(lower(primary_name), ' ')[1:2], ' ') AS n FROM {{characters}}),
e AS (SELECT alias_norm, max(character_id) AS cid FROM {{aliases}} GROUP BY 1),
s AS (SELECT k, min(character_id) AS cid FROM (SELECT {_stripped('alias_norm')} AS k, character_id FROM {{aliases}}) y WHERE k <> '' GROUP BY k HAVING count(DISTINCT character_id) = 1)
SELECT id, coalesce(e.cid, s.cid, -1) AS cid FROM q LEFT JOIN e ON e.alias_norm = n LEFT JOIN s ON s.k = {_stripped('n')}""")
def resolve_exact(spark, sf_dir):
    return resolve.exact(_wanted(spark, sf_dir), directory(spark, sf_dir).aliases).select("id", F.coalesce("exact_cid", F.lit(-1)).alias("cid"))


SHARED = f"len(list_filter(list_intersect(t, u), lambda x: length(x) >= 2 AND x NOT IN ({_quoted(V.STOPWORDS)})))"


@query(f"""WITH q AS (SELECT DISTINCT 'new ' || lower(n_name) || ' ' || split_part(p_name, ' ', 2) AS name FROM part JOIN nation ON n_nationkey = p_partkey % 5 UNION SELECT DISTINCT p_name || ' x' FROM part),
a AS (SELECT DISTINCT character_id, alias_norm, list_distinct(string_split(alias_norm, ' ')) AS u FROM {{aliases}}),
m AS (SELECT name, character_id AS cid, {SHARED} AS d, len(list_intersect(t, u))::DOUBLE / greatest(len(t), len(u)) AS s FROM (SELECT name, list_distinct(string_split(name, ' ')) AS t FROM q) q, a
  WHERE len(list_filter(t, lambda x: NOT list_contains(u, x))) = 0 OR len(list_filter(u, lambda x: NOT list_contains(t, x))) = 0)
SELECT name, cid, max(d)::INT AS shared, max(s) AS score FROM m WHERE d > 0 GROUP BY name, cid""")
def resolve_tokens(spark, sf_dir):
    p, n = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    q = p.join(n, F.col("n_nationkey") == F.col("p_partkey") % 5).select(F.concat(F.lit("new "), F.lower("n_name"), F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("name"))
    return resolve.token_candidates(q.union(p.select(F.concat("p_name", F.lit(" x")))), directory(spark, sf_dir).aliases)


@query()
def resolve_existing(spark, sf_dir):
    """The whole ladder with hints; its similarity has no SQL. Tests hold it to golden scenarios."""
    q = _wanted(spark, sf_dir).withColumn("pointer", F.when(F.col("id") % 3 == 0, F.concat(F.col("name"), F.lit("s"))).otherwise(F.col("name")))
    return resolve.resolve(q, directory(spark, sf_dir).aliases).select("id", "name", "cid", "method", F.size("candidates").alias("n_candidates"))


# ---------------------------------------------------------------- plans


PAIRS = "(SELECT c_custkey AS keep, c_custkey + 5 AS \"drop\" FROM customer WHERE c_custkey % 10 < 5)"


def _pairs(spark, sf_dir):
    """Every character is in one pair: of each ten, the first five are kept and the fifth after each goes."""
    return table(spark, sf_dir, "customer").where("c_custkey % 10 < 5").selectExpr("c_custkey as keep", "c_custkey + 5 as drop")


def _no_place(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '' OR lower(trim({x})) LIKE 'unknown%')"


@query(f"""WITH u AS (UNPIVOT (SELECT character_id, coalesce(nationality, '~') AS nationality, coalesce(physical_traits, '~') AS physical_traits, coalesce(age, '~') AS age, coalesce(filiations, '~') AS filiations,
    coalesce(associations, '~') AS associations, coalesce(personality, '~') AS personality, coalesce(description, '~') AS description FROM {{characters}}) ON nationality, physical_traits, age, filiations, associations, personality, description INTO NAME field VALUE v),
t AS (SELECT character_id, field, nullif(v, '~') AS v FROM u)
SELECT keep, "drop", a.field, CASE WHEN NOT {_no_place('a.v')} THEN 'keep' WHEN NOT {_no_place('b.v')} THEN 'fill' ELSE 'both_placeholder' END AS action, a.v AS kept, b.v AS dropped,
  NOT {_no_place('a.v')} AND NOT {_no_place('b.v')} AND lower(a.v) <> lower(b.v) AS differs FROM {PAIRS} p JOIN t a ON a.character_id = keep JOIN t b ON b.character_id = "drop" AND b.field = a.field""")
def merge_plan_traits(spark, sf_dir):
    return merge.traits(directory(spark, sf_dir), _pairs(spark, sf_dir))


@query(f"""WITH o AS (SELECT character_id, first_chapter_id, series_order * 100000 + chapter_number AS place FROM {{characters}} LEFT JOIN {{chapters}} c ON c.chapter_id = first_chapter_id LEFT JOIN {{books}} b ON b.book_id = c.book_id)
SELECT keep, "drop", CASE WHEN b.place IS NOT NULL AND (a.place IS NULL OR b.place < a.place) THEN 'update' ELSE 'keep' END AS action,
  coalesce(CASE WHEN b.place IS NOT NULL AND (a.place IS NULL OR b.place < a.place) THEN b.first_chapter_id ELSE a.first_chapter_id END, -1) AS first_chapter_id
FROM {PAIRS} p JOIN o a ON a.character_id = keep JOIN o b ON b.character_id = "drop\"""")
def merge_plan_anchors(spark, sf_dir):
    a = merge.anchors(directory(spark, sf_dir), _pairs(spark, sf_dir))
    return a.withColumn("first_chapter_id", F.coalesce("first_chapter_id", F.lit(-1)))


@query(f"""WITH r AS (SELECT keep, alias_text, alias_norm, CASE WHEN alias_type = 'primary' THEN 'epithet' ELSE alias_type END AS alias_type, 0 AS k FROM {PAIRS} p JOIN {{aliases}} a ON a.character_id = "drop"
  UNION ALL SELECT keep, primary_name, lower(primary_name), 'epithet', 1 FROM {PAIRS} p JOIN {{characters}} c ON c.character_id = "drop"),
n AS (SELECT *, row_number() OVER (PARTITION BY keep, alias_norm ORDER BY k, alias_text) AS i FROM r)
SELECT keep, alias_text, alias_norm, alias_type, CASE WHEN i = 1 AND NOT EXISTS (SELECT 1 FROM {{aliases}} a WHERE a.character_id = keep AND a.alias_norm = n.alias_norm) THEN 'insert' ELSE 'skip' END AS action FROM n""")
def merge_plan_aliases(spark, sf_dir):
    return merge.aliases(directory(spark, sf_dir), _pairs(spark, sf_dir))


@query(f"""SELECT keep, "drop", chapter_id, CASE WHEN EXISTS (SELECT 1 FROM {{appearances}} x WHERE x.character_id = keep AND x.chapter_id = a.chapter_id) THEN 'conflict' ELSE 'reassign' END AS action
FROM {PAIRS} p JOIN {{appearances}} a ON a.character_id = "drop\"""")
def merge_plan_appearances(spark, sf_dir):
    return merge.appearances(directory(spark, sf_dir), _pairs(spark, sf_dir))


@query(f"""WITH m AS (SELECT keep, character_id AS owner, chapter_id, row_number() OVER (PARTITION BY keep, chapter_id ORDER BY character_id <> keep) AS k FROM {PAIRS} p JOIN {{mentions}} m ON character_id IN (keep, "drop"))
SELECT keep, owner, chapter_id, CASE WHEN k > 1 OR EXISTS (SELECT 1 FROM {PAIRS} q JOIN {{appearances}} a ON a.character_id IN (q.keep, q."drop") WHERE q.keep = m.keep AND a.chapter_id = m.chapter_id) THEN 'drop' WHEN owner = keep THEN 'keep' ELSE 'reassign' END AS action FROM m""")
def merge_plan_mentions(spark, sf_dir):
    return merge.mentions(directory(spark, sf_dir), _pairs(spark, sf_dir))


@query(f"""WITH r AS (SELECT keep, character_a, character_b, relationship_type, directed, CASE WHEN character_a = "drop" THEN character_b ELSE character_a END AS other_id, CASE WHEN character_a = "drop" THEN 'a' ELSE 'b' END AS side
  FROM {PAIRS} p JOIN {{relationships}} ON "drop" IN (character_a, character_b)),
f AS (SELECT r.*, CASE WHEN other_id = keep THEN 'self_loop' WHEN EXISTS (SELECT 1 FROM {{relationships}} x WHERE x.relationship_type = r.relationship_type AND
  (x.character_a = keep AND x.character_b = other_id AND (NOT r.directed OR side = 'a') OR x.character_a = other_id AND x.character_b = keep AND (NOT r.directed OR side = 'b'))) THEN 'duplicate' END AS verdict FROM r)
SELECT keep, character_a, character_b, relationship_type, directed, other_id, side, coalesce(verdict, CASE WHEN row_number() OVER (PARTITION BY keep, other_id, relationship_type, verdict ORDER BY character_a, character_b) = 1 THEN 'reassign' ELSE 'duplicate' END) AS action FROM f""")
def merge_plan_relationships(spark, sf_dir):
    return merge.relationships(directory(spark, sf_dir), _pairs(spark, sf_dir))


@query(f"""SELECT keep, "drop", faction_id, role, CASE WHEN EXISTS (SELECT 1 FROM {{character_factions}} x WHERE x.character_id = keep AND x.faction_id = f.faction_id) THEN 'duplicate' ELSE 'reassign' END AS action
FROM {PAIRS} p JOIN {{character_factions}} f ON f.character_id = "drop\"""")
def merge_plan_factions(spark, sf_dir):
    return merge.factions(directory(spark, sf_dir), _pairs(spark, sf_dir)).drop("first_chapter_id")


@query(f"""SELECT 'characters' AS name, (SELECT count(*) FROM {{characters}}) - (SELECT count(*) FROM {PAIRS} p JOIN {{characters}} ON character_id = "drop") AS rows
UNION ALL SELECT 'appearances', (SELECT count(*) FROM (SELECT DISTINCT coalesce(keep, character_id), chapter_id FROM {{appearances}} LEFT JOIN {PAIRS} p ON "drop" = character_id) x)
UNION ALL SELECT 'character_factions', (SELECT count(*) FROM (SELECT DISTINCT coalesce(keep, character_id), faction_id FROM {{character_factions}} LEFT JOIN {PAIRS} p ON "drop" = character_id) x)""")
def merge_applied_counts(spark, sf_dir):
    d = merge.apply(_once(spark, sf_dir, "characters", "appearances", "character_factions"), _pairs(spark, sf_dir))  # of others nothing is counted
    one = lambda t: getattr(d, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("name"), "rows")
    return one("characters").union(one("appearances")).union(one("character_factions"))


LINKS = "(SELECT c_custkey AS \"drop\", c_custkey - 5 AS keep FROM customer WHERE c_custkey % 35 >= 5 AND (c_custkey % 35) // 5 <= 1 + (c_custkey // 35) % 5)"
#: Everyone with whom they are in the end, how far above, and the order in which they go into them.
ROOTS = f"""up("drop", keep, depth) AS (SELECT "drop", keep, 1 FROM {LINKS} l UNION ALL SELECT up."drop", l.keep, depth + 1 FROM up JOIN {LINKS} l ON l."drop" = up.keep),
roots AS (SELECT "drop", arg_max(keep, depth) AS keep, max(depth) AS depth FROM up GROUP BY "drop"),
everyone AS (SELECT c_custkey AS character_id, coalesce(keep, c_custkey) AS root, coalesce(depth, 0) AS depth FROM customer LEFT JOIN roots ON "drop" = c_custkey)"""


def _links(spark, sf_dir):
    """Chains of two to six characters of one type, each of whom goes into the one before."""
    c = table(spark, sf_dir, "customer").where("c_custkey % 35 >= 5 and floor((c_custkey % 35) / 5) <= 1 + floor(c_custkey / 35) % 5")
    return c.selectExpr("c_custkey - 5 as keep", "c_custkey as drop")


@query(f'WITH RECURSIVE {ROOTS} SELECT "drop", keep, depth FROM roots')
def merge_chains(spark, sf_dir):
    found = merge.resolved(directory(spark, sf_dir), _links(spark, sf_dir))
    return found.select("drop", "keep", F.size("path").alias("depth"))


@query(f"""WITH RECURSIVE {ROOTS},
a AS (SELECT root, chapter_id, arg_min(whereabouts, depth) AS whereabouts FROM {{appearances}} JOIN everyone USING (character_id) GROUP BY ALL),
m AS (SELECT DISTINCT root, chapter_id FROM {{mentions}} JOIN everyone USING (character_id) EXCEPT SELECT root, chapter_id FROM a),
f AS (SELECT root, faction_id, arg_min(role, depth) AS role FROM {{character_factions}} JOIN everyone USING (character_id) GROUP BY ALL),
r AS (SELECT DISTINCT least(x.root, y.root) AS low, greatest(x.root, y.root) AS high, relationship_type FROM {{relationships}} e JOIN everyone x ON x.character_id = character_a JOIN everyone y ON y.character_id = character_b WHERE x.root <> y.root)
SELECT 'appearances' AS name, root AS a, chapter_id AS b, whereabouts AS said FROM a UNION ALL SELECT 'mentions', root, chapter_id, NULL FROM m
UNION ALL SELECT 'character_factions', root, faction_id, role FROM f UNION ALL SELECT 'relationships', low, high, relationship_type FROM r
UNION ALL SELECT 'characters', root, NULL, NULL FROM everyone WHERE depth = 0 AND root IN (SELECT character_id FROM {{characters}})""")
def merge_chains_applied(spark, sf_dir):
    """What is left of all tables; relationships as pairs, whichever way they point."""
    d = merge.apply(_once(spark, sf_dir, "characters", "aliases", "appearances", "relationships", "mentions", "character_factions"), _links(spark, sf_dir))
    none = F.lit(None).cast("string")
    row = lambda df, name, a, b, said: df.select(F.lit(name).alias("name"), F.expr(a).cast("bigint").alias("a"), F.expr(b).cast("bigint").alias("b"), said.alias("said"))
    out = row(d.appearances, "appearances", "character_id", "chapter_id", F.col("whereabouts"))
    out = out.union(row(d.mentions, "mentions", "character_id", "chapter_id", none)).union(row(d.character_factions, "character_factions", "character_id", "faction_id", F.col("role")))
    pairs = d.relationships.selectExpr("least(character_a, character_b) as low", "greatest(character_a, character_b) as high", "relationship_type").distinct()
    return out.union(row(pairs, "relationships", "low", "high", F.col("relationship_type"))).union(row(d.characters, "characters", "character_id", "null", none))


DOOMED = "(SELECT c_custkey FROM customer WHERE c_custkey % 7 = 3)"


@query(f"""SELECT 'aliases' AS name, count(*) AS rows FROM {{aliases}} WHERE character_id IN {DOOMED} UNION ALL SELECT 'appearances', count(*) FROM {{appearances}} WHERE character_id IN {DOOMED}
UNION ALL SELECT 'mentions', count(*) FROM {{mentions}} WHERE character_id IN {DOOMED} UNION ALL SELECT 'relationships', count(*) FROM {{relationships}} WHERE character_a IN {DOOMED} OR character_b IN {DOOMED}
UNION ALL SELECT 'character_factions', count(*) FROM {{character_factions}} WHERE character_id IN {DOOMED} UNION ALL SELECT 'distinct_pairs', count(*) FROM {{distinct_pairs}} WHERE cid_low IN {DOOMED} OR cid_high IN {DOOMED}
UNION ALL SELECT 'acknowledged_collisions', count(*) FROM {{acknowledged_collisions}} WHERE owner_cid IN {DOOMED} OR other_cid IN {DOOMED} UNION ALL SELECT 'disguise_map', count(*) FROM {{disguise_map}} WHERE true_cid IN {DOOMED}
UNION ALL SELECT 'characters', count(*) FROM {{characters}} WHERE character_id IN {DOOMED}""")
def delete_cascade_counts(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").where("c_custkey % 7 = 3").select(F.col("c_custkey").alias("character_id"))
    return change.deletion_counts(_once(spark, sf_dir, "characters", "aliases", "appearances", "relationships", "mentions"), ids)


@query(f"SELECT character_a, character_b, relationship_type FROM {{relationships}} WHERE character_a NOT IN {DOOMED} AND character_b NOT IN {DOOMED}")
def delete_cascade(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").where("c_custkey % 7 = 3").select(F.col("c_custkey").alias("character_id"))
    return change.delete(directory(spark, sf_dir), ids).relationships.select("character_a", "character_b", "relationship_type")


def _earlier(spark, sf_dir, last: int = 8):
    """The snapshot up to a book: later rows are not there, and some traits and names are not yet told."""
    d = directory(spark, sf_dir)
    books = d.books.where(F.col("series_order") <= last)
    chapters = d.chapters.join(books.select("book_id"), "book_id", "left_semi")
    people = d.characters.where("character_id % 4 <> 1").withColumn("physical_traits", F.when(F.col("character_id") % 8 == 0, F.col("physical_traits"))).withColumn("age", F.when(F.col("character_id") % 3 == 0, F.col("age")))
    own = people.select("character_id")
    return d.having(
        books=books, chapters=chapters, characters=people, appearances=d.appearances.join(chapters.select("chapter_id"), "chapter_id", "left_semi").join(own, "character_id", "left_semi"),
        character_factions=d.character_factions.join(own, "character_id", "left_semi").where("(character_id + faction_id) % 2 = 0"), factions=d.factions.where("faction_id % 5 <> 0"),
    )


@query("""WITH n AS (SELECT chapter_id, series_order, chapter_number FROM {chapters} c JOIN {books} b ON b.book_id = c.book_id), u AS (SELECT chapter_id FROM {appearances} WHERE character_id % 100 = 1 UNION SELECT chapter_id FROM {mentions} WHERE character_id % 100 = 1)
SELECT 'chapter' AS kind, chapter_id::VARCHAR AS value FROM u JOIN n USING (chapter_id) WHERE series_order > 8
UNION ALL SELECT DISTINCT 'faction', name_norm FROM {character_factions} m JOIN {factions} f ON f.faction_id = m.faction_id WHERE m.character_id % 100 = 1 AND f.faction_id % 5 = 0
UNION ALL SELECT 'character', primary_name FROM {characters} c WHERE character_id % 100 <> 1 AND character_id IN (SELECT character_a FROM {relationships} WHERE character_b % 100 = 1 UNION SELECT character_b FROM {relationships} WHERE character_a % 100 = 1)
  AND primary_name NOT IN (SELECT primary_name FROM {characters} WHERE character_id % 4 <> 1)
UNION ALL SELECT 'name taken', primary_name FROM {characters} c WHERE character_id % 100 = 1 AND primary_name IN (SELECT primary_name FROM {characters} WHERE character_id % 4 <> 1)""")
def restore_lookup_check(spark, sf_dir):
    d = directory(spark, sf_dir)
    ids = d.characters.where("character_id % 100 = 1").select("character_id")
    return change.restore_gaps(d, _earlier(spark, sf_dir), ids)


@query(f"""WITH f AS (SELECT primary_name, 'Origin ' || c_nationkey AS nationality, CASE c_custkey % 3 WHEN 0 THEN 'x_book3.db' WHEN 1 THEN 'x_book11.db' ELSE 'x_newspring.db' END AS db_file FROM customer JOIN {{characters}} ON character_id = c_custkey
  UNION ALL SELECT 'Nobody At All', 'Tear', 'x_book2.db'),
i AS (SELECT lower(primary_name) AS key, count(*) AS n, min(character_id) AS cid, arg_min(coalesce(nationality, ''), character_id) AS cur FROM {{characters}} GROUP BY 1)
SELECT primary_name, nationality, db_file, action, CASE WHEN action IN ('would_write', 'already_matches', 'conflict') THEN cid ELSE -1 END AS character_id FROM (
  SELECT f.*, cid, CASE WHEN db_file LIKE '%newspring%' THEN 'skipped_no_book_number' WHEN db_file LIKE '%book11%' THEN 'filtered_by_book' WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' WHEN {_no_place('cur')} THEN 'would_write' WHEN lower(cur) = lower(nationality) THEN 'already_matches' ELSE 'conflict' END AS action
  FROM f LEFT JOIN i ON i.key = lower(primary_name)) x""")
def carry_forward(spark, sf_dir):
    d = directory(spark, sf_dir)
    c = table(spark, sf_dir, "customer").join(d.characters.select(F.col("character_id").alias("c_custkey"), "primary_name"), "c_custkey")
    file = F.when(F.col("c_custkey") % 3 == 0, "x_book3.db").when(F.col("c_custkey") % 3 == 1, "x_book11.db").otherwise("x_newspring.db")
    found = c.select("primary_name", F.concat(F.lit("Origin "), F.col("c_nationkey").cast("string")).alias("nationality"), file.alias("db_file")).union(spark.createDataFrame([("Nobody At All", "Tear", "x_book2.db")], "primary_name string, nationality string, db_file string"))
    return change.carry_forward(found, d, 10).withColumn("character_id", F.coalesce("character_id", F.lit(-1)))


MAIN = "(SELECT a.character_id FROM {appearances} a JOIN {chapters} c ON c.chapter_id = a.chapter_id JOIN {books} b ON b.book_id = c.book_id WHERE NOT is_prequel)"


@query(f"""SELECT character_id, 'physical_traits' AS field, physical_traits AS value FROM {{characters}} WHERE character_id % 4 <> 1 AND character_id % 8 <> 0 AND trim(physical_traits) <> '' AND character_id IN {MAIN}
UNION ALL SELECT character_id, 'age', age FROM {{characters}} WHERE character_id % 4 <> 1 AND character_id % 3 <> 0 AND trim(age) <> '' AND character_id IN {MAIN}""")
def snapshot_diff_revert(spark, sf_dir):
    return change.prequel_fills(directory(spark, sf_dir), _earlier(spark, sf_dir))


@query(f"""SELECT m.character_id, m.faction_id FROM {{character_factions}} m JOIN {{factions}} f ON f.faction_id = m.faction_id WHERE f.faction_type IN ('other', 'order') AND m.character_id % 4 <> 1 AND m.character_id IN {MAIN} AND (m.character_id + m.faction_id) % 2 <> 0""")
def prequel_memberships(spark, sf_dir):
    return change.prequel_memberships(directory(spark, sf_dir), _earlier(spark, sf_dir))


@query(f"""SELECT character_id, 'age' AS field, age AS before, CASE age WHEN 'young man' THEN 'young' WHEN 'Sixty-three' THEN 'about 63' END AS after FROM {{characters}} WHERE age IN ('young man', 'alive', 'Sixty-three')
UNION ALL SELECT character_id, 'nationality', nationality, {ORIGIN} FROM {{characters}} WHERE nationality IN ('unknown', 'Andoran', 'Two Rivers', 'Maule (presumably)')""")
def trait_changes(spark, sf_dir):
    return change.trait_changes(directory(spark, sf_dir))


@query(f"""WITH k AS (SELECT character_id, {_stripped('lower(primary_name)')} AS p FROM {{characters}}), g AS (SELECT a.character_id, p, {_stripped('a.alias_norm')} AS q FROM {{aliases}} a JOIN k USING (character_id) WHERE alias_type = 'given_name')
SELECT character_id, q AS chosen FROM g WHERE len(string_split(q, ' ')) > len(string_split(p, ' ')) AND len(list_filter(string_split(p, ' '), lambda x: NOT list_contains(string_split(q, ' '), x))) = 0""")
def promotions(spark, sf_dir):
    return change.promotions(directory(spark, sf_dir)).select("character_id", F.lower("chosen").alias("chosen"))


BARE = "regexp_replace({0}, '^((the|Lord|Lady) )+', '')"


@query(f"""WITH k AS (SELECT character_id, primary_name, {_stripped('lower(primary_name)')} AS p FROM {{characters}}),
up AS (SELECT DISTINCT character_id, primary_name, {BARE.format('alias_text')} AS chosen, lower({BARE.format('alias_text')}) AS cn, lower(primary_name) AS was FROM (SELECT a.character_id, primary_name, alias_text, p, {_stripped('a.alias_norm')} AS q FROM {{aliases}} a JOIN k USING (character_id) WHERE alias_type = 'given_name') g
  WHERE len(string_split(q, ' ')) > len(string_split(p, ' ')) AND len(list_filter(string_split(p, ' '), lambda x: NOT list_contains(string_split(q, ' '), x))) = 0),
b AS (SELECT up.*, (SELECT min(character_id) FROM {{characters}} o WHERE o.primary_name = up.chosen AND o.character_id <> up.character_id) AS owner FROM up),
free AS (SELECT * FROM b WHERE owner IS NULL),
a2 AS (SELECT a.character_id, alias_text, alias_norm, notes, CASE WHEN cn IS NULL THEN alias_type WHEN alias_norm = cn THEN 'primary' WHEN alias_norm = was THEN 'given_name'
    WHEN lower({BARE.format('alias_text')}) = cn AND (alias_type = 'given_name' OR is_primary) THEN 'title' ELSE alias_type END AS alias_type FROM {{aliases}} a LEFT JOIN free USING (character_id)
  UNION ALL SELECT character_id, chosen, cn, NULL, 'primary' FROM free WHERE NOT EXISTS (SELECT 1 FROM {{aliases}} a WHERE a.character_id = free.character_id AND a.alias_norm = cn)),
t AS (SELECT character_id, list_distinct(flatten(list(string_split({_stripped('alias_norm')}, ' ')))) AS tokens FROM a2 WHERE alias_type IN ('primary', 'given_name') GROUP BY character_id),
v AS (SELECT a.*, coalesce(chosen, c.primary_name) AS primary_name, CASE WHEN notes = 'wrongly named' THEN 'corrected_misnomer' WHEN {_rank_decorated('a.alias_norm', 'tokens')} THEN 'rank_decorated'
    WHEN a.alias_type IN ('title', 'epithet') AND a.alias_norm NOT LIKE 'the %' AND EXISTS (SELECT 1 FROM a2 s WHERE s.character_id = a.character_id AND s.alias_norm = 'the ' || a.alias_norm) THEN 'article_dup'
    WHEN (CASE WHEN a.alias_norm LIKE 'the %' THEN substr(a.alias_norm, 5) ELSE a.alias_norm END) IN ({_quoted(V.ROLES)}) THEN 'generic_role' WHEN {_stripped('a.alias_norm')} = '' THEN 'empty_residue' ELSE '' END AS rule
  FROM a2 a JOIN {{characters}} c ON c.character_id = a.character_id LEFT JOIN free f ON f.character_id = a.character_id LEFT JOIN t ON t.character_id = a.character_id WHERE a.alias_type IN ('title', 'epithet', 'nickname'))
SELECT character_id, CASE WHEN owner IS NULL THEN chosen ELSE primary_name END AS primary_name, chosen AS alias_text, cn AS alias_norm, 'primary' AS alias_type, CASE WHEN owner IS NULL THEN 'PROMOTE' ELSE 'PROMOTE_BLOCKED' END AS action, 'promotion' AS rule,
  CASE WHEN owner IS NULL THEN 'from ' || primary_name ELSE 'name of character ' || owner END AS note FROM b
UNION ALL SELECT character_id, primary_name, alias_text, alias_norm, alias_type, CASE rule WHEN 'corrected_misnomer' THEN 'DROP' WHEN 'rank_decorated' THEN 'DROP' WHEN 'article_dup' THEN 'COLLAPSE' WHEN '' THEN 'KEEP' ELSE 'REVIEW' END, rule, coalesce(notes, '') FROM v""")
def cleanup_trace(spark, sf_dir):
    """Every decision of the cleaning and why."""
    return traced.trace(_once(spark, sf_dir, "characters", "aliases"))


ITEMS = """(SELECT event_id, k, CASE WHEN k % 2 = 0 THEN 'Red  Widget' ELSE 'Nobody ' || (user_id % 40)::VARCHAR END AS said, CASE k % 4 WHEN 0 THEN 'merge' WHEN 3 THEN 'dismiss' ELSE 'create' END AS asked,
  CASE WHEN event_id % 3 = 0 THEN 'nobody ' || (user_id % 40)::VARCHAR END AS target, CASE WHEN event_id % 3 = 1 THEN k END AS target_cid, CASE WHEN event_id % 11 = 0 THEN 'Renamed ' || (k % 10)::VARCHAR END AS rename, event_type
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e)"""
#: What each item comes to: who is there by its name, or which item created them before.
OUTCOMES = f"""ids AS (SELECT lower(primary_name) AS key, max(character_id) AS id FROM {{characters}} GROUP BY 1),
w AS (SELECT i.*, CASE WHEN asked = 'create' THEN coalesce(rename, said) ELSE said END AS name, lower(replace(CASE WHEN asked = 'merge' THEN target WHEN asked = 'create' THEN coalesce(rename, said) ELSE said END, '  ', ' ')) AS key FROM {ITEMS} i),
x AS (SELECT w.*, id FROM w LEFT JOIN ids USING (key)),
firsts AS (SELECT key, min(event_id) AS first FROM x WHERE asked = 'create' AND id IS NULL GROUP BY key),
y AS (SELECT x.*, CASE WHEN asked = 'merge' THEN coalesce(target_cid, id) ELSE id END AS there, first FROM x LEFT JOIN firsts USING (key)),
outcome AS (SELECT event_id, name, event_type, there, first, CASE WHEN asked = 'dismiss' THEN 'dismiss' WHEN there IS NOT NULL OR first < event_id THEN 'merge' WHEN asked = 'create' AND first = event_id THEN 'create' ELSE 'unresolved' END AS action FROM y)"""


def _review(spark, sf_dir):
    """Items of the queue and decisions on them: creations of names that others create as well, and merges into names, by id or by name, before and after their creation."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    nobody = F.concat(F.lit("obody "), (F.col("user_id") % 40).cast("string"))
    name = F.when(F.col("k") % 2 == 0, "Red  Widget").otherwise(F.concat(F.lit("N"), nobody))
    person = F.struct(name.alias("name_used_in_text"), F.struct(F.col("event_type").alias("physical_traits")).alias("stable_traits"))
    queue = e.select(F.col("event_id").alias("review_id"), (F.col("event_id") % 50).alias("chapter_id"), F.lit("possible_duplicate").alias("kind"), F.to_json(F.struct(person.alias("character"))).alias("payload"), F.lit("").alias("note"), F.lit(False).alias("resolved"))
    action = F.when(F.col("k") % 4 == 0, "merge").when(F.col("k") % 4 == 3, "dismiss").otherwise("create")
    decisions = e.select(
        F.col("event_id").alias("review_id"), action.alias("action"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("n"), nobody)).alias("target"), F.when(F.col("event_id") % 3 == 1, F.col("k")).alias("target_cid"),
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("Renamed "), (F.col("k") % 10).cast("string"))).alias("rename"),
    )
    return queue, decisions


@query(f"WITH {OUTCOMES} SELECT event_id AS review_id, action, name, coalesce(CASE WHEN action = 'merge' THEN there END, -1) AS character_id, coalesce(CASE WHEN action = 'merge' AND there IS NULL THEN first END, -1) AS created_by FROM outcome")
def review_replay(spark, sf_dir):
    done = reconcile.decided(*_review(spark, sf_dir), directory(spark, sf_dir))
    return done.select("review_id", "action", "name", F.coalesce("character_id", F.lit(-1)).alias("character_id"), F.coalesce("created_by", F.lit(-1)).alias("created_by"))


@query(f"""WITH {OUTCOMES}, m AS (SELECT event_id, name, event_type, CASE WHEN action = 'create' THEN event_id ELSE first END AS maker FROM outcome WHERE action = 'create' OR action = 'merge' AND there IS NULL),
people AS (SELECT event_id AS maker, name AS primary_name FROM m WHERE maker = event_id)
SELECT primary_name, arg_min(event_type, event_id) AS physical_traits, count(DISTINCT event_id % 50) AS appearances, 1::BIGINT AS aliases FROM m JOIN people USING (maker) GROUP BY primary_name""")
def review_applied(spark, sf_dir):
    """Characters that decisions made: the first account of them, and in how many chapters their items are."""
    d = _once(spark, sf_dir, "characters", "aliases", "appearances")
    queue, decisions = _review(spark, sf_dir)
    after = replay.apply(d.having(review_queue=queue), decisions)
    new = after.characters.join(d.characters.select("character_id"), "character_id", "left_anti").select("character_id", "primary_name", "physical_traits")
    n = after.appearances.groupBy("character_id").agg(F.count(F.lit(1)).alias("appearances"))
    names_ = after.aliases.groupBy("character_id").agg(F.count(F.lit(1)).alias("aliases"))
    return new.join(n, "character_id", "left").join(names_, "character_id", "left").drop("character_id")


@query(f"WITH {OUTCOMES} SELECT action, count(*) AS items, count(DISTINCT name) AS names FROM outcome GROUP BY action")
def review_pending(spark, sf_dir):
    """How many items each outcome has; unresolved ones stay open."""
    done = reconcile.decided(*_review(spark, sf_dir), directory(spark, sf_dir))
    return done.groupBy("action").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("name").alias("names"))


# ---------------------------------------------------------------- texts


@query()
def html_text(spark, sf_dir):
    """Pages as text; a parser has no SQL, tests hold it to golden pages."""
    return table(spark, sf_dir, "pages").select("page_id", texts.html_text(F.col("html")).alias("text"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(texts.heading(F.col("html")), F.lit("")).alias("title"))


LABELS = """(SELECT conv_id, turn, CASE turn WHEN 0 THEN 'Prologue: Dark' WHEN 1 THEN 'Contents' WHEN 2 THEN concat(turn, '  The Road') WHEN 3 THEN concat('Chapter ', turn) WHEN 4 THEN 'Epilogue' WHEN 5 THEN '1st Age' ELSE concat('chapter ', turn, ': ', role) END AS label FROM conversations)"""


@query(f"""SELECT conv_id, turn, kind, number, coalesce(title, '') AS title FROM (SELECT conv_id, turn, CASE turn WHEN 0 THEN 'prologue' WHEN 4 THEN 'epilogue' ELSE 'chapter' END AS kind,
  (CASE turn WHEN 0 THEN 0 WHEN 4 THEN 1 + max(CASE WHEN turn NOT IN (1, 4, 5) THEN turn END) OVER (PARTITION BY conv_id) ELSE turn END)::INT AS number,
  CASE turn WHEN 0 THEN 'Dark' WHEN 2 THEN 'The Road' WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE role END AS title FROM conversations) x WHERE turn NOT IN (1, 5)""")
def toc_classify(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    t = F.col("turn")
    label = F.when(t == 0, "Prologue: Dark").when(t == 1, "Contents").when(t == 2, F.concat(t.cast("string"), F.lit("  The Road"))).when(t == 3, F.concat(F.lit("Chapter "), t.cast("string"))).when(t == 4, "Epilogue").when(t == 5, "1st Age").otherwise(F.concat(F.lit("chapter "), t.cast("string"), F.lit(": "), F.col("role")))
    return texts.numbered_chapters(c.withColumn("label", label), "conv_id", "turn").select("conv_id", "turn", "kind", "number", F.coalesce("title", F.lit("")).alias("title"))


@query()
def passages(spark, sf_dir):
    """Where three words stand and what is around them; positions have no SQL here, tests compare with a plain scan."""
    terms = spark.createDataFrame([(1, "idiot"), (2, "the"), (3, "trash")], "id bigint, term string")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chapter_id"), F.col("text").alias("full_text"))
    met = audits.mentions_found(docs, terms.select("term"), text=True).join(F.broadcast(terms), "term")  # three rows
    return texts.gathered(met.select("id", "chapter_id", "term", "full_text"))


@query()
def reconcile_fold(spark, sf_dir):
    """Conversations as chapters: each turn names characters, some known; the fold is no SQL, tests hold it to golden chapters."""
    d = _once(spark, sf_dir, "characters", "aliases")
    c = table(spark, sf_dir, "conversations").join(d.chapters.select("chapter_id"), F.col("chapter_id") == F.col("conv_id"), "left_semi")
    word = F.initcap(F.regexp_extract("text", r"(\p{L}+)", 1))
    person = F.struct(
        F.when(F.col("turn") % 2 == 0, word).otherwise(F.concat(word, F.lit(" Red Widget"))).alias("name_used_in_text"), F.lit(None).cast("string").alias("likely_matches_existing"), (F.col("turn") % 2 == 0).alias("is_new_character"), F.lit("high").alias("confidence"), F.lit("human").alias("character_type"),
        F.struct(F.lit("Andoran").alias("nationality"), F.lit(None).cast("string").alias("physical_traits"), F.lit("young").alias("age"), F.lit(None).cast("string").alias("filiations"), F.lit(None).cast("string").alias("personality")).alias("stable_traits"),
        F.array(F.struct(F.initcap("role").alias("name"), F.lit("society").alias("faction_type"), F.lit("member").alias("role"), F.lit(None).cast("string").alias("notes"))).alias("factions"),
        F.array().cast("array<struct<alias_text:string,alias_type:string,notes:string>>").alias("aliases_observed"), F.lit(None).cast("string").alias("notes"),
    )
    seen = F.struct(F.lit("x").alias("character"), F.lit(None).cast("string").alias("whereabouts"), F.lit(None).cast("string").alias("notable_actions"), F.array().cast("array<string>").alias("alliances_shown"), F.lit(None).cast("string").alias("demeanor"))
    rows = c.groupBy(F.col("conv_id").alias("chapter_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", person.alias("p")))), lambda s: s["p"]).alias("characters"))
    told = rows.select("chapter_id", F.lit("x").alias("title"), "characters", F.array_remove(F.array(seen), seen).alias("appearances"), F.array().cast("array<struct<character:string,context:string>>").alias("mentions"), F.array().cast("array<struct<character_a:string,character_b:string,relationship_type:string,directed:boolean,description:string>>").alias("relationships"))
    out = reconcile.reconcile(d, told, "all", auto=True)
    return out.characters.select("character_id", "primary_name", "nationality", "age").unionByName(out.review_queue.select(F.col("review_id").alias("character_id"), F.col("kind").alias("primary_name"), F.lit(None).cast("string").alias("nationality"), F.lit(None).cast("string").alias("age")))


# ---------------------------------------------------------------- further


@query("SELECT chapter_id, series_order, chapter_number, length(full_text) AS n FROM {chapters} c JOIN {books} b ON b.book_id = c.book_id WHERE chapter_number <= 4 AND trim(full_text) <> ''")
def chapters_up_to(spark, sf_dir):
    return read.chapters_between(directory(spark, sf_dir), last=4).select("chapter_id", "series_order", "chapter_number", F.length("full_text").cast("bigint").alias("n"))


@query("SELECT chapter_id, chapter_number, length(full_text) AS n FROM {chapters} c WHERE book_id = 3 AND chapter_number >= 2 AND trim(full_text) <> ''")
def chapters_from(spark, sf_dir):
    return read.chapters_between(directory(spark, sf_dir), book_id=3, first=2).select("chapter_id", "chapter_number", F.length("full_text").cast("bigint").alias("n"))


@query("SELECT chapter_id, c.title, md5(full_text) AS digest FROM {chapters} c JOIN {books} b ON b.book_id = c.book_id WHERE slot = 'book7' AND chapter_number = 1")
def chapter_by_number(spark, sf_dir):
    return read.chapter_text(directory(spark, sf_dir), "7", 1).select("chapter_id", "title", F.md5("full_text").alias("digest"))


@query("""SELECT character_id, count(*) AS n, string_agg(label, ', ' ORDER BY k) FILTER (k <= 3) || CASE WHEN count(*) > 3 THEN ', ... ' || (count(*) - 3) || ' more' ELSE '' END AS chapters FROM (
  SELECT character_id, 'Bk ' || series_order || ' Ch ' || chapter_number AS label, row_number() OVER (PARTITION BY character_id ORDER BY series_order, chapter_number) AS k
  FROM {appearances} a JOIN {chapters} c ON c.chapter_id = a.chapter_id JOIN {books} b ON b.book_id = c.book_id) x GROUP BY character_id""")
def shortened_reports(spark, sf_dir):
    a = read.appearances_of(directory(spark, sf_dir))
    label = read.chapter_label(F.col("series_order"), F.col("chapter_number"), long=True)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("series_order", "chapter_number", label.alias("l")))), lambda s: s["l"])
    return a.groupBy("character_id").agg(F.count(F.lit(1)).alias("n"), listed.alias("all")).select("character_id", "n", F.array_join(read.shortened(F.col("all"), 3), ", ").alias("chapters"))


@query("SELECT DISTINCT faction FROM (" + NODES + ") n WHERE faction IS NOT NULL ORDER BY faction LIMIT 12")
def graph_legend(spark, sf_dir):
    return read.legend(read.graph_nodes(directory(spark, sf_dir)))


@query(f"""SELECT c.character_id, (SELECT string_agg(DISTINCT coalesce(o.primary_name, '?'), ', ' ORDER BY coalesce(o.primary_name, '?')) FROM {EDGES} e LEFT JOIN {{characters}} o ON o.character_id = e.other_id WHERE e.character_id = c.character_id) AS neighbours,
  (SELECT 'b' || series_order || '_c' || chapter_number FROM {{chapters}} h JOIN {{books}} b ON b.book_id = h.book_id WHERE h.chapter_id = c.first_chapter_id) AS sources,
  (SELECT count(*) FROM {{aliases}} a JOIN {{aliases}} b ON b.character_id = a.character_id AND a.alias_norm = 'the ' || b.alias_norm WHERE a.character_id = c.character_id) > 0 AS article FROM {{characters}} c""")
def dossiers(spark, sf_dir):
    f = audits.dossier(_apart(spark, sf_dir, "characters", "aliases", "appearances", "relationships", "character_factions", "mentions"))
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, ", ")).alias(c)
    return f.select("character_id", text("neighbours"), text("sources"), F.array_contains("findings", "article duplicate").alias("article"))


@query("""WITH i AS (SELECT lower(primary_name) AS k, max(character_id) AS id FROM {characters} GROUP BY 1),
w AS (SELECT a.id AS owner_cid, b.id AS other_cid, lower(p.p_name) AS alias_norm FROM part p JOIN {characters} c ON c.character_id = p.p_partkey JOIN i a ON a.k = lower(c.primary_name) JOIN {characters} e ON e.character_id = p.p_partkey + 1 JOIN i b ON b.k = lower(e.primary_name))
SELECT owner_cid, other_cid, alias_norm FROM {acknowledged_collisions} UNION ALL SELECT DISTINCT owner_cid, other_cid, alias_norm FROM w WHERE owner_cid <> other_cid
  AND NOT EXISTS (SELECT 1 FROM {acknowledged_collisions} k WHERE k.owner_cid = w.owner_cid AND k.other_cid = w.other_cid AND k.alias_norm = w.alias_norm)""")
def seeded_collisions(spark, sf_dir):
    d = directory(spark, sf_dir)
    c = d.characters.select(F.col("character_id").alias("p_partkey"), F.col("primary_name").alias("owner"))
    e = d.characters.select((F.col("character_id") - 1).alias("p_partkey"), F.col("primary_name").alias("other"))
    wanted = table(spark, sf_dir, "part").join(c, "p_partkey").join(e, "p_partkey").select("owner", "other", F.col("p_name").alias("alias"), F.lit(None).cast("string").alias("note"))
    return change.seed_collisions(d, wanted)[0].select("owner_cid", "other_cid", "alias_norm")


@query("""WITH i AS (SELECT lower(primary_name) AS k, max(character_id) AS id FROM {characters} GROUP BY 1),
w AS (SELECT lower(s_name) AS persona_norm, i.id AS true_cid, min(s_nationkey)::INT AS reveal_book FROM supplier JOIN {characters} c ON c.character_id = s_suppkey JOIN i ON i.k = lower(c.primary_name) GROUP BY 1, 2)
SELECT persona_norm, true_cid, reveal_book FROM {disguise_map} UNION ALL SELECT persona_norm, true_cid, reveal_book FROM w WHERE NOT EXISTS (SELECT 1 FROM {disguise_map} m WHERE m.persona_norm = w.persona_norm AND m.true_cid = w.true_cid)""")
def seeded_disguises(spark, sf_dir):
    d = directory(spark, sf_dir)
    c = d.characters.select(F.col("character_id").alias("s_suppkey"), F.col("primary_name").alias("true_name"))
    wanted = table(spark, sf_dir, "supplier").join(c, "s_suppkey").select(F.col("s_name").alias("persona"), "true_name", F.col("s_nationkey").alias("reveal_book"))
    return change.seed_disguises(d, wanted)[0].select("persona_norm", "true_cid", "reveal_book")


@query()
def fuzzy_best(spark, sf_dir):
    """The most similar key of every misspelt name; no other engine here has the similarity, a test compares with the library on all pairs."""
    c = directory(spark, sf_dir)
    wrong = c.characters.select(F.concat(F.expr("substr(lower(primary_name), 1, 4)"), F.lit("x"), F.expr("substr(lower(primary_name), 5)")).alias("name"))
    return resolve.fuzzy(wrong, c.aliases)


@query("""WITH q AS (SELECT alias_norm AS k, max(character_id) AS id FROM {aliases} GROUP BY 1),
t AS (SELECT DISTINCT q.id FROM {characters} c JOIN q ON q.k = lower(primary_name) WHERE c.character_id % 4 = 1)
SELECT character_id, '2021-01-0' || (character_id % 9 + 1) AS created_at, CASE WHEN t.id IS NULL THEN '2022-02-0' || (character_id % 9 + 1) ELSE '2030-03-03' END AS updated_at FROM {characters} c LEFT JOIN t ON t.id = c.character_id""")
def reconcile_timestamps(spark, sf_dir):
    """A chapter that tells something of every fourth character, in a row each: who is told of is changed now, all others and all creations keep their times."""
    d = _once(spark, sf_dir, "characters", "aliases")
    day = lambda m: F.to_timestamp(F.concat(F.lit(m), (F.col("character_id") % 9 + 1).cast("string")))
    d = d.having(characters=d.characters.withColumn("created_at", day("2021-01-0")).withColumn("updated_at", day("2022-02-0")))
    people = d.characters.where("character_id % 4 = 1").select(
        F.col("character_id").alias("part"),
        F.struct(F.col("primary_name").alias("name_used_in_text"), F.lit(None).cast("string").alias("likely_matches_existing"), F.lit(False).alias("is_new_character"), F.lit("high").alias("confidence"), F.lit("human").alias("character_type"),
            F.struct(F.lit(None).cast("string").alias("nationality"), F.lit("tall").alias("physical_traits"), F.lit(None).cast("string").alias("age"), F.lit(None).cast("string").alias("filiations"), F.lit(None).cast("string").alias("personality")).alias("stable_traits"),
            F.array().cast("array<struct<name:string,faction_type:string,role:string,notes:string>>").alias("factions"), F.array().cast("array<struct<alias_text:string,alias_type:string,notes:string>>").alias("aliases_observed"), F.lit(None).cast("string").alias("notes")).alias("c"))
    first = d.chapters.agg(F.min("chapter_id").alias("chapter_id"))
    told = people.crossJoin(F.broadcast(first)).select("chapter_id", "part", F.lit("x").alias("title"), F.array("c").alias("characters"), F.array().cast("array<struct<character:string,whereabouts:string,notable_actions:string,alliances_shown:array<string>,demeanor:string>>").alias("appearances"),
        F.array().cast("array<struct<character:string,context:string>>").alias("mentions"), F.array().cast("array<struct<character_a:string,character_b:string,relationship_type:string,directed:boolean,description:string>>").alias("relationships"))
    out = reconcile.reconcile(d, told, "all", now=F.to_timestamp(F.lit("2030-03-03")))
    return out.characters.select("character_id", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("created_at", "updated_at")])
