"""Reconciling extracted chapters with a directory, in reading order.

What a character becomes depends on all before it, so the chapters of one directory are folded one
by one, in one task; directories are folded side by side. The task sees only what the rules need:
all rules on texts are Column expressions evaluated before, and the fold itself compares sets.
Entries of one name in a chapter are one before they come to it. Of the directory it holds who can be meant: a name is that of the last of its
owners, or of the only one, so that of a name that many have the first and the last few are held, of the others it is known only that there are
some. So the task grows with the distinct names that the chapters tell, and with the aliases near to these, not with the directory's characters.
"""

from __future__ import annotations

import difflib
import json
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.durable import written
from tesserae.functions import ages, names, origins
from tesserae.functions import values as V
from tesserae.functions.similarity import near_any
from tesserae.model import SCHEMAS, Directory
from tesserae.operators.write import insert_ignore, insert_replace

#: One chapter's extraction.
EXTRACTION = """chapter_id bigint, title string,
characters array<struct<name_used_in_text:string, likely_matches_existing:string, is_new_character:boolean, confidence:string, character_type:string,
  stable_traits:struct<nationality:string, physical_traits:string, age:string, filiations:string, personality:string>,
  factions array_of_factions, aliases_observed:array<struct<alias_text:string, alias_type:string, notes:string>>, notes:string>>,
appearances array<struct<character:string, whereabouts:string, notable_actions:string, alliances_shown:array<string>, demeanor:string>>,
mentions array<struct<character:string, context:string>>,
relationships array<struct<character_a:string, character_b:string, relationship_type:string, directed:boolean, description:string>>""".replace(
    "factions array_of_factions", "factions:array<struct<name:string, faction_type:string, role:string, notes:string>>"
)
TRAITS = ("physical_traits", "filiations", "personality")
#: Tables whose rows of the characters it holds the fold gives back, and those it only adds rows to.
RESULT = ("characters", "aliases", "character_factions")
ADDED = ("factions", "review_queue", "appearances", "mentions", "relationships")


def _names(raw: DataFrame) -> DataFrame:
    """raw with all that the fold needs to know of each distinct name, step by step, so that no step is computed twice."""
    c = F.col
    steps = raw.where("raw is not null").distinct().withColumn("text", names.strip(c("raw"))).withColumn("norm", names.norm(c("text")))
    steps = steps.withColumn("key", names.strip_titles(c("norm"))).withColumn("bare", names.words(c("key"))).withColumn("ranked", c("key") != c("norm"))
    steps = steps.withColumn("plain", F.filter(names.words(c("norm")), lambda t: ~t.isin("the", "a"))).withColumn("generic", names.is_generic(c("norm")))
    steps = steps.withColumn("placeholder", names.is_placeholder(c("norm"))).withColumn("title", names.is_title(c("norm"))).withColumn("named", names.is_named(c("text")))
    steps = steps.withColumn("species", F.array_compact(F.array(*[F.when(names.is_collective(c("norm"), F.lit(k)), k) for k in V.SPECIES]))).withColumn("cosmic", c("norm").isin(*V.COSMIC))
    steps = steps.withColumn("clean", names.adopted(c("text"))).withColumn("clean_norm", names.norm(c("clean")))
    steps = steps.withColumn("clean_key", names.strip_titles(c("clean_norm"))).withColumn("clean_tokens", F.array_distinct(F.filter(names.words(c("clean_key")), lambda t: ~t.isin("the", "a", "an"))))
    return steps.drop("clean_key")


def _told(texts: dict[str, DataFrame], named: DataFrame, slot: str) -> DataFrame:
    """What the rules say of every distinct text: rows (slot, name, at, payload) for names, origins, ages and notes. named: ``_names`` of the names."""
    raw = {k: df.where("raw is not null").distinct() for k, df in texts.items()}
    found = {
        "name": named.select("raw", F.to_json(F.struct(*[x for x in named.columns if x != "raw"])).alias("told")),
        "origin": raw["origin"].withColumn("x", origins.normalized(F.col("raw"))).select("raw", F.to_json(F.struct(F.col("x").alias("value"))).alias("told")),
        "age": raw["age"].withColumn("x", ages.normalized(F.col("raw"))).withColumn("r", ages.rank(F.col("x"))).withColumn("o", ages.rank(F.col("raw"))).select("raw", F.to_json(F.struct(F.col("x").alias("value"), F.col("r").alias("rank"), F.col("o").alias("own"))).alias("told")),
        "note": raw["note"].select("raw", F.to_json(F.struct(names.is_misnomer(F.col("raw")).alias("value"))).alias("told")),
    }
    out = None
    for kind, df in found.items():
        rows = df.select(F.lit(slot).alias("slot"), F.lit(f"told {kind}").alias("name"), F.lit(0).cast("bigint").alias("at"), F.to_json(F.struct("raw", "told")).alias("payload"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _texts(extractions: DataFrame) -> dict[str, DataFrame]:
    """Every text of the chapters that a rule is asked about."""
    x = extractions.select(F.explode("characters").alias("c"), "chapter_id")
    m = extractions.select(F.explode("mentions").alias("m"))
    lists = F.concat(
        F.array(F.col("c.name_used_in_text"), F.col("c.likely_matches_existing")),
        F.coalesce(F.transform("c.aliases_observed", lambda a: a["alias_text"]), F.array().cast("array<string>")),
        F.coalesce(F.transform("c.factions", lambda f: f["name"]), F.array().cast("array<string>")),
    )
    name = x.select(F.explode(lists).alias("raw")).union(m.select("m.character"))
    note = x.select(F.explode("c.aliases_observed").alias("a")).select(F.col("a.notes").alias("raw"))
    return {"name": name, "origin": x.select(F.col("c.stable_traits.nationality").alias("raw")), "age": x.select(F.col("c.stable_traits.age").alias("raw")), "note": note}


def _key(c: str) -> Column:
    return names.norm(names.strip(F.col(c)))


def _entries(extractions: DataFrame) -> DataFrame:
    """(chapter_id, place, c, x): entries of one name in a chapter as one, x, at the place of the first one, c.

    The first one's scalars, new only if all say so, any hint, lists joined, empty traits filled. Of a list's elements
    those of the first entry that has their name stay.
    """
    part = F.col("part").cast("bigint") if "part" in extractions.columns else F.lit(0).cast("bigint")
    e = extractions.select("chapter_id", part.alias("part"), F.posexplode("characters").alias("pos", "c")).select("chapter_id", F.struct("part", "pos").alias("place"), "c").withColumn("norm", _key("c.name_used_in_text")).where("norm <> ''")
    by = ["chapter_id", "norm"]
    given = lambda c: F.min_by(c, F.when(F.col(c) != "", F.col("place"))).alias(c.split(".")[-1])
    traits = ("nationality", "age", *TRAITS)
    one = e.groupBy(*by).agg(F.min("place").alias("place"), F.min_by("c", "place").alias("c"), F.bool_and(F.coalesce("c.is_new_character", F.lit(False))).alias("new"), given("c.likely_matches_existing"), *[given(f"c.stable_traits.{t}") for t in traits])

    def listed(field: str, name: str) -> DataFrame:
        rows = e.select(*by, "place", F.posexplode(f"c.{field}").alias("at", "x")).withColumn("own", _key(f"x.{name}"))
        each = rows.groupBy(*by, "own", "place").agg(F.collect_list(F.struct("place", "at", "x")).alias("xs"))
        first = each.groupBy(*by, "own").agg(F.min_by("xs", "place").alias("xs"))
        return first.groupBy(*by).agg(F.transform(F.array_sort(F.flatten(F.collect_list("xs"))), lambda y: y["x"]).alias(field))

    met = one.join(listed("aliases_observed", "alias_text"), by, "left").join(listed("factions", "name"), by, "left")
    x = F.struct(
        F.col("c.name_used_in_text"), "likely_matches_existing", F.col("new").alias("is_new_character"), F.col("c.confidence"), F.col("c.character_type"), F.struct(*traits).alias("stable_traits"), "factions", "aliases_observed",
    )
    return met.select("chapter_id", "place", "c", x.alias("x"))


class Told:
    """What the rules said, by text."""

    def __init__(self, rows: list[tuple[str, dict]]):
        self.by: dict[tuple[str, str], dict] = {(kind, r["raw"]): json.loads(r["told"]) for kind, r in rows}

    def name(self, raw: str | None) -> dict:
        return self.by.get(("name", raw or "")) or {"text": "", "norm": "", "key": "", "bare": [], "ranked": False, "plain": [], "generic": False, "placeholder": False, "title": False, "named": True, "species": [], "cosmic": False, "clean": "", "clean_norm": "", "clean_tokens": []}

    def of(self, kind: str, raw: str | None) -> dict:
        return self.by.get((kind, raw), {}) if raw else {}

    def entry(self, x: dict) -> dict:
        """An extracted character with what the rules say of it."""
        name, t = self.name(x.get("name_used_in_text")), x.get("stable_traits") or {}
        kind = (x.get("character_type") or "human").strip().lower()
        kind = kind if kind in V.CHARACTER_TYPES else "other"
        age = self.of("age", t.get("age"))
        rejection = "placeholder" if name["placeholder"] else "collective" if kind in name["species"] else "title" if name["title"] else None
        groups = []
        for f in x.get("factions") or []:
            g, sort = self.name(f.get("name")), (f.get("faction_type") or "other").strip().lower()
            sort = sort if sort in V.FACTION_TYPES else "other"
            exclusive = sort == "ajah" or g["norm"] == "ajah" or g["norm"].endswith(" ajah")
            groups.append({"name": g["text"], "norm": g["norm"], "type": sort, "role": (f.get("role") or "").strip().lower() or "member", "notes": f.get("notes"), "exclusive": exclusive, "covert": g["norm"] == "black ajah"})
        return {
            "name": name, "hint": self.name(x["likely_matches_existing"]) if x.get("likely_matches_existing") else None, "new": bool(x.get("is_new_character")), "confidence": x.get("confidence") or "low",
            "type": kind, "rejection": rejection, "category": "Shadow" if kind in V.SPECIES else "Time" if name["cosmic"] else None,
            "origin_said": t.get("nationality"), "origin": self.of("origin", t.get("nationality")).get("value"), "age_said": t.get("age"), "age": age.get("value"), "age_rank": age.get("rank", -1),
            "traits": {c: t.get(c) or None for c in TRAITS}, "factions": groups, "raw": json.dumps(x.get("first") or x, ensure_ascii=False),
            "aliases": [{"name": self.name(a.get("alias_text")), "type": a.get("alias_type") or "nickname", "notes": a.get("notes"), "misnomer": self.of("note", a.get("notes")).get("value", False)} for a in x.get("aliases_observed") or []],
        }


def dedupe(entries: list[dict]) -> list[dict]:
    """Entries of one name as one: the first one's scalars, new only if all say so, any hint, lists joined, empty traits filled."""
    out: dict[str, dict] = {}
    for e in entries:
        key = e["name"]["norm"]
        if not key:
            continue
        m = out.setdefault(key, e)
        if m is e:
            continue
        m["new"] = m["new"] and e["new"]
        m["hint"] = m.get("hint") or e.get("hint")
        for part, tell in (("aliases", lambda a: a["name"]["norm"]), ("factions", lambda f: f["norm"])):
            known = {tell(x) for x in m[part]}
            m[part] += [x for x in e[part] if tell(x) not in known]
        for c in TRAITS:
            m["traits"][c] = m["traits"].get(c) or e["traits"].get(c)
        for said, rest in (("origin_said", ("origin",)), ("age_said", ("age", "age_rank"))):
            if not m.get(said) and e.get(said):
                for c in (said, *rest):
                    m[c] = e.get(c)
    return list(out.values())


def _places(origin: str) -> set[str]:
    return {" ".join(p.lower().replace("’", "'").split()) for p in origin.split(",") if p.strip()}


def _similar(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


class Lettered:
    """Texts by length with how often each letter is in them, letters in 32 bins: what bounds a similarity, for all texts of a length at once."""

    def __init__(self):
        self.texts: dict[int, list[str]] = defaultdict(list)
        self.counts: dict[int, np.ndarray] = {}

    @staticmethod
    def count(text: str) -> np.ndarray:
        return np.bincount([ord(x) % 32 for x in text], minlength=32).clip(max=255).astype("uint8")  # 255 stands for all above, on both sides

    def add(self, text: str) -> None:
        n, own = len(text), self.texts[len(text)]
        if len(own) == len(held := self.counts.get(n, np.zeros((0, 32), "uint8"))):
            self.counts[n] = np.concatenate([held, np.zeros((max(16, len(held)), 32), "uint8")])
        self.counts[n][len(own)] = self.count(text)
        own.append(text)

    def near(self, text: str, least: float) -> Iterator[str]:
        """All texts whose similarity with this one may be that, and a few more."""
        n, mine = len(text), self.count(text)
        if (mine == 255).any():  # its letters aren't all counted
            yield from (x for own in self.texts.values() for x in own)
            return
        for m, own in self.texts.items():
            if 2 * min(m, n) >= least * (m + n) - 1e-9:
                common = np.minimum(self.counts[m][: len(own)], mine).sum(axis=1, dtype="int64")
                yield from (own[k] for k in np.flatnonzero(2 * common >= least * (m + n) - 1e-9))


class Fold:
    """A directory in the making: those of its characters who can be meant, and what is known of all others.

    state: rows of tables; beside them keys (alias_norm) and (key) that others have as well, (clean_norm, clean, character_id) of
    primary names that others have, and the tables' last ids.
    """

    def __init__(self, state: dict[str, list[dict]], told: Told):
        self.told_of = told
        self.more_norms = {r["n"] for r in state["more norms"]}
        self.more_keys = {r["key"] for r in state["more keys"]}
        self.taken = {(r["clean_norm"], r["clean"]): r["character_id"] for r in state["taken"]}
        last = {k: max((r[k] or 0 for r in state["last"]), default=0) for k in ("characters", "aliases", "factions", "review_queue")}
        self.people = {r["character_id"]: r for r in state["characters"]}
        for p in self.people.values():
            p |= {"name": told.name(p["primary_name"]), "origin_known": bool(told.of("origin", p.get("nationality")).get("value")), "age_rank": told.of("age", p.get("age")).get("own", -1)}
        self.aliases: dict[int, dict[str, dict]] = defaultdict(dict)
        # whose is a key; whose is it without ranks; which keys have a word, and which have it as the rarest when they came; keys by letters
        self.norms: dict[str, set[int]] = defaultdict(set)
        self.keys: dict[str, Counter] = defaultdict(Counter)
        self.words: dict[str, set[str]] = defaultdict(set)
        self.rarest: dict[str, set[str]] = defaultdict(set)
        self.lettered = Lettered()
        self.last_alias = last["aliases"]
        for r in sorted(state["aliases"], key=lambda r: r.get("alias_id") or 0):
            self.put(r["character_id"], r.get("alias_norm") or told.name(r["alias_text"])["norm"], r | {"name": told.name(r["alias_text"])})
        self.groups = {r["name_norm"]: r for r in state["factions"]}
        self.members = {(r["character_id"], r["faction_id"]): r for r in state["character_factions"]}
        self.known_groups = set(self.groups)
        self.last_group = last["factions"]
        self.queue: list[dict] = []
        self.last = last["review_queue"]
        self.newest = last["characters"]
        self.seen = {(r["character_id"], r["chapter_id"]): None for r in state["appearances"]}
        self.told: dict[tuple[int, int], dict] = {}
        self.edges: dict[tuple[int, int, str], dict] = {}
        self.main = {c for c, p in self.people.items() if p.get("in_main")}
        self.made: set[int] = set()
        self.touched: set[int] = set()  # whose traits or names were written, if only with what they had
        self.auto = False

    def put(self, c: int, n: str, alias: dict) -> None:
        if alias.get("alias_id") is None:
            self.last_alias += 1
            alias["alias_id"] = self.last_alias
        self.aliases[c][n] = alias
        self.keys[alias["name"]["key"]][c] += 1
        if n not in self.norms:
            self.lettered.add(n)
            if words := n.split():
                self.rarest[min(words, key=lambda w: len(self.words.get(w, ())))].add(n)
            for w in words:
                self.words[w].add(n)
        self.norms[n].add(c)

    def drop(self, c: int, n: str) -> None:
        key = self.aliases[c].pop(n)["name"]["key"]
        self.norms[n].discard(c)
        self.keys[key] -= Counter([c])

    # ------------------------------------------------ who it is

    def owner(self, name: dict) -> int | None:
        if exact := self.norms.get(name["norm"]):
            return max(exact)
        bare = self.keys.get(name["key"]) if name["key"] else None
        return next(iter(bare)) if bare and len(bare) == 1 and name["key"] not in self.more_keys else None

    def candidates(self, name: dict) -> tuple[dict[int, tuple[int, float]], dict[str, int]]:
        """Those with an alias whose words are all in the name, or have all of it; and such aliases that others have as well."""
        mine, out, more = set(name["norm"].split()), {}, {}
        telling = lambda words: sum(len(t) > 1 and t not in V.STOPWORDS for t in words)
        # what has all words of the name has its rarest one; what has no other words has its own rarest one in the name
        whole = min((self.words.get(w, set()) for w in mine), key=len, default=set())
        for n in whole.union(*[self.rarest.get(w, ()) for w in mine]):
            theirs = set(n.split())
            both = mine & theirs
            if (both == mine or both == theirs) and telling(both):
                for c in self.norms.get(n, ()):
                    d, s = out.get(c, (0, 0.0))
                    out[c] = max(d, telling(both)), max(s, len(both) / max(len(mine), len(theirs)))
                if n in self.more_norms:
                    more[n] = telling(both)
        return out, more

    def closest(self, name: dict) -> tuple[int | None, float]:
        """The most similar key's owner, if it is similar enough to matter; bounds by letters come first, for all keys at once."""
        best: tuple[int | None, float] = (None, 0.0)
        m = difflib.SequenceMatcher(None, "", "")
        for n in self.lettered.near(name["norm"], V.FUZZY):
            if (owners := self.norms[n]) and 2 * min(len(n), len(name["norm"])) >= V.FUZZY * (len(n) + len(name["norm"])):
                m.set_seqs(name["norm"], n)
                if m.quick_ratio() >= V.FUZZY and (r := m.ratio()) >= V.FUZZY and (r, -min(owners)) > (best[1], -(best[0] or 0)):
                    best = min(owners), r
        return best

    def likeness(self, name: dict, c: int) -> float:
        return max((_similar(name["norm"], a) for a in self.aliases.get(c, {})), default=0.0)

    def who(self, name: dict, hint: dict | None = None) -> tuple[int | None, str, dict]:
        """(id, how, among): among whom it is ambiguous: ids that are held, and aliases of others; where there are others, several are held."""
        if (c := self.owner(name)) is not None:
            return c, "exact", {}
        met, others = self.candidates(name)
        strong, weak = ({"ids": sorted(c for c, (d, _) in met.items() if (d > 1) == more), "norms": sorted(n for n, d in others.items() if (d > 1) == more)} for more in (True, False))
        if len(strong["ids"]) == 1:
            return strong["ids"][0], "token_subset", {}
        if strong["ids"]:
            return None, "ambiguous", strong
        if hint and (c := self.owner(hint)) is not None and (c in met or self.likeness(name, c) >= V.POINTER):
            return c, "llm_pointer", {}
        return (None, "ambiguous", weak) if len(weak["ids"]) > 1 else (None, "none", {})

    # ------------------------------------------------ what is written

    def park(self, chapter: dict, kind: str, e: dict, note: str, among: dict | None = None) -> None:
        """Into the queue, with all that a later decision needs."""
        n = e["name"]["norm"]
        same = lambda x: " ".join((x or "").lower().replace("’", "'").split()) == n
        payload = {
            "character": json.loads(e["raw"]),
            "appearance": next((a for a in chapter["appearances"] if same(a.get("character"))), None),
            "relationships": [r for r in chapter["relationships"] if same(r.get("character_a")) or same(r.get("character_b"))],
        }
        self.queued(chapter["chapter_id"], kind, payload, note, among)

    def queued(self, chapter_id: int | None, kind: str, payload: dict, note: str, among: dict | None = None) -> None:
        """among: the note ends with these ids and those of all others who have the aliases."""
        self.last += 1
        self.queue.append({"review_id": self.last, "chapter_id": chapter_id, "kind": kind, "payload": json.dumps(payload, ensure_ascii=False), "note": note, "resolved": False, "among": among})

    def tokens(self, c: int) -> set[str]:
        return {w for a in self.aliases[c].values() if a["alias_type"] in ("primary", "given_name") for w in a["name"]["bare"]}

    def add_alias(self, c: int, name: dict, kind: str, notes: str | None = None, misnomer: bool = False, primary: bool = False) -> None:
        own, n = self.aliases[c], name["norm"]
        if not n or (name["generic"] and not primary):
            return
        if kind not in V.PROTECTED:
            mine = self.tokens(c)
            adjective = [t for t in name["plain"] if t in V.ADJECTIVES]
            described = adjective and any(t in mine for t in name["plain"]) and all(t in mine or t in V.ADJECTIVES for t in name["plain"])
            if misnomer or (name["ranked"] and name["bare"] and set(name["bare"]) <= mine) or described:
                return
            if kind in ("title", "epithet"):  # of "the X" and "X" the first stays
                if f"the {n}" in own:
                    return
                bare = own.get(n.removeprefix("the "))
                if n.startswith("the ") and bare and bare["alias_type"] in ("title", "epithet"):
                    self.drop(c, n.removeprefix("the "))
        if n not in own:
            self.put(c, n, {"character_id": c, "alias_text": name["text"], "alias_norm": n, "alias_type": kind, "notes": notes, "is_primary": primary, "name": name})

    def promote(self, c: int) -> None:
        """The primary name becomes the one fullest form that has all its words."""
        own, person = self.aliases[c], self.people[c]
        now = person["name"]
        forms = {}
        for a in own.values():
            if a["alias_type"] == "given_name":
                x = a["name"]
                if x["clean_norm"] and x["clean_norm"] != now["clean_norm"] and set(now["clean_tokens"]) < set(x["clean_tokens"]):
                    forms.setdefault(x["clean_norm"], x)
        top = max((len(x["clean_tokens"]) for x in forms.values()), default=0)
        best = [x for x in forms.values() if len(x["clean_tokens"]) == top]
        if len(best) != 1 or best[0]["clean_norm"] == now["norm"]:
            return
        x = best[0]
        other = min([o for o in self.norms.get(x["clean_norm"], ()) if o != c and self.people[o]["primary_name"] == x["clean"]] + [o for o in (self.taken.get((x["clean_norm"], x["clean"])),) if o is not None], default=None)
        if other is not None:
            self.queued(None, "promotion_blocked_duplicate", {"character_id": c, "from": person["primary_name"], "to": x["clean"], "conflicts_with": other}, f"{other} has the name {x['clean']}")
            return
        for n, a in own.items():
            if a["name"]["clean_norm"] == x["clean_norm"] and n != x["clean_norm"] and (a["alias_type"] == "given_name" or a["is_primary"]):
                a |= {"alias_type": "title", "is_primary": False}
        if now["norm"] in own:
            own[now["norm"]] |= {"alias_type": "given_name", "is_primary": False}
        whole = x if x["norm"] == x["clean_norm"] else x | {"text": x["clean"], "norm": x["clean_norm"], "key": " ".join(x["bare"]), "ranked": False, "plain": x["clean_norm"].split()}
        if x["clean_norm"] not in own:
            self.put(c, x["clean_norm"], {"character_id": c, "alias_text": x["clean"], "alias_norm": x["clean_norm"], "notes": None, "name": whole})
        own[x["clean_norm"]] |= {"alias_type": "primary", "is_primary": True}
        person |= {"primary_name": x["clean"], "name": whole}
        self.touched.add(c)

    def create(self, e: dict) -> int:
        self.newest = c = self.newest + 1
        traits = {t: e["traits"].get(t) for t in TRAITS}
        self.people[c] = {"character_id": c, "primary_name": e["name"]["text"], "character_type": e["type"], "nationality": e.get("origin") or e.get("category"), "age": e.get("age"), "age_rank": e["age_rank"], "name": e["name"], "first_chapter_id": None, **traits}
        self.made.add(c)
        self.touched.add(c)
        self.add_alias(c, e["name"], "primary", primary=True)
        for a in e["aliases"]:
            self.add_alias(c, a["name"], a["type"], a.get("notes"), a["misnomer"])
        self.promote(c)
        return c

    def guarded(self, c: int, chapter: dict) -> bool:
        """A prequel tells nothing that passes of a character of the main series."""
        return bool(chapter["is_prequel"]) and c not in self.made and c in self.main

    def enrich(self, c: int, e: dict, chapter: dict) -> None:
        p, guard = self.people[c], self.guarded(c, chapter)
        if e.get("origin"):
            said, now = e["origin"], p["nationality"] if p.get("origin_known", True) else None
            if now is None:
                p |= {"nationality": said, "origin_known": True}
                self.touched.add(c)
            elif not _places(now) & _places(said):
                self.park(chapter, "origin_conflict", e, f"have {now}, chapter suggests {said}; kept")
            elif len(_places(said)) > len(_places(now)):
                p["nationality"] = said
                self.touched.add(c)
        if e.get("age") and not guard:
            rank, now = e["age_rank"], p.get("age_rank")
            now = -1 if now is None or p.get("age") is None else now
            number = e["age"].startswith("about ") and not str(p.get("age")).startswith("about ")
            if rank > now or (rank == now and number):
                p |= {"age": e["age"], "age_rank": rank}
                self.touched.add(c)
        for t in TRAITS:
            if e["traits"].get(t) and not (guard and t in V.GUARDED_TRAITS):
                p[t] = e["traits"][t] if p.get(t) is None else p[t]
                self.touched.add(c)
        for a in e["aliases"]:
            self.add_alias(c, a["name"], a["type"], a.get("notes"), a["misnomer"])
        x, now = e["name"], p["name"]
        mine, theirs = x["bare"], now["bare"]
        if x["norm"] != now["norm"] and x["named"] and not x["placeholder"] and theirs and 1 < len(mine) <= 4 and set(mine) > set(theirs):
            self.add_alias(c, x, "given_name", "fuller form used in chapter text")
        self.promote(c)

    def join(self, c: int, e: dict, chapter: dict) -> None:
        """Memberships: of exclusive groups the first that is held stays, covert ones come on top."""
        guard = self.guarded(c, chapter)
        for f in e["factions"]:
            if not f["norm"] or (guard and f["type"] in V.GUARDED_FACTIONS):
                continue
            if f["exclusive"] and not f["covert"]:
                held = {g["name_norm"] for (m, i), _ in self.members.items() if m == c for g in self.groups.values() if g["faction_id"] == i and g["faction_type"] == "ajah"}
                if held - {f["norm"], "black ajah"}:
                    continue
            if f["norm"] not in self.groups:
                self.last_group += 1
                self.groups[f["norm"]] = {"faction_id": self.last_group, "name": f["name"], "name_norm": f["norm"], "faction_type": f["type"]}
            g = self.groups[f["norm"]]
            m = self.members.setdefault((c, g["faction_id"]), {"character_id": c, "faction_id": g["faction_id"], "role": f["role"], "first_chapter_id": chapter["chapter_id"], "notes": f.get("notes")})
            if f["role"] == "leader":
                m["role"] = "leader"

    # ------------------------------------------------ a chapter

    def settle(self, e: dict, chapter: dict) -> int | None:
        name, hint = e["name"], e.get("hint")
        c, method, met = self.who(name, hint)
        if method == "ambiguous" and not e["new"]:
            self.park(chapter, "ambiguous_character", e, f"{name['text']} shares words with ", met)
        elif c is None and hint and not e["new"] and self.owner(hint) is not None:
            self.park(chapter, "suspicious_llm_match", e, f"{name['text']} is not similar to {hint['text']}")
        elif method == "exact" and e["new"] and not hint and " " not in name["norm"] and name["norm"] != self.people[c]["name"]["norm"]:
            self.park(chapter, "namesake_alias", e, f"{name['text']} is an alias of {c}, but said to be new")
        elif c is not None:
            self.enrich(c, e, chapter)
            return c
        elif not e["new"]:
            self.park(chapter, "ambiguous_character", e, f"{name['text']} is unresolved")
        elif e.get("rejection"):
            self.park(chapter, f"rejected_{e['rejection']}", e, f"{name['text']} is no individual's name")
        else:
            near, likeness = self.closest(name)
            if near is None or likeness < V.FUZZY:
                return self.create(e)
            sure = self.auto and e["confidence"] == "high"
            made = self.create(e) if sure else None
            self.park(chapter, "possible_duplicate", e, f"{name['text']} is similar to {near}")
            return made
        return None

    def chapter(self, chapter: dict) -> None:
        at, found = chapter["chapter_id"], {}
        self.made = set()  # those whom this very chapter introduces
        for e in dedupe([self.told_of.entry(x) for x in chapter["characters"]]):
            if (c := self.settle(e, chapter)) is not None:
                found[e["name"]["text"]] = c
                self.join(c, e, chapter)
        strip = lambda x: (x or "").strip()
        for a in chapter["appearances"]:
            if (c := found.get(strip(a.get("character")))) is not None:
                self.seen[c, at] = {"character_id": c, "chapter_id": at, "name_used": a["character"], "whereabouts": a.get("whereabouts"), "notable_actions": a.get("notable_actions"), "alliances_shown": ", ".join(a.get("alliances_shown") or []) or None, "demeanor": a.get("demeanor")}
                if not chapter["is_prequel"]:
                    self.main.add(c)
                if self.people[c].get("first_chapter_id") is None:
                    self.people[c]["first_chapter_id"] = at
        for r in chapter["relationships"]:
            a, b = found.get(strip(r.get("character_a"))), found.get(strip(r.get("character_b")))
            if a is not None and b is not None and a != b:
                ends = (a, b) if r.get("directed") else tuple(sorted((a, b)))
                kind = r.get("relationship_type") or "other"
                self.edges.setdefault((*ends, kind), {"character_a": ends[0], "character_b": ends[1], "relationship_type": kind, "directed": bool(r.get("directed")), "description": r.get("description"), "first_chapter_id": at})
        for m in chapter["mentions"]:
            name = self.told_of.name(m.get("character"))
            if not name["norm"]:
                continue
            c = found.get(name["text"])
            c = self.who(name)[0] if c is None else c
            if c is not None and (c, at) not in self.seen:
                self.told.setdefault((c, at), {"character_id": c, "chapter_id": at, "name_used": name["text"], "context": m.get("context")})

    def tables(self) -> dict[str, list[dict]]:
        own = [a for c in sorted(self.aliases) for a in self.aliases[c].values()]
        for c, p in self.people.items():
            p["touched"] = c in self.touched
        return {
            "characters": list(self.people.values()), "aliases": own, "factions": [g for n, g in self.groups.items() if n not in self.known_groups], "character_factions": list(self.members.values()), "review_queue": self.queue,
            "appearances": [r for r in self.seen.values() if r], "mentions": list(self.told.values()), "relationships": list(self.edges.values()),
        }


class Met:
    """Who of a directory can be meant by the names told, ``people``, and what is to be known of all others.

    named: (character_id, n, key) of all aliases, written once; near: keys n that a name told can meet: the same, those with all its
    words or all of whose words it has, and ones similar to a new name. Of the owners of each, and of those of a name without ranks, the first and the last ``many`` are held: a
    name that more have stays ambiguous whatever the chapters take away.
    """

    def __init__(self, d: Directory, said: DataFrame, entries: DataFrame, many: int):
        c = F.col
        forms = written(d.aliases.select("alias_text", "alias_norm").distinct().withColumn("n", F.when(c("alias_norm") != "", c("alias_norm")).otherwise(_key("alias_text"))).withColumn("key", names.strip_titles(_key("alias_text"))))
        alike = d.aliases.select("character_id", "alias_text", "alias_norm").join(forms, (d.aliases["alias_text"].eqNullSafe(forms["alias_text"])) & (d.aliases["alias_norm"].eqNullSafe(forms["alias_norm"])))
        self.named = written(alike.select("character_id", "n", "key").distinct())
        told, there = said.select("norm").where("norm <> ''").distinct(), forms.select("n").distinct()
        tasks = int(d.spark.conf.get("spark.sql.shuffle.partitions"))
        mine = told.withColumn("t", names.tokens(c("norm"))).withColumn("w", F.explode(names.distinctive(c("t"))))
        theirs = there.repartition(tasks).withColumn("u", names.tokens(c("n"))).withColumn("w", F.explode(names.distinctive(c("u"))))
        words = theirs.join(mine, (theirs["w"] == mine["w"]) & (names.subset(c("t"), c("u")) | names.subset(c("u"), c("t"))), "left_semi").select("n")
        similar = near_any(entries.where("x.is_new_character").select(_key("x.name_used_in_text").alias("n")).distinct(), there.repartition(tasks), V.FUZZY)
        self.near = written(there.join(told, c("n") == c("norm"), "left_semi").union(words).union(similar).distinct())
        keys = said.select("key").where("key <> ''").distinct()
        owned, keyed = self.named.select("n", "character_id").distinct().join(self.near, "n", "left_semi"), self.named.select("key", "character_id").distinct().join(keys, "key", "left_semi")
        at = lambda df, by, order: df.withColumn("k", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(c("k") <= many).select("character_id")
        ends = [at(owned, "n", c("character_id")), at(owned, "n", c("character_id").desc()), at(keyed, "key", c("character_id"))]
        self.people = written(ends[0].union(ends[1]).union(ends[2]).distinct())
        self.others = self.named.join(self.people, "character_id", "left_anti")
        self.more_norms, self.more_keys = owned.join(self.people, "character_id", "left_anti").select("n").distinct(), keyed.join(self.people, "character_id", "left_anti").select("key").distinct()

    def of(self, df: DataFrame) -> DataFrame:
        return df.join(self.people, "character_id", "left_semi")

    def taken(self, d: Directory, clean: DataFrame) -> DataFrame:
        """(clean_norm, clean, character_id): the first of the others who has a name as primary one."""
        met = self.others.select("character_id", F.col("n").alias("clean_norm")).distinct().join(clean.select("clean_norm", "clean").distinct(), "clean_norm")
        own = d.characters.select("character_id", F.col("primary_name").alias("clean"))
        return met.join(own, ["character_id", "clean"]).groupBy("clean_norm", "clean").agg(F.min("character_id").alias("character_id"))

    def notes(self, queue: DataFrame) -> DataFrame:
        """Notes that end with ids, written out: those that the fold named and those of others, by the aliases it named."""
        among = F.col("among.norms")
        lists = queue.select(among.alias("norms")).where(F.size("norms") > 0).distinct()
        found = lists.select("norms", F.explode("norms").alias("n")).join(self.others.select("n", "character_id"), "n").groupBy("norms").agg(F.collect_set("character_id").alias("others"))
        met = queue.withColumn("norms", among).join(found, "norms", "left")
        ids = F.array_sort(F.array_union("among.ids", F.coalesce("others", F.array().cast("array<bigint>"))))
        return met.withColumn("note", F.when(F.col("among").isNull(), F.col("note")).otherwise(F.concat("note", F.lit("["), F.array_join(ids.cast("array<string>"), ", "), F.lit("]")))).drop("among", "norms", "others")


def _state(d: Directory, met: Met, slot: str, extractions: DataFrame, said: DataFrame, own: DataFrame) -> DataFrame:
    """(slot, name, at, payload): what the fold holds of the directory: those who can be meant, who of them is in the chapters told, and what it is to know of others."""
    from tesserae.plans.change import main_series

    main = main_series(d.having(appearances=met.of(d.appearances))).withColumn("in_main", F.lit(True))
    members = met.of(d.character_factions)
    groups = d.factions.join(said.select(F.col("norm").alias("name_norm")).distinct(), "name_norm", "left_semi").select(d.factions.columns)
    held = d.factions.join(members.select("faction_id").distinct(), "faction_id", "left_semi").select(d.factions.columns)
    last = [getattr(d, t).agg(F.max(k).alias("last")).select(F.lit(t).alias("t"), "last") for t, k in (("characters", "character_id"), ("factions", "faction_id"), ("review_queue", "review_id"))]
    last.append((d.aliases.agg(F.max("alias_id").alias("last")) if "alias_id" in d.aliases.columns else d.aliases.limit(0).select(F.lit(0).alias("last"))).select(F.lit("aliases").alias("t"), "last"))
    each = last[0]
    for x in last[1:]:
        each = each.union(x)
    told = {
        "characters": met.of(d.characters.drop("created_at", "updated_at")).join(main, "character_id", "left"),
        "aliases": met.of(d.aliases),
        "factions": groups.union(held).distinct().drop("created_at"),
        "character_factions": members,
        "appearances": met.of(d.appearances.select("character_id", "chapter_id")).join(extractions.select("chapter_id").distinct(), "chapter_id", "left_semi").select("character_id", "chapter_id"),
        "more norms": met.more_norms,
        "more keys": met.more_keys,
        "taken": met.taken(d, said.select("clean_norm", "clean").union(own.select("clean_norm", "clean"))),
        "last": each.groupBy().pivot("t", ["characters", "aliases", "factions", "review_queue"]).agg(F.max("last")),
    }
    out = None
    for t, df in told.items():
        rows = df.select(F.lit(slot).alias("slot"), F.lit(t).alias("name"), F.lit(0).cast("bigint").alias("at"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _kept(df: DataFrame, t: str) -> DataFrame:
    """A table's rows with all its columns."""
    fields = [f.split() for f in SCHEMAS[t].split(",")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in fields])


def _dated(d: Directory, t: str, rows: DataFrame, now: Column) -> DataFrame:
    """rows with the times of creation and change: those of the directory, or now for new rows; now is also the change of rows that were touched."""
    old, key = getattr(d, t), {"characters": "character_id", "factions": "faction_id", "review_queue": "review_id"}[t]
    made, changed = (f"old_{c}" for c in ("created_at", "updated_at"))
    at = lambda c: F.col(c).cast("timestamp") if c in old.columns else F.lit(None).cast("timestamp")
    times = old.select(key, at("created_at").alias(made), at("updated_at").alias(changed), F.lit(True).alias("known"))
    met = rows.drop("created_at", "updated_at").join(times, key, "left")
    out = met.withColumn("created_at", F.when(F.col("known"), F.col(made)).otherwise(now))
    if t == "characters":
        out = out.withColumn("updated_at", F.when(F.col("touched"), now).otherwise(F.col(changed)))
    return out.select(*[f.strip().split()[0] for f in SCHEMAS[t].split(",")])


def reconcile(d: Directory, extractions: DataFrame, slot: str = "", auto: bool = False, now: Column | None = None) -> Directory:
    """The next version of the directory, with all chapters of the extractions told in reading order.

    extractions: rows of EXTRACTION. Chapters that the directory lacks are refused by leaving them
    out; missing lists are empty. A chapter of very many characters may be given in several rows, which a further column ``part``
    orders: they are told as one. auto: new characters whose confidence is high are made though a
    similar name exists, and queued all the same. now: the time that new and changed rows bear, that
    of the run by default. The fold's answer is written to the shared folder once. Aliases that are there keep their alias_id.
    """
    from tesserae.session import ship

    ship(d.spark)
    order = d.chapters.select("chapter_id", "book_id", "chapter_number").join(d.books.select("book_id", "series_order", F.coalesce("is_prequel", F.lit(False)).alias("is_prequel")), "book_id")
    listed = lambda c: F.coalesce(c, F.array()).alias(c)
    lists = ("appearances", "mentions", "relationships")
    part = (F.col("part").cast("bigint") if "part" in extractions.columns else F.lit(0).cast("bigint")).alias("part")
    order = order.join(extractions.select("chapter_id").distinct(), "chapter_id", "left_semi")
    places = order.select((F.col("series_order") * 1_000_000 + F.col("chapter_number")).cast("bigint").alias("at"), "chapter_id", "is_prequel")
    filled = extractions.where(" or ".join(f"size({c}) > 0" for c in lists)).select("chapter_id", part, *[listed(c) for c in lists])
    entries = written(_entries(extractions))
    told = {"chapter": places, "entry": entries.join(places.select("chapter_id", "at"), "chapter_id"), "lists": filled.join(places.select("chapter_id", "at"), "chapter_id")}
    texts = _texts(extractions)
    said = written(_names(texts["name"]))
    dropping = extractions.select(F.explode("characters").alias("c")).select(F.explode("c.aliases_observed").alias("a")).where(F.col("a.alias_type").isin("title", "epithet") & F.startswith(_key("a.alias_text"), F.lit("the "))).count()
    met = Met(d, said, entries, 2 + dropping)
    people, aliases = met.of(d.characters), met.of(d.aliases)
    own = _names(people.select(F.col("primary_name").alias("raw")).union(aliases.select("alias_text")).distinct().join(said.select("raw"), "raw", "left_anti"))
    own = written(own)
    texts |= {"origin": texts["origin"].union(people.select("nationality")), "age": texts["age"].union(people.select("age"))}
    rows = _state(d, met, slot, extractions, said, own)
    for t, df in told.items():
        rows = rows.unionByName(df.select(F.lit(slot).alias("slot"), F.lit(t).alias("name"), "at", F.to_json(F.struct(*[c for c in df.columns if c != "at"]), {"ignoreNullFields": "false"}).alias("payload")))
    tables = ("characters", "aliases", "factions", "character_factions", "appearances", "more norms", "more keys", "taken", "last")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        state: dict[str, list[dict]] = {t: [] for t in tables}
        said: list[tuple[str, dict]] = []
        chapters: dict[int, dict] = {}
        entries, parts = [], []
        for t, at, x in zip(rows["name"], rows["at"], rows["payload"], strict=True):
            r = json.loads(x)
            if t.startswith("told "):
                said.append((t[5:], r))
            elif t == "chapter":
                chapters[r["chapter_id"]] = r | {"at": at, "characters": []} | {c: [] for c in lists}
            elif t in ("entry", "lists"):
                (entries if t == "entry" else parts).append(r)
            else:
                state[t].append(r)
        for r in sorted(entries, key=lambda r: (r["place"]["part"], r["place"]["pos"])):
            chapters[r["chapter_id"]]["characters"].append(r["x"] | {"first": r["c"]})
        for r in sorted(parts, key=lambda r: r["part"]):
            for c in lists:
                chapters[r["chapter_id"]][c] += r[c]
        fold = Fold(state, Told(said))
        fold.auto = auto
        for x in sorted(chapters.values(), key=lambda x: x["at"]):
            fold.chapter(x)
        out = [(t, json.dumps(r, ensure_ascii=False)) for t, rs in fold.tables().items() for r in rs]
        return pd.DataFrame({"slot": slot, "name": [t for t, _ in out], "payload": [x for _, x in out]}, dtype="object")

    folded = rows.unionByName(_told(texts, said.unionByName(own), slot)).groupBy("slot").applyInPandas(run, "slot string, name string, payload string")
    folded = written(folded)
    more = {"characters": ", touched boolean", "review_queue": ", among struct<ids:array<bigint>,norms:array<string>>"}
    made = {t: folded.where(F.col("name") == t).select(F.from_json("payload", SCHEMAS[t] + more.get(t, "")).alias("x")).select("x.*") for t in (*RESULT, *ADDED)}
    now = F.current_timestamp() if now is None else now
    made["review_queue"] = met.notes(made["review_queue"])
    new = {t: _kept(getattr(d, t).join(met.people, "character_id", "left_anti"), t).unionByName(_dated(d, t, made[t], now) if t == "characters" else made[t]) for t in RESULT}
    for t in ("factions", "review_queue"):
        new[t] = _kept(getattr(d, t), t).unionByName(_dated(d, t, made[t], now))
    one = lambda t: made[t].select(*[c for c in made[t].columns if c in getattr(d, t).columns])
    new["appearances"] = insert_replace(d.appearances, one("appearances"), ["character_id", "chapter_id"], [F.col("name_used")])
    for t, keys in (("mentions", ["character_id", "chapter_id"]), ("relationships", ["character_a", "character_b", "relationship_type"])):
        new[t] = insert_ignore(getattr(d, t), one(t), keys, [F.col(keys[0])])
    done = extractions.select("chapter_id").distinct().withColumn("__done", F.lit(True))
    marked = d.chapters.join(done, "chapter_id", "left").withColumn("extracted", F.coalesce("__done", "extracted")).select(d.chapters.columns)
    return d.having(**new, chapters=marked)


def decided(queue: DataFrame, decisions: DataFrame, d: Directory) -> DataFrame:
    """(review_id, kind, action, character_id, created_by, name): ``replay.outcomes`` of the decisions."""
    from tesserae.plans.replay import outcomes

    return outcomes(queue, decisions, d.characters).select("review_id", "kind", "action", "character_id", "created_by", "name")


def backfill(d: Directory, extractions: DataFrame) -> Directory:
    """Appearances of saved extractions that resolve with confidence and are not there yet; nobody is made, and the roster doesn't change meanwhile, so all names are resolved at once."""
    from tesserae.operators.resolve import confident, resolve

    said = extractions.select("chapter_id", F.explode("appearances").alias("a"), "characters")
    hint = F.filter("characters", lambda c: names.norm(c["name_used_in_text"]) == names.norm(F.col("a.character")))
    rows = said.select("chapter_id", "a", names.strip(F.col("a.character")).alias("name"), F.get(hint, 0)["likely_matches_existing"].alias("pointer"))
    met = confident(resolve(rows, d.aliases)).withColumn("character_id", F.col("cid"))
    new = met.join(d.appearances.select("character_id", "chapter_id"), ["character_id", "chapter_id"], "left_anti").join(d.chapters.select("chapter_id"), "chapter_id", "left_semi").dropDuplicates(["character_id", "chapter_id"])
    cols = new.select("character_id", "chapter_id", F.col("a.character").alias("name_used"), F.col("a.whereabouts").alias("whereabouts"), F.col("a.notable_actions").alias("notable_actions"), F.array_join("a.alliances_shown", ", ").alias("alliances_shown"), F.col("a.demeanor").alias("demeanor"))
    stale = d.mentions.join(cols.select("character_id", "chapter_id"), ["character_id", "chapter_id"], "left_anti").select(d.mentions.columns)
    return d.having(appearances=d.appearances.unionByName(cols.select(*[c for c in cols.columns if c in d.appearances.columns]), allowMissingColumns=True), mentions=stale)


def roster_text(d: Directory) -> DataFrame:
    """(character_id, line): the roster as an extractor reads it."""
    own = d.aliases.where("not is_primary").groupBy("character_id").agg(F.array_join(F.array_sort(F.collect_set("alias_text")), ", ").alias("aliases"))
    held = d.character_factions.join(d.factions.select("faction_id", "name"), "faction_id").groupBy("character_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("factions"))
    c = d.characters.join(own, "character_id", "left").join(held, "character_id", "left")
    line = F.format_string("%s [%s; %s; factions: %s; aliases: %s]", "primary_name", F.coalesce("character_type", F.lit("human")), F.coalesce("nationality", F.lit("unknown")), F.coalesce("factions", F.lit("none")), F.coalesce("aliases", F.lit("none")))
    return c.select("character_id", line.alias("line"))


def chapters_in_order(extractions: Iterator[str]) -> list[str]:
    """Extraction files b<order>_c<chapter>.json by their numbers, others left out."""
    import re

    found = [(int(m[1]), int(m[2]), x) for x in extractions if (m := re.search(r"(?:^|/)b(\d+)_c(\d+)\.json$", x))]
    return [x for *_, x in sorted(found)]
