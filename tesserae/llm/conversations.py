"""Conversation structure: faults of turns, and the cheapest edits that give a legal order of roles.

Legal are the role initials ``(s?(ua)+)?``. A forward Viterbi search reads a conversation's rows in
order and keeps, for each of four states (nothing yet, after system, after user, after assistant),
the least (cost, audit string); each row's layer is closed with at most two insertions. Equal
costs mean that no audit is a prefix of another, so the least string so far stays the least.
What all survivors agree on is final: it is handed on and forgotten, so that a task holds the part
of a conversation on which they differ, and not the conversation. (In the worst case, rows that fit no
order better than another, they differ throughout.)
"""

from __future__ import annotations

import hashlib
import os.path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import WORD, arrow_map, durable

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = (1 << 60, "")
#: Rows after which survivors are compared.
SETTLE = 256

Survivor = tuple[int, str]


def closed(layer: list[Survivor]) -> list[Survivor]:
    """The layer with insertions: any state to user, user to assistant; a third insertion would lead back."""
    nothing, system, user, assistant = layer
    user = min(user, *((c + INSERT, a + "I") for c, a in (nothing, system, assistant)))
    return [nothing, system, user, min(assistant, (user[0] + INSERT, user[1] + "I"))]


def advance(layer: list[Survivor], initial: str, must_go: bool, cut: bool) -> list[Survivor]:
    """The layer after one more row."""
    found = [(c + DELETE, a + "D") for c, a in layer]
    if not must_go:
        nothing, system, user, assistant = layer

        def taken(state: Survivor, fits: bool) -> Survivor:
            return state[0] + CUT * cut + (KEEP if fits else REROLE), state[1] + ("K" if fits else "R")

        if initial == "s":
            found[SYSTEM] = min(found[SYSTEM], taken(nothing, True))
        found[USER] = min(found[USER], *(taken(x, initial == "u") for x in (nothing, system, assistant)))
        found[ASSISTANT] = min(found[ASSISTANT], taken(user, initial == "a"))
    return closed(found)


def hopeful(layer: list[Survivor]) -> list[Survivor]:
    """The layer without survivors that can't win any more: after an assistant everything can follow that follows a system, and what follows nothing but for one row's deletion."""
    nothing, system, user, assistant = layer
    return [nothing if nothing[0] <= assistant[0] + DELETE else _NEVER, system if system[0] <= assistant[0] else _NEVER, user, assistant]


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.layer = closed([(0, ""), _NEVER, _NEVER, _NEVER])
        self.pending: list[tuple] = []  # (role, digest) of rows whose edit isn't final
        self.audit: list[str] = []
        self.edits: list[tuple] = []  # (place, edit, role, own, digest), handed on by ``taken``
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.place = 0
        self.first_turn = self.last_turn = self.initial = None
        self.state = NONE

    def add(self, turn: int | None, role: str, digest: str, blank: bool, again: bool, cut: bool) -> None:
        initial = role[:1]
        if self.rows and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.rows, self.initial = self.rows + 1, initial
        self.blank += blank
        self.duplicate += again and not blank
        cut = cut and not blank and not again
        self.truncated += cut
        self.layer = advance(self.layer, initial, blank or again, cut)
        self.pending.append((role, digest))
        if not self.rows % SETTLE:
            self.layer = hopeful(self.layer)
            agreed = os.path.commonprefix([a for c, a in self.layer if c < _NEVER[0]])
            self._final(agreed)
            self.layer = [(c, a[len(agreed) :]) for c, a in self.layer]

    def _final(self, letters: str) -> None:
        self.audit.append(letters)
        at = 0
        for e in letters:
            own = digest = None
            if e != "I":
                own, digest = self.pending[at]
                at += 1
            if e == "D":
                continue
            if e == "K" and own[:1] == "s":
                self.state, role = SYSTEM, own
            else:
                self.state = ASSISTANT if self.state == USER else USER
                role = own if e == "K" else "assistant" if self.state == ASSISTANT else "user"
            self.edits.append((self.place, e, role, own, digest))
            self.place += 1
        del self.pending[:at]

    def taken(self) -> list[tuple]:
        found, self.edits = self.edits, []
        return found

    def finish(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit)."""
        cost, letters = min(self.layer[NONE], self.layer[ASSISTANT])
        self._final(letters)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN = ["conv_id", "place", "edit", "role", "own", "digest", *_COUNTS, "audit"]
_PLAN_TYPES = "conv_id bigint, place bigint, edit string, role string, own string, digest string, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string"
_ARROW = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in _PLAN_TYPES.split(", "))])
#: Edit rows that a task holds before it hands them on.
_HELD = 4096


def _rows(rows: DataFrame) -> DataFrame:
    """The four columns, nulls of role and text as one space."""
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(rows: DataFrame, parts: int = 20) -> DataFrame:
    """conversations with planted faults, by crc32(conv_id:turn) mod parts: 0 dropped, 1 emptied, 2 without its end marks, 3 twice, 4 as user.

    Nulls are one space, in the hashed text as well. Columns: conv_id, turn, role, text.
    """
    d = _rows(rows)

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % parts
    d = d.withColumn("fault", fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def diagnosed(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, blank, cut, again): n equal rows each; again: role and text occur at an earlier turn.

    Texts are replaced by their MD5 before anything is shuffled; equal rows are one with their number,
    so that no group of copies meets in one task.
    """
    blank = ~F.col("text").rlike(WORD)
    slim = _rows(rows).select("conv_id", "turn", "role", F.md5("text").alias("digest"), blank.alias("blank"), (~blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    g = slim.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    first = g.groupBy("conv_id", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first"))
    f = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.when(~F.col("unnumbered"), F.col("first")).alias("first"))
    joined = g.join(f, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    return joined.select("conv_id", "turn", "role", "digest", "n", "blank", "cut", (~F.col("turn").eqNullSafe(F.col("first"))).alias("again"))


def plan(rows: DataFrame) -> DataFrame:
    """For each conversation its summary (place null: counts, cost, audit) and a row for each row that its repair has.

    Rows are read by turn (nulls first), then by role and MD5 of the text. Edits: K keep, R rerole,
    I insert (digest null); own and digest tell the row that is kept. An empty table gives an empty plan.
    """

    def run(batches):
        out: list[tuple] = []

        def emit():
            batch = pa.RecordBatch.from_pydict(dict(zip(_PLAN, zip(*out, strict=True), strict=True)), schema=_ARROW)
            out.clear()
            return batch

        def hand_on(conv, repair, last):
            none = (None,) * (len(_COUNTS) + 1)
            if last:
                summary = repair.finish()
                out.extend((conv, *e, *none) for e in repair.taken())
                out.append((conv, None, None, None, None, None, *summary))
            else:
                out.extend((conv, *e, *none) for e in repair.taken())

        conv, repair = None, None
        for b in batches:
            for c, turn, role, digest, n, blank, cut, again in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if repair is None or c != conv:
                    if repair is not None:
                        hand_on(conv, repair, True)
                    conv, repair = c, Repair()
                for k in range(n):
                    repair.add(turn, role, digest, blank, again or k > 0, cut)
                if len(repair.edits) > _HELD:
                    hand_on(conv, repair, False)
                if len(out) > _HELD:
                    yield emit()
        if repair is not None:
            hand_on(conv, repair, True)
        if out:
            yield emit()

    ordered = diagnosed(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return arrow_map(ordered, run, _PLAN_TYPES)


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired conversations, in places from 0. planned: ``plan(rows)``, written."""
    edits = planned.where("place is not null").select("conv_id", "place", "role", "own", "digest", "edit")
    texts = _rows(rows).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.md5("text").alias("d"), "text").groupBy("c", "r", "d").agg(F.first("text").alias("text"))
    there = edits.join(texts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("own") == F.col("r")) & (F.col("digest") == F.col("d")))
    made = edits.where("edit = 'I'").select("conv_id", "place", "role", F.lit("").alias("text"), "edit")
    return there.select("conv_id", "place", "role", "text", "edit").unionByName(made)


def hashed(conversations: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's ``role:text`` rows, joined by line feeds; a row at a time, whatever the conversation's length."""

    def run(batches):
        conv, digest, started = None, None, False
        for b in batches:
            done: list[tuple] = []
            for c, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not started or c != conv:
                    if started:
                        done.append((conv, digest.hexdigest()))
                    conv, digest, started = c, hashlib.sha256(), True
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield _pairs(done)
        if started:
            yield _pairs([(conv, digest.hexdigest())])

    ordered = conversations.select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return arrow_map(ordered.select("conv_id", "role", "text"), run, "conv_id bigint, sha256 string")


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([c for c, _ in found], pa.int64()), pa.array([h for _, h in found], pa.string())], ["conv_id", "sha256"])


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each conversation of rows and of ids.

    Null roles and texts are one space: such a text is blank, such a role fits nowhere. A null conv_id
    is a conversation of its own, null turns come first and count in no gap, equal turns go by role
    and MD5 of the text, repeated rows are duplicates. A conversation without rows has zeros, an empty audit and
    the hash of an empty text. Very long texts are hashed whole and never sorted; further columns are ignored.
    """
    planned = durable(plan(rows))
    of = hashed(repaired(rows, planned)).select(F.col("conv_id").alias("h"), "sha256")
    found = planned.where("place is null").select("conv_id", *_COUNTS, "audit").join(of, F.col("conv_id").eqNullSafe(F.col("h")), "left").drop("h")
    if ids is not None:
        every = ids.select(F.col("conv_id").cast("bigint").alias("i")).distinct()
        found = every.join(found, F.col("i").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("i", "conv_id")
    empty = hashlib.sha256().hexdigest()
    return found.select("conv_id", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))
