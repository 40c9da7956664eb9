import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesserae.llm import conversations
from tests.llm.cases import rows_of

NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORD = r"[^\x20\x09-\x0D]"


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def faults(rows):
    """(role, text, fault) of a conversation's ordered rows."""
    seen, out = set(), []
    for _, role, text in rows:
        words = re.findall(WORD, text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by searching all edits in the order of (cost, audit)."""
    n = len(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == n and state in ("", "a"):
            return cost, audit, out
        if (i, state) in done:
            continue
        done.add((i, state))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        names = {"u": "user", "a": "assistant"}
        for x in nexts:
            if x in names:
                heapq.heappush(heap, (cost + 2, audit + "I", i, x, (*out, (names[x], ""))))
        if i < n:
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[:1] in nexts:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, (role, text))))
                for x in nexts:
                    if x in names:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, x, (*out, (names[x], text))))
    raise AssertionError


def naive(table, plant=True):
    told = {}
    for conv, turn, role, text in table:
        rows = told.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if plant else -1
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in told.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], md5(r[2])))
        marked = faults(rows)
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, repaired = cheapest(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, *(sum(f == x for *_, f in marked) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def odd_table():
    r = random.Random(3)
    texts = ["Yes.", "no", "", " \t", "What? ", "End!\n", "a ", "Ünd…", None, "long " * 3000 + "."]
    rows = [(conv, turn, r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]), r.choice(texts)) for conv in range(40) for turn in range(r.randint(0, 9))]
    rows += [(100 + c, t, ["user", "assistant"][t % 2], f"Turn {t}.") for c in range(60) for t in range(8)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (7, None, "system", "Rules."), (7, None, None, None), (7, 3, "user", "Tied."), (7, 3, "user", "Tied too."), (7, 3, "user", "Tied.")]
    return rows + [(200, None, None, None), (201, 5, "assistant", "Alone.")]


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_search_of_all_edits(spark, extra):
    table = odd_table()
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    if extra:
        for c in ("place", "edit", "n", "digest", "own", "blank", "fault", "audit", "c", "r", "d", "first", "h", "i"):
            df = df.selectExpr("*", f"'x' as {c}")
    assert rows_of(conversations.report(conversations.damaged(df), df), *NAMES) == naive(table)


_row = st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), st.sampled_from(["A.", "B.", "C", "", "D?"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(_row, max_size=12))
def test_search_is_the_cheapest(rows):
    marked = faults([(0, *r) for r in rows])
    repair = conversations.Repair()
    for k, (role, text, fault) in enumerate(marked):
        repair.add(k, role, md5(text), fault == "blank", fault == "duplicate", fault == "truncated")
    *_, cost, audit = repair.finish()
    expected = cheapest(marked)
    assert (cost, audit) == expected[:2]
    assert [(role, digest) for _, _, role, _, digest in repair.taken()] == [(role, None if e == "I" else md5(text)) for e, (role, text) in zip(audit.replace("D", ""), expected[2], strict=True)]


def test_a_conversation_is_not_held(monkeypatch):
    r = random.Random(9)
    rows = [(r.choice(["user", "assistant", "user", "assistant", "system"]), f"Text {k}.") for k in range(3000)]
    whole, parts = conversations.Repair(), conversations.Repair()
    most = 0
    monkeypatch.setattr(conversations, "SETTLE", 1 << 30)
    for role, text in rows:
        whole.add(0, role, text, False, False, False)
    monkeypatch.setattr(conversations, "SETTLE", 64)
    for role, text in rows:
        parts.add(0, role, text, False, False, False)
        most = max(most, len(parts.pending))
    assert most < 600
    assert parts.finish() == whole.finish()
    assert parts.taken() == whole.taken()


def test_one_very_long_conversation_of_copies(spark):
    rows = [(1, t, "user", "Same.") for t in range(2000)] + [(1, 5, "user", "Same.")] * 500 + [(2, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(5000)]
    found = rows_of(conversations.report(spark.createDataFrame(rows, SCHEMA)), *NAMES)
    assert found == naive(rows, plant=False)
    repaired = "\n".join(f"{['user', 'assistant'][t % 2]}:{t}." for t in range(5000))
    assert found[1] == (2, 0, 0, 0, 0, 0, 0, "K" * 5000, hashlib.sha256(repaired.encode()).hexdigest())


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Go on"), (1, 2, "user", "Go on"), (1, 3, "tool", "x.")]
    df = spark.createDataFrame(rows, SCHEMA)
    planned = conversations.durable(conversations.plan(df))
    cost, audit, repaired = cheapest(faults([r[1:] for r in rows]))
    found = conversations.repaired(df, planned).orderBy("place").collect()
    assert [(r.place, r.role, r.text) for r in found] == [(k, *x) for k, x in enumerate(repaired)]
    assert "".join(r.edit for r in found) == audit.replace("D", "")


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations.report(conversations.damaged(df), df).count() == 0
