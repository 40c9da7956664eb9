"""Embedding near-dedup by NN-descent.

Equal vectors of a label are one node. Every node starts with the nearest in its stretches of a few random
orderings of its label's nodes; then, again and again, a node's neighbours (and those it is a
neighbour of) are compared with one another, and each keeps the nearest it has met. Every link met
joins two components, whether or not a list has room for it, and each node also keeps the nearest
it has met outside its component, so that a crowd of copies never hides what lies around it. Two nodes
that a list held together before are not compared there again, lists with nobody new are left out,
and only what is nearer than what a node keeps leaves a task, so that a round costs what the last one
changed. A node may have more links than any list holds: inside each component
that the links connect, all pairs are compared in blocks, in double precision, which gives the
exact number of links and the exact links that remain. A sample compared with all rows tells what share
of their links the sampled nodes have found, those with few links apart from those with many; if
too little, the search goes on from more orderings with longer lists, and if that does not help, all nodes of a
label are compared in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release
from tesserae.llm.components import HELD, Sets, components

SIMILARITY = 0.93
#: Neighbours a node keeps in the first search, and in any; random orderings; rounds in a row that may join no components.
NEAREST, MOST, ORDERINGS, ROUNDS = 8, 32, 4, 2
#: Rows of an ordering that one task sorts, and nodes of a component that one task compares with as many.
CELL, BLOCK = 4096, 2048
#: Nodes of an ordering that are compared at once.
STRETCH = 256
#: Nodes compared with all others to audit the search, at least (their number grows with the root of all nodes), and the share of their links to be found.
AUDITED, RECALL = 256, 0.99
#: Sampled nodes with links that an audit asks for, and bytes of a sample that travel with tasks.
LINKED, TRAVEL = 32, 1 << 25
_SLACK = 1e-4  # single precision in the search


def prepared(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, x): a row for each row; x: the vector's doubles, null if it links with nothing."""

    def run(batches):
        for b in batches:
            out = []
            for v, label in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = None
                if v is not None and label is not None and len(v) and not any(y is None for y in v):
                    a = np.array(v, "<f8")
                    if np.isfinite(a).all() and a.any():
                        x = (a + 0.0).tobytes()  # -0.0 is 0.0
                out.append(x)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "x"])

    d = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return durable(arrow_map(d, run, "vec_id bigint, label string, x binary").withColumn("row", F.monotonically_increasing_id()))


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of equal length, scaled to length 1, in the precision they come in."""
    a = np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)
    top = np.abs(a).max(axis=1, keepdims=True)  # no overflow in squares
    a = a / top
    return a / np.linalg.norm(a, axis=1, keepdims=True)


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, group, x, u, m): distinct vectors of a label and length; u: the unit vector in single precision; m: how many rows."""
    same = rows.where("x is not null").groupBy("label", "x").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("m"))
    same = same.withColumn("group", F.concat_ws("|", "label", F.octet_length("x").cast("string")))

    def run(batches):
        for b in batches:
            units = []
            for x in b.column(2).to_pylist():
                units.append(_unit(pa.array([x], pa.binary())).astype("<f4").tobytes())
            yield pa.record_batch([*b.columns, pa.array(units, pa.binary())], ["node", "group", "x", "m", "u"])

    return durable(arrow_map(same.select("node", "group", "x", "m"), run, "node bigint, group string, x binary, m bigint, u binary"))


def _orderings(nodes: DataFrame, n: int, seeds: range) -> DataFrame:
    """(pivot, member): stretches of STRETCH nodes of random orderings of each group, by the signs of 60 projections; a pivot stands for a stretch and is no node."""

    def run(batches):
        for b in batches:
            found = b.column(2).to_pylist()
            by: dict[int, list[int]] = {}
            for k, x in enumerate(found):
                by.setdefault(len(x), []).append(k)
            for size, own in by.items():
                u = np.frombuffer(b"".join(found[k] for k in own), "<f4").reshape(len(own), -1)
                for seed in seeds:
                    planes = np.random.default_rng(seed).standard_normal((size // 4, 60)).astype(np.float32)
                    code = ((u @ planes > 0).astype(np.int64) << np.arange(60)).sum(axis=1)
                    take = pa.array(own, pa.int64())
                    yield pa.record_batch([b.column(0).take(take), b.column(1).take(take), pa.array(np.full(len(own), seed), pa.int32()), pa.array(code)], ["node", "group", "seed", "code"])

    codes = arrow_map(nodes.select("node", "group", "u"), run, "node bigint, group string, seed int, code bigint")
    bits = max(0, int(np.ceil(np.log2(max(1, n) / (CELL / 4)))))
    cut = codes.withColumn("cell", F.shiftright("code", 60 - min(bits, 59)))
    # a cell may still be crowded by vectors that lie on one another: any two of its parts' nodes can meet in another ordering or later
    sizes = cut.groupBy("group", "seed", "cell").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
    cut = cut.join(sizes, ["group", "seed", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    place = F.row_number().over(Window.partitionBy("group", "seed", "cell", "part").orderBy("code", "node"))
    return cut.select(F.xxhash64("group", "seed", "cell", "part", F.floor((place - 1) / STRETCH)).alias("pivot"), F.col("node").alias("member"))


def _met(lists: DataFrame, nodes: DataFrame, roots: DataFrame, near: int, similarity: float, before: DataFrame | None = None, graph: DataFrame | None = None) -> DataFrame:
    """lists: (pivot, member). (node, other, sim, out, link): what the members of a list, the pivot included, learn from one another.

    out: the two lie in different components. For link, node and other are roots of components
    that links met here connect; each task gives a forest of them. before: lists of the last round; two members that
    one of them held together aren't compared again. graph: what nodes keep by now; only what is as near as the last of these is told.
    """
    own = lists.union(lists.select("pivot", F.col("pivot").alias("member"))).withColumn("fresh", F.lit(True))
    if before is not None:
        held = before.union(before.select("pivot", F.col("pivot").alias("member"))).withColumn("fresh", F.lit(False))
        each = own.union(held).repartition("pivot").groupBy("pivot", "member").agg(F.bool_and("fresh").alias("fresh"), F.bool_or("fresh").alias("now")).where("now").drop("now")
        own = each.withColumn("some", F.max("fresh").over(Window.partitionBy("pivot"))).where("some").drop("some")
    else:
        own = own.distinct()
    known = nodes.select("node", "u").join(roots, "node")
    if graph is not None:
        kth = lambda c: F.coalesce(F.try_element_at(F.sort_array(F.collect_list(c), asc=False), F.lit(near)), F.lit(-2.0).cast("float"))
        known = known.join(graph.groupBy("node").agg(kth(F.col("sim")).alias("least"), kth(F.when(F.col("out"), F.col("sim"))).alias("least_out")), "node", "left")
    else:
        known = known.withColumns({"least": F.lit(None).cast("float"), "least_out": F.lit(None).cast("float")})
    none = F.lit(-2.0).cast("float")
    known = known.select(F.col("node").alias("member"), "root", "u", F.coalesce("least", none).alias("least"), F.coalesce("least_out", none).alias("least_out"))
    rows = own.join(known, "member").repartition("pivot").sortWithinPartitions("pivot", "member").select("pivot", "member", "root", "fresh", "least", "least_out", "u")

    def run(batches):
        held: tuple | None = None
        sets = Sets()
        for b in batches:
            part = (*(b.column(k).to_numpy(zero_copy_only=False) for k in range(6)), b.column(6).to_pylist())
            if held is not None:
                part = (*(np.concatenate(x) for x in zip(held[:6], part[:6], strict=True)), held[6] + part[6])
            pivot = part[0]
            if not len(pivot):
                continue
            at = int(np.searchsorted(pivot, pivot[-1]))  # the last list may go on in the next batch
            last = _learned(*(x[:at] for x in part), near, similarity, sets)
            held = tuple(x[at:] for x in part)
            if last is not None:
                yield last
            if len(sets.parent) > HELD:
                yield _joined(sets)
                sets = Sets()
        if held is not None and (last := _learned(*held, near, similarity, sets)) is not None:
            yield last
        yield _joined(sets)

    return arrow_map(rows, run, "node bigint, other bigint, sim float, out boolean, link boolean")


_MET = ["node", "other", "sim", "out", "link"]


def _joined(sets: Sets) -> pa.RecordBatch:
    links = [(x, r) for x in list(sets.parent) if (r := sets.root(x)) != x]
    n = len(links)
    return pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([r for _, r in links], pa.int64()), pa.array(np.zeros(n, np.float32)), pa.array(np.ones(n, bool)), pa.array(np.ones(n, bool))], _MET)


def _learned(pivot: np.ndarray, member: np.ndarray, root: np.ndarray, fresh: np.ndarray, least: np.ndarray, least_out: np.ndarray, u: list[bytes], near: int, similarity: float, sets: Sets) -> pa.RecordBatch | None:
    if not len(pivot):
        return None
    cuts = np.flatnonzero(pivot[1:] != pivot[:-1]) + 1
    a, b, s, o = [], [], [], []
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pivot)], strict=True):
        n = hi - lo
        if n < 2:
            continue
        x = np.frombuffer(b"".join(u[lo:hi]), "<f4").reshape(n, -1)
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        own, of, new = member[lo:hi], root[lo:hi], fresh[lo:hi]
        if not new.all():
            sims[~(new[:, None] | new[None, :])] = -2
        apart = of[:, None] != of[None, :]
        i, j = np.nonzero(np.triu(apart & (sims >= similarity - _SLACK)))
        for p, q in set(zip(of[i].tolist(), of[j].tolist(), strict=True)):
            sets.join(p, q)
        k = min(near, n - 1)
        best = np.argpartition(sims, n - k, axis=1)[:, n - k :] if k < n - 1 else np.argsort(sims, axis=1)[:, 1:]
        take = np.zeros((n, n), bool)
        np.put_along_axis(take, best, True, axis=1)
        if k < n - 1 and not apart[~np.eye(n, dtype=bool)].all():
            far = np.where(apart, sims, -3)
            best = np.argpartition(far, n - k, axis=1)[:, n - k :]
            more = np.zeros((n, n), bool)
            np.put_along_axis(more, best, True, axis=1)
            take |= more & apart
        take &= (sims >= np.where(apart, least_out[lo:hi, None], least[lo:hi, None])) & (sims > -2)
        i, j = np.nonzero(take)
        a.append(own[i])
        b.append(own[j])
        s.append(sims[i, j])
        o.append(apart[i, j])
    if not a:
        return None
    out = np.concatenate(o)
    return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(np.concatenate(s).astype(np.float32)), pa.array(out), pa.array(np.zeros(len(out), bool))], _MET)


def _first(rows: DataFrame, node: str, other: str, near: int, *also: str) -> DataFrame:
    """Of each node's rows the nearest, and the nearest that lead out of its component."""
    k = F.row_number().over(Window.partitionBy(node, *also).orderBy(F.desc("sim"), other))
    k_out = F.row_number().over(Window.partitionBy(node, *also, "out").orderBy(F.desc("sim"), other))
    return rows.withColumn("k", k).withColumn("k_out", k_out).where((F.col("k") <= near) | (F.col("out") & (F.col("k_out") <= near))).drop("k", "k_out")


def _nearest(found: DataFrame, near: int) -> DataFrame:
    """found: as from ``_met``. Links all stay; each is a list of its own here, however many a root has."""
    once = found.groupBy("node", "other", "out", "link").agg(F.max("sim").alias("sim")).select(*_MET)
    return _first(once.withColumn("spread", F.when(F.col("link"), F.col("other"))), "node", "other", near, "link", "spread").drop("spread")


def _lists(graph: DataFrame, near: int) -> DataFrame:
    """(pivot, member): a node's neighbours, and the nearest of those whose neighbour it is."""
    reverse = _first(graph, "other", "node", near).select(F.col("other").alias("pivot"), F.col("node").alias("member"))
    return graph.select(F.col("node").alias("pivot"), F.col("other").alias("member")).union(reverse)


def _told_apart(graph: DataFrame, roots: DataFrame) -> DataFrame:
    """graph with ``out`` by the components of now."""
    a, b = roots.select("node", F.col("root").alias("a")), roots.select(F.col("node").alias("other"), F.col("root").alias("b"))
    return graph.select("node", "other", "sim").join(a, "node").join(b, "other").select("node", "other", "sim", (F.col("a") != F.col("b")).alias("out"), F.lit(False).alias("link"))


def _merged(roots: DataFrame, met: DataFrame) -> DataFrame | None:
    """(node, root) after the links met, or nothing if they join no components."""
    links = met.where("link").select("node", "other")
    if links.isEmpty():
        return None
    up = components(links).select(F.col("node").alias("root"), F.col("root").alias("up"))
    return durable(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))


def descend(nodes: DataFrame, graph: DataFrame | None, roots: DataFrame, n: int, similarity: float, seeds: range, near: int = NEAREST, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(node, other, sim, out): each node's nearest; and (node, root), the components that all links met connect.

    Goes on until a round changes next to nothing and joins no components, or ``rounds`` in a row
    join none. Lists full of links need no more room here, for what lies outside a component has its own
    places; what is missed all the same an audit sees.
    """
    before = None
    found = _met(_orderings(nodes, n, seeds), nodes, roots, near, similarity)
    if graph is not None:
        found = found.union(_told_apart(graph, roots))
    new = durable(_nearest(found, near))
    roots, graph = _merged(roots, new) or roots, new.where("not link")
    quiet = 0
    while quiet < rounds:
        now = durable(_told_apart(graph, roots))
        lists = durable(_lists(now, near).distinct())
        held = new
        new = durable(_nearest(now.union(_met(lists, nodes, roots, near, similarity, before, now)), near))
        merged, wider = _merged(roots, new), new.where("not link")
        changed = wider.join(graph.select("node", "other"), ["node", "other"], "left_anti").count()
        quiet += 1
        if merged is not None:
            roots, quiet = merged, 0
        release(held, now, *([] if before is None else [before]))
        graph, before = wider, lists
        if merged is None and changed <= 0.02 * n:
            break
    release(before)
    return graph, roots


def _exact(nodes: DataFrame, roots: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """(u, v, n): inside each component, for v null: node u has links to n rows of other nodes; else u and v are linked, enough to connect all links."""
    d = nodes.join(roots, "node").select("root", "node", "m", "x")
    sizes = d.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    d = d.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = dealt.select("root", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).alias("right"), "node", "m", "x")
    rows = pairs.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "node")

    def block_of(part: list[tuple]) -> tuple[list, list, list]:
        _, a, b, *_ = part[0]
        node = np.array([r[4] for r in part], np.int64)
        m = np.array([r[5] for r in part], np.int64)
        u = _unit(pa.array([r[6] for r in part], pa.binary()))
        right = np.array([r[3] for r in part], bool)
        left_at, right_at = (np.arange(len(part)),) * 2 if a == b else (np.flatnonzero(~right), np.flatnonzero(right))
        if not len(left_at) or not len(right_at):
            return [], [], []
        near = u[left_at] @ u[right_at].T >= similarity
        near &= node[left_at][:, None] != node[right_at][None, :]
        sets = Sets()
        for p, q in zip(*(z.tolist() for z in np.nonzero(_sparse(near))), strict=True):
            sets.join(int(node[left_at[p]]), int(node[right_at[q]]))
        links = [(x, r) for x in list(sets.parent) if (r := sets.root(x)) != x]
        counts = [(int(k), int(c)) for k, c in zip(node[left_at], near @ m[right_at], strict=True)]
        if a != b:
            counts += [(int(k), int(c)) for k, c in zip(node[right_at], near.T @ m[left_at], strict=True)]
        return [k for k, _ in counts] + [x for x, _ in links], [None] * len(counts) + [r for _, r in links], [c for _, c in counts] + [0] * len(links)

    def run(batches):
        part: list[tuple] = []
        for b in batches:
            u, v, n = [], [], []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part and r[:3] != part[0][:3]:
                    for into, x in zip((u, v, n), block_of(part), strict=True):
                        into += x
                    part = []
                part.append(r)
            if u:
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], ["u", "v", "n"])
        if part:
            u, v, n = block_of(part)
            if u:
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], ["u", "v", "n"])

    return arrow_map(rows, run, "u bigint, v bigint, n bigint")


def _sparse(near: np.ndarray) -> np.ndarray:
    """Fewer true entries that connect the same rows and columns: rows with the same links keep one of them each but the first."""
    out = near.copy()
    packed = np.packbits(near, axis=1)
    _, first, of = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    again = np.ones(len(near), bool)
    again[first] = False
    where = np.flatnonzero(again & near.any(axis=1))
    out[where] = False
    out[where, near[where].argmax(axis=1)] = True
    return out


def audit(nodes: DataFrame, counts: DataFrame, similarity: float, n: int | None = None, sample: int | None = None) -> float:
    """The share of its links that a node has found, on average over sampled nodes that have links; the lower one of nodes with few links and of nodes with many.

    A sample is compared with all of the n nodes and travels with the tasks, in TRAVEL bytes at most. Where fewer than
    LINKED of its nodes have links, four times as many further nodes follow, until that many have, or
    until every node was compared: only then are no links taken for a full recall.
    """
    n = nodes.count() if n is None else n
    size = nodes.agg(F.max(F.octet_length("x"))).first()[0] or 8
    want = max(AUDITED, 4 * math.isqrt(n)) if sample is None else sample
    place = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 40)) / float(1 << 40)
    low, tally = 0.0, {True: [0, 0.0], False: [0, 0.0]}
    while low < 1.0 and sum(k for k, _ in tally.values()) < LINKED:
        high = min(1.0, low + min(want, max(1, TRAVEL // size)) / max(n, 1))
        chosen = nodes.where((place >= low) & (place < high)).select("node", "group", "x").collect()  # of bounded size
        for r in _shares(nodes, counts, similarity, chosen).collect():  # two rows
            tally[r["few"]][0] += r["k"]
            tally[r["few"]][1] += r["share"]
        low, want = high, 4 * want
    return min((share / k for k, share in tally.values() if k), default=1.0)


def _shares(nodes: DataFrame, counts: DataFrame, similarity: float, chosen: list) -> DataFrame:
    """(few, k, share): of the chosen nodes that have links, apart for those with few and with many, their number and the sum of the shares found."""
    by: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    members: dict[str, list] = {}
    for r in chosen:
        members.setdefault(r["group"], []).append(r)
    for g, own in members.items():
        by[g] = np.array([r["node"] for r in own], np.int64), _unit(pa.array([bytes(r["x"]) for r in own], pa.binary()))

    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            every = b.column(1).to_pylist()
            for g, lo in [(g, lo) for lo in range(0, len(every), 1024) for g in set(every[lo : lo + 1024]) & by.keys()]:
                groups = every[lo : lo + 1024]
                at = [lo + k for k, x in enumerate(groups) if x == g]
                take = pa.array(at, pa.int64())
                ids, m = b.column(0).take(take).to_numpy(), b.column(3).take(take).to_numpy()
                new = _unit(b.column(2).take(take)).T
                for first in range(0, len(by[g][0]), 1024):
                    own, x = by[g][0][first : first + 1024], by[g][1][first : first + 1024]
                    near = x @ new >= similarity
                    near &= own[:, None] != ids[None, :]
                    for node, k in zip(own.tolist(), (near @ m).tolist(), strict=True):
                        if k:
                            total[node] = total.get(node, 0) + k
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["node", "n"])

    true = arrow_map(nodes.select("node", "group", "x", "m"), run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n")).where("n > 0")
    share = F.coalesce("found", F.lit(0)) / F.col("n")
    met = true.join(counts.select("node", F.col("n").alias("found")), "node", "left")
    return met.groupBy((F.col("n") <= NEAREST).alias("few")).agg(F.count(F.lit(1)).alias("k"), F.sum(share).alias("share"))


def linked(vectors: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, tries: int = 3) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of vectors.

    Vectors link if their labels and lengths are equal and their cosine, in double precision, is
    ``similarity`` or more; null labels, null or zero vectors and vectors with null or non-finite
    components link with nothing. n_links: other rows linked. component_id: the smallest vec_id
    that links reach, its own included; null vec_ids are passed over. kept: vec_id is
    component_id, so that repeated rows of a smallest vec_id are all kept. An empty table gives an
    empty result; columns beyond vec_id, label and embedding are ignored.
    """
    rows = prepared(vectors)
    nodes = _nodes(rows)
    n = nodes.count()
    graph, roots = None, nodes.select("node", F.col("node").alias("root"))
    for k in range(tries):
        graph, roots = descend(nodes, graph, roots, n, similarity, range(k * ORDERINGS, (k + 1) * ORDERINGS), min(MOST, NEAREST << k))
        near = roots.join(roots.where("node <> root").select("root").distinct(), "root", "left_semi").select("node", "root")
        exact = durable(_exact(nodes, near, similarity))
        counts = exact.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
        if audit(nodes, counts, similarity, n) >= recall:
            break
        release(exact)
    else:  # the search misses too much: each group is compared as if it were one component
        whole = nodes.select("node", F.xxhash64("group").alias("root"))
        exact = durable(_exact(nodes, whole, similarity))
        counts = exact.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(exact.where("v is not null").select("u", "v"))
    of = nodes.join(counts, "node", "left").join(roots, "node", "left").select("node", "group", "x", "m", "n", F.coalesce("root", "node").alias("root"))
    named = rows.withColumn("group", F.concat_ws("|", "label", F.octet_length("x").cast("string")))
    firsts = named.where("x is not null").join(of.select("group", "x", "node", "m", "n", "root"), ["group", "x"])
    slim = durable(firsts.select("row", "vec_id", "m", "n", "root"))
    least = slim.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    good = slim.join(least, "root").select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).cast("bigint").alias("n_links"), "component_id")
    alone = rows.where("x is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
