"""Connected components of a distributed graph: contraction inside partitions, then large and small stars in turn."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import arrow_map, durable, release


#: Nodes that a task holds while it contracts edges.
HELD = 500_000


class Sets:
    """Union-find that keeps the smallest member as root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        r = x
        while (up := parent.setdefault(r, r)) != r:
            r = up
        while parent[x] != r:
            parent[x], x = r, parent[x]
        return r

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forests(edges: DataFrame) -> DataFrame:
    """For each partition a star for each of its components: at most as many edges as it has nodes. A task holds so many nodes at most, then begins anew."""

    def run(batches):
        sets = Sets()

        def out():
            found = [(x, r) for x in list(sets.parent) if (r := sets.root(x)) != x]
            return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["u", "v"])

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sets.join(x, y)
            if len(sets.parent) > HELD:
                yield out()
                sets = Sets()
        yield out()

    return arrow_map(edges, run, "u bigint, v bigint")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: two bigint columns, each a link. (node, root) for every node with a link, root the smallest node reachable.

    Self links count for nothing. Stars need logarithmically many rounds; each is written to the
    shared folder, so that a lost executor costs one round. A node with very many neighbours is
    reduced by partial minima, and its rows are spread by their other ends.
    """
    a, b = edges.columns
    e = durable(_forests(edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).where("u is not null and v is not null and u <> v")).distinct())
    state = _state(e)
    for _ in range(most_rounds if state[0] else 0):
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # after a large star every edge points from the larger node to the smaller
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        new = durable(small.distinct())
        now = _state(new)
        release(e)
        e = new
        if now == state:
            break
        state = now
    else:
        if state[0]:
            raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
