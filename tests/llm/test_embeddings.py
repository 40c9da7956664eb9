import numpy as np
import pytest

from tesserae.llm import neardup_vectors as N
from tests.llm.test_simhash import grouped


def table(n=260, dim=16, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        rows.append((k, r.standard_normal(dim).tolist(), int(k % 3)))
    crowd = r.standard_normal(dim)
    for k in range(150):
        rows.append((1000 + k, (crowd + 0.05 * r.standard_normal(dim)).tolist(), 1))
    for k in range(40):
        rows.append((2000 - k, crowd.tolist(), 1))  # equal vectors
        rows.append((3000 + k, (3 * crowd).tolist(), 2))
    step = r.standard_normal(dim)
    for k in range(30):  # a chain: neighbours are near, ends are not
        rows.append((4000 + k, step.tolist(), 0))
        step = step + 0.25 * r.standard_normal(dim)
    rows += [(5000, None, 1), (5001, [0.0] * dim, 1), (5002, [float("nan")] + [1.0] * (dim - 1), 1), (5003, [None] + [1.0] * (dim - 1), 1), (5004, crowd.tolist(), None)]
    rows += [(5005, [float("inf")] * dim, 1), (5006, crowd[:8].tolist(), 1), (5007, (1e200 * crowd).tolist(), 1), (None, crowd.tolist(), 1), (7, rows[7][1], 1), (7, rows[7][1], 1), (5008, [], 1)]
    return rows


def by_hand(rows, cut=0.93):
    good = [k for k, (_, v, g) in enumerate(rows) if v and g is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i, a in enumerate(good):
        for b in good[:i]:
            x, y = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (a, b))
            if rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cut:
                links.append((a, b))
    n = np.bincount(np.array(links).reshape(-1), minlength=len(rows))
    of = grouped(range(len(rows)), links)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[of[k]] = min(least.get(of[k], i), i)
    return sorted(((i, int(n[k]), least.get(of[k]), i is not None and i == least.get(of[k])) for k, (i, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [2048, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N._exact, "__defaults__", (block,))
    rows = table()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3).selectExpr("*", "1 as node", "2 as x", "3 as root", "4 as row")
    got = N.linked(df)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows)


def test_empty_and_alone(spark):
    t = "vec_id bigint, embedding array<float>, label int"
    assert N.linked(spark.createDataFrame([], t)).count() == 0
    assert [tuple(r) for r in N.linked(spark.createDataFrame([(3, [1.0, 2.0], 1)], t)).collect()] == [(3, 0, 3, True)]


def test_audit_sees_what_is_missed(spark):
    rows = table(60)
    nodes = N._nodes(N.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    none = spark.createDataFrame([], "node bigint, n bigint")
    assert N.audit(nodes, none, 0.93) == 0.0


def crowds(n=45, dim=48, seed=4):
    """Two crowds of one label: cosine 0.99 inside a crowd, 0.94 across."""
    r = np.random.default_rng(seed)
    q, _ = np.linalg.qr(r.standard_normal((dim, 2)))
    far = np.sqrt(0.06 / 2 / 0.99)  # the centres' half distance, so that the cosine across is near 0.94
    rows = []
    for g in range(2):
        centre = q[:, 0] + (far if g else -far) * q[:, 1]
        for k in range(n):
            noise = r.standard_normal(dim)
            noise -= q @ (q.T @ noise)
            rows.append((g * 1000 + k, (centre + 0.08 * noise / np.linalg.norm(noise)).tolist(), 1))
    return rows


def test_links_beyond_full_lists(spark):
    rows = crowds()
    want = by_hand(rows)
    assert {r[1] for r in want} == {89} and {r[2] for r in want} == {0}
    got = N.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_a_met_link_outside_the_list_joins_components(spark):
    """A list of nine: one node lies 0.94 from eight that lie closer to one another."""
    x = crowds(9)
    rows = [(k, v, 1) for k, (_, v, _) in enumerate(x[:9] + x[9:10])]
    nodes = N._nodes(N.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    ids = sorted(r["node"] for r in nodes.select("node").collect())
    lists = spark.createDataFrame([(ids[0], k) for k in ids[1:]], "pivot bigint, member bigint")
    roots = nodes.select("node", nodes.node.alias("root"))
    met = N._nearest(N._met(lists, nodes, roots, 2, 0.93), 2)
    assert {r["root"] for r in N._merged(roots, met).collect()} == {ids[0]}


def test_audit_does_not_let_crowds_hide_pairs(spark):
    """A crowd whose links are all found, and pairs whose links are not."""
    r = np.random.default_rng(3)
    rows = [*crowds(60)]
    for k in range(20):
        x = r.standard_normal(48)
        rows += [(5000 + 2 * k, x.tolist(), 2), (5001 + 2 * k, (x + 0.01 * r.standard_normal(48)).tolist(), 2)]
    nodes = N._nodes(N.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    counts = nodes.where("`group` like '1|%'").selectExpr("node", "119L as n")
    assert 40 / (40 + 120 * 119) < 0.01
    assert N.audit(nodes, counts, 0.93) == 0.0


def rare(n=700, pairs=2, dim=24, seed=8):
    """Vectors of which hardly any have links."""
    r = np.random.default_rng(seed)
    rows = [(k, r.standard_normal(dim).tolist(), 1) for k in range(n)]
    for k in range(pairs):
        rows.append((10_000 + k, (np.array(rows[300 * k + 5][1]) * 1.5).tolist() if k else (np.array(rows[5][1]) + 0.01).tolist(), 1))
    return rows


def test_no_sampled_link_is_no_recall(spark):
    rows = rare(pairs=2)
    nodes = N._nodes(N.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    none = spark.createDataFrame([], "node bigint, n bigint")
    assert N.audit(nodes, none, 0.93) == 0.0
    assert N.audit(nodes, none, 0.93, sample=10) == 0.0
    linked = {r[0] for r in by_hand(rows) if r[1]}
    assert len(linked) == 4
    none_linked = N._nodes(N.prepared(spark.createDataFrame([r for r in rows if r[0] not in linked], "vec_id bigint, embedding array<double>, label int")))
    assert N.audit(none_linked, none, 0.93, sample=500) == 1.0


def test_rare_links_of_a_search_that_finds_nothing(spark, monkeypatch):
    monkeypatch.setattr(N, "descend", lambda nodes, graph, roots, *_: (graph, roots))
    rows = rare(pairs=2)
    got = N.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows)


def test_a_search_that_finds_nothing_is_made_up_for(spark, monkeypatch):
    monkeypatch.setattr(N, "descend", lambda nodes, graph, roots, *_: (graph, roots))
    rows = table(60)
    got = N.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows)


def test_a_list_compares_only_with_new_members(spark):
    """Two that a list held together before are not compared again, and what is farther than what a node keeps isn't told."""
    rows = [(k, v, 1) for k, (_, v, _) in enumerate(crowds(4))]
    nodes = N._nodes(N.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    ids = sorted(r["node"] for r in nodes.select("node").collect())
    lists = spark.createDataFrame([(ids[0], k) for k in ids[1:5]] + [(ids[5], ids[6])], "pivot bigint, member bigint")
    before = lists.where(lists.member != ids[4])
    roots = nodes.select("node", nodes.node.alias("root"))
    met = N._met(lists, nodes, roots, 8, 0.93, before).where("not link").select("node", "other", "sim").collect()
    pairs = {(r["node"], r["other"]) for r in met}
    assert pairs and all(ids[4] in p for p in pairs) and len({x for p in pairs for x in p}) == 5
    kept = spark.createDataFrame([(ids[1], k, 1.0, True) for k in range(100, 108)], "node bigint, other bigint, sim float, out boolean")
    told = N._met(lists, nodes, roots, 8, 0.93, before, kept).where("not link").select("node", "other").collect()
    assert {tuple(r) for r in told} == {p for p in pairs if p[0] != ids[1]}
