"""Graph operators against small Python versions."""

import random

import pytest

from riskweave.operators import graph
from riskweave.session import open_stages


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


@pytest.fixture(scope="module")
def random_graph(spark):
    """Random links plus one hub that holds about a third of them."""
    rng = random.Random(4)
    pairs = {(f"n{rng.randrange(40):02d}", f"n{rng.randrange(40):02d}") for _ in range(120)} | {("hub", f"n{i:02d}") for i in range(40)}
    pairs |= {("n01", "n01"), ("x", "y"), ("y", "z")}
    return sorted(pairs), frame(spark, sorted(pairs)).repartition(5)


def brute_rank(pairs, rounds):
    nodes = sorted({v for p in pairs for v in p})
    out = {v: [d for s, d in pairs if s == v] for v in nodes}
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(rounds):
        lost = sum(rank[v] for v in nodes if not out[v])
        new = {v: 0.15 / len(nodes) + 0.85 * lost / len(nodes) for v in nodes}
        for v in nodes:
            for d in out[v]:
                new[d] += 0.85 * rank[v] / len(out[v])
        rank = new
    return rank


@pytest.mark.parametrize("hub_edges", [7, 1_000_000])
def test_pagerank(random_graph, hub_edges):
    pairs, edges = random_graph
    got = {r["id"]: r["pagerank"] for r in graph.pagerank(edges, tol=0.0, max_iter=4, hub_edges=hub_edges).collect()}
    want = brute_rank(pairs, 4)
    assert got.keys() == want.keys() and sum(got.values()) == pytest.approx(1.0)
    assert all(got[v] == pytest.approx(want[v]) for v in want)


def test_pagerank_rounds_move_numbers_only(spark, random_graph):
    before = set(open_stages())
    assert graph.pagerank(random_graph[1], tol=0.0, max_iter=2).count() > 0
    rounds = [p for p in open_stages() if p not in before and p.rsplit("/", 1)[1].startswith(("rank-", "edges-", "nodes-"))]
    assert rounds and not any("string" in spark.read.parquet(p).schema.simpleString() for p in rounds)


def test_pagerank_stops_at_tolerance(random_graph):
    pairs, edges = random_graph
    got = {r["id"]: r["pagerank"] for r in graph.pagerank(edges).collect()}
    want = brute_rank(pairs, 100)
    assert all(abs(got[v] - want[v]) < 1e-4 for v in want)


def test_components_of_a_long_chain(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(200)]
    random.Random(1).shuffle(chain)
    extra = [("q", "r"), ("loop", "loop"), ("r", "q")]
    got = {r["id"]: r["component"] for r in graph.connected_components(frame(spark, chain + extra)).collect()}
    assert {got[f"c{i:03d}"] for i in range(201)} == {"c000"}
    assert (got["q"], got["r"], got["loop"]) == ("q", "q", "loop")


def test_components_are_closed_under_edges(random_graph):
    pairs, edges = random_graph
    got = {r["id"]: r["component"] for r in graph.connected_components(edges).collect()}
    assert all(got[s] == got[d] for s, d in pairs)
    assert got["x"] == got["z"] == "x" and got["hub"] == "hub"


def test_clustering(random_graph):
    pairs, edges = random_graph
    near = {}
    for s, d in pairs:
        near.setdefault(s, set())
        near.setdefault(d, set())
        if s != d:
            near[s].add(d)
            near[d].add(s)
    got = {r["id"]: r["clustering_coef"] for r in graph.clustering_coef(edges).collect()}
    assert got.keys() == near.keys()
    for v, ns in near.items():
        links = sum(b in near[a] for a in ns for b in ns if a < b)
        want = 2 * links / (len(ns) * (len(ns) - 1)) if len(ns) > 1 else 0.0
        assert got[v] == pytest.approx(want), v


def test_triangles_with_a_hub_and_small_triples(spark):
    """A hub next to all vertices, long ids, and triples of a few edges: every triangle counts once."""
    rng = random.Random(8)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(300)} | {(i, 60) for i in range(60)} | {(60, 100 + i) for i in range(200)}
    table = spark.createDataFrame(sorted(pairs), "a long, b long").repartition(4)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {v: sum(len(near[v] & near[w]) for w in ws) // 2 for v, ws in near.items()}
    for per_task in (20, 500_000):
        got = {r.id: r.triangles for r in graph.triangle_counts(table, per_task).collect()}
        assert got == {v: n for v, n in want.items() if n}
    assert graph.triangle_counts(table.limit(0)).count() == 0


def union_find(pairs):
    root = {v: v for p in pairs for v in p}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {v: find(v) for v in root}


def test_components_by_union_find(spark):
    """Two long chains in any order, one giant component, small ones, a star and a loop."""
    rng = random.Random(6)
    names = [f"c{i:03d}" for i in rng.sample(range(400), 400)]
    pairs = list(zip(names[:200], names[1:200])) + list(zip(names[201:], names[200:]))
    pairs += [(f"g{rng.randrange(150):03d}", f"g{rng.randrange(150):03d}") for _ in range(600)]
    pairs += [(f"s{i}a", f"s{i}b") for i in range(20)] + [("star", f"t{i}") for i in range(50)] + [("loop", "loop")]
    rng.shuffle(pairs)
    got = {r["id"]: r["component"] for r in graph.connected_components(frame(spark, pairs).repartition(5)).collect()}
    assert got == union_find(pairs) and len(set(got.values())) == 2 + len({v for k, v in got.items() if k[0] == "g"}) + 22


def test_components_by_smallest_neighbours_first(spark, monkeypatch):
    """The links of smallest neighbours leave parts that only the remaining pairs join; stars take no round."""
    rng = random.Random(9)
    pairs = [(f"g{rng.randrange(300):03d}", f"g{rng.randrange(300):03d}") for _ in range(900)]
    for part in range(6):  # two tight groups joined by one pair of their largest members
        a, b = ([f"{k}{part}{i}" for i in range(5)] for k in "pq")
        pairs += [(x, y) for g in (a, b) for x in g for y in g if x < y] + [(a[-1], b[-1])]
    edges = frame(spark, pairs + [("star", f"t{i}") for i in range(9)] + [("loop", "loop")]).repartition(5)
    want = union_find(pairs + [("star", f"t{i}") for i in range(9)] + [("loop", "loop")])
    for dense in (0, 1e9):
        assert {r.id: r.component for r in graph.connected_components(edges, dense=dense).collect()} == want
    stars = frame(spark, [(f"c{i % 7}", f"o{i:03d}") for i in range(100)])
    rounds, write = [], graph.write_stage
    monkeypatch.setattr(graph, "write_stage", lambda df, tag="stage": (rounds.append(tag), write(df, tag))[1])
    got = {r.id: r.component for r in graph.connected_components(stars).collect()}
    assert got == {f"o{i:03d}": f"c{i % 7}" for i in range(100)} | {f"c{i}": f"c{i}" for i in range(7)} and "cc" not in rounds


def test_edge_table_keeps_last_write(spark):
    df = spark.createDataFrame([("a", "b", 1, 10.0, 0), ("a", "b", 2, 5.0, 1), ("b", "a", 1, 1.0, 0)], "s string, d string, t int, amount double, f int")
    got = {(r["src"], r["dst"]): (r["f"], r["transactions"], r["total_amount"]) for r in graph.edge_table(df, "s", "d", ["t"], ["f"], "amount").collect()}
    assert got == {("a", "b"): (1, 2, 15.0), ("b", "a"): (0, 1, 1.0)}


def test_subgraph_size(random_graph):
    _, edges = random_graph
    comps = graph.connected_components(edges)
    part = graph.subgraph(edges, comps, "hub", n=10)
    assert 0 < len({v for r in part.collect() for v in r}) <= 10


def test_edges_travel_packed():
    """Every edge comes to each triple of its colours once, as two whole numbers of four bytes."""
    import numpy as np
    import pyarrow as pa

    rng, c = np.random.default_rng(3), 5
    edges = np.unique(rng.integers(0, 3000, (20_000, 2)), axis=0)
    edges = edges[edges[:, 0] < edges[:, 1]]
    batch = pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"])
    packets = pa.Table.from_batches(graph._dealt(c)([batch]))
    assert sum(len(p.as_buffer()) for p in packets.column("edges")) == 8 * c * len(edges)
    got = np.concatenate([np.column_stack(graph._unpacked(p.as_buffer())) for p in packets.column("edges")])
    found, times = np.unique(got, axis=0, return_counts=True)
    assert (found == edges).all() and (times == c).all()
