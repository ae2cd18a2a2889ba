"""Account networks as vertex and edge tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.operators.joins import join_features, mark_join
from riskweave.operators.ordered import with_global_index
from riskweave.session import drop_stage, materialize, ship_package, write_measured, write_stage

HUB_EDGES = 1_000_000


def edge_table(df: DataFrame, src: str, dst: str, order: list[str], attrs: list[str], amount: str | None = None) -> DataFrame:
    """One row per directed pair. Attributes come from the last transaction in `order`;
    the number of transactions and the amount total are kept as well."""
    last = F.max(F.struct(*order, *[a for a in attrs if a not in order])).alias("_last")
    extra = [F.sum(amount).alias("total_amount")] if amount else []
    pairs = df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(last, F.count(F.lit(1)).alias("transactions"), *extra)
    totals = ["total_amount"] if amount else []
    return pairs.select("src", "dst", *[F.col(f"_last.{a}").alias(a) for a in attrs], "transactions", *totals)


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def graph_counts(edges: DataFrame) -> DataFrame:
    count = lambda d, v, e: d.select(F.lit(v).alias("v"), F.lit(e).alias("e"))
    both = count(vertices(edges), 1, 0).unionByName(count(edges.select("src", "dst").distinct(), 0, 1))
    return both.agg(F.sum("v").alias("vertices"), F.sum("e").alias("edges"))


def degrees(edges: DataFrame) -> DataFrame:
    """In, out and total degree on distinct edges; both ends are counted in one aggregation."""
    ends = edges.select("src", "dst").distinct().select(
        F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                          F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")
    ).select("e.*")
    return ends.groupBy("id").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.count(F.lit(1)).alias("total_degree")
    )


def pagerank(edges: DataFrame, alpha: float = 0.85, tol: float = 1e-6, max_iter: int = 100, hub_edges: int = HUB_EDGES) -> DataFrame:
    """PageRank with uniform restart and dangling mass; stops when the total change is below n*tol.

    Raises where `max_iter` rounds do not get there; a `tol` of 0 asks for exactly `max_iter` rounds.

    Edges carry a salt that splits the out-edges of hubs into parts of about `hub_edges`;
    a hub's vertex row is repeated once per part, so no task sees all edges of one account.
    Vertices are numbered first and edges sorted once by sender, so each round shuffles numbers
    alone, the vertices and pre-aggregated shares, and sorts no edge.
    """
    spark = edges.sparkSession
    links = edges.select("src", "dst").distinct()
    out = degrees(links).select("id", F.col("out_degree").cast("double").alias("out_degree"))
    named = materialize(with_global_index(out, ["id"], "at"), "numbers")
    split = F.greatest(F.ceil(F.col("out_degree") / hub_edges), F.lit(1)).cast("int")
    nodes = materialize(named.select("at", "out_degree", split.alias("parts")), "nodes")
    n = nodes.count()
    if n == 0:
        return named.select("id", F.lit(0.0).alias("pagerank"))
    number = lambda d, end, own: d.join(named.select(F.col("id").alias(end), F.col("at").alias(own)), end).drop(end)
    hubs = nodes.where(F.col("parts") > 1).select(F.col("at").alias("u"), "parts")
    salted = materialize(
        number(number(links, "src", "u"), "dst", "v").join(hubs, "u", "left").select(
            "u", "v", F.pmod(F.xxhash64("v"), F.coalesce("parts", F.lit(1))).cast("int").alias("salt")
        ),
        "edges",
    )
    # Placed once by sender and kept, so a round shuffles vertices but never the edges;
    # a lost part is read again from the written table.
    count = salted.count()
    parts = max(min(spark.sparkContext.defaultParallelism, -(-count // 50_000)), -(-count // hub_edges), 1)
    salted = salted.repartition(parts, "u", "salt").sortWithinPartitions("u", "salt").persist()
    lost = F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("rank"))), F.lit(0.0)).alias("dangling")
    rank, path, seen = write_measured(nodes.withColumn("rank", F.lit(1.0 / n)), "rank", lost)
    for _ in range(max_iter):
        senders = rank.where(F.col("out_degree") > 0).select(
            F.col("at").alias("u"),
            (F.col("rank") / F.col("out_degree")).alias("share"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
        )
        received = salted.join(senders, ["u", "salt"]).groupBy(F.col("v").alias("at")).agg(F.sum("share").alias("got"))
        base = alpha * seen["dangling"] / n + (1.0 - alpha) / n
        following = rank.join(received, "at", "left").select(
            "at", "out_degree", "parts",
            (F.coalesce("got", F.lit(0.0)) * alpha + F.lit(base)).alias("rank"),
            F.col("rank").alias("previous"),
        )
        change = F.sum(F.abs(F.col("rank") - F.col("previous"))).alias("change")
        rank, new_path, seen = write_measured(following, "rank", lost, change)
        drop_stage(spark, path)
        path = new_path
        if seen["change"] < n * tol:
            break
    else:
        if tol > 0:
            salted.unpersist()
            raise RuntimeError("PageRank did not converge; raise max_iter or tol")
    salted.unpersist()
    return named.join(rank, "at").select("id", F.col("rank").alias("pagerank"))


#: With more links than this for each vertex, components are found on the smallest neighbours first.
DENSE = 3


def _stars(links: DataFrame, max_rounds: int) -> tuple[DataFrame, str | None]:
    """Links (u, v) of each vertex but the smallest of its component to that smallest one; and their path, if written.

    `links` holds each pair once, u > v. Alternating large-star and small-star rounds
    (Kiveris et al., 2014): every round only links vertices to smaller neighbours, so long
    chains shrink fast and no task collects a component. The links are written after each
    round. They are stars as soon as a vertex with a smaller neighbour has no other, which the
    table of smallest neighbours tells before a round is begun.
    """
    spark = links.sparkSession
    current, path = links, None
    for _ in range(max_rounds + 1):
        side = lambda u, v, less: current.select(F.col(u).alias("u"), F.col(v).alias("v"), F.lit(less).alias("less"), F.lit(1 - less).alias("more"))
        near = side("u", "v", 1).unionByName(side("v", "u", 0)).groupBy("u").agg(
            F.least(F.min("v"), F.first("u")).alias("m"), F.sum("less").alias("less"), F.sum("more").alias("more")
        )
        left = F.count_if((F.col("less") > 1) | (F.col("less") > 0) & (F.col("more") > 0)).alias("left")
        near, near_path, seen = write_measured(near, "cc-near", left)
        if not seen["left"]:
            drop_stage(spark, near_path)
            return current, path
        # Large star: neighbours larger than u move to u's smallest neighbour.
        large = (
            current.select(F.col("v").alias("u"), F.col("u").alias("w")).join(near.select("u", "m"), "u")
            .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: u and its smaller neighbours move to the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where(F.col("u") != F.col("v")).distinct()
        )
        current, new_path = write_stage(small, "cc")
        drop_stage(spark, near_path)
        if path:
            drop_stage(spark, path)
        path = new_path
    raise RuntimeError("connected components did not settle; raise max_rounds")


def connected_components(edges: DataFrame, max_rounds: int = 100, dense: float = DENSE) -> DataFrame:
    """Component of each vertex, named by its smallest id, on undirected edges.

    The distinct pairs are written once. Rounds of stars (see `_stars`) link each vertex to the
    smallest one of its component. With more than `dense` pairs for each vertex they run on the
    link of each vertex to its smallest neighbour alone, one row a vertex; the names found
    are then put to both ends of all pairs, and only pairs whose names differ, few as a rule,
    take part in further rounds.
    """
    ordered = F.col("src") <= F.col("dst")
    pairs = materialize(
        edges.select(F.when(ordered, F.col("dst")).otherwise(F.col("src")).alias("u"), F.when(ordered, F.col("src")).otherwise(F.col("dst")).alias("v")).distinct(),
        "pairs",
    )
    nodes = materialize(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "vertices")
    links = pairs.where(F.col("u") != F.col("v"))
    named = lambda rows, stars, at, name: rows.join(stars.select(F.col("u").alias(at), F.col("v").alias("_root")), at, "left").withColumn(name, F.coalesce("_root", at)).drop("_root")
    if links.count() <= dense * nodes.count():
        return named(nodes, _stars(links, max_rounds)[0], "id", "component")
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v"))
    thin = materialize(least.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-least")
    first = _stars(thin, max_rounds)[0]
    apart = named(named(links, first, "u", "a"), first, "v", "b").where(F.col("a") != F.col("b"))
    rest = materialize(apart.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-rest")
    found = named(nodes, first, "id", "near")
    return named(found, _stars(rest, max_rounds)[0], "near", "component").select("id", "component")


#: Edges of one triple of colours, where degrees are even.
TRIPLE_EDGES = 4_000_000
#: Edges that a task deals to their triples at a time.
DEALT_EDGES = 1_000_000


def _packed(u: np.ndarray, v: np.ndarray) -> bytes:
    """Edges in order as the four bytes of the steps of u and of v, byte by byte: the high ones are nearly all equal."""
    both = np.stack([np.diff(u, prepend=0), v]).astype("<u4")
    return both.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes()


def _unpacked(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(2, 4, -1)
    step, v = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0].astype(np.int64)
    return np.cumsum(step), v


def _colour(at: np.ndarray, c: int) -> np.ndarray:
    """One of c colours by a hash of a vertex number."""
    mixed = (at.astype(np.uint64) + np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(c)).astype(np.int64)


def _dealt(c: int):
    """Edges (u, v) to the c triples of colours that hold both ends: triple, packed edges."""

    def deal(u: np.ndarray, v: np.ndarray):
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        cu, cv = _colour(u, c), _colour(v, c)
        low, high, third = np.minimum(cu, cv)[:, None], np.maximum(cu, cv)[:, None], np.arange(c)
        first, last = np.minimum(low, third), np.maximum(high, third)
        triple = ((first * c + (low + high + third - first - last)) * c + last).reshape(-1)
        by = np.argsort(triple, kind="stable")
        triple, edge = triple[by], by // c
        starts = np.flatnonzero(np.diff(triple, prepend=-1))
        packets = [_packed(u[e], v[e]) for e in np.split(edge, starts[1:])] if len(starts) else []
        return pa.RecordBatch.from_arrays([pa.array(triple[starts], pa.int64()), pa.array(packets, pa.binary())], names=["triple", "edges"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
            rows += len(batch)
            if rows >= DEALT_EDGES:
                yield deal(*map(np.concatenate, zip(*held)))
                held, rows = [], 0
        if rows:
            yield deal(*map(np.concatenate, zip(*held)))

    return run


def _corners(c: int):
    """Triangles of one triple of colours, by corner: at, n."""

    def corners(packets: pa.Table) -> pa.Table:
        triple = packets.column("triple")[0].as_py()
        want = np.array([triple // c // c, triple // c % c, triple % c])
        u, v = map(np.concatenate, zip(*[_unpacked(p.as_buffer()) for p in packets.column("edges")]))
        ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
        m, size = len(u), len(ids)
        # Edges point from fewer to more neighbours (here), so no list of targets is long.
        rank = np.empty(size, dtype=np.int64)
        rank[np.lexsort((np.arange(size), np.bincount(ends, minlength=size)))] = np.arange(size)
        ends = rank[ends]
        known = np.sort(np.minimum(ends[:m], ends[m:]) * size + np.maximum(ends[:m], ends[m:]))
        u, v = known // size, known % size
        later = np.searchsorted(u, u, side="right") - np.arange(m) - 1
        of = np.empty(size, dtype=np.int64)
        of[rank] = _colour(ids, c)
        n, steps = np.zeros(size, dtype=np.int64), np.concatenate([[0], np.cumsum(later)])
        at = 0
        while at < m:
            to = int(max(at + 1, np.searchsorted(steps, steps[at] + 2_000_000, side="right") - 1))
            first = np.repeat(np.arange(at, to), later[at:to])
            second = first + 1 + np.arange(len(first)) - np.repeat(steps[at:to] - steps[at], later[at:to])
            x, y = v[first], v[second]
            # A triangle of fewer colours lies in several triples and counts in its own one.
            own = (np.sort(np.stack([of[u[first]], of[x], of[y]]), axis=0) == want[:, None]).all(axis=0)
            first, x, y = first[own], x[own], y[own]
            wedge = x * size + y
            closed = known[np.minimum(np.searchsorted(known, wedge), m - 1)] == wedge
            n += np.bincount(np.concatenate([u[first][closed], x[closed], y[closed]]), minlength=size)
            at = to
        n = n[rank]
        seen = np.flatnonzero(n)
        return pa.table({"at": ids[seen], "n": n[seen]})

    return corners


def triangle_counts(pairs: DataFrame, per_task: int = TRIPLE_EDGES) -> DataFrame:
    """id, triangles of every vertex of some triangle; `pairs` (a, b) holds each undirected edge once.

    Vertices get one of c colours by a hash, and an edge goes to the c triples of colours
    that hold both of its ends (Suri and Vassilvitskii, 2011). c grows with the root of the
    edges, so a triple keeps its size, and the edges of a hub are dealt among all triples with
    its colour. No list of a vertex's neighbours travels. Vertices are numbered first, so an
    edge is two whole numbers and travels packed with others of its triple, in about four bytes.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    nodes = materialize(with_global_index(ends, ["id"], "at"), "numbers")
    if nodes.count() >= 1 << 32:
        raise ValueError("vertices are numbered by four bytes")
    number = lambda d, end, out: d.join(nodes.select(F.col("id").alias(end), F.col("at").alias(out)), end).drop(end)
    links, path = write_stage(number(number(pairs.select("a", "b"), "a", "u"), "b", "v"), "links")
    c = max(4, math.ceil(math.sqrt(6 * links.count() / per_task)))
    ship_package(pairs.sparkSession)
    dealt = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).mapInArrow(_dealt(c), "triple long, edges binary")
    found = dealt.groupBy("triple").applyInArrow(_corners(c), "at long, n long")
    sums = materialize(found.groupBy("at").agg(F.sum("n").alias("triangles")), "triangles")
    drop_stage(pairs.sparkSession, path)
    return nodes.join(sums, "at").select("id", "triangles")


def clustering_coef(edges: DataFrame, per_task: int = TRIPLE_EDGES) -> DataFrame:
    """Local clustering coefficient on undirected distinct edges without loops."""
    ordered = F.col("src") <= F.col("dst")
    # Loops and open ends stay here: their accounts are vertices too, with no neighbour.
    pairs = materialize(
        edges.select(F.when(ordered, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(ordered, F.col("dst")).otherwise(F.col("src")).alias("b")).distinct(),
        "pairs",
    )
    apart = F.coalesce((F.col("a") != F.col("b")).cast("long"), F.lit(0))
    degree = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id"), apart.alias("n")).groupBy("id").agg(F.sum("n").alias("degree")), "degree")
    # A vertex with one neighbour is in no triangle: the spokes of a star need not travel.
    ends = degree.where(F.col("degree") == 1).select("id")
    inner = pairs.where(F.col("a") != F.col("b"))
    inner = inner.join(ends.withColumnRenamed("id", "a"), "a", "left_anti").join(ends.withColumnRenamed("id", "b"), "b", "left_anti")
    triangles = triangle_counts(materialize(inner.select("a", "b"), "inner"), per_task)
    possible = F.col("degree") * (F.col("degree") - 1)
    return degree.join(triangles, "id", "left").select(
        "id", F.coalesce(F.try_divide(2.0 * F.coalesce("triangles", F.lit(0)), possible), F.lit(0.0)).alias("clustering_coef")
    )


def attach_component(edges: DataFrame, comps: DataFrame) -> DataFrame:
    """Component of each edge; both ends share it, so one join on the source is enough."""
    return edges.join(comps.select(F.col("id").alias("src"), "component"), "src")


def component_stats(edges: DataFrame, comps: DataFrame, amount: str, flag: str, k: int = 200) -> DataFrame:
    """Size, edges, flagged edges, rate and amounts of the `k` largest components."""
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    flagged = F.col(flag) == 1
    # Summed by source first: the join meets a row for each account, not for each edge.
    by_source = edges.groupBy("src").agg(
        F.count(F.lit(1)).alias("total_edges"), F.count_if(flagged).alias("fraud_edges"),
        F.sum(amount).alias("total_amount"), F.sum(F.when(flagged, F.col(amount))).alias("fraud_amount"),
    )
    sums = attach_component(by_source, comps).groupBy("component").agg(
        F.sum("total_edges").alias("total_edges"), F.sum("fraud_edges").alias("fraud_edges"),
        F.sum("total_amount").alias("total_amount"), F.coalesce(F.sum("fraud_amount"), F.lit(0.0)).alias("fraud_amount"),
    )
    return (
        sizes.join(sums, "component")
        .withColumn("fraud_rate", F.col("fraud_edges") / F.greatest(F.col("total_edges"), F.lit(1)))
        .orderBy(F.col("size").desc(), "component").limit(k)
    )


def graph_features(edges: DataFrame, flagged: DataFrame, **pagerank_options) -> DataFrame:
    """PageRank, degrees, clustering and flagged mark per account."""
    ranks = pagerank(edges, **pagerank_options)
    base = join_features(ranks, "id", degrees(edges), clustering_coef(edges))
    return mark_join(base, flagged, "id", "is_fraud_account").withColumnRenamed("id", "account")


def subgraph(edges: DataFrame, comps: DataFrame, component: Column | str, n: int = 80, seed: int = 42) -> DataFrame:
    """Edges among at most `n` hash-chosen vertices of one component."""
    wanted = F.lit(component) if isinstance(component, str) else component
    chosen = comps.where(F.col("component") == wanted).orderBy(hash_order("id", seed=seed), "id").limit(n).select("id")
    chosen = materialize(chosen, "chosen")
    return edges.join(chosen.withColumnRenamed("id", "src"), "src", "left_semi").join(
        chosen.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
