"""Account graphs built from line items: customers pay suppliers and parts' accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import rounded
from riskweave.operators import aggregates, graph, joins, sampling
from riskweave.plans.registry import query
from riskweave.plans.views import rnd
from riskweave.session import materialize


def transfers(t):
    """Every line item as a transfer from the ordering customer to the account numbered like the part.

    Both ends share one id space, so the network has directed cycles and triangles.
    """
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return t.lineitem.join(orders, "l_orderkey").select(
        F.concat(F.lit("a"), F.col("o_custkey")).alias("src"), F.concat(F.lit("a"), F.col("l_partkey")).alias("dst"),
        "l_orderkey", "l_linenumber", "l_suppkey", "o_orderdate", F.col("l_extendedprice").alias("amount"), "l_quantity",
        (F.col("l_returnflag") == "R").cast("int").alias("is_fraud"), F.col("l_linestatus").alias("tx_type"),
    )


TRANSFERS = """(SELECT 'a' || o_custkey AS src, 'a' || l_partkey AS dst, l_orderkey, l_linenumber, l_suppkey, o_orderdate, l_extendedprice AS amount,
  l_quantity, CAST(l_returnflag = 'R' AS INT) AS is_fraud, l_linestatus AS tx_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def ring_transfers(t):
    """Payments of customers on their orders, the network of the component study."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return t.lineitem.join(orders, "l_orderkey").select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("src"), F.concat(F.lit("o"), F.col("l_orderkey")).alias("dst"),
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"), (F.col("l_returnflag") == "R").cast("int").alias("is_fraud"),
    )


RING = """(SELECT 'c' || o_custkey AS src, 'o' || l_orderkey AS dst, l_orderkey, l_linenumber, l_extendedprice AS amount, CAST(l_returnflag = 'R' AS INT) AS is_fraud
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
RING_EDGES = f"(SELECT src, dst, arg_max(is_fraud, (l_orderkey, l_linenumber, amount)) AS is_fraud, sum(amount) AS total_amount FROM {RING} GROUP BY src, dst)"


def ring_edges(t):
    return graph.edge_table(ring_transfers(t), "src", "dst", ["l_orderkey", "l_linenumber", "amount"], ["is_fraud"], "amount")


def components_sql(rounds: int, source: str = RING) -> str:
    """Unrolled rounds in which each vertex takes the smallest name next to it."""
    steps = ", ".join(
        f"c{i} AS MATERIALIZED (SELECT s.a AS id, min(c{i - 1}.component) AS component FROM s JOIN c{i - 1} ON c{i - 1}.id = s.b GROUP BY s.a)" for i in range(1, rounds + 1)
    )
    return f"""WITH e AS MATERIALIZED (SELECT DISTINCT src AS a, dst AS b FROM {source}),
  s AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e),
  c0 AS (SELECT DISTINCT a AS id, a AS component FROM s), {steps}, comps AS (SELECT id, component FROM c{rounds})"""


COMPONENTS = components_sql(6)


@query("edge_table", f"""
SELECT src, dst, arg_max(amount, (o_orderdate, l_orderkey, l_linenumber, l_suppkey, amount)) AS amount,
  arg_max(is_fraud, (o_orderdate, l_orderkey, l_linenumber, l_suppkey, amount)) AS is_fraud,
  arg_max(tx_type, (o_orderdate, l_orderkey, l_linenumber, l_suppkey, amount)) AS tx_type, count(*) AS transactions,
  {rnd('sum(amount)', 3)} AS total_amount FROM {TRANSFERS} GROUP BY src, dst""")
def edge_table(t):
    order = ["o_orderdate", "l_orderkey", "l_linenumber", "l_suppkey", "amount"]
    out = graph.edge_table(transfers(t), "src", "dst", order, ["amount", "is_fraud", "tx_type"], "amount")
    return out.withColumn("total_amount", rounded("total_amount", 3))


@query("graph_counts", f"""
SELECT (SELECT count(*) FROM (SELECT src FROM {TRANSFERS} UNION SELECT dst FROM {TRANSFERS})) AS vertices,
  (SELECT count(*) FROM (SELECT DISTINCT src, dst FROM {TRANSFERS})) AS edges""")
def graph_counts(t):
    return graph.graph_counts(transfers(t))


DEGREES = f"""SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree, count(*) AS total_degree FROM (
  SELECT src AS id, 0 AS i, 1 AS o FROM (SELECT DISTINCT src, dst FROM {TRANSFERS})
  UNION ALL SELECT dst, 1, 0 FROM (SELECT DISTINCT src, dst FROM {TRANSFERS})) GROUP BY id"""


@query("degrees", DEGREES)
def degrees(t):
    return graph.degrees(transfers(t))


FLAGGED = f"SELECT src AS account FROM {TRANSFERS} WHERE is_fraud = 1 UNION SELECT dst FROM {TRANSFERS} WHERE is_fraud = 1"


def flagged(t):
    return joins.flagged_accounts(transfers(t), "src", "dst", F.col("is_fraud") == 1)


@query("flagged_accounts", FLAGGED)
def flagged_accounts(t):
    return flagged(t)


@query("mark_join", f"SELECT id, CAST(id IN ({FLAGGED}) AS INT) AS is_fraud_account FROM ({DEGREES})")
def mark_join(t):
    return joins.mark_join(graph.vertices(transfers(t)), flagged(t), "id", "is_fraud_account")


def pagerank_sql(rounds: int) -> str:
    """Unrolled power iteration; each round is stored so it is computed once."""
    steps = [
        f"l AS MATERIALIZED (SELECT DISTINCT src, dst FROM {TRANSFERS})",
        "v AS MATERIALIZED (SELECT id, coalesce(d, 0) AS d, (SELECT count(*) FROM (SELECT src FROM l UNION SELECT dst FROM l)) AS n "
        "FROM (SELECT src AS id FROM l UNION SELECT dst FROM l) LEFT JOIN (SELECT src, count(*) AS d FROM l GROUP BY src) ON id = src)",
        "r0 AS MATERIALIZED (SELECT id, d, n, 1.0::DOUBLE / n AS rank FROM v)",
    ]
    for i in range(rounds):
        steps.append(
            f"r{i + 1} AS MATERIALIZED (SELECT r.id, r.d, r.n, 0.85::DOUBLE * (coalesce(g.got, 0) + (SELECT coalesce(sum(rank) FILTER (d = 0), 0) FROM r{i}) / r.n) "
            f"+ 0.15::DOUBLE / r.n AS rank FROM r{i} r LEFT JOIN (SELECT dst, sum(rank / d) AS got FROM l JOIN r{i} ON src = id GROUP BY dst) g ON r.id = g.dst)"
        )
    return "WITH " + ", ".join(steps)


@query("pagerank_3_rounds", pagerank_sql(3) + f" SELECT id, {rnd('rank', 9)} AS pagerank FROM r3")
def pagerank_3_rounds(t):
    out = graph.pagerank(transfers(t), tol=0.0, max_iter=3)
    return out.withColumn("pagerank", rounded("pagerank", 9))


@query("pagerank", pagerank_sql(25) + f" SELECT id, {rnd('rank', 8)} AS pagerank FROM r25")
def pagerank(t):
    return graph.pagerank(transfers(t), tol=1e-13).withColumn("pagerank", rounded("pagerank", 8))


@query("connected_components", COMPONENTS + " SELECT id, component FROM comps")
def connected_components(t):
    return graph.connected_components(ring_transfers(t))


@query("component_stats", COMPONENTS + f""", sizes AS (SELECT component, count(*) AS size FROM comps GROUP BY component),
  sums AS (SELECT component, count(*) AS total_edges, count(*) FILTER (is_fraud = 1) AS fraud_edges, sum(total_amount) AS total_amount,
    coalesce(sum(total_amount) FILTER (is_fraud = 1), 0) AS fraud_amount FROM {RING_EDGES} JOIN comps ON id = src GROUP BY component)
SELECT component, size, total_edges, fraud_edges, {rnd('total_amount', 3)} AS total_amount, {rnd('fraud_amount', 3)} AS fraud_amount,
  {rnd('fraud_edges / total_edges')} AS fraud_rate FROM sizes JOIN sums USING (component) ORDER BY size DESC, component LIMIT 200""")
def component_stats(t):
    edges = materialize(ring_edges(t), "ring")
    out = graph.component_stats(edges, graph.connected_components(edges), "total_amount", "is_fraud")
    return out.withColumns({"total_amount": rounded("total_amount", 3), "fraud_amount": rounded("fraud_amount", 3), "fraud_rate": rounded("fraud_rate")})


@query("high_rate_components", COMPONENTS + f""", sums AS (SELECT component, count(*) AS total_edges, count(*) FILTER (is_fraud = 1) AS fraud_edges
  FROM {RING_EDGES} JOIN comps ON id = src GROUP BY component), big AS (
  SELECT component, size, fraud_edges / total_edges AS rate FROM (SELECT component, count(*) AS size FROM comps GROUP BY component) JOIN sums USING (component)
  ORDER BY size DESC, component LIMIT 200)
SELECT component, size, {rnd('rate')} AS fraud_rate FROM big WHERE rate > 0.5""")
def high_rate_components(t):
    edges = materialize(ring_edges(t), "ring")
    stats = graph.component_stats(edges, graph.connected_components(edges), "total_amount", "is_fraud")
    return sampling.having(stats, F.col("fraud_rate") > 0.5).select("component", "size", rounded("fraud_rate").alias("fraud_rate"))


NETWORK = components_sql(12, TRANSFERS)
NETWORK_EDGES = f"""(SELECT src, dst, arg_max(is_fraud, (o_orderdate, l_orderkey, l_linenumber, l_suppkey, amount)) AS is_fraud, sum(amount) AS total_amount
  FROM {TRANSFERS} GROUP BY src, dst)"""


def network_edges(t):
    order = ["o_orderdate", "l_orderkey", "l_linenumber", "l_suppkey", "amount"]
    return graph.edge_table(transfers(t), "src", "dst", order, ["is_fraud"], "amount")


@query("network_components", NETWORK + " SELECT id, component FROM comps")
def network_components(t):
    """Components of the whole network of transfers, one of which holds nearly all accounts."""
    return graph.connected_components(transfers(t))


@query("network_component_stats", NETWORK + f""", sizes AS (SELECT component, count(*) AS size FROM comps GROUP BY component),
  sums AS (SELECT component, count(*) AS total_edges, count(*) FILTER (is_fraud = 1) AS fraud_edges, sum(total_amount) AS total_amount,
    coalesce(sum(total_amount) FILTER (is_fraud = 1), 0) AS fraud_amount FROM {NETWORK_EDGES} JOIN comps ON id = src GROUP BY component)
SELECT component, size, total_edges, fraud_edges, {rnd('total_amount', 3)} AS total_amount, {rnd('fraud_amount', 3)} AS fraud_amount,
  {rnd('fraud_edges / total_edges')} AS fraud_rate FROM sizes JOIN sums USING (component) ORDER BY size DESC, component LIMIT 200""")
def network_component_stats(t):
    edges = materialize(network_edges(t), "network")
    out = graph.component_stats(edges, graph.connected_components(edges), "total_amount", "is_fraud")
    return out.withColumns({"total_amount": rounded("total_amount", 3), "fraud_amount": rounded("fraud_amount", 3), "fraud_rate": rounded("fraud_rate")})


TRIANGLES = f"""WITH p AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM {TRANSFERS} WHERE src <> dst),
  deg AS (SELECT id, count(*) AS d FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY id),
  tri AS MATERIALIZED (SELECT x.a AS i, x.b AS j, y.b AS k FROM p x JOIN p y ON x.b = y.a JOIN p z ON z.a = x.a AND z.b = y.b),
  per AS (SELECT id, count(*) AS n FROM (SELECT i AS id FROM tri UNION ALL SELECT j FROM tri UNION ALL SELECT k FROM tri) GROUP BY id)"""
CLUSTERING = "SELECT id, CASE WHEN d < 2 THEN 0.0 ELSE 2.0 * coalesce(n, 0) / (d * (d - 1)) END AS clustering_coef FROM deg LEFT JOIN per USING (id)"


@query("clustering_coef", f"{TRIANGLES} SELECT id, {rnd('clustering_coef')} AS clustering_coef FROM ({CLUSTERING})")
def clustering_coef(t):
    return graph.clustering_coef(transfers(t)).withColumn("clustering_coef", rounded("clustering_coef"))


FEATURES_SQL = pagerank_sql(25) + TRIANGLES.replace("WITH p", ", p", 1) + f""", f AS (
  SELECT r25.id AS account, rank AS pagerank, in_degree, out_degree, total_degree, clustering_coef, CAST(r25.id IN ({FLAGGED}) AS INT) AS is_fraud_account
  FROM r25 JOIN ({DEGREES}) USING (id) JOIN ({CLUSTERING}) c USING (id))"""


def account_features(t):
    return graph.graph_features(transfers(t), flagged(t), tol=1e-13)


@query("graph_features", FEATURES_SQL + f"""
SELECT account, {rnd('pagerank', 8)} AS pagerank, in_degree, out_degree, total_degree, {rnd('clustering_coef')} AS clustering_coef, is_fraud_account FROM f""")
def graph_features(t):
    return account_features(t).withColumns({"pagerank": rounded("pagerank", 8), "clustering_coef": rounded("clustering_coef")})


@query("graph_feature_means", FEATURES_SQL + f"""
SELECT is_fraud_account, count(*) AS rows, {rnd('avg(pagerank)', 8)} AS mean_pagerank, {rnd('avg(in_degree)')} AS mean_in_degree,
  {rnd('avg(out_degree)')} AS mean_out_degree, {rnd('avg(clustering_coef)')} AS mean_clustering_coef FROM f GROUP BY is_fraud_account""")
def graph_feature_means(t):
    cols = ["pagerank", "in_degree", "out_degree", "clustering_coef"]
    out = aggregates.group_means(account_features(t), "is_fraud_account", cols)
    return out.select("is_fraud_account", "rows", *[rounded(f"mean_{c}", 8 if c == "pagerank" else 6).alias(f"mean_{c}") for c in cols])


@query("subgraph", COMPONENTS + f""", top AS (SELECT component FROM comps GROUP BY component ORDER BY count(*) DESC, component LIMIT 1),
  picked AS (SELECT id FROM comps WHERE component = (SELECT component FROM top) ORDER BY md5(concat_ws('|', id, '42')), id LIMIT 80)
SELECT DISTINCT src, dst FROM {RING} WHERE src IN (SELECT id FROM picked) AND dst IN (SELECT id FROM picked)""")
def subgraph(t):
    edges = materialize(ring_edges(t), "ring")
    comps = graph.connected_components(edges)
    largest = comps.groupBy("component").count().orderBy(F.col("count").desc(), "component").first()["component"]
    return graph.subgraph(edges, comps, largest).select("src", "dst")
