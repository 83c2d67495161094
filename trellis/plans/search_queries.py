"""Pair search, the path call with all options, patterns over several labels, path objects,
nodes that share a key, node-only graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.model import Graph
from trellis.operators.match import top_k
from trellis.operators.merge import create_nodes, set_rel_property
from trellis.operators.paths import between, best_paths
from trellis.operators.rank import degree
from trellis.plans import fixtures as fx
from trellis.plans.oracle_sql import cte
from trellis.plans.path_queries import START, _start_df, _with
from trellis.plans.registry import register

# [choice] parameters of the path call
OPTION_MAX_LEN = 4
OPTION_MAX_COST = 12
OPTION_PATHS = 5


# ------------------------------------------------------------------ P1 pair form
@register("shortest_path_between", ids="P1", sql=_with(
    START,
    "target AS (SELECT max(dst) AS t FROM handoff)",
    "ud AS (SELECT src AS a, dst AS b FROM handoff UNION SELECT dst, src FROM handoff)",
    """bfs(id, d) AS (SELECT s, 0 FROM start UNION
               SELECT ud.b, bfs.d + 1 FROM bfs JOIN ud ON ud.a = bfs.id WHERE bfs.d < 200)""",
    "dist AS (SELECT id, min(d) AS d FROM bfs GROUP BY id)",
    """par AS (SELECT v.id, min(u.id) AS pred FROM dist v JOIN ud ON ud.b = v.id
               JOIN dist u ON u.id = ud.a AND u.d = v.d - 1 GROUP BY v.id)""",
    """rt(id, route) AS (SELECT s, CAST(s AS VARCHAR) FROM start
               UNION ALL SELECT p.id, rt.route || ',' || CAST(p.id AS VARCHAR) FROM rt JOIN par p ON p.pred = rt.id)""",
    recursive=True) + "SELECT dist.d AS length, rt.route FROM dist JOIN rt USING (id) WHERE id = (SELECT t FROM target)")
def shortest_path_between_q(spark, sf):
    """shortestPath((a)-[:HANDOFF*]-(b)) for one pair: the busiest sender and the largest receiver id.
    Two searches that stop where they meet."""
    g = fx.handoff_graph(spark, sf)
    target = g.rels["HANDOFF", "User", "User"].agg(F.max("dst").alias("id"))
    res = between(g, _start_df(g), target, "HANDOFF", "User", "both")
    return res.select(F.col("depth").alias("length"), F.array_join(F.transform("route", lambda x: x.cast("string")), ",").alias("route"))


# ------------------------------------------------------------------ P5 P6 P7 in one call
@register("path_options", ids="P5 P6 P7", sql=_with(
    START,
    "target AS (SELECT dst AS t FROM handoff GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 1)",
    f"""t(cur, hops, d, c, nodes, eids) AS (
  SELECT s, 0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), [s], CAST([] AS BIGINT[]) FROM start
  UNION ALL
  SELECT h.dst, t.hops + 1, t.d + h.w, t.c + 1 + h.eid % 5, list_append(t.nodes, h.dst), list_append(t.eids, h.eid)
  FROM t JOIN handoff h ON h.src = t.cur
  WHERE t.hops < {OPTION_MAX_LEN} AND t.c + 1 + h.eid % 5 <= {OPTION_MAX_COST} AND NOT list_contains(t.eids, h.eid))""",
    recursive=True) + f"""
SELECT rank, d AS path_weight, c AS path_cost, hops, array_to_string(nodes, ',') AS route FROM (
  SELECT *, row_number() OVER (ORDER BY d, hops, nodes, eids) AS rank FROM t
  WHERE hops > 0 AND cur = (SELECT t FROM target)) WHERE rank <= {OPTION_PATHS}""")
def path_options(spark, sf):
    """One call with all options: the OPTION_PATHS cheapest trails (w) from the busiest sender to the busiest
    receiver, of at most OPTION_MAX_LEN relationships and a total cost of at most OPTION_MAX_COST."""
    g = fx.handoff_graph(spark, sf)
    users = g.nodes["User"]
    src = _start_df(g).select(F.col("id").alias("user_id"))
    dst = top_k(degree(g, "User", "HANDOFF", "in"), 1, ("degree", "desc"), ("id", "asc")).select(F.col("id").alias("user_id"))
    # both ends come from the data: they are marked by a property, the call finds them by its value
    marked = (users.join(src.withColumn("is_src", F.lit("from")), "user_id", "left")
              .join(dst.withColumn("is_dst", F.lit("to")), "user_id", "left"))
    g = g.with_nodes("User", marked, "user_id")
    res = best_paths(g, "User", "user_id", None, None, "HANDOFF", F.col("w"), 1 + F.pmod(F.col("rel_id"), F.lit(5)), OPTION_MAX_COST,
                     OPTION_MAX_LEN, OPTION_PATHS, source_where=F.col("is_src") == "from", target_where=F.col("is_dst") == "to")
    return res.select(F.col("rank").cast("bigint").alias("rank"), F.col("pathWeight").cast("bigint").alias("path_weight"),
                      F.col("pathCost").cast("bigint").alias("path_cost"), "hops",
                      F.array_join(F.transform("route", lambda x: x.cast("string")), ",").alias("route"))


# ------------------------------------------------------------------ M10 M11 over several labels
@register("trails_several_labels", ids="M10 M11", sql="""
WITH e AS (SELECT 'S' || s_suppkey AS src, 'N' || s_nationkey AS dst FROM supplier
           UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer
           UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation),
ud AS (SELECT src AS eid, src, dst FROM e),     -- each of these has one relationship of its own
b AS (SELECT eid, src AS a, dst AS b FROM ud UNION ALL SELECT eid, dst, src FROM ud)
SELECT CAST(substr(x.a, 2) AS BIGINT) AS supplier, CASE substr(y.b, 1, 1) WHEN 'S' THEN 'Supplier' WHEN 'C' THEN 'Customer' ELSE 'Region' END AS far_label,
       count(*) AS n_trails
FROM b x JOIN b y ON y.a = x.b AND y.eid <> x.eid WHERE x.a LIKE 'S%' GROUP BY 1, 2""")
def trails_several_labels(spark, sf):
    """MATCH (s:Supplier)-[:IN_NATION|IN_REGION*2]-(x) RETURN s.s_suppkey, labels(x), count(*):
    trails pass nodes of several labels and relationships of several tables."""
    g = fx.trade_graph(spark, sf)
    m = g.match("s", "Supplier").var_hop(["IN_NATION", "IN_REGION"], "x", None, 2, 2, direction="both", keep=["labels(x)"])
    return m.agg({"supplier": "s.s_suppkey", "far_label": "labels(x)"}, n_trails=m.rows())


@register("untyped_after_hop", ids="M11 M10", sql="""
SELECT c_custkey AS customer, CAST(count(*) AS BIGINT) AS n FROM customer c
JOIN (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) o ON o.k = c.c_nationkey
GROUP BY c_custkey HAVING count(*) > 1""")
def untyped_after_hop(spark, sf):
    """MATCH (c:Customer)-[:IN_NATION]->(n:Nation)<-[*1..1]-(x) RETURN c, count(*): the untyped step never
    goes back over the relationship that the first step took, so the customer does not meet itself."""
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer").out("r", "IN_NATION", "n", "Nation").var_hop(None, "x", None, 1, 1, direction="in", keep=[])
    # + 1: the customer itself, which the oracle counts
    return m.agg({"customer": "c.c_custkey"}, n=m.rows() + 1)


# ------------------------------------------------------------------ R3 M15
@register("trail_objects", ids="R3 M15", sql="""
SELECT s_suppkey AS supplier, 2 AS hops, 'Supplier>Nation>Region' AS labels, 'IN_NATION>IN_REGION' AS types,
       s_name || '>' || n_name || '>' || r_name AS names, CAST(s_suppkey AS VARCHAR) || '>' || CAST(n_nationkey AS VARCHAR) AS rel_ids
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def trail_objects(spark, sf):
    """MATCH path = (s:Supplier)-[:IN_NATION|IN_REGION*2]->(r:Region) RETURN path, as STRUCT<nodes, rels, hops>"""
    g = fx.trade_graph(spark, sf)
    m = (g.match("s", "Supplier").var_hop(["IN_NATION", "IN_REGION"], "r", "Region", 2, 2, path="p").path_object("p"))
    p = F.col("p__object")
    join = lambda items, fn: F.array_join(F.transform(items, fn), ">")
    name = lambda n: F.coalesce(n["props"]["s_name"], n["props"]["n_name"], n["props"]["r_name"])
    return m.df.select(m.c("s.s_suppkey").alias("supplier"), p["hops"].alias("hops"), join(p["nodes"], lambda n: n["label"]).alias("labels"),
                       join(p["rels"], lambda r: r["type"]).alias("types"), join(p["nodes"], name).alias("names"),
                       join(p["rels"], lambda r: r["id"]).alias("rel_ids"))


# ------------------------------------------------------------------ G1 G7 with a key that exists
@register("create_existing_key", ids="G1", sql=cte("halves") + """
SELECT c.c_custkey, c.half, count(o.o_orderkey) AS n_orders
FROM (SELECT c_custkey, 'old' AS half FROM cust_old UNION ALL SELECT c_custkey, 'new' FROM cust_new) c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND c.half = 'old' GROUP BY c.c_custkey, c.half""")
def create_existing_key(spark, sf):
    """CREATE (:Customer {c_custkey: ...}) for keys that exist, then a hop: the orders stay with the old nodes."""
    old, new = fx.customer_halves(spark, sf)
    orders = fx.table(spark, sf, "orders")
    g = Graph().with_nodes("Customer", old.select("c_custkey", F.lit("old").alias("half")), "c_custkey").with_nodes("Order", orders, "o_orderkey")
    g = g.with_rels("PLACED", "Customer", "Order", orders.join(old.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        F.col("o_orderkey").alias("rel_id"), F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")))
    g = create_nodes(g, "Customer", new.select("c_custkey", F.lit("new").alias("half")))
    hop = g.match("c", "Customer").out("r", "PLACED", "o", "Order")
    placed = hop.df.groupBy(hop.c("c").alias("id")).agg(F.count("*").alias("n"))
    every = g.match("c", "Customer")
    return (every.df.select(every.c("c").alias("id"), every.c("c.c_custkey").alias("c_custkey"), every.c("c.half").alias("half"))
            .join(placed, "id", "left").groupBy("c_custkey", "half").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n_orders")))


@register("set_edge_shared_key", ids="G7 G1", sql=cte("halves") + """
SELECT o_orderkey, c.c_acctbal AS balance FROM orders o JOIN cust_old c ON c.c_custkey = o.o_custkey""")
def set_edge_shared_key(spark, sf):
    """SET r.balance = c.c_acctbal where several customers share a key: each relationship is written once."""
    old, new = fx.customer_halves(spark, sf)
    orders = fx.table(spark, sf, "orders")
    g = Graph().with_nodes("Customer", old, "c_custkey").with_nodes("Order", orders, "o_orderkey")
    g = g.with_rels("PLACED", "Customer", "Order", orders.join(old.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        F.col("o_orderkey").alias("rel_id"), F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")))
    g = create_nodes(g, "Customer", new)
    g = set_rel_property(g, ("PLACED", "Customer", "Order"), "balance", lambda s, d, r: s("c_acctbal"))
    return g.rels["PLACED", "Customer", "Order"].select(F.col("dst").alias("o_orderkey"), "balance")


# ------------------------------------------------------------------ G13-G15 A3 before any relationship
@register("node_only_graph", ids="G14 G15 A3", sql="""
SELECT count(*) AS node_count, CAST(0 AS BIGINT) AS relationship_count, 'Customer' AS labels, '' AS relationship_types,
       'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' AS property_keys, CAST(0 AS BIGINT) AS degrees FROM customer""")
def node_only_graph(spark, sf):
    """Statistics, schema context and degrees after the first node load, when there is no relationship yet."""
    g = Graph().with_nodes("Customer", fx.table(spark, sf, "customer"), "c_custkey")
    ctx = g.schema_context()
    total = degree(g, "Customer").agg(F.sum("degree").alias("degrees"))
    # two one-row aggregates side by side
    return ctx.select("node_count", "relationship_count", *[F.array_join(c, ",").alias(c) for c in ("labels", "relationship_types", "property_keys")]) \
        .crossJoin(F.broadcast(total))
