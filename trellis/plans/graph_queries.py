"""Pattern, projection, aggregation and mutation queries over the ``trade`` graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators.match import Match, cypher_order, top_k
from trellis.operators.merge import create_nodes, create_rels, merge_nodes, merge_rels, set_rel_property
from trellis.functions import scalar as S
from trellis.plans import fixtures as fx
from trellis.plans.oracle_sql import cte
from trellis.plans.registry import register
from trellis.model import Graph
from trellis.sources.sinks import query_echo as echo_rows


# ------------------------------------------------------------------ M5 A2 R7
@register("placed_top10", ids="M5 A2 R7", sql="""
SELECT c.c_name AS name, count(o.o_orderkey) AS n_orders
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_name ORDER BY n_orders DESC, name LIMIT 10""")
def placed_top10(spark, sf):
    """MATCH (c:Customer)-[:PLACED]->(o:Order) RETURN c.name, count(o) ORDER BY 2 DESC LIMIT 10"""
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer").out("r", "PLACED", "o", "Order")
    counts = m.agg({"name": "c.c_name"}, n_orders=F.count(m.c("o")))
    return top_k(counts, 10, ("n_orders", "desc"), ("name", "asc"))


# ------------------------------------------------------------------ M1 M3 M4 R1
@register("label_scan", ids="M1 R1", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def label_scan(spark, sf):
    g = fx.trade_graph(spark, sf)
    return g.match("s", "Supplier").ret("s.s_suppkey", "s.s_name", "s.s_nationkey", "s.s_acctbal")


@register("inline_filter", ids="M3 R1", sql="""
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""")
def inline_filter(spark, sf):
    g = fx.trade_graph(spark, sf)
    return g.match("c", "Customer", c_mktsegment="BUILDING").ret("c.c_custkey", "c.c_name", "c.c_acctbal")


@register("where_ne", ids="M4 R1", sql="""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def where_ne(spark, sf):
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer")
    return m.where(m.c("c.c_mktsegment") != "BUILDING").ret("c.c_custkey", "c.c_mktsegment")


# ------------------------------------------------------------------ M2 A1
@register("all_nodes_by_label", ids="M2 A1", sql="""
SELECT label, count(*) AS n_nodes, count(DISTINCT id) AS n_ids FROM (
  SELECT 'Region' AS label, CAST(r_regionkey AS VARCHAR) AS id FROM region UNION ALL
  SELECT 'Nation', CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL
  SELECT 'Customer', CAST(c_custkey AS VARCHAR) FROM customer UNION ALL
  SELECT 'Supplier', CAST(s_suppkey AS VARCHAR) FROM supplier UNION ALL
  SELECT 'Part', CAST(p_partkey AS VARCHAR) FROM part UNION ALL
  SELECT 'Order', CAST(o_orderkey AS VARCHAR) FROM orders) GROUP BY label""")
def all_nodes_by_label(spark, sf):
    """MATCH (n) RETURN labels(n), count(n)"""
    g = fx.trade_graph(spark, sf)
    return g.all_nodes().groupBy("label").agg(F.count("*").alias("n_nodes"), F.countDistinct("id").alias("n_ids"))


# ------------------------------------------------------------------ M5 R2
@register("one_hop_props", ids="M5 R2", sql="""
SELECT c.c_name, o.o_orderdate AS orderdate, o.o_totalprice
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = 'AUTOMOBILE'""")
def one_hop_props(spark, sf):
    """MATCH (c:Customer)-[r:PLACED]->(o:Order) WHERE c.c_mktsegment = 'AUTOMOBILE'
    RETURN c.c_name, r.orderdate, o.o_totalprice"""
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer", c_mktsegment="AUTOMOBILE").out("r", "PLACED", "o", "Order")
    return m.ret("c.c_name", "r.orderdate", "o.o_totalprice")


# ------------------------------------------------------------------ M6
@register("two_hop_chain", ids="M6", sql="""
SELECT c.c_mktsegment, p.p_brand, count(*) AS n_lines, round(sum(l.l_quantity), 2) AS qty
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY c.c_mktsegment, p.p_brand""")
def two_hop_chain(spark, sf):
    """MATCH (c:Customer)-[:PLACED]->(o:Order)-[r:CONTAINS]->(p:Part)
    RETURN c.c_mktsegment, p.p_brand, count(*), sum(r.quantity)"""
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer").out("r1", "PLACED", "o", "Order").out("r", "CONTAINS", "p", "Part")
    return m.agg({"c_mktsegment": "c.c_mktsegment", "p_brand": "p.p_brand"},
                 n_lines=F.count(F.lit(1)), qty=F.round(F.sum(m.c("r.quantity")), 2))


# ------------------------------------------------------------------ M7 G13 G14 A1 A7
@register("anon_edge_count", ids="M7 A1", sql="""
SELECT type, count(*) AS n_rels FROM (
  SELECT 'IN_REGION' AS type FROM nation UNION ALL
  SELECT 'IN_NATION' FROM customer UNION ALL SELECT 'IN_NATION' FROM supplier UNION ALL
  SELECT 'PLACED' FROM orders UNION ALL SELECT 'CONTAINS' FROM lineitem UNION ALL
  SELECT 'SUPPLIES' FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) GROUP BY type""")
def anon_edge_count(spark, sf):
    """MATCH ()-[r]->() RETURN type(r), count(r)"""
    g = fx.trade_graph(spark, sf)
    return g.all_rels().groupBy("type").agg(F.count("*").alias("n_rels"))


@register("graph_stats", ids="G14 A1", sql="""
SELECT (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
     + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders) AS node_count,
       (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
     + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)
     + (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) AS relationship_count""")
def graph_stats(spark, sf):
    return fx.trade_graph(spark, sf).stats()


_TRADE_PROPS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}
_REL_PROPS = {"orders": [("o_orderdate", "orderdate")],
              "lineitem": [("l_linenumber", "linenumber"), ("l_quantity", "quantity"),
                           ("l_extendedprice", "extendedprice")]}


def _inspect_sql() -> str:
    labels = ["Region", "Nation", "Customer", "Supplier", "Part", "Order"]
    types = ["IN_REGION", "IN_NATION", "PLACED", "CONTAINS", "SUPPLIES"]
    parts = [f"SELECT 'label' AS kind, '{x}' AS name" for x in labels]
    parts += [f"SELECT 'relationshipType', '{x}'" for x in types]
    for t, cols in _TRADE_PROPS.items():
        parts += [f"SELECT DISTINCT 'propertyKey', '{c}' FROM {t} WHERE {c} IS NOT NULL" for c in cols]
    for t, cols in _REL_PROPS.items():
        parts += [f"SELECT DISTINCT 'propertyKey', '{alias}' FROM {t} WHERE {c} IS NOT NULL" for c, alias in cols]
    return "SELECT DISTINCT kind, name FROM (\n" + "\nUNION ALL ".join(parts) + ")"


@register("inspect_graph", ids="G13 A7", sql=_inspect_sql())
def inspect_graph(spark, sf):
    return fx.trade_graph(spark, sf).inspect()


@register("schema_context", ids="G15", sql="""
SELECT (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
     + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders) AS node_count,
       'Customer,Nation,Order,Part,Region,Supplier' AS labels,
       'CONTAINS,IN_NATION,IN_REGION,PLACED,SUPPLIES' AS relationship_types,
       (SELECT string_agg(name, ',' ORDER BY name) FROM (""" + _inspect_sql() + """) WHERE kind = 'propertyKey') AS property_keys""")
def schema_context(spark, sf):
    ctx = fx.trade_graph(spark, sf).schema_context()
    return ctx.select("node_count", F.array_join("labels", ",").alias("labels"),
                      F.array_join("relationship_types", ",").alias("relationship_types"),
                      F.array_join("property_keys", ",").alias("property_keys"))


@register("query_echo", ids="G16", sql="""
SELECT 'trade' AS graph_name, 'MATCH (c:Customer)-[:PLACED]->(o:Order) RETURN c.c_mktsegment, count(*)' AS cypher_query,
       '{"c_mktsegment":"' || c_mktsegment || '","n_orders":' || CAST(count(*) AS VARCHAR) || '}' AS result
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def query_echo(spark, sf):
    """``{graph_name, cypher_query, result}`` echo of the result rows."""
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer").out("r", "PLACED", "o", "Order")
    res = m.agg({"c_mktsegment": "c.c_mktsegment"}, n_orders=F.count(F.lit(1)))
    text = "MATCH (c:Customer)-[:PLACED]->(o:Order) RETURN c.c_mktsegment, count(*)"
    return echo_rows("trade", text, res)


# ------------------------------------------------------------------ M8 M12 M13 M14
@register("unlabelled_endpoint", ids="M8", sql="""
SELECT x_label, n_name, count(*) AS n FROM (
  SELECT 'Customer' AS x_label, c_nationkey AS k FROM customer UNION ALL
  SELECT 'Supplier', s_nationkey FROM supplier) x JOIN nation ON n_nationkey = k GROUP BY x_label, n_name""")
def unlabelled_endpoint(spark, sf):
    """MATCH (x)-[:IN_NATION]->(n:Nation) RETURN labels(x), n.n_name, count(*)"""
    g = fx.trade_graph(spark, sf)
    m = g.match("n", "Nation").inc("r", "IN_NATION", "x")
    return m.agg({"x_label": "labels(x)", "n_name": "n.n_name"}, n=F.count(F.lit(1)))


@register("cross_match", ids="M12", sql="""
SELECT c.c_name, o.o_orderpriority AS o_priority, l.l_linenumber FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = l.l_suppkey""")
def cross_match(spark, sf):
    """UNWIND lineitem AS row MATCH (c:Customer {c_custkey: row.l_suppkey}), (o:Order {o_orderkey: row.l_orderkey})
    RETURN c.c_name, ...: two endpoints, bound from one row by equi joins."""
    g = fx.trade_graph(spark, sf)
    m = Match.from_rows(g, fx.table(spark, sf, "lineitem"))
    m = m.bind("c", "Customer", c_custkey=m.c("row.l_suppkey")).bind("o", "Order", o_orderkey=m.c("row.l_orderkey"))
    return m.ret(c_name="c.c_name", o_priority="o.o_orderpriority", l_linenumber="row.l_linenumber")


@register("unlabelled_start", ids="M8", sql="""
SELECT x_label, x, n_name FROM (
  SELECT 'Customer' AS x_label, c_custkey AS x, c_nationkey AS k FROM customer UNION ALL
  SELECT 'Supplier', s_suppkey, s_nationkey FROM supplier) x JOIN nation ON n_nationkey = k""")
def unlabelled_start(spark, sf):
    """MATCH (x)-[:IN_NATION]->(n:Nation) RETURN labels(x), x, n.n_name, from every node."""
    g = fx.trade_graph(spark, sf)
    m = g.match("x").out("r", "IN_NATION", "n", "Nation")
    return m.ret(x_label="labels(x)", x="x", n_name="n.n_name")


@register("row_match", ids="M13 M14", sql="""
SELECT n.n_name, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name""")
def row_match(spark, sf):
    """UNWIND orders AS row MATCH (c:Customer {c_custkey: row.o_custkey})
    MATCH (c)-[:IN_NATION]->(n:Nation) RETURN n.n_name, count(*), sum(row.o_totalprice)"""
    g = fx.trade_graph(spark, sf)
    rows = fx.table(spark, sf, "orders")
    m1 = Match.from_rows(g, rows)
    m1 = m1.bind("c", "Customer", c_custkey=m1.c("row.o_custkey"))
    m2 = g.match("c", "Customer").out("r", "IN_NATION", "n", "Nation")
    m = m1.join(m2)
    return m.agg({"n_name": "n.n_name"}, n_orders=F.count(F.lit(1)),
                 total=F.round(F.sum(m.c("row.o_totalprice")), 2))


# ------------------------------------------------------------------ R3 R4 R5 R6 R8 R9
@register("path_object", ids="R3", sql="""
SELECT n_nationkey, to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}) AS n
FROM nation""")
def path_object(spark, sf):
    """MATCH (n:Nation) RETURN n (the node as an object)"""
    g = fx.trade_graph(spark, sf)
    m = g.match("n", "Nation")
    return m.ret("n.n_nationkey", n=F.to_json(F.struct(m.c("n.n_nationkey").alias("n_nationkey"),
                                                       m.c("n.n_name").alias("n_name"),
                                                       m.c("n.n_regionkey").alias("n_regionkey"))))


@register("order_desc_nulls", ids="R5", sql=cte("usage_apps") + """
SELECT c_custkey, CAST(last_upgraded_on AS DATE) AS last_upgraded
FROM usage_apps ORDER BY last_upgraded_on DESC NULLS FIRST, c_custkey LIMIT 20""")
def order_desc_nulls(spark, sf):
    """ORDER BY x DESC puts nulls first (Cypher: null is the greatest value)."""
    apps = fx.usage_apps(spark, sf)
    out = cypher_order(apps, ("last_upgraded_on", "desc"), ("c_custkey", "asc")).limit(20)
    return out.select("c_custkey", F.to_date("last_upgraded_on").alias("last_upgraded"))


@register("limit_ordered", ids="R6", sql="""
SELECT p_partkey, p_name FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25""")
def limit_ordered(spark, sf):
    g = fx.trade_graph(spark, sf)
    m = g.match("p", "Part")
    return top_k(m.ret("p.p_partkey", "p.p_name", "p.p_retailprice"), 25,
                 ("p_retailprice", "desc"), ("p_partkey", "asc")).drop("p_retailprice")


@register("sorted_names", ids="R9 A7", sql="""
SELECT r.r_name, string_agg(n.n_name, ',' ORDER BY n.n_name) AS nations
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""")
def sorted_names(spark, sf):
    """MATCH (n:Nation)-[:IN_REGION]->(r:Region) RETURN r.r_name, sorted list of n.n_name.
    (A list per region: bounded by the nation dimension, not by the fact data.)"""
    g = fx.trade_graph(spark, sf)
    m = g.match("n", "Nation").out("x", "IN_REGION", "r", "Region")
    return m.agg({"r_name": "r.r_name"}, nations=F.array_join(F.sort_array(F.collect_list(m.c("n.n_name"))), ","))


@register("distinct_return", ids="R4", sql="""
SELECT DISTINCT c.c_mktsegment, n.n_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def distinct_return(spark, sf):
    g = fx.trade_graph(spark, sf)
    m = g.match("c", "Customer").out("r", "IN_NATION", "n", "Nation")
    return m.ret("c.c_mktsegment", "n.n_name", distinct=True)


# ------------------------------------------------------------------ F7 A4 A5
@register("created_stamp", ids="F7 F20", sql="""
SELECT c_custkey, epoch_ms(TIMESTAMP '2024-06-01 00:00:00') AS created FROM customer""")
def created_stamp(spark, sf):
    """MATCH (c:Customer) SET c.created = timestamp()  (``now`` injected)"""
    g = fx.trade_graph(spark, sf)
    g2, _ = merge_nodes(g, "Customer", fx.table(spark, sf, "customer"), {"c_custkey": F.col("c_custkey")},
                        set_={"created": S.timestamp_millis("2024-06-01T00:00:00Z")})
    return g2.nodes["Customer"].select("c_custkey", "created")


@register("load_check_text", ids="A4 A5", sql="""
SELECT 'Nodes loaded: ' || CAST(count(*) AS VARCHAR) AS msg,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') > 0 AS has_building FROM customer""")
def load_check_text(spark, sf):
    g = fx.trade_graph(spark, sf)
    c = g.nodes["Customer"]
    return c.agg(F.concat(F.lit("Nodes loaded: "), F.count("*").cast("string")).alias("msg"),
                 (F.count_if(F.col("c_mktsegment") == "BUILDING") > 0).alias("has_building"))


# ------------------------------------------------------------------ G7 F3-F6
@register("set_edge_distance", ids="G7 F3 F4 F5 F6", sql="""
WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
c AS (SELECT s, p,
        ((s * 1777) % 18000) / 100.0 - 90 AS lat1, ((s * 3571) % 36000) / 100.0 - 180 AS lon1,
        ((p * 1777) % 18000) / 100.0 - 90 AS lat2, ((p * 3571) % 36000) / 100.0 - 180 AS lon2 FROM e)
SELECT s AS src, p AS dst, round(2 * 6371000.0 * asin(sqrt(least(1.0,
   pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
   + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2)))) / 1000) AS km
FROM c""")
def set_edge_distance(spark, sf):
    """MATCH (s:Supplier)-[r:SUPPLIES]->(p:Part)
    SET r.km = round(distance(point(s), point(p)) / 1000)"""
    g = fx.trade_graph(spark, sf)
    slat, slon = fx.coordinates("s_suppkey")
    plat, plon = fx.coordinates("p_partkey")
    g = g.with_nodes("Supplier", g.nodes["Supplier"].withColumn("lat", slat).withColumn("lon", slon), "s_suppkey")
    g = g.with_nodes("Part", g.nodes["Part"].withColumn("lat", plat).withColumn("lon", plon), "p_partkey")
    g = set_rel_property(g, ("SUPPLIES", "Supplier", "Part"), "km",
                         lambda s, d, r: F.round(S.distance(S.point(s("lat"), s("lon")),
                                                            S.point(d("lat"), d("lon"))) / 1000))
    return g.rels[("SUPPLIES", "Supplier", "Part")].select("src", "dst", "km")


# ------------------------------------------------------------------ G1 G2
@register("create_nodes", ids="G1", sql=cte("halves") + """
SELECT c_custkey, c_acctbal FROM cust_old UNION ALL SELECT c_custkey, c_acctbal FROM cust_new""")
def create_nodes_q(spark, sf):
    old, new = fx.customer_halves(spark, sf)
    g = Graph().with_nodes("Customer", old, "c_custkey")
    g = create_nodes(g, "Customer", new)
    return g.nodes["Customer"].select("c_custkey", "c_acctbal")


@register("create_rels", ids="G2", sql=cte("halves") + """
SELECT c.c_custkey, o.o_orderkey, o.o_orderdate AS orderdate
FROM orders o JOIN cust_old c ON c.c_custkey = o.o_custkey""")
def create_rels_q(spark, sf):
    """MATCH (c:Customer {c_custkey: row.o_custkey}), (o:Order {o_orderkey: row.o_orderkey})
    CREATE (c)-[:BOUGHT {orderdate: row.o_orderdate}]->(o); rows without a customer create nothing."""
    old, _ = fx.customer_halves(spark, sf)
    orders = fx.table(spark, sf, "orders")
    g = Graph().with_nodes("Customer", old, "c_custkey").with_nodes("Order", orders, "o_orderkey")
    g = create_rels(g, "BOUGHT", "Customer", "Order", orders, {"c_custkey": "o_custkey"},
                    {"o_orderkey": "o_orderkey"}, {"orderdate": "o_orderdate"}, rel_id=F.col("o_orderkey"))
    return g.rels[("BOUGHT", "Customer", "Order")].select(
        F.col("src").alias("c_custkey"), F.col("dst").alias("o_orderkey"), "orderdate")


@register("create_both_directions", ids="G2", sql="""
SELECT 'Customer' AS src_label, c_custkey AS src, CAST(n_nationkey AS BIGINT) AS dst FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL
SELECT 'Nation', CAST(n_nationkey AS BIGINT), c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def create_both_directions(spark, sf):
    """CREATE (c)-[:LIVES]->(n), (n)-[:LIVES]->(c) for every customer row."""
    g = fx.trade_graph(spark, sf)
    c = fx.table(spark, sf, "customer")
    g = create_rels(g, "LIVES", "Customer", "Nation", c, {"c_custkey": "c_custkey"},
                    {"n_nationkey": "c_nationkey"}, rel_id=F.col("c_custkey"), both_directions=True)
    parts = [df.select(F.lit(s).alias("src_label"), F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
             for (t, s, d), df in g.rel_tables("LIVES")]
    return parts[0].unionAll(parts[1])


# ------------------------------------------------------------------ G3-G6 G8 G10
_G4_SQL = cte("halves") + """
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NULL THEN n.c_name ELSE o.c_name END AS c_name,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
       CASE WHEN o.c_custkey IS NULL THEN 'created' WHEN n.c_custkey IS NOT NULL THEN 'matched' END AS state
FROM cust_old o FULL OUTER JOIN cust_new n ON o.c_custkey = n.c_custkey"""


def _g4_merge(spark, sf, twice=False):
    old, new = fx.customer_halves(spark, sf)
    g = Graph().with_nodes("Customer", old.select("c_custkey", "c_name", "c_acctbal"), "c_custkey")
    kw = dict(on_create={"c_name": F.col("c_name"), "c_acctbal": F.col("c_acctbal"), "state": F.lit("created")},
              on_match={"c_acctbal": F.col("c_acctbal"), "state": F.lit("matched")})
    g, touched = merge_nodes(g, "Customer", new, {"c_custkey": F.col("c_custkey")}, **kw)
    return g, touched


@register("merge_nodes", ids="G3", sql=cte("halves") + """
SELECT c_custkey, c_name, c_acctbal FROM cust_old
UNION ALL SELECT c_custkey, NULL, NULL FROM cust_new WHERE c_custkey NOT IN (SELECT c_custkey FROM cust_old)""")
def merge_nodes_q(spark, sf):
    """MERGE (n:Customer {c_custkey: row.c_custkey}): matched nodes stay, new keys are created bare."""
    old, new = fx.customer_halves(spark, sf)
    g = Graph().with_nodes("Customer", old.select("c_custkey", "c_name", "c_acctbal"), "c_custkey")
    g, _ = merge_nodes(g, "Customer", new, {"c_custkey": F.col("c_custkey")})
    return g.nodes["Customer"]


@register("merge_on_create_on_match", ids="G4", sql=_G4_SQL)
def merge_on_create_on_match(spark, sf):
    g, _ = _g4_merge(spark, sf)
    return g.nodes["Customer"].select("c_custkey", "c_name", "c_acctbal", "state")


@register("merge_return", ids="G8", sql=cte("halves") + """
SELECT n.c_custkey, o.c_custkey IS NULL AS created, n.c_acctbal
FROM cust_new n LEFT JOIN cust_old o ON o.c_custkey = n.c_custkey""")
def merge_return(spark, sf):
    """MERGE ... RETURN n.c_custkey, created, n.c_acctbal: only the touched nodes."""
    _, touched = _g4_merge(spark, sf)
    return touched.select("c_custkey", "created", "c_acctbal")


@register("merge_set", ids="G5 G3", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
    l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def merge_set(spark, sf):
    """MERGE (l:Line {l_orderkey: row.l_orderkey, l_linenumber: row.l_linenumber}) SET l.p = row.p ...
    over lineitem, whose two-column key repeats: the last row by all columns wins."""
    li = fx.table(spark, sf, "lineitem")
    props = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    g, _ = merge_nodes(Graph(), "Line", li, {"l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber")},
                       set_={p: F.col(p) for p in props}, order_by=[F.col(c) for c in li.columns])
    return g.nodes["Line"].select("l_orderkey", "l_linenumber", *props)


@register("merge_twice", ids="G10 G5", sql=cte("halves") + """
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
       coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal
FROM cust_old o FULL OUTER JOIN cust_new n ON o.c_custkey = n.c_custkey""")
def merge_twice(spark, sf):
    """The same MERGE ... SET run twice equals running it once."""
    old, new = fx.customer_halves(spark, sf)
    g = Graph().with_nodes("Customer", old.select("c_custkey", "c_name", "c_acctbal"), "c_custkey")
    s = {"c_name": F.col("c_name"), "c_acctbal": F.col("c_acctbal")}
    g, _ = merge_nodes(g, "Customer", new, {"c_custkey": F.col("c_custkey")}, set_=s)
    g, _ = merge_nodes(g, "Customer", new, {"c_custkey": F.col("c_custkey")}, set_=s)
    return g.nodes["Customer"]


@register("merge_rels", ids="G6", sql=cte("halves") + """
SELECT DISTINCT o_custkey AS src, o_orderkey AS dst, o_orderdate AS orderdate FROM (
  SELECT * FROM ord_old UNION ALL SELECT * FROM ord_new)
WHERE o_custkey IN (SELECT c_custkey FROM customer)""")
def merge_rels_q(spark, sf):
    """MATCH (c:Customer {..}), (o:Order {..}) MERGE (c)-[:PLACED {orderdate: row.o_orderdate}]->(o)"""
    old, new = fx.order_halves(spark, sf)
    cust = fx.table(spark, sf, "customer")
    orders = fx.table(spark, sf, "orders")
    g = Graph().with_nodes("Customer", cust, "c_custkey").with_nodes("Order", orders, "o_orderkey")
    g = g.with_rels("PLACED", "Customer", "Order", old.join(cust.select("c_custkey"),
                    F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        F.col("o_orderkey").cast("string").alias("rel_id"), F.col("o_custkey").alias("src"),
        F.col("o_orderkey").alias("dst"), F.col("o_orderdate").alias("orderdate")))
    g, _ = merge_rels(g, "PLACED", "Customer", "Order", new, {"c_custkey": "o_custkey"},
                      {"o_orderkey": "o_orderkey"}, key_props={"orderdate": F.col("o_orderdate")})
    return g.rels[("PLACED", "Customer", "Order")].select("src", "dst", "orderdate")
