"""Variable-length patterns, shortest paths and ranking over the ``handoff`` graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators.match import top_k
from trellis.operators.paths import bfs, constrained_paths, k_paths, shortest_path, weighted_paths
from trellis.operators.rank import degree, page_rank_top
from trellis.plans import fixtures as fx
from trellis.plans.oracle_sql import FIXTURES
from trellis.plans.registry import register

# [choice] parameters of the registered path queries
MAX_COST_CENTS = 1500
K_PATHS = 3
K_PATHS_MAX_LEN = 3
MAX_LEN = 3
PAGE_RANK_ROUNDS = 20
DAMPING = 0.85


def _with(*ctes: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join([FIXTURES["handoff"].strip()] + [c.strip() for c in ctes]) + "\n"


START = "start AS (SELECT src AS s FROM handoff GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)"
WEDGES = "we AS (SELECT src AS a, dst AS b, min(w) AS w FROM handoff GROUP BY src, dst)"
WEDGES_IN = "we AS (SELECT dst AS a, src AS b, min(w) AS w FROM handoff GROUP BY src, dst)"


def _start_df(g):
    """Start node rule: the largest out-degree, ties by the smaller id (from the data, not a literal)."""
    deg = degree(g, "User", "HANDOFF", "out")
    return top_k(deg, 1, ("degree", "desc"), ("id", "asc")).select("id")


def _relax_ctes(rounds: int) -> list[str]:
    """Unrolled Bellman-Ford rounds on (dist, hops) in lexicographic order."""
    out = ["r0 AS (SELECT s AS id, CAST(0 AS BIGINT) AS d, 0 AS h FROM start)"]
    for k in range(1, rounds + 1):
        out.append(f"""r{k} AS MATERIALIZED (
  SELECT id, d, min(h) AS h FROM (
    SELECT id, d, h, min(d) OVER (PARTITION BY id) AS md FROM (
      SELECT id, d, h FROM r{k - 1}
      UNION ALL SELECT e.b, r.d + e.w, r.h + 1 FROM r{k - 1} r JOIN we e ON e.a = r.id))
  WHERE d = md GROUP BY id, d)""")
    return out


def _route_ctes(final: str) -> list[str]:
    """Predecessor = smallest id that reaches the node on an optimal (dist, hops) label; walk from the start."""
    return [
        f"fin AS (SELECT * FROM {final})",
        """par AS (SELECT v.id, min(u.id) AS pred FROM fin v JOIN we e ON e.b = v.id
               JOIN fin u ON u.id = e.a AND u.d + e.w = v.d AND u.h + 1 = v.h WHERE v.h > 0 GROUP BY v.id)""",
        """rt(id, route) AS (SELECT s, CAST(s AS VARCHAR) FROM start
               UNION ALL SELECT p.id, rt.route || ',' || CAST(p.id AS VARCHAR) FROM rt JOIN par p ON p.pred = rt.id)""",
    ]


def _route_text(col: str = "route"):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",")


# ------------------------------------------------------------------ M9 M10 R4
@register("undirected_hop", ids="M9 R4", sql=_with() + """
SELECT DISTINCT src AS a, dst AS b FROM handoff UNION SELECT dst, src FROM handoff""")
def undirected_hop(spark, sf):
    """MATCH (a:User)-[:HANDOFF]-(b:User) RETURN DISTINCT a.user_id, b.user_id"""
    g = fx.handoff_graph(spark, sf)
    return g.match("a", "User").both("r", "HANDOFF", "b", "User").ret(a="a", b="b", distinct=True)


@register("exact_two_undirected", ids="M10", sql=_with(
    "ud AS (SELECT eid, src AS a, dst AS b FROM handoff UNION ALL SELECT eid, dst, src FROM handoff)") + """
SELECT u1.a, u2.b, count(*) AS n_trails FROM ud u1 JOIN ud u2 ON u2.a = u1.b AND u2.eid <> u1.eid
GROUP BY u1.a, u2.b""")
def exact_two_undirected(spark, sf):
    """MATCH (a:User)-[:HANDOFF*2]-(b:User) RETURN a, b, count(*)  (no relationship twice)"""
    g = fx.handoff_graph(spark, sf)
    m = g.match("a", "User").var_hop("HANDOFF", "b", "User", 2, 2, direction="both", keep=["b"])
    return m.agg({"a": "a", "b": "b"}, n_trails=m.rows())


# ------------------------------------------------------------------ M11 M15 F8 F9 F10 P11
@register("trails_1_3", ids="M11 M15 F8 F9 F10 P11", sql=_with("""
t(start, cur, hops, eids, route) AS (
  SELECT src, dst, 1, [eid], CAST(src AS VARCHAR) || ',' || CAST(dst AS VARCHAR) FROM handoff
  UNION ALL
  SELECT t.start, h.dst, t.hops + 1, list_append(t.eids, h.eid), t.route || ',' || CAST(h.dst AS VARCHAR)
  FROM t JOIN handoff h ON h.src = t.cur WHERE t.hops < 3 AND NOT list_contains(t.eids, h.eid))""",
    recursive=True) + "SELECT start, cur AS dst, hops, route FROM t")
def trails_1_3(spark, sf):
    """MATCH path = (a:User)-[:HANDOFF*1..3]->(b:User)
    RETURN a, b, length(path), [n IN nodes(path) | n.user_id]"""
    g = fx.handoff_graph(spark, sf)
    m = g.match("a", "User").var_hop("HANDOFF", "b", "User", 1, 3, path="p", carry="user_id")
    return m.ret(start="a", dst="b", hops=m.c("p.length"), route=_route_text("p__carried"))


# ------------------------------------------------------------------ P1
@register("bfs_all_from", ids="P1", sql=_with(START, """
bfs(id, d) AS (SELECT s, 0 FROM start UNION
               SELECT h.dst, b.d + 1 FROM bfs b JOIN handoff h ON h.src = b.id WHERE b.d < 200)""",
    recursive=True) + "SELECT id AS user_id, min(d) AS depth FROM bfs GROUP BY id")
def bfs_all_from(spark, sf):
    """Unweighted directed reachability with depth from the busiest node."""
    g = fx.handoff_graph(spark, sf)
    res = bfs(g, _start_df(g), "HANDOFF", "User", "out", with_route=False)
    return res.select(F.col("id").alias("user_id"), "depth")


@register("shortest_path_unweighted", ids="P1", sql=_with(
    START,
    "ud AS (SELECT src AS a, dst AS b FROM handoff UNION SELECT dst, src FROM handoff)",
    """bfs(id, d) AS (SELECT s, 0 FROM start UNION
               SELECT ud.b, bfs.d + 1 FROM bfs JOIN ud ON ud.a = bfs.id WHERE bfs.d < 200)""",
    "dist AS (SELECT id, min(d) AS d FROM bfs GROUP BY id)",
    """par AS (SELECT v.id, min(u.id) AS pred FROM dist v JOIN ud ON ud.b = v.id
               JOIN dist u ON u.id = ud.a AND u.d = v.d - 1 GROUP BY v.id)""",
    """rt(id, route) AS (SELECT s, CAST(s AS VARCHAR) FROM start
               UNION ALL SELECT p.id, rt.route || ',' || CAST(p.id AS VARCHAR) FROM rt JOIN par p ON p.pred = rt.id)""",
    recursive=True) + "SELECT dist.id AS user_id, dist.d AS depth, rt.route FROM dist JOIN rt USING (id)")
def shortest_path_unweighted(spark, sf):
    """shortestPath((a)-[:HANDOFF*]-(b)) from the busiest node to every node (undirected)."""
    g = fx.handoff_graph(spark, sf)
    res = bfs(g, _start_df(g), "HANDOFF", "User", "both")
    return res.select(F.col("id").alias("user_id"), "depth", _route_text().alias("route"))


# ------------------------------------------------------------------ P2 P3 P4
_RELAX_ROUNDS = 60


@register("shortest_path_weighted", ids="P2 P3 P4", sql=_with(
    START, WEDGES, *_relax_ctes(_RELAX_ROUNDS), *_route_ctes(f"r{_RELAX_ROUNDS}"), recursive=True) + """
SELECT fin.id AS user_id, fin.d AS path_weight, fin.h AS hops, rt.route FROM fin JOIN rt USING (id)""")
def shortest_path_weighted(spark, sf):
    """algo.SPpaths(source, weightProp: w, pathCount: 1) to every reachable node."""
    g = fx.handoff_graph(spark, sf)
    res = weighted_paths(g, _start_df(g), "HANDOFF", "User", F.col("w"))
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("bigint").alias("path_weight"),
                      "hops", _route_text().alias("route"))


@register("shortest_path_pair", ids="P2", sql=_with(
    START, WEDGES,
    "target AS (SELECT dst AS t FROM handoff GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 1)",
    *_relax_ctes(_RELAX_ROUNDS), *_route_ctes(f"r{_RELAX_ROUNDS}"), recursive=True) + """
SELECT fin.d AS pathWeight, rt.route FROM fin JOIN rt USING (id) WHERE id = (SELECT t FROM target)""")
def shortest_path_pair(spark, sf):
    """shortest_path(graph, 'User', 'user_id', source, target, 'HANDOFF', 'w') → pathWeight, route.
    Source: the busiest sender; target: the busiest receiver (both read from the data)."""
    g = fx.handoff_graph(spark, sf)
    src = _start_df(g).first()["id"]
    indeg = degree(g, "User", "HANDOFF", "in")
    dst = top_k(indeg, 1, ("degree", "desc"), ("id", "asc")).first()["id"]
    res = shortest_path(g, "User", "user_id", src, dst, "HANDOFF", "w")
    return res.select(F.col("pathWeight").cast("bigint").alias("pathWeight"),
                      F.array_join(F.transform("route", lambda x: x.cast("string")), ",").alias("route"))


WEDGES_TYPES = """we AS (SELECT a, b, min(w) AS w FROM (SELECT src AS a, dst AS b, w FROM handoff
                                                UNION ALL SELECT src, dst, w FROM follow) GROUP BY a, b)"""


@register("shortest_path_rel_types", ids="P3", sql=_with(START, WEDGES_TYPES, *_relax_ctes(_RELAX_ROUNDS)) + f"""
SELECT id AS user_id, d AS path_weight, h AS hops FROM r{_RELAX_ROUNDS}""")
def shortest_path_rel_types(spark, sf):
    """algo.SPpaths(relTypes: ['HANDOFF', 'FOLLOW'], weightProp: 'w'): several types as one edge set."""
    g = fx.handoff_graph(spark, sf, with_follow=True)
    res = weighted_paths(g, _start_df(g), ["HANDOFF", "FOLLOW"], "User", F.col("w"), with_route=False)
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("bigint").alias("path_weight"), "hops")


@register("shortest_path_stops", ids="P4", sql=_with(START, """
bfs(id, d) AS (SELECT s, 0 FROM start UNION
               SELECT h.dst, b.d + 1 FROM bfs b JOIN handoff h ON h.src = b.id WHERE b.d < 200)""",
    recursive=True) + "SELECT id AS user_id, min(d) AS stops FROM bfs GROUP BY id")
def shortest_path_stops(spark, sf):
    """Another weight: every relationship costs one stop, so the path weight is its stop count."""
    g = fx.handoff_graph(spark, sf)
    res = weighted_paths(g, _start_df(g), "HANDOFF", "User", F.lit(1), with_route=False)
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("int").alias("stops"))


# ------------------------------------------------------------------ P6 P8
@register("shortest_path_maxlen", ids="P6", sql=_with(START, WEDGES, *_relax_ctes(MAX_LEN)) + f"""
SELECT id AS user_id, d AS path_weight, h AS hops FROM r{MAX_LEN}""")
def shortest_path_maxlen(spark, sf):
    """Cheapest path of at most MAX_LEN relationships (maxLen)."""
    g = fx.handoff_graph(spark, sf)
    res = weighted_paths(g, _start_df(g), "HANDOFF", "User", F.col("w"), max_len=MAX_LEN, with_route=False)
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("bigint").alias("path_weight"), "hops")


@register("rel_direction", ids="P8", sql=_with(START, WEDGES_IN, *_relax_ctes(_RELAX_ROUNDS)) + f"""
SELECT id AS user_id, d AS path_weight, h AS hops FROM r{_RELAX_ROUNDS}""")
def rel_direction(spark, sf):
    """relDirection: 'incoming' — cheapest paths that end at the busiest node."""
    g = fx.handoff_graph(spark, sf)
    res = weighted_paths(g, _start_df(g), "HANDOFF", "User", F.col("w"), direction="in", with_route=False)
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("bigint").alias("path_weight"), "hops")


# ------------------------------------------------------------------ P5
def _layers_sql(layers: int) -> list[str]:
    """Min cost over walks of exactly k relationships, k = 0..layers."""
    out = ["l0 AS (SELECT s AS id, CAST(0 AS BIGINT) AS c, 0 AS k FROM start)",
           "ce AS (SELECT src AS a, dst AS b, min(w) AS w FROM handoff GROUP BY src, dst)"]
    for k in range(1, layers + 1):
        out.append(f"""l{k} AS MATERIALIZED (SELECT e.b AS id, min(l.c + e.w) AS c, {k} AS k
                 FROM l{k - 1} l JOIN ce e ON e.a = l.id WHERE l.c + e.w <= {MAX_COST_CENTS} GROUP BY e.b)""")
    return out


_LAYERS = 40


@register("shortest_path_constrained", ids="P5", sql=_with(START, *_layers_sql(_LAYERS)) + """
SELECT id AS user_id, k AS hops, c AS cost FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, c) AS rn FROM (
""" + "\n    UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(0, _LAYERS + 1)) + ")) WHERE rn = 1")
def shortest_path_constrained(spark, sf):
    """Fewest hops (weightProp = 1 per relationship) with total cost w <= MAX_COST_CENTS (costProp/maxCost)."""
    g = fx.handoff_graph(spark, sf)
    res = constrained_paths(g, _start_df(g), "HANDOFF", "User", F.lit(1), F.col("w"), MAX_COST_CENTS, with_route=False)
    return res.select(F.col("id").alias("user_id"), F.col("dist").cast("int").alias("hops"),
                      F.col("cost").cast("bigint").alias("cost"))


# ------------------------------------------------------------------ P7
@register("k_paths", ids="P7", sql=_with(START, f"""
t(cur, hops, d, nodes, eids) AS (
  SELECT s, 0, CAST(0 AS BIGINT), [s], CAST([] AS BIGINT[]) FROM start
  UNION ALL
  SELECT h.dst, t.hops + 1, t.d + h.w, list_append(t.nodes, h.dst), list_append(t.eids, h.eid)
  FROM t JOIN handoff h ON h.src = t.cur WHERE t.hops < {K_PATHS_MAX_LEN} AND NOT list_contains(t.eids, h.eid))""",
    recursive=True) + f"""
SELECT cur AS user_id, rn AS rank, d AS path_weight, array_to_string(nodes, ',') AS route FROM (
  SELECT *, row_number() OVER (PARTITION BY cur ORDER BY d, hops, nodes, eids) AS rn FROM t WHERE hops > 0)
WHERE rn <= {K_PATHS}""")
def k_paths_q(spark, sf):
    """algo.SPpaths(pathCount: K_PATHS, maxLen: K_PATHS_MAX_LEN) from the busiest node to every target."""
    g = fx.handoff_graph(spark, sf)
    res = k_paths(g, _start_df(g), "HANDOFF", "User", F.col("w"), K_PATHS, K_PATHS_MAX_LEN)
    return res.select(F.col("cur").alias("user_id"), F.col("rank").cast("bigint").alias("rank"),
                      F.col("dist").cast("bigint").alias("path_weight"), _route_text("nodes").alias("route"))


# ------------------------------------------------------------------ P9 P10 A3
def _pagerank_sql(rounds: int, last: str) -> str:
    ctes = [
        "nodes AS (SELECT DISTINCT user_id AS id FROM events)",
        "e AS (SELECT DISTINCT src, dst FROM handoff)",
        "deg AS (SELECT src, count(*) AS deg FROM e GROUP BY src)",
        "ew AS (SELECT e.src, e.dst, 1.0 / deg AS inv FROM e JOIN deg USING (src))",
        "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)",
        "dang AS (SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM deg))",
        "r0 AS (SELECT id, 1.0 / (SELECT n FROM nn) AS score FROM nodes)",
    ]
    for k in range(1, rounds + 1):
        ctes.append(f"""r{k} AS MATERIALIZED (
  SELECT nodes.id, (1 - {DAMPING}) / (SELECT n FROM nn)
     + {DAMPING} * (coalesce(c.s, 0) + coalesce((SELECT sum(score) FROM r{k - 1} WHERE id IN (SELECT id FROM dang)), 0)
                    / (SELECT n FROM nn)) AS score
  FROM nodes LEFT JOIN (SELECT ew.dst, sum(r.score * ew.inv) AS s FROM r{k - 1} r JOIN ew ON ew.src = r.id
                        GROUP BY ew.dst) c ON c.dst = nodes.id)""")
    return _with(*ctes) + f"SELECT {last.format(table=f'r{rounds}')}"


@register("page_rank_top10", ids="P9 P10", sql=_pagerank_sql(
    PAGE_RANK_ROUNDS, "node, round(score, 9) AS score FROM (SELECT id AS node, score FROM {table} ORDER BY score DESC, node LIMIT 10)"))
def page_rank_top10(spark, sf):
    """page_rank(graph, 'User', 'HANDOFF', 'user_id', 10)"""
    g = fx.handoff_graph(spark, sf)
    return page_rank_top(g, "User", "HANDOFF", "user_id", 10, damping=DAMPING, max_rounds=PAGE_RANK_ROUNDS)


@register("page_rank_sum", ids="P9", sql=_pagerank_sql(PAGE_RANK_ROUNDS, "round(sum(score), 9) AS total FROM {table}"))
def page_rank_sum(spark, sf):
    """Scores over the whole ranked graph sum to 1 (dangling mass handed back)."""
    from trellis.operators.rank import page_rank
    g = fx.handoff_graph(spark, sf)
    ranks = page_rank(g, "User", "HANDOFF", damping=DAMPING, max_rounds=PAGE_RANK_ROUNDS)
    return ranks.agg(F.round(F.sum("score"), 9).alias("total"))


@register("degree_top10", ids="A3", sql=_with("nodes AS (SELECT DISTINCT user_id FROM events)") + """
SELECT n.user_id, count(h.eid) AS degree FROM nodes n LEFT JOIN handoff h ON h.src = n.user_id
GROUP BY n.user_id ORDER BY degree DESC, n.user_id LIMIT 10""")
def degree_top10(spark, sf):
    """Top 10 users by outgoing handoffs."""
    g = fx.handoff_graph(spark, sf)
    deg = degree(g, "User", "HANDOFF", "out").withColumnRenamed("id", "user_id")
    return top_k(deg, 10, ("degree", "desc"), ("user_id", "asc"))
