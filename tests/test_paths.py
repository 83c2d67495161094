"""Properties of the path algorithms on a small weighted graph with a hub,
a zero-weight cycle and parallel relationships."""

import heapq
import itertools

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators.paths import bfs, constrained_paths, k_paths, shortest_path, weighted_paths

EDGES = [  # rel_id, src, dst, w, c
    (1, 0, 1, 4, 1), (2, 0, 2, 1, 5), (3, 2, 1, 1, 5), (4, 1, 3, 2, 1), (5, 2, 3, 7, 1),
    (6, 3, 4, 0, 0), (7, 4, 3, 0, 0), (8, 4, 5, 3, 2), (9, 0, 5, 20, 0), (10, 1, 3, 1, 9),
]
EDGES += [(100 + i, 6, i % 6, 1, 1) for i in range(12)]  # node 6: a hub holding half the relationships


def graph(spark):
    nodes = spark.createDataFrame([(i, f"v{i}") for i in range(8)], "id long, name string")
    e = spark.createDataFrame(EDGES, "rel_id long, src long, dst long, w long, c long")
    return Graph().with_nodes("V", nodes, "id").with_rels("E", "V", "V", e)


def dijkstra(src, weight):
    adj = {}
    for rid, s, d, w, c in EDGES:
        adj.setdefault(s, []).append((d, weight(w, c)))
    dist = {src: 0}
    pq = [(0, src)]
    while pq:
        dd, u = heapq.heappop(pq)
        if dd > dist.get(u, 1e18):
            continue
        for v, w in adj.get(u, []):
            if dd + w < dist.get(v, 1e18):
                dist[v] = dd + w
                heapq.heappush(pq, (dd + w, v))
    return dist


def src_df(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_weighted_equals_dijkstra_and_route_sums(spark):
    g = graph(spark)
    res = weighted_paths(g, src_df(spark, 0, 6), "E", "V", F.col("w")).collect()
    w = {(s, d): ww for rid, s, d, ww, c in EDGES}
    for src in (0, 6):
        exp = dijkstra(src, lambda w_, c_: w_)
        got = {r.id: r.dist for r in res if r.source == src}
        assert got == pytest.approx(exp)
    for r in res:
        route = list(r.route)
        assert len(route) == r.hops + 1
        assert sum(min(ww for (s, d), ww in w.items() if (s, d) == (a, b)) for a, b in zip(route, route[1:])) == r.dist


def test_unit_weight_equals_bfs_depth(spark):
    g = graph(spark)
    b = {r.id: r.depth for r in bfs(g, src_df(spark, 0), "E", "V").collect()}
    w = {r.id: r.dist for r in weighted_paths(g, src_df(spark, 0), "E", "V", F.lit(1)).collect()}
    assert b == w


def test_large_max_len_equals_unbounded(spark):
    g = graph(spark)
    a = rows(weighted_paths(g, src_df(spark, 0), "E", "V", F.col("w")), "id", "dist")
    b = rows(weighted_paths(g, src_df(spark, 0), "E", "V", F.col("w"), max_len=50), "id", "dist")
    assert a == b


def test_max_len_bounds_hops(spark):
    g = graph(spark)
    res = {r.id: (r.dist, r.hops) for r in weighted_paths(g, src_df(spark, 0), "E", "V", F.col("w"), max_len=1).collect()}
    assert res == {0: (0, 0), 1: (4, 1), 2: (1, 1), 5: (20, 1)}


def test_constrained_with_huge_budget_equals_unconstrained(spark):
    g = graph(spark)
    a = {r.id: r.dist for r in weighted_paths(g, src_df(spark, 0), "E", "V", F.col("w")).collect()}
    b = {r.id: r.dist for r in constrained_paths(g, src_df(spark, 0), "E", "V", F.col("w"), F.col("c"), 1e9).collect()}
    assert a == b


def test_constrained_budget(spark):
    g = graph(spark)
    # cheapest w with total c <= 2: 0->1 (4,1) ->3 (6,2) ->4 (6,2); 5 reachable by 0->5 (20, 0)
    got = {r.id: (r.dist, r.cost) for r in constrained_paths(g, src_df(spark, 0), "E", "V", F.col("w"), F.col("c"), 2).collect()}
    assert got == {0: (0, 0), 1: (4, 1), 3: (6, 2), 4: (6, 2), 5: (20, 0)}


def test_k_paths_brute_force(spark):
    g = graph(spark)
    got = rows(k_paths(g, src_df(spark, 0), "E", "V", F.col("w"), 2, 3), "cur", "rank", "dist")
    trails = []
    def walk(cur, used, dist):
        if used:
            trails.append((cur, dist, len(used)))
        if len(used) == 3:
            return
        for rid, s, d, w, c in EDGES:
            if s == cur and rid not in used:
                walk(d, used + [rid], dist + w)
    walk(0, [], 0)
    exp = []
    for tgt, grp in itertools.groupby(sorted(trails), key=lambda t: t[0]):
        ds = sorted(t[1] for t in grp)[:2]
        exp += [(tgt, i + 1, float(d)) for i, d in enumerate(ds)]
    assert [(a, b, c) for a, b, c in got] == sorted(exp, key=lambda t: (str(t[0]), str(t[1]), str(t[2])))


def test_string_values_match_string_property(spark):
    g = graph(spark)
    r = shortest_path(g, "V", "name", "v0", "v4", "E", "w").collect()
    assert [(x.pathWeight, list(x.route)) for x in r] == [(3.0, ["v0", "v2", "v1", "v3", "v4"])]  # 1+1+1 (parallel 1->3 of weight 1)+0


def test_negative_weight_refused(spark):
    g = graph(spark)
    with pytest.raises(ValueError):
        weighted_paths(g, src_df(spark, 0), "E", "V", -F.col("w"))


def test_shuffled_edges_give_the_same_answer(spark):
    g = graph(spark)
    a = rows(weighted_paths(g, src_df(spark, 0, 6), "E", "V", F.col("w")), "source", "id", "dist", "hops")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no side counts as small
    try:
        b = rows(weighted_paths(g, src_df(spark, 0, 6), "E", "V", F.col("w")), "source", "id", "dist", "hops")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b
    c = {r.id: r.depth for r in bfs(g, src_df(spark, 0), "E", "V").collect()}
    assert c == {k: int(v) for k, v in dijkstra(0, lambda w_, c_: 1).items()}


def test_several_targets_at_unequal_distances(spark):
    """Every connected (source, target) pair has its cheapest path, however near another target is."""
    edges = [(1, 0, 1, 1), (2, 0, 2, 3), (3, 2, 3, 3), (4, 3, 4, 4), (5, 0, 4, 25), (6, 6, 4, 2), (7, 6, 0, 5)]
    nodes = spark.createDataFrame([(i, f"v{i}") for i in range(8)], "id long, name string")
    e = spark.createDataFrame(edges, "rel_id long, src long, dst long, w long")
    g = Graph().with_nodes("V", nodes, "id").with_rels("E", "V", "V", e)
    got = {(r.source, r.target): (r.pathWeight, list(r.route))
           for r in shortest_path(g, "V", "name", ["v0", "v6"], ["v1", "v4", "v7"], "E", "w").collect()}
    assert got == {(0, 1): (1.0, ["v0", "v1"]), (0, 4): (10.0, ["v0", "v2", "v3", "v4"]),
                   (6, 1): (6.0, ["v6", "v0", "v1"]), (6, 4): (2.0, ["v6", "v4"])}
