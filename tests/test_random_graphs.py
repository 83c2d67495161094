"""Randomised checks against plain-Python references on graphs with ties, zero weights,
parallel relationships and a hub (several seeds)."""

import heapq
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from trellis.model import Graph
from trellis.operators.paths import bfs, weighted_paths
from trellis.operators.rank import page_rank


def make(seed, n=25, m=70):
    rnd = random.Random(seed)
    edges = []
    for i in range(m):
        s = 0 if rnd.random() < 0.3 else rnd.randrange(n)  # node 0 is a hub
        d = rnd.randrange(n)
        if s != d:
            edges.append((i, s, d, rnd.choice([0, 1, 1, 2, 3, 5])))
    return n, edges


def graph(spark, n, edges):
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
    e = spark.createDataFrame(edges, "rel_id long, src long, dst long, w long")
    return Graph().with_nodes("V", nodes, "id").with_rels("E", "V", "V", e)


def dijkstra(edges, src):
    adj = {}
    for _, s, d, w in edges:
        adj.setdefault(s, []).append((d, w))
    best = {src: (0, 0)}
    pq = [(0, 0, src)]
    while pq:
        dd, hh, u = heapq.heappop(pq)
        if (dd, hh) > best.get(u, (1e18, 0)):
            continue
        for v, w in adj.get(u, []):
            cand = (dd + w, hh + 1)
            if cand < best.get(v, (1e18, 0)):
                best[v] = cand
                heapq.heappush(pq, (cand[0], cand[1], v))
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weighted_dist_and_hops(spark, seed):
    n, edges = make(seed)
    g = graph(spark, n, edges)
    srcs = spark.createDataFrame([(0,), (5,), (5,)], "id long")
    got = {(r.source, r.id): (r.dist, r.hops) for r in weighted_paths(g, srcs, "E", "V", F.col("w")).collect()}
    exp = {}
    for s in (0, 5):
        for v, (d, h) in dijkstra(edges, s).items():
            exp[(s, v)] = (d, h)
    assert got == exp


@pytest.mark.parametrize("seed", [4, 5])
def test_bfs_depths(spark, seed):
    n, edges = make(seed)
    g = graph(spark, n, edges)
    got = {r.id: r.depth for r in bfs(g, spark.createDataFrame([(0,), (0,)], "id long"), "E", "V", "both").collect()}
    adj = {}
    for _, s, d, _ in edges:
        adj.setdefault(s, set()).add(d)
        adj.setdefault(d, set()).add(s)
    exp, q = {0: 0}, deque([0])
    while q:
        u = q.popleft()
        for v in adj.get(u, ()):
            if v not in exp:
                exp[v] = exp[u] + 1
                q.append(v)
    assert got == exp


def test_pagerank_sums_to_one_on_random_graph(spark):
    n, edges = make(9)
    g = graph(spark, n, edges)
    pr = page_rank(g, "V", "E", max_rounds=12)
    assert pr.count() == n
    assert abs(pr.agg(F.sum("score")).first()[0] - 1.0) < 1e-9
