"""Pair search, the path call with all options, routes, hubs, typed trails, path objects."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators import paths as P
from trellis.operators.rank import degree, page_rank


def make(seed, n=14, m=34):
    rnd = random.Random(seed)
    edges = []
    for i in range(m):
        s, d = 0 if rnd.random() < 0.25 else rnd.randrange(n), rnd.randrange(n)
        edges.append((i, s, d, rnd.choice([0, 1, 1, 2, 3]), rnd.choice([1, 1, 2])))
    return n, edges


def graph(spark, n, edges):
    nodes = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("name"))
    e = spark.createDataFrame(edges, "rel_id long, src long, dst long, w long, c long")
    return Graph().with_nodes("V", nodes, "k").with_rels("E", "V", "V", e)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def bfs_routes(edges, s, undirected):
    """Depth of each node and its route: smallest predecessor at every step from the node back."""
    adj = {}
    for _, a, b, *_ in edges:
        adj.setdefault(a, set()).add(b)
        if undirected:
            adj.setdefault(b, set()).add(a)
    depth, queue = {s: 0}, deque([s])
    while queue:
        u = queue.popleft()
        for v in adj.get(u, ()):
            if v not in depth:
                depth[v] = depth[u] + 1
                queue.append(v)
    out = {}
    for v in depth:
        route = [v]
        while depth[route[-1]]:
            x = route[-1]
            route.append(min(u for u in depth if depth[u] == depth[x] - 1 and x in adj.get(u, ())))
        out[v] = route[::-1]
    return out


@pytest.mark.parametrize("seed,direction", [(1, "both"), (2, "out"), (3, "both"), (4, "in")])
def test_pair_search_equals_the_whole_search(spark, seed, direction):
    n, edges = make(seed, 14, 18)
    g = graph(spark, n, edges)
    flipped = [(r, d, s) for r, s, d, *_ in edges] if direction == "in" else edges
    want = bfs_routes(flipped, 3, direction == "both")
    for t in range(0, n, 3):
        got = P.between(g, ids(spark, 3), ids(spark, t), "E", "V", direction).collect()
        assert [r.route for r in got] == ([want[t]] if t in want else [])
        assert all(r.depth == len(r.route) - 1 for r in got)


def test_pair_search_stops_where_the_sides_meet(spark):
    """A line of 20 nodes with a broom of 40 at the far side of each end: levels beyond the meeting are not built."""
    edges = [(i, i, i + 1, 1, 1) for i in range(20)] + [(100 + i, 20, 100 + i, 1, 1) for i in range(40)]
    edges += [(200 + i, 100 + i, 300 + i, 1, 1) for i in range(40)]
    e = spark.createDataFrame(edges, "rel_id long, src long, dst long, w long, c long")
    g = Graph().with_nodes("V", e.select(F.explode(F.array("src", "dst")).alias("k")).distinct(), "k").with_rels("E", "V", "V", e)
    trace = []
    got = P.between(g, ids(spark, 4), ids(spark, 12), "E", "V", "both", trace=trace).collect()
    assert got[0].route == list(range(4, 13))
    assert sum(level for side, level, _ in trace if (side, level) in {(s, max(x for t, x, _ in trace if t == s)) for s in ("source", "target")}) == 8
    assert sum(size for *_, size in trace) <= 2 * 8          # no broom was reached
    assert P.between(g, ids(spark, 4), ids(spark, 12), "E", "V", "both", max_depth=7).collect() == []
    assert P.between(g, ids(spark, 4), ids(spark, 12), "E", "V", "in").collect() == []


def test_shortest_path_between_by_property(spark):
    g = graph(spark, *make(1))
    got = P.shortest_path_between(g, "V", "name", "v0", "v0", "E").collect()
    assert [(r.length, r.route) for r in got] == [(0, ["v0"])]
    twice = g.with_nodes("V", g.nodes["V"].withColumn("name", F.lit("same")), "k")
    with pytest.raises(ValueError):
        P.shortest_path_between(twice, "V", "name", "same", "same", "E")


def trails_between(edges, s, targets, max_len, max_cost, undirected=False):
    adj = [(r, a, b, w, c) for r, a, b, w, c in edges] + ([(r, b, a, w, c) for r, a, b, w, c in edges if a != b] if undirected else [])
    out = []

    def walk(cur, used, nodes, w, c):
        if used and cur in targets:
            out.append((w, len(used), nodes, used, c))
        if len(used) == max_len:
            return
        for r, a, b, x, y in adj:
            if a == cur and r not in used and c + y <= max_cost:
                walk(b, used + [r], nodes + [b], w + x, c + y)

    walk(s, [], [s], 0, 0)
    return sorted(out)


@pytest.mark.parametrize("seed,max_len,max_cost,k,direction", [(1, 4, 6, 5, "out"), (2, 3, 100, 3, "both"), (5, 5, 5, 2, "out"), (7, 4, 4, 40, "out")])
def test_path_call_equals_enumeration(spark, seed, max_len, max_cost, k, direction):
    n, edges = make(seed, 9, 16 if direction == "both" else 24)
    g = graph(spark, n, edges)
    got = P.best_paths(g, "V", "k", 0, [4, 7], "E", F.col("w"), F.col("c"), max_cost, max_len, k, direction).collect()
    for t in (4, 7):
        want = trails_between(edges, 0, {t}, max_len, max_cost, direction == "both")[:k]
        mine = sorted((r["rank"], r.pathWeight, r.hops, r.route, r.pathCost) for r in got if r.target == t)
        assert mine == [(i + 1, float(w), h, nodes, float(c)) for i, (w, h, nodes, _, c) in enumerate(want)]


def test_path_call_without_length_bound_drops_dominated_trails(spark, monkeypatch):
    """A dear detour grows with every lap, but no trail that passes the best arrivals is continued."""
    lap = [(i, i, i + 1, 1, 1) for i in range(6)] + [(50 + i, 20 + i, 20 + (i + 1) % 12, 9, 1) for i in range(12)] + [(90, 0, 20, 9, 1)]
    seen = []
    keep = P.cut_lineage
    monkeypatch.setattr(P, "cut_lineage", lambda df: seen.append(df.columns) or keep(df))
    e = spark.createDataFrame(lap, "rel_id long, src long, dst long, w long, c long")
    g = Graph().with_nodes("V", spark.range(40).select(F.col("id").alias("k")), "k").with_rels("E", "V", "V", e)
    got = P.best_paths(g, "V", "k", 0, 6, "E", F.col("w"), path_count=2).collect()
    assert [(r["rank"], r.pathWeight, r.route) for r in got] == [(1, 6.0, list(range(7)))]
    assert sum("rels" in c for c in seen) < 20               # the lap of 12 leads nowhere: it is never walked


def test_search_state_has_no_routes(spark):
    """History rows are of fixed width; the routes are read back from them."""
    n, edges = make(3)
    g = graph(spark, n, edges)
    e = P.Edges(P._edges(g, "E", "V", "out", weight=F.col("w"), collapse=True))
    history = P._relax(ids(spark, 0, 5), e, None)
    assert history.columns == ["source", "id", "dist", "hops", "pred"]
    for r in P.weighted_paths(g, ids(spark, 0, 5), "E", "V", F.col("w")).collect():
        assert r.route[0] == r.source and r.route[-1] == r.id and len(r.route) == r.hops + 1
        best = {}
        for _, a, b, w, _ in edges:
            best[a, b] = min(w, best.get((a, b), 10**9))
        assert sum(best[x] for x in zip(r.route, r.route[1:])) == r.dist


def test_routes_of_a_bounded_search_keep_their_length(spark):
    """With max_len a node's own best label may be longer than the one its follower came from."""
    edges = [(1, 0, 1, 9, 1), (2, 0, 2, 1, 1), (3, 2, 1, 1, 1), (4, 1, 3, 1, 1)]
    g = graph(spark, 4, edges)
    got = {r.id: (r.dist, r.route) for r in P.weighted_paths(g, ids(spark, 0), "E", "V", F.col("w"), max_len=2).collect()}
    assert got[3] == (10.0, [0, 1, 3]) and got[1] == (2.0, [0, 2, 1])


def test_constrained_routes_follow_their_own_labels(spark):
    edges = [(1, 0, 1, 1, 5), (2, 0, 1, 4, 1), (3, 1, 2, 1, 1), (4, 1, 2, 3, 1)]
    g = graph(spark, 3, edges)
    got = {r.id: (r.dist, r.cost, r.route) for r in P.constrained_paths(g, ids(spark, 0), "E", "V", F.col("w"), F.col("c"), 3).collect()}
    assert got[2] == (5.0, 2.0, [0, 1, 2])


def test_a_hub_is_spread_over_salts_and_answers_stay(spark):
    """A third of all relationships leave one node."""
    rnd = random.Random(9)
    edges = [(i, 0 if i % 3 == 0 else rnd.randrange(60), rnd.randrange(60), rnd.choice([1, 2, 5]), 1) for i in range(600)]
    g = graph(spark, 60, edges)
    split = P.Edges(P._edges(g, "E", "V", "out", weight=F.col("w")), 20)
    shares = split.df.groupBy("a", "salt").count().collect()
    assert max(r["count"] for r in shares) < 45 and len([r for r in shares if r.a == 0]) >= 10
    plan = split.step(ids(spark, 0))._jdf.queryExecution().toString()
    assert "row_salt" in plan and split.step(ids(spark, 0)).count() == sum(s == 0 for _, s, *_ in edges)
    for fn in (lambda h: P.weighted_paths(g, ids(spark, 0, 7), "E", "V", F.col("w"), hub=h),
               lambda h: P.bfs(g, ids(spark, 0, 7), "E", "V", hub=h),
               lambda h: page_rank(g, "V", "E", max_rounds=4, hub=h).select("id", F.round("score", 9)),
               lambda h: P.best_paths(g, "V", "k", 0, 9, "E", F.col("w"), max_len=3, path_count=4, hub=h)):
        assert rows(fn(20)) == rows(fn(None))


# ---------------------------------------------------------------- without relationships
def test_searches_without_relationships(spark):
    g = Graph().with_nodes("V", spark.range(3).select(F.col("id").alias("k")), "k")
    assert rows(P.bfs(g, ids(spark, 1), "E", "V")) == [(1, 1, 0, [1])]
    assert rows(P.weighted_paths(g, ids(spark, 1), "E", "V", F.col("w")), "id", "dist") == [(1, 0.0)]
    assert P.between(g, ids(spark, 1), ids(spark, 2), "E", "V").collect() == []
    assert P.best_paths(g, "V", "k", 0, 1, "E", F.col("w")).collect() == []
    assert rows(degree(g, "V", "E")) == [(0, 0), (1, 0), (2, 0)]
    m = g.match("a", "V").var_hop("E", "b", "V", 0, 2, path="p")
    assert rows(m.ret(a="a", b="b")) == [(0, 0), (1, 1), (2, 2)]


def test_statistics_of_small_graphs(spark):
    g = Graph().with_nodes("V", spark.range(3).select(F.col("id").alias("k")), "k")
    assert rows(g.stats()) == [(3, 0)] and g.all_rels().collect() == []
    one = g.schema_context().first()
    assert (one.node_count, one.relationship_count, one.labels, one.relationship_types, one.property_keys) == (3, 0, ["V"], [], ["k"])
    empty = Graph()
    assert rows(empty.stats()) == [(0, 0)] and empty.all_nodes().collect() == [] and empty.inspect().collect() == []
    assert empty.schema_context().first().node_count == 0


# ---------------------------------------------------------------- several labels and types
def labelled(spark):
    """A 1-K->A 2, A 2-L->B 1, B 1-L->A 3; ids repeat over labels and relationship ids over tables."""
    a, b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, p string"), spark.createDataFrame([(1, "b")], "k long, p string")
    rel = lambda *r: spark.createDataFrame(list(r), "rel_id long, src long, dst long")
    return (Graph().with_nodes("A", a, "k").with_nodes("B", b, "k").with_rels("K", "A", "A", rel((1, 1, 2)))
            .with_rels("L", "A", "B", rel((1, 2, 1))).with_rels("L", "B", "A", rel((1, 1, 3))))


def test_trails_pass_all_labels(spark):
    g = labelled(spark)
    m = g.match("a", "A").var_hop(None, "x", None, 1, 3, path="p", carry="p")
    got = rows(m.ret(a="a", label="labels(x)", x="x", hops=m.c("p.length"), ps=F.array_join("p__carried", "")))
    assert got == [(1, "A", 2, 1, "xy"), (1, "A", 3, 3, "xybz"), (1, "B", 1, 2, "xyb"), (2, "A", 3, 2, "ybz"), (2, "B", 1, 1, "yb")]
    # an end label filters the end only, not the nodes on the way
    m = g.match("a", "A").var_hop(["K", "L"], "x", "A", 1, 3, path="p")
    assert rows(m.ret(a="a", x="x")) == [(1, 2), (1, 3), (2, 3)]


def test_untyped_step_never_uses_a_relationship_twice(spark):
    k = spark.createDataFrame([(1, 1, 2), (2, 2, 3)], "rel_id long, src long, dst long")
    g = Graph().with_nodes("A", spark.createDataFrame([(1,), (2,), (3,)], "k long"), "k").with_rels("K", "A", "A", k)
    m = g.match("a", "A").both("r", "K", "b", "A").var_hop(None, "c", "A", 1, 1, direction="both")
    assert rows(m.ret(a="a", b="b", c="c")) == [(1, 2, 3), (3, 2, 1)]
    m = (g.match("a", "A").var_hop("K", "b", "A", 1, 1, direction="both", path="p").var_hop(None, "c", "A", 1, 1, direction="both", path="q"))
    assert rows(m.ret(a="a", b="b", c="c")) == [(1, 2, 3), (3, 2, 1)]


def test_equal_ids_of_two_labels_are_no_self_loop(spark):
    g = labelled(spark)
    m = g.match("b", "B").both("r", "L", "a", "A")
    assert rows(m.ret(b="b", a="a")) == [(1, 2), (1, 3)]
    g = g.with_rels("M", "A", "B", spark.createDataFrame([(7, 1, 1)], "rel_id long, src long, dst long"))
    assert rows(g.match("b", "B").both("r", "M", "a", "A").ret(b="b", a="a")) == [(1, 1)]


def test_path_objects(spark):
    g = labelled(spark)
    m = g.match("a", "A", k=1).var_hop(None, "x", "A", 0, 3, path="p").path_object("p")
    got = sorted((r.p__object for r in m.df.select("p__object").collect()), key=lambda o: o.hops)
    assert [o.hops for o in got] == [0, 1, 3]
    assert [(n.label, n.id, n.props["p"]) for n in got[2].nodes] == [("A", "1", "x"), ("A", "2", "y"), ("B", "1", "b"), ("A", "3", "z")]
    assert [(r.type, r.id) for r in got[2].rels] == [("K", "1"), ("L", "1"), ("L", "1")] and got[0].rels == []


@pytest.mark.parametrize("seed,k,max_len", [(1, 1, 3), (2, 2, 4), (6, 3, 3), (8, 50, 3)])
def test_k_paths_to_all_nodes_equal_enumeration(spark, seed, k, max_len):
    n, edges = make(seed, 8, 22)
    g = graph(spark, n, edges)
    got = P.k_paths(g, ids(spark, 0, 3), "E", "V", F.col("w"), k, max_len).collect()
    for s in (0, 3):
        for t in range(n):
            want = trails_between(edges, s, {t}, max_len, 10**9)[:k]
            mine = sorted((r["rank"], r.dist, r.hops, r.nodes, r.rels) for r in got if (r.source, r.cur) == (s, t))
            assert mine == [(i + 1, float(w), h, nodes, rels) for i, (w, h, nodes, rels, _) in enumerate(want)]


def test_k_paths_list_no_dominated_trail(spark):
    """40 parallel relationships a step: 40^3 trails, of which a few can be in the answer."""
    edges = [(100 * i + j, i, i + 1, 1 + j, 1) for i in range(3) for j in range(40)]
    g = graph(spark, 4, edges)
    e = P.Edges(P._edges(g, "E", "V", "out", weight=F.col("w")))
    whole = P._run_trails(ids(spark, 0).withColumnRenamed("id", "source"), e, 3, None).count()
    seen = []
    run = P._run_trails

    def counted(*a):
        out = run(*a)
        seen.append(out.count())
        return out

    P._run_trails = counted
    try:
        got = P.k_paths(g, ids(spark, 0), "E", "V", F.col("w"), 2, 3).where("cur = 3").collect()
    finally:
        P._run_trails = run
    assert sorted((r["rank"], r.dist) for r in got) == [(1, 3.0), (2, 4.0)]
    assert whole == 40 + 40**2 + 40**3 and max(seen) < 40
