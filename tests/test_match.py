"""Pattern-builder semantics: undirected = both directions, isomorphism, trails, linked matches."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators.match import Match
from trellis.operators.paths import trails


def ring_graph(spark):
    names = ["n0", "n1", "n2", "n3"]
    nodes = spark.createDataFrame([(n,) for n in names], "name string")
    edges = [(i, names[i], names[(i + 1) % 4]) for i in range(4)] + [(4, "n0", "n2"), (5, "n0", "n2")]
    e = spark.createDataFrame(edges, "rel_id long, src string, dst string")
    return Graph().with_nodes("N", nodes, "name").with_rels("R", "N", "N", e), edges


def test_undirected_is_union_of_both_directions(spark):
    g, edges = ring_graph(spark)
    und = g.match("a", "N").both("r", "R", "b", "N").ret(a="a", b="b", rid="r.rel_id")
    fwd = g.match("a", "N").out("r", "R", "b", "N").ret(a="a", b="b", rid="r.rel_id")
    rev = g.match("a", "N").inc("r", "R", "b", "N").ret(a="a", b="b", rid="r.rel_id")
    assert rows(und) == rows(fwd.unionAll(rev))


def test_fixed_chain_never_reuses_a_relationship(spark):
    g, _ = ring_graph(spark)
    m = g.match("a", "N").both("r1", "R", "b", "N").both("r2", "R", "c", "N")
    assert m.df.where(F.col("r1__rel_id") == F.col("r2__rel_id")).count() == 0


def brute_trails(edges, lo, hi, undirected=False):
    adj = [(rid, s, d) for rid, s, d in edges] + ([(rid, d, s) for rid, s, d in edges if s != d] if undirected else [])
    out = []
    def walk(start, cur, used, nodes):
        if lo <= len(used) <= hi:
            out.append((start, cur, len(used), ",".join(nodes)))
        if len(used) == hi:
            return
        for rid, s, d in adj:
            if s == cur and rid not in used:
                walk(start, d, used + [rid], nodes + [d])
    for n in {s for _, s, _ in edges} | {d for _, _, d in edges}:
        walk(n, n, [], [n])
    return sorted(out)


@pytest.mark.parametrize("lo,hi,und", [(1, 3, False), (2, 2, True), (0, 2, False)])
def test_var_length_trails_match_brute_force(spark, lo, hi, und):
    g, edges = ring_graph(spark)
    m = g.match("a", "N").var_hop("R", "b", "N", lo, hi, direction="both" if und else "out", path="p")
    got = m.ret(start="a", end="b", hops=m.c("p.length"), route=F.array_join("p__nodes", ","))
    assert rows(got) == brute_trails(edges, lo, hi, und)


def test_two_endpoints_from_one_row(spark):
    g, _ = ring_graph(spark)
    m = Match.from_rows(g, spark.createDataFrame([("n0", "n1"), ("n0", "zz")], "x string, y string"))
    m = m.bind("a", "N", name=m.c("row.x")).bind("b", "N", name=m.c("row.y"))
    assert rows(m.ret(a="a", b="b")) == [("n0", "n1")]


def test_unlabelled_endpoint_unions_labels(spark):
    a = spark.createDataFrame([(1,)], "id long")
    b = spark.createDataFrame([(2,)], "id long")
    t = spark.createDataFrame([(9,)], "id long")
    e1 = spark.createDataFrame([(1, 1, 9)], "rel_id long, src long, dst long")
    e2 = spark.createDataFrame([(2, 2, 9)], "rel_id long, src long, dst long")
    g = (Graph().with_nodes("A", a, "id").with_nodes("B", b, "id").with_nodes("T", t, "id")
         .with_rels("TO", "A", "T", e1).with_rels("TO", "B", "T", e2))
    m = g.match("t", "T").inc("r", "TO", "x")
    assert rows(m.ret(label="labels(x)", x="x")) == [("A", 1), ("B", 2)]


def test_pattern_relationships_distinct_across_var_length(spark):
    g, edges = ring_graph(spark)
    # (a)-[r]->(b)-[*1..2]->(c): r never reappears inside the segment, and vice versa
    m = g.match("a", "N").out("r", "R", "b", "N").var_hop("R", "c", "N", 1, 2, path="p")
    assert m.df.where(F.array_contains("p__rels", F.col("r__rel_id"))).count() == 0
    m2 = g.match("a", "N").var_hop("R", "b", "N", 1, 2, path="p").out("r", "R", "c", "N")
    got = m2.df.where(F.array_contains("p__rels", F.col("r__rel_id"))).count()
    assert got == 0 and m2.df.count() > 0


def test_unrelated_match_is_refused_at_any_size(spark):
    for n in (1, 10_050):
        g = Graph().with_nodes("B", spark.range(0, n).select(F.col("id").alias("k")), "k")
        with pytest.raises(ValueError):
            g.match("a", "B").bind("b", "B")


def two_label_graph(spark):
    """Three C and two S, all in the one N; ids repeat between the tables."""
    ids = lambda n: spark.range(n).select(F.col("id").alias("k"))
    rel = lambda n: spark.range(n).select(F.col("id").alias("rel_id"), F.col("id").alias("src"), F.lit(0).cast("long").alias("dst"))
    return (Graph().with_nodes("C", ids(3), "k").with_nodes("S", ids(2), "k")
            .with_nodes("N", spark.createDataFrame([(0, "x")], "k long, nn string"), "k")
            .with_rels("IN", "C", "N", rel(3), dst_exists=True).with_rels("IN", "S", "N", rel(2), dst_exists=True))


def test_relationships_of_two_tables_with_equal_ids_differ(spark):
    g = two_label_graph(spark)
    assert g.match("c", "C").out("r", "IN", "n", "N").inc("q", "IN", "s", "S").df.count() == 6


def test_unlabelled_start_joins_by_label_too(spark):
    g = two_label_graph(spark)
    assert rows(g.match("x").out("r", "IN", "n", "N").ret(label="labels(x)", x="x")) == \
        [("C", 0), ("C", 1), ("C", 2), ("S", 0), ("S", 1)]


def test_consecutive_match_keeps_nodes_not_yet_joined(spark):
    g = two_label_graph(spark)
    both = g.match("c", "C").join(g.match("c", "C").out("r", "IN", "n", "N"))
    assert rows(both.ret("n.nn", c="c")) == [("x", 0), ("x", 1), ("x", 2)]


def test_trails_over_two_types_with_equal_ids(spark):
    ids = spark.range(3).select(F.col("id").alias("k"))
    one = spark.createDataFrame([(1, 0, 1)], "rel_id long, src long, dst long")
    two = spark.createDataFrame([(1, 1, 2)], "rel_id long, src long, dst long")
    g = Graph().with_nodes("V", ids, "k").with_rels("A", "V", "V", one).with_rels("B", "V", "V", two)
    got = trails(g, ids.select(F.col("k").alias("start")), ["A", "B"], "V", "V", 2, 2)
    assert rows(got.select("start", "cur")) == [(0, 2)]
