"""Golden values worked out by hand on the five-person sample graph."""

from pyspark.sql import functions as F

from conftest import rows
from trellis.operators.paths import shortest_path
from trellis.operators.rank import degree, page_rank
from trellis.plans.sample_graph import sample_graph


def test_sample_graph_shape(spark):
    g = sample_graph(spark)
    assert g.nodes["Person"].count() == 5
    assert g.rels[("KNOWS", "Person", "Person")].count() == 5
    assert rows(g.stats()) == [(5, 5)]


def test_sample_graph_rerun_is_safe(spark):
    g1 = sample_graph(spark)
    g2 = sample_graph(spark, g1)
    assert rows(g2.nodes["Person"]) == rows(g1.nodes["Person"])
    assert rows(g2.rels[("KNOWS", "Person", "Person")], "src", "dst", "since") == \
        rows(g1.rels[("KNOWS", "Person", "Person")], "src", "dst", "since")
    # relationship ids are kept on a rematch
    assert rows(g2.rels[("KNOWS", "Person", "Person")], "rel_id") == \
        rows(g1.rels[("KNOWS", "Person", "Person")], "rel_id")


def test_shortest_path_by_hops_and_by_since(spark):
    g = sample_graph(spark)
    by_hops = shortest_path(g, "Person", "name", "Alice", "Eve", "KNOWS", None).collect()
    assert [(r.pathWeight, list(r.route)) for r in by_hops] == [(2.0, ["Alice", "David", "Eve"])]
    by_since = shortest_path(g, "Person", "name", "Alice", "Eve", "KNOWS", "since").collect()
    assert [(r.pathWeight, list(r.route)) for r in by_since] == [(4043.0, ["Alice", "David", "Eve"])]


def test_no_path_gives_no_row(spark):
    g = sample_graph(spark)
    assert shortest_path(g, "Person", "name", "Eve", "Alice", "KNOWS", "since").count() == 0


def test_degree_and_dangling_pagerank(spark):
    g = sample_graph(spark)
    d = {r.id: r.degree for r in degree(g, "Person", "KNOWS", "out").collect()}
    assert d["Alice"] == 2 and d["Eve"] == 0
    pr = page_rank(g, "Person", "KNOWS", max_rounds=30)
    total = pr.agg(F.sum("score")).first()[0]
    assert abs(total - 1.0) < 1e-9
    scores = {r.id: r.score for r in pr.collect()}
    assert scores["Eve"] == max(scores.values())  # everything flows to Eve
