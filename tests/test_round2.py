"""Faults found in review: text types, stale promises, ranking without relationships."""

from conftest import rows
from trellis import Graph
from trellis.operators.rank import page_rank, page_rank_top
from trellis.sources.csv import propose_types, read_inferred


def test_reviewed_string_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,n,free\n00000,1,007\n00012,x,8\nX9,3,9\n")
    df = read_inferred(spark, str(tmp_path / "a.csv"), {"code": "string", "n": "int"})
    assert rows(df) == [("00000", 1, "007"), ("00012", None, "8"), ("X9", 3, "9")]
    assert propose_types(spark, str(tmp_path / "a.csv"), 1.0)["free"] == "int"


def test_new_node_set_drops_earlier_promises(spark):
    a = spark.createDataFrame([(1,), (2,)], "a long")
    n = spark.createDataFrame([(5,)], "n long")
    rel = spark.createDataFrame([(1, 1, 5), (2, 2, 5)], "rel_id long, src long, dst long")
    g = Graph().with_nodes("A", a, "a").with_nodes("N", n, "n").with_rels("IN", "A", "N", rel, src_exists=True, dst_exists=True)
    hop = lambda h: h.match("x", "A").out("r", "IN", "y", "N").ret("x.a").count()
    assert hop(g) == 2
    assert hop(g.with_nodes("N", n.filter("false"), "n")) == 0


def test_page_rank_without_relationships_is_even(spark):
    g = Graph().with_nodes("A", spark.createDataFrame([(1,), (2,)], "a long"), "a")
    assert [r["score"] for r in page_rank(g, "A", "KNOWS").collect()] == [0.5, 0.5]


def test_top_ranks_by_scores_before_rounding(spark, monkeypatch):
    from trellis.operators import rank
    ranks = spark.createDataFrame([(1, 1.0e-10), (2, 3.0e-10), (3, 2.0e-10)], "id long, score double")
    monkeypatch.setattr(rank, "page_rank", lambda *a, **k: ranks)
    g = Graph().with_nodes("A", spark.createDataFrame([(1,), (2,), (3,)], "a long"), "a")
    assert [r["node"] for r in page_rank_top(g, "A", "KNOWS", "a", 2).collect()] == [2, 3]
