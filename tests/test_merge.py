"""CREATE / MERGE / upsert semantics, including the hand-made rows of FIXTURES B4."""

from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators.merge import (create_nodes, create_rels, delete_keys, ensure_columns, merge_nodes,
                                     merge_rels, upsert_table)


def people(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "c", 30.0)], "k long, name string, v double")


def test_create_always_adds(spark):
    g = Graph().with_nodes("P", people(spark), "k")
    g = create_nodes(g, "P", people(spark))
    assert g.nodes["P"].count() == 6


def test_merge_null_key_dup_key_on_create_on_match(spark):
    g = Graph().with_nodes("P", people(spark), "k")
    inp = spark.createDataFrame([(2, "B", 21.0, 1), (2, "BB", 22.0, 2), (4, "d", 40.0, 1), (None, "x", 0.0, 1)],
                                "k long, name string, v double, seq int")
    g2, touched = merge_nodes(g, "P", inp, {"k": F.col("k")},
                              on_create={"name": F.col("name"), "v": F.col("v"), "state": F.lit("new")},
                              on_match={"v": F.col("v"), "state": F.lit("seen")}, order_by=[F.col("seq")])
    # key 2 appears twice: the last by seq wins; null key does nothing; matched keeps its name
    assert rows(g2.nodes["P"], "k", "name", "v", "state") == [
        (1, "a", 10.0, None), (2, "b", 22.0, "seen"), (3, "c", 30.0, None), (4, "d", 40.0, "new")]
    assert rows(touched, "k", "created") == [(2, False), (4, True)]


def test_merge_twice_equals_once(spark):
    g = Graph().with_nodes("P", people(spark), "k")
    inp = spark.createDataFrame([(2, "B", 1.0), (5, "e", 5.0)], "k long, name string, v double")
    s = {"name": F.col("name"), "v": F.col("v")}
    once, _ = merge_nodes(g, "P", inp, {"k": F.col("k")}, set_=s)
    twice, _ = merge_nodes(once, "P", inp, {"k": F.col("k")}, set_=s)
    assert rows(once.nodes["P"]) == rows(twice.nodes["P"])


def test_two_column_key_collapse_greatest_without_order(spark):
    inp = spark.createDataFrame([(1, 1, "x"), (1, 1, "z"), (1, 2, "y")], "a int, b int, p string")
    g, _ = merge_nodes(Graph(), "L", inp, {"a": F.col("a"), "b": F.col("b")}, set_={"p": F.col("p")})
    assert rows(g.nodes["L"], "a", "b", "p") == [(1, 1, "z"), (1, 2, "y")]


def test_create_rels_missing_endpoint_and_two_matches(spark):
    nodes = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "k long, tag string")
    g = Graph().with_nodes("N", nodes, "k")
    inp = spark.createDataFrame([(1, "y"), (9, "x")], "src long, dst_tag string")
    g = create_rels(g, "T", "N", "N", inp, {"k": "src"}, {"tag": "dst_tag"})
    # src 9 does not exist → nothing; tag 'y' matches two nodes → two relationships
    assert rows(g.rels[("T", "N", "N")], "src", "dst") == [(1, 2), (1, 3)]


def test_merge_rels_key_includes_inline_props(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "k long")
    g = Graph().with_nodes("N", nodes, "k")
    inp = spark.createDataFrame([(1, 2, 2020), (1, 2, 2020), (1, 2, 2021)], "a long, b long, since int")
    g, _ = merge_rels(g, "R", "N", "N", inp, {"k": "a"}, {"k": "b"}, key_props={"since": F.col("since")})
    assert rows(g.rels[("R", "N", "N")], "src", "dst", "since") == [(1, 2, 2020), (1, 2, 2021)]
    g2, _ = merge_rels(g, "R", "N", "N", inp, {"k": "a"}, {"k": "b"}, key_props={"since": F.col("since")})
    assert g2.rels[("R", "N", "N")].count() == 2


def test_table_upsert_delete_ensure(spark):
    t = spark.createDataFrame([("A", "1"), ("B", "2")], "key string, value string")
    s = spark.createDataFrame([("B", "20"), ("C", "30")], "key string, value string")
    out = upsert_table(t, s, ["key"])
    assert rows(out) == [("A", "1"), ("B", "20"), ("C", "30")]
    assert rows(delete_keys(out, spark.createDataFrame([("A",)], "key string"), ["key"])) == [("B", "20"), ("C", "30")]
    e = ensure_columns(out, {"key": "string", "extra": "int"})
    assert e.columns == ["key", "value", "extra"] and e.schema["extra"].dataType.simpleString() == "int"


def test_two_creates_get_different_ids(spark):
    g = Graph().with_nodes("N", spark.createDataFrame([(1,), (2,), (3,)], "k long"), "k")
    for a, b in ((1, 2), (2, 3)):
        inp = spark.createDataFrame([(a, b)], "a long, b long")
        g = create_rels(g, "T", "N", "N", inp, {"k": "a"}, {"k": "b"})
    hops = g.match("x", "N").out("r", "T", "y", "N").out("q", "T", "z", "N")
    assert rows(hops.ret(x="x", z="z")) == [(1, 3)]


def test_merge_then_create_and_parallel_rels_keep_their_ids(spark):
    g = Graph().with_nodes("N", spark.createDataFrame([(1,), (2,)], "k long"), "k")
    g = g.with_rels("R", "N", "N", spark.createDataFrame([(7, 1, 2), (8, 1, 2)], "rel_id long, src long, dst long"))
    inp = spark.createDataFrame([(1, 2), (2, 1)], "a long, b long")
    g, touched = merge_rels(g, "R", "N", "N", inp, {"k": "a"}, {"k": "b"})
    got = rows(g.rels[("R", "N", "N")], "src", "dst", "rel_id")
    assert [r[:2] for r in got] == [(1, 2), (1, 2), (2, 1)] and {r[2] for r in got[:2]} == {"7", "8"}
    assert "rel_id" not in touched.columns
    g = create_rels(g, "R", "N", "N", inp, {"k": "a"}, {"k": "b"}, rel_id=F.col("a"))
    assert g.rels[("R", "N", "N")].count() == 5


def test_first_load_of_a_struct_property(spark):
    inp = spark.createDataFrame([(1, 2.0, 3.0)], "k long, x double, y double")
    g, _ = merge_nodes(Graph(), "P", inp, {"k": "k"}, set_={"loc": F.struct("x", "y"), "tags": F.array("x")})
    got = g.nodes["P"].first()
    assert got["loc"]["y"] == 3.0 and got["tags"] == [2.0]
