"""Counted trails, trails whose last hop is not shuffled, deltas and parts computed once."""

import itertools

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators import paths as P


def _graph(spark):
    """Two labels, parallel relationships, a self loop, an id held twice and one without id."""
    a = spark.createDataFrame([(1, "u"), (2, "v"), (3, "u"), (3, "w"), (None, "x")], "k long, p string")
    b = spark.createDataFrame([(1, "s"), (2, None)], "k long, p string")
    g = Graph().with_nodes("A", a, "k").with_nodes("B", b, "k")
    g = g.with_rels("T", "A", "A", spark.createDataFrame(
        [(1, 1, 2), (2, 1, 2), (3, 2, 2), (4, 2, 3), (4, 3, 1), (None, 1, 3), (5, 3, 9)], "rel_id long, src long, dst long"))
    return g.with_rels("S", "A", "B", spark.createDataFrame([(1, 1, 1), (2, 2, 1), (2, 3, 1), (3, 3, 2), (None, 2, 2)], "rel_id long, src long, dst long"))


@pytest.mark.parametrize("types,direction,hops,keep", [
    (t, d, h, k) for (t, d, h), k in zip(itertools.product(["T", ["T", "S"]], ["out", "in", "both"], [(0, 1), (1, 2), (2, 2), (1, 3)]),
                                         itertools.cycle([["x"], [], ["labels(x)", "x.p"]]))])
def test_counted_trails_agree_with_trails(spark, types, direction, hops, keep):
    g = _graph(spark)
    m = g.match("a", "A").var_hop(types, "x", None, *hops, direction=direction)
    c = g.match("a", "A").var_hop(types, "x", None, *hops, direction=direction, keep=keep)
    cols = lambda q: {"a": "a", "p": "a.p", **{f"c{i}": r for i, r in enumerate(keep)}}
    assert rows(c.agg(cols(c), n=c.rows())) == rows(m.agg(cols(m), n=m.rows()))


@pytest.mark.parametrize("first", ["S", "T"])
def test_counted_step_avoids_the_bound_relationship(spark, first):
    g = _graph(spark)
    for rel_type, direction in ((None, "in"), (None, "both"), (first, "in")):
        out = []
        for keep in (None, ["labels(x)"]):
            m = g.match("a", "A").out("r", first, "n").var_hop(rel_type, "x", None, 1, 1, direction=direction, keep=keep)
            out.append(rows(m.agg({"a": "a", "p": "a.p", "n": "n", "l": "labels(x)"}, c=m.rows())))
        assert out[0] == out[1] and out[0]


def test_counted_hub_makes_no_trails(spark):
    n = 20_000                                  # 4 * 10^8 pairs meet at the hub
    g = (Graph().with_nodes("A", spark.range(n).select(F.col("id").alias("k")), "k")
         .with_nodes("H", spark.createDataFrame([(0,)], "k long"), "k"))
    g = g.with_rels("T", "A", "H", spark.range(n).select(F.col("id").alias("rel_id"), F.col("id").alias("src"), F.lit(0).cast("long").alias("dst")))
    m = g.match("a", "A").var_hop("T", "x", None, 2, 2, direction="both", keep=["labels(x)"])
    got = m.agg({"l": "labels(x)"}, n=m.rows(), starts=F.count("*")).collect()
    assert [tuple(r) for r in got] == [("A", n * (n - 1), n)]
    m = g.match("a", "A").out("r", "T", "h").var_hop(None, "x", None, 1, 1, direction="in", keep=[])
    assert m.agg({}, n=m.rows()).first()["n"] == n * (n - 1)


def test_tables_out_of_reach_are_not_read(spark):
    g = _graph(spark)
    never = spark.range(3).select(F.raise_error(F.lit("read")).cast("long").alias("rel_id"), F.col("id").alias("src"), F.col("id").alias("dst"))
    g = g.with_nodes("C", spark.range(3).select(F.col("id").alias("k")), "k").with_rels("U", "C", "A", never)
    m = g.match("b", "B").var_hop(None, "x", None, 1, 1, direction="in")
    assert m.df.count() == 7


def test_counted_trails_come_last(spark):
    m = _graph(spark).match("a", "A").var_hop("T", "x", "A", 1, 1, keep=["x"])
    with pytest.raises(ValueError):
        m.out("r", "T", "y", "A")
    with pytest.raises(ValueError):
        m.ret(a="a")


def test_long_trails_are_dealt_by_their_number(spark, monkeypatch):
    g = _graph(spark)
    q = lambda: g.match("a", "A").var_hop("T", "x", "A", 1, 3, direction="both", path="p", carry="p")
    cols = lambda m: (m.c("a").cast("string"), m.c("a.p"), m.c("x").cast("string"), m.c("x.p"), m.c("p").cast("string"), m.c("p.length"))
    whole = q()
    want = rows(whole.df.select(*cols(whole)))
    monkeypatch.setattr(P, "ROWS_A_TASK", 2)
    dealt = q()
    assert rows(dealt.df.select(*cols(dealt))) == want and want
    assert P.spread(spark.range(10), 100, "id").rdd.getNumPartitions() == 50


def test_rows_made_are_dealt_whatever_the_shuffle_partitions(spark, monkeypatch):
    """Partitions of few bytes are put together again, so many of them do not bound what a task makes and reads."""
    g = _graph(spark)
    q = lambda: g.match("a", "A").var_hop("T", "x", "A", 1, 3, path="p")
    cols = lambda m: (m.c("a").cast("string"), m.c("x").cast("string"), m.c("p").cast("string"))
    want = rows((m := q()).df.select(*cols(m)))
    n = spark.sparkContext.defaultParallelism + 1
    kept = []
    monkeypatch.setattr(P, "KEPT_A_TASK", 1)
    cut = P.cut_lineage
    monkeypatch.setattr(P, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert rows((m := q()).df.select(*cols(m))) == want and want
        assert P.spread(spark.range(10), n * P.ROWS_A_TASK, "id").rdd.getNumPartitions() == n
        assert len(kept) == 3          # relationships, trails of one and of two hops
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    from trellis.operators import ordered as O

    n = 4 * (spark.sparkContext.defaultParallelism + 1)
    df = spark.range(n).select(F.col("id"), (F.col("id") * 7 % 5).alias("u"))
    want = rows(O.global_lag(df, ["id"], ["u"]))
    ranged = []
    cut = O.cut_lineage
    monkeypatch.setattr(O, "cut_lineage", lambda x: ranged.append(cut(x)) or ranged[-1])
    monkeypatch.setattr(O, "ROWS_A_RANGE", 2)
    assert rows(O.global_lag(df, ["id"], ["u"])) == want
    assert ranged[0].rdd.getNumPartitions() == n // 2


def test_parts_are_parsed_once(spark, tmp_path):
    from trellis.sources import csv as C

    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    lines = spark.createDataFrame([("p1", "1", "10"), ("p1", None, "11"), ("p2", "2", "10"), ("p2", "1", "10")], "part string, a string, b string")
    key = lambda c: F.col(c).cast("long")
    g, summary = C.load_parts(Graph(), lines.mapInPandas(look, lines.schema),
                              nodes=[{"label": "A", "key": {"k": key("a")}}, {"label": "B", "key": {"k": key("b")}}],
                              rels=[{"rel_type": "T", "src_label": "A", "dst_label": "B", "src_on": {"k": key("a")}, "dst_on": {"k": key("b")}}])
    assert rows(summary) == [("p1", 3, 0, 1, 0), ("p2", 1, 2, 1, 1)]
    assert g.rels["T", "A", "B"].count() == 2
    assert seen.value == 4


def test_lines_without_quotes_are_cut_alike(spark):
    from trellis.sources.csv import split_line

    text = ["a,,b", ",", "\\N,x,", "a", 'q,"x,y","",z', ""]
    got = spark.createDataFrame([(t,) for t in text], "t string").select("t", split_line(F.col("t")).alias("r")).collect()
    assert {r["t"]: r["r"] for r in got} == {"a,,b": ["a", None, "b"], ",": [None, None], "\\N,x,": [None, "x", None], "a": ["a"],
                                             'q,"x,y","",z': ["q", "x,y", "", "z"], "": [None]}
