"""Nodes that share a key, catalog commits and deltas, loads by parts, whole CSV rows, reports."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trellis.catalog import Catalog
from trellis.model import NODE_ID, Graph
from trellis.operators.merge import create_nodes, create_rels, merge_nodes, merge_rels, set_rel_property
from trellis.session import scratch_path
from trellis.sources import csv as C
from trellis.sources import sinks as K
from trellis.streaming.parts import NodeMerge, RelMerge, stream_merge_parts


# ---------------------------------------------------------------- CREATE of an existing key
def placed(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b")], "k long, name string")
    o = spark.createDataFrame([(10,), (11,)], "o long")
    r = spark.createDataFrame([("r1", 1, 10), ("r2", 1, 11)], "rel_id string, src long, dst long")
    return Graph().with_nodes("C", c, "k").with_nodes("O", o, "o").with_rels("P", "C", "O", r, dst_exists=True)


def test_a_created_node_of_an_existing_key_has_no_relationships(spark):
    g = create_nodes(placed(spark), "C", spark.createDataFrame([(1, "twin")], "k long, name string"))
    hop = g.match("c", "C").out("r", "P", "o", "O")
    assert rows(hop.ret("c.k", "c.name", o="o.o")) == [(1, "a", 10), (1, "a", 11)]
    assert rows(g.match("o", "O").inc("r", "P", "c", "C").ret("c.name", o="o")) == [("a", 10), ("a", 11)]
    # SET on the relationships writes each once
    g2 = set_rel_property(g, ("P", "C", "O"), "who", lambda s, d, r: s("name"))
    assert rows(g2.rels["P", "C", "O"], "rel_id", "who") == [("r1", "a"), ("r2", "a")]
    # a relationship made by key goes to every node of that key
    g3 = create_rels(g, "P", "C", "O", spark.createDataFrame([(1, 10)], "k long, o long"), {"k": "k"}, {"o": "o"})
    assert g3.rels["P", "C", "O"].count() == 4
    # the surrogate id is no property
    assert g.props("C") == ["k", "name"] and "name" in [r.name for r in g.inspect().collect()]
    assert NODE_ID not in [r.name for r in g.inspect().collect()]


def test_merge_on_shared_keys_and_on_another_property(spark):
    g = create_nodes(placed(spark), "C", spark.createDataFrame([(1, "twin")], "k long, name string"))
    inp = spark.createDataFrame([(1,), (5,)], "x long")
    g2, touched = merge_nodes(g, "C", inp, {"k": F.col("x")}, set_={"seen": F.lit(True)})
    assert rows(g2.nodes["C"], "k", "name", "seen") == [(1, "a", True), (1, "twin", True), (2, "b", None), (5, None, True)]
    assert rows(touched, "k", "created") == [(1, False), (1, False), (5, True)] and NODE_ID not in touched.columns
    assert g2.nodes["C"].where(F.col(NODE_ID).isNull()).count() == 0 and g2.nodes["C"].select(NODE_ID).distinct().count() == 4
    # MERGE by a property that is not the key leaves the relationship ends where they are
    g3, _ = merge_nodes(placed(spark), "C", spark.createDataFrame([("a",)], "n string"), {"name": F.col("n")}, set_={"hit": F.lit(1)})
    assert rows(g3.match("c", "C").out("r", "P", "o", "O").ret("c.name", "c.hit", o="o.o")) == [("a", 1, 10), ("a", 1, 11)]
    g4, _ = merge_rels(g3, "P", "C", "O", spark.createDataFrame([(1, 10)], "k long, o long"), {"k": "k"}, {"o": "o"}, set_={"w": F.lit(7)})
    assert rows(g4.rels["P", "C", "O"], "rel_id", "w") == [("r1", 7), ("r2", None)]


def test_create_without_a_key_and_save(spark):
    g = create_nodes(Graph(), "L", spark.createDataFrame([("x",), ("x",)], "p string"))
    g = create_nodes(g, "L", spark.createDataFrame([("y",)], "p string"))
    assert rows(g.match("n", "L").ret("n.p")) == [("x",), ("x",), ("y",)]
    assert g.match("n", "L").df.select("n___id").distinct().count() == 3
    cat = Catalog(spark, scratch_path(spark, "t-cat"))
    cat.save("g", g)
    back = cat.load("g")
    assert back.keys["L"] == () and back.surrogate("L") and rows(back.match("n", "L").ret("n.p")) == [("x",), ("x",), ("y",)]


# ---------------------------------------------------------------- catalog
def node(spark, *values):
    return Graph().with_nodes("N", spark.createDataFrame([(v,) for v in values], "k long"), "k")


def test_a_saver_that_dies_before_its_commit_changes_nothing(spark, monkeypatch):
    cat = Catalog(spark, scratch_path(spark, "t-cat"))
    assert cat.save("g", node(spark, 1)) == 1
    create = cat._create
    monkeypatch.setattr(cat, "_create", lambda p: (_ for _ in ()).throw(RuntimeError("died")) if p.endswith("_committed") else create(p))
    with pytest.raises(RuntimeError):
        cat.save("g", node(spark, 2))
    monkeypatch.undo()
    assert rows(cat.load("g").nodes["N"]) == [(1,)] and rows(cat.versions("g")) == [(1, True)]
    assert cat.save("g", node(spark, 3)) == 3                # the dead number is passed over
    assert rows(cat.load("g").nodes["N"]) == [(3,)] and rows(cat.list()) == [("g",)]


def test_two_savers_never_share_a_version(spark):
    root = scratch_path(spark, "t-cat")
    one, two = Catalog(spark, root), Catalog(spark, root)
    numbers = []
    claim = one._claim

    def slow(name):
        v = claim(name)
        numbers.append(two.save(name, node(spark, 2)))       # the other saver runs between claim and commit
        return v

    one._claim = slow
    numbers.append(one.save("g", node(spark, 1)))
    assert sorted(numbers) == [1, 2] and rows(one.versions("g")) == [(1, False), (2, True)]
    assert rows(two.load("g").nodes["N"]) == [(2,)]


@pytest.mark.parametrize("bad", ["a/b", "", "_x", ".x", "a b", "../x"])
def test_graph_names_are_checked(spark, bad):
    with pytest.raises(ValueError):
        Catalog(spark, scratch_path(spark, "t-cat")).save(bad, node(spark, 1))


def test_deltas_replace_rows_of_their_keys_until_a_new_base_is_written(spark, monkeypatch):
    import trellis.catalog as mod
    monkeypatch.setattr(mod, "MAX_DELTAS", 2)
    cat = Catalog(spark, scratch_path(spark, "t-cat"))
    make = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    cat.save("g", Graph().with_nodes("N", make((1, "a"), (2, "b"), (None, "n")), "k"))
    held = {1: "a", 2: "b", None: "n"}
    for i, change in enumerate([{2: "c", 3: "d"}, {3: "e"}, {1: "f", 4: "g"}, {None: "m"}]):
        held.update(change)
        g = cat.load("g")
        after = g.with_nodes("N", make(*held.items()), "k")
        cat.append("g", after, {("node", "N"): (make(*change.items()), ["k"])}, note=str(i))
        assert rows(cat.load("g").nodes["N"]) == rows(make(*held.items())) and cat.note("g") == str(i)
        sets = cat._tables("g")["node", "N"]
        assert len(sets) == [2, 3, 1, 2][i]                  # base and deltas; the third change is written as a base


# ---------------------------------------------------------------- parts
def plain_parts(table):
    """Parts one after the other over dictionaries."""
    customers, orders, rels, out = set(), set(), set(), []
    for part in sorted({r[0] for r in table}):
        mine = [r for r in table if r[0] == part]
        n = [0, 0, 0, 0]
        for have, keys in ((customers, {r[1] for r in mine if r[1] is not None}), (orders, {r[3] for r in mine if r[3] is not None})):
            n[0] += len(keys - have)
            n[1] += len(keys & have)
            have |= keys
        keys = {(r[2], r[3]) for r in mine if r[2] in customers and r[3] in orders}
        n[2], n[3] = len(keys - rels), len(keys & rels)
        rels |= keys
        out.append((part, *n))
    return out, rels


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_parts_attribute_relationships_as_one_after_the_other_would(spark, seed):
    rnd = random.Random(seed)
    table = [(f"p{rnd.randrange(4)}", rnd.choice([None, c]), c, rnd.choice([None, *range(8)])) for c in (rnd.randrange(10) for _ in range(60))]
    frame = spark.createDataFrame(table, "part string, cust long, c long, o long")
    spec = dict(nodes=[{"label": "C", "key": {"k": F.col("cust")}}, {"label": "O", "key": {"o": F.col("o")}}],
                rels=[{"rel_type": "P", "src_label": "C", "dst_label": "O", "src_on": {"k": F.col("c")}, "dst_on": {"o": F.col("o")}}])
    g, summary = C.load_parts(Graph(), frame, **spec)
    want, rels = plain_parts(table)
    assert rows(summary) == want and rows(g.rels["P", "C", "O"], "src", "dst") == sorted(rels)
    # the same load again: everything is matched; rows whose customer came late now find it
    g2, again = C.load_parts(g, frame, **spec)
    assert all(r.nodes_created == 0 for r in again.collect())
    assert sum(r.rels_created for r in again.collect()) == len({(c, o) for _, _, c, o in table if c in {x for _, x, *_ in table} and o is not None}) - len(rels)
    assert rows(g2.nodes["C"], "k") == rows(g.nodes["C"], "k")


def test_parts_are_read_from_folders_and_files(spark):
    path = scratch_path(spark, "t-parts")
    C.unload_csv(spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k long, d string"), path, partition_by=["d"])
    got = C.with_part(C.read_positional(spark, path, 1), path.rsplit("/", 1)[-1])
    assert rows(got, "_c0", "part") == [("1", "d=x"), ("2", "d=y"), ("3", "d=x")]
    assert C.with_part(C.read_positional(spark, path, 1)).select("part").distinct().count() >= 2


def test_stream_of_deltas_writes_what_it_touches_and_resumes(spark, monkeypatch):
    base = scratch_path(spark, "t-delta")
    spark.range(0, 4000).select("id", F.lit("old")).write.csv(f"{base}/first")
    cat = Catalog(spark, f"{base}/cat")
    key, order = F.col("_c0").cast("long"), F.col("_c1")
    merges = [NodeMerge("N", {"k": key}, set_={"v": order}), RelMerge("R", "N", "N", {"k": key}, {"k": (key % 5)}, set_={"w": order})]
    schema = C.positional_schema(2)
    assert stream_merge_parts(spark, f"{base}/first", schema, cat, "g", merges, f"{base}/c0", files_per_batch=100) == 1
    # two files a batch; each has three keys, one of them new
    for i in range(4):
        spark.createDataFrame([(f"{i}", f"n{i}"), (f"{i + 100}", f"n{i}"), (f"{9000 + i}", f"n{i}")], "a string, b string").coalesce(1).write.csv(f"{base}/more/f{i}")

    def died(*a, **kw):
        if cat.note("g").endswith("c1#0"):
            raise RuntimeError("died")
        return append(*a, **kw)

    append = cat.append
    monkeypatch.setattr(cat, "append", died)
    more = f"{base}/more/*"
    with pytest.raises(Exception):
        stream_merge_parts(spark, more, schema, cat, "g", merges, f"{base}/c1", files_per_batch=2)
    monkeypatch.undo()
    assert stream_merge_parts(spark, more, schema, cat, "g", merges, f"{base}/c1", files_per_batch=2) == 1
    sets = cat._tables("g")
    assert [spark.read.parquet(p).count() for _, p in sets["node", "N"]] == [4000, 6, 6]
    assert [spark.read.parquet(p).count() for _, p in sets["rel", "R", "N", "N"]] == [4000, 6, 6]
    want = {k: "old" for k in range(4000)} | {k: f"n{i}" for i in range(4) for k in (i, i + 100, 9000 + i)}
    g = cat.load("g")
    assert rows(g.nodes["N"], "k", "v") == sorted(want.items(), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(g.rels["R", "N", "N"].select("src", "dst", "w")) == sorted(((k, k % 5, v) for k, v in want.items()), key=lambda t: tuple((False, str(x)) for x in t))
    # a batch that was committed before the run died is passed over when it comes again
    note = cat.note("g")
    version = cat.versions("g").where("live").first().version
    again = Catalog(spark, f"{base}/cat")
    monkeypatch.setattr(again, "note", lambda name: f"{base}/c2#0")
    assert stream_merge_parts(spark, more, schema, again, "g", merges, f"{base}/c2", files_per_batch=100) == 0
    assert cat.note("g") == note and cat.versions("g").where("live").first().version == version


# ---------------------------------------------------------------- CSV rows and reports
def test_all_fields_of_a_row_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,2,3,4\n"x,y","say ""hi""",\n,b\n\n"",\\N,"z"\n', encoding="utf-8")
    got = [list(r["row"]) for r in C.read_positional(spark, str(tmp_path / "a.csv"), 2).collect()]
    assert got == [["1", "2", "3", "4"], ["x,y", 'say "hi"', None], [None, "b"], ["", None, "z"]]
    r = C.read_positional(spark, str(tmp_path / "a.csv"), 2).select(C.row(3).alias("d"), "_c1").first()
    assert (r.d, r._c1) == ("4", "2")


def test_a_longer_row_is_an_error_where_the_reader_needs_the_width(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n1,2\n3,4,5\n", encoding="utf-8")
    with pytest.raises(Exception, match="more than 2 fields"):
        C.read_positional(spark, str(tmp_path / "h.csv"), 2, header=True).select("row").collect()
    assert len(C.read_positional(spark, str(tmp_path / "h.csv"), 3, header=True).select("row").collect()) == 2


def test_report_keeps_fields_that_are_null_everywhere(spark):
    path = scratch_path(spark, "t-report")
    head = K.write_report(spark, spark.createDataFrame([("a", None), ("b", None)], "hs_name string, plan string"), path, {"run_id": "7"}).collect()
    assert [(r.run_id, r.subscription_count) for r in head] == [("7", 2)]
    assert rows(K.read_report(spark, path)) == [("a", None), ("b", None)]
    empty = scratch_path(spark, "t-report")
    assert K.write_report(spark, spark.createDataFrame([], "hs_name string"), empty, {"run_id": "7"}).first().subscription_count == 0
    assert K.read_report(spark, empty).columns == ["hs_name"] and K.read_report(spark, empty).collect() == []


def test_single_document_with_a_schema(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"subscriptions": [{"hs_name": "a"}, {"hs_name": "b", "email": "x"}]}', encoding="utf-8")
    got = K.read_report(spark, str(tmp_path / "r.json"), "hs_name string, email string, plan string")
    assert rows(got) == [("a", None, None), ("b", "x", None)]


def test_array_of_objects_refuses_a_large_result(spark):
    assert len(K.array_of_objects(spark.range(5), ["id"], most=5).first()["items"]) == 5
    with pytest.raises(Exception, match="more than 4 rows"):
        K.array_of_objects(spark.range(5), ["id"], most=4).collect()
