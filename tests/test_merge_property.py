"""Upsert semantics against a dictionary model (Hypothesis): last by order wins, keys not in the
input keep their values, a null key does nothing, and merging twice equals merging once."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from trellis.model import Graph
from trellis.operators.merge import merge_nodes

keys = st.one_of(st.none(), st.integers(0, 6))
existing_s = st.dictionaries(st.integers(0, 6), st.integers(-50, 50), max_size=6)
input_s = st.lists(st.tuples(keys, st.integers(-50, 50)), max_size=10)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(existing=existing_s, incoming=input_s)
def test_merge_matches_dict_model(spark, existing, incoming):
    cur = spark.createDataFrame(sorted(existing.items()) or [(0, 0)], "k long, v long")
    if not existing:
        cur = cur.where(F.lit(False))
    inp = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(incoming)] or [(None, 0, 0)],
                                "k long, v long, seq int")
    if not incoming:
        inp = inp.where(F.lit(False))
    g = Graph().with_nodes("N", cur, "k")
    once, _ = merge_nodes(g, "N", inp, {"k": F.col("k")}, set_={"v": F.col("v")}, order_by=[F.col("seq")])
    model = dict(existing)
    for k, v in incoming:
        if k is not None:
            model[k] = v
    assert rows(once.nodes["N"], "k", "v") == rows(spark.createDataFrame(sorted(model.items()) or [(0, 0)],
                                                                         "k long, v long")
                                                   .where(F.lit(bool(model))), "k", "v")
    twice, _ = merge_nodes(once, "N", inp, {"k": F.col("k")}, set_={"v": F.col("v")}, order_by=[F.col("seq")])
    assert rows(twice.nodes["N"], "k", "v") == rows(once.nodes["N"], "k", "v")
