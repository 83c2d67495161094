"""The pipeline's stages: columns, clashing names, edge rows and decisions."""

from collections import Counter

import pytest
from llm_cases import PROSE, SCHEMA, SF, edge_rows, table_dir
from pyspark.sql import functions as F

import corpus_pipeline
from trellis.llm.common import table
from test_llm_operators import brute_components

CLASHES = ("n", "share", "rep", "kept", "p_good", "q_row", "q_n_words", "near_id", "component_id", "n_shingles", "copies", "mix_row",
           "mix_domain", "mix_epoch", "rest", "key", "full_epochs", "virtual_slot_", "vslot", "item_id", "n_tokens", "label")


@pytest.fixture(scope="module")
def bench_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipe")
    bench = spark.createDataFrame([(1, " ".join(f"secret{i}" for i in range(30))), (2, None)], "item_id long, text string")
    return table_dir(spark, path, spark.createDataFrame(edge_rows(), SCHEMA), benchmark=bench)


@pytest.mark.parametrize("number", range(5))
def test_stage_keeps_columns_with_clashing_names(spark, bench_dir, number):
    docs = table(spark, bench_dir, "documents").select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHES))
    out = corpus_pipeline.STAGES[number][1](spark, docs, bench_dir)
    assert out.columns[:len(docs.columns)] == docs.columns
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHES)


@pytest.mark.parametrize("number", range(5))
def test_stage_on_an_empty_table(spark, bench_dir, number):
    docs = table(spark, bench_dir, "documents").filter("false")
    assert corpus_pipeline.STAGES[number][1](spark, docs, bench_dir).collect() == []


def test_near_copy_stage_keeps_the_smallest_of_each_group(spark, bench_dir):
    docs = table(spark, SF, "documents")
    comp = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    out = corpus_pipeline.near_copy_stage(spark, docs, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _, c in comp if i == c)


def test_near_copy_stage_on_edge_rows(spark, bench_dir):
    out = corpus_pipeline.near_copy_stage(spark, table(spark, bench_dir, "documents"), bench_dir).collect()
    got = Counter(r["doc_id"] for r in out)
    assert got[1] == 1 and got[2] == 0 and got[3] in (0, 1) and got[7] == 1 and got[8] == 0
    assert got[4] == got[5] == got[6] == 1 and got[None] == 0     # the row without an id is a near copy of row 1


def test_benchmark_stage_drops_only_what_holds_an_item(spark, bench_dir):
    planted = PROSE + " " + " ".join(f"Secret{i}" for i in range(30)) + " " + PROSE
    docs = table(spark, bench_dir, "documents").unionByName(
        spark.createDataFrame([(99, planted, "en", "s1", 1)], SCHEMA))
    left = Counter(r["doc_id"] for r in corpus_pipeline.benchmark_stage(spark, docs, bench_dir).collect())
    assert left == Counter(i for i, *_ in edge_rows())


def test_run_is_the_stages_one_after_another(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = table(spark, SF, "documents")
    assert out.columns == [*docs.columns, "virtual_slot", "shard"]
    rows = out.collect()
    assert rows and all(0 <= r["shard"] < 24 for r in rows)
    kept = corpus_pipeline.quality_stage(spark, docs, SF)
    kept = corpus_pipeline.benchmark_stage(spark, corpus_pipeline.near_copy_stage(spark, kept, SF), SF)
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in kept.collect()}
    again = Counter(r["doc_id"] for r in rows)
    assert max(again.values()) <= 3


def test_near_copy_stage_judges_texts_not_ids(spark):
    """An id with two texts loses neither, rows without an id take part, equal rows leave one."""
    other = " ".join(f"b{i}" for i in range(60))
    rows = [(1, PROSE, "x"), (2, PROSE, "y"), (2, other, "z"), (None, PROSE, "n"), (None, PROSE, "n"), (None, other + " q", "n"), (3, None, "k"),
            (4, " ", "k"), (5, "u v w", "k"), (5, "u v w", "k"), (None, "only here", "n"), (None, "only here", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((tuple(r) for r in corpus_pipeline.near_copy_stage(spark, docs, None).collect()), key=repr)
    assert got == sorted([(1, PROSE, "x"), (2, other, "z"), (3, None, "k"), (4, " ", "k"), (5, "u v w", "k"), (None, "only here", "n")], key=repr)
