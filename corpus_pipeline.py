"""The training-data pipeline over ``documents``.

Five stages, each a function ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage
before it kept, written as Parquet and read again in between:

1. quality rules: documents that the rules' label model rejects go;
2. n-gram Jaccard join: of each group of near copies the document of smallest id stays;
3. benchmark decontamination: documents that contain a benchmark item go;
4. mixing: sources are dealt to the target weights; a document stays once for each epoch it is in;
5. sharding: each row gets its fixed virtual slot and the shard the slot map gives it.

All stages but the last return the columns of ``documents``; the last adds ``virtual_slot``
and ``shard``.  Rows with a null text fail the first stage.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trellis.llm import decontaminate, jaccard_join, mixing, quality_rules, queries, sharding
from trellis.llm.common import store, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shards(docs)


STAGES = [("quality_rules", quality_stage), ("jaccard_join", near_copy_stage), ("decontaminate", benchmark_stage),
          ("mix_weights", mixing_stage), ("virtual_slots", sharding_stage)]

# SQL has no expectation-maximisation; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def load() -> tuple[dict, dict]:
    """Queries and DuckDB SQL of the operators and of the pipeline."""
    run_queries, sql = (dict(x) for x in queries.load())
    run_queries["pipeline"] = run
    if ORACLE_SQL is not None:
        sql["pipeline"] = ORACLE_SQL
    return run_queries, sql
