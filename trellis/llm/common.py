"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# A word is a run of anything but ASCII white space.
SPACES = "[\\x20\\x09-\\x0D]+"


def register(name: str, sql: str | None = None):
    """Add a query ``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its DuckDB text."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# (setting, Spark's default, ours): bytes sent to Python at once, rows read from Parquet at once
_BATCHES = [("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"),
            ("spark.sql.parquet.columnarReaderBatchSize", "4096", "512")]
# of scratch: a task holds a row group in memory while it writes or reads it; long rows are counted every ten
_GROUPS = {"parquet.block.size": 16_000_000, "parquet.page.size.row.check.min": 10}


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of 8 MB and read 512 at once, unless the session says otherwise.

    Rows here are whole texts and sets; at the defaults of 64 MB and 4,096 rows a task would hold
    several copies of that, and a small heap runs out where many tasks share it."""
    for name, default, ours in _BATCHES:
        if spark.conf.get(name) == default:
            spark.conf.set(name, ours)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: a cut that survives lost executors."""
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.options(**_GROUPS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver to drop frames that nothing refers to any more.

    Spark removes the shuffle files of a finished step when the driver's memory is collected; a
    driver with little to do collects late, and the files of all steps lie on disk until then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


WHITE = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """The words of a text; none for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times: a lambda argument is computed once,
    a column used inside another lambda would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)
