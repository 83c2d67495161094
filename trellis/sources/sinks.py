"""Result sinks and result-shape handling.

* ``write_rows``: query rows → ``(row_index, row_data VARIANT)`` table, the
  index 0-based in a caller-given total order, computed without a global
  window (range partitions + per-partition offsets from a table with one row
  per partition).
* ``normalize_result``: the array / ``{data}`` / ``{records}`` / ``{results}``
  / scalar / null rule as column expressions.
* ``write_report`` / ``read_report``: the metrics report as a header row plus
  records written in parallel as JSON lines (no single-document array, which
  would pass every record through one task).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from trellis.session import cut_lineage

TABLE_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_$]*[.][A-Za-z_][A-Za-z0-9_$]*[.][A-Za-z_][A-Za-z0-9_$]*$")
WRITE_NOTE = "row_data is a VARIANT: each query returns columns of its own, so the table has no fixed ones"


def check_table_name(name: str | None) -> str:
    """An unquoted fully qualified ``CATALOG.SCHEMA.TABLE``."""
    if not name or not TABLE_NAME.match(name):
        raise ValueError(f"cannot write to {name!r}: the output table needs three plain names, catalog.schema.table")
    return name


def with_row_index(df: DataFrame, order: list[str], n_ranges: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (must be total), distributed.

    Rows are range-partitioned on the order; the range id is materialised once
    (checkpoint) so counting and numbering see the same ranges; each row's
    index is its range's offset plus its number inside the range."""
    # without an explicit count AQE may merge small ranges; the range id is written once either way
    byrange = df.repartitionByRange(n_ranges, *order) if n_ranges else df.repartitionByRange(*order)
    ranged = cut_lineage(byrange.withColumn("_rng", F.spark_partition_id()))
    counts = ranged.groupBy("_rng").agg(F.count("*").alias("_n"))
    # one row per range: a running sum over a table of at most n rows
    offsets = counts.select("_rng", (F.sum("_n").over(Window.orderBy("_rng")
                                                      .rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    w = Window.partitionBy("_rng").orderBy(*order)
    numbered = ranged.withColumn("_rn", F.row_number().over(w))
    out = numbered.join(F.broadcast(offsets), "_rng")
    return out.select((F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn") - 1).cast("long").alias("row_index"),
                      *[F.col(c) for c in df.columns])


def write_rows(df: DataFrame, output: str, order: list[str], as_table: bool = False) -> DataFrame:
    """Replace ``output`` with ``(row_index, row_data)`` and return the summary row.

    ``as_table`` writes a catalog table (name checked as CATALOG.SCHEMA.TABLE);
    otherwise ``output`` is a folder (parquet keeps VARIANT)."""
    indexed = with_row_index(df, order)
    rows = indexed.select("row_index", F.to_variant_object(F.struct(*[F.col(c) for c in df.columns])).alias("row_data"))
    if as_table:
        check_table_name(output)
        rows.write.mode("overwrite").saveAsTable(output)
        written = df.sparkSession.table(output)
    else:
        rows.write.mode("overwrite").parquet(output)
        written = df.sparkSession.read.parquet(output)
    return written.agg(F.count("*").alias("row_count")).select(
        F.lit(output).alias("output_table"), "row_count", F.lit(WRITE_NOTE).alias("note"))


# The spellings under which callers pass the write options.
WRITE_KEYS = ["write", "WRITE"]
TABLE_KEYS = ["outputTable", "output_table", "OUTPUTTABLE", "OUTPUT_TABLE"]


def option(options: dict | None, spellings: list[str]):
    """The value of an option under the first of its spellings that is there; None without it."""
    return next((options[s] for s in spellings if s in (options or {})), None)


def query_result(df: DataFrame, options=None, order: list[str] | None = None) -> DataFrame:
    """``graph_query(graph, query, options)``: without ``write`` options the rows
    themselves; with them (F24: looked up under several spellings, options as a dict
    or JSON text) the rows are written to the checked table and the summary row is
    returned (S10-S12).  ``order`` (default: all columns) fixes ROW_INDEX."""
    opts = json.loads(options) if isinstance(options, str) else (options or {})
    write = option(opts, WRITE_KEYS)
    if write is None:
        return df
    table = check_table_name(option(write, TABLE_KEYS))
    return write_rows(df, table, order or df.columns, as_table=True)


def query_echo(graph_name: str, query_text: str, df: DataFrame) -> DataFrame:
    """G16 ``{graph_name, cypher_query, result}`` per result row."""
    return df.select(F.lit(graph_name).alias("graph_name"), F.lit(query_text).alias("cypher_query"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("result"))


def parse_or_raw(text: Column) -> Column:
    """JSON text → VARIANT; unparseable text → ``{"raw_result": text}``; SQL null → null."""
    return F.when(text.isNull(), F.lit(None)).otherwise(
        F.coalesce(F.try_parse_json(text), F.to_variant_object(F.struct(text.alias("raw_result")))))


def normalize_result(v: Column) -> Column:
    """The list of rows a result holds (``ARRAY<VARIANT>``)."""
    arr = "array<variant>"
    is_empty = (F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("x")) == "") & \
        (F.schema_of_variant(v) == "STRING")
    return F.coalesce(
        F.try_variant_get(v, "$", arr),
        F.try_variant_get(v, "$.data", arr),
        F.try_variant_get(v, "$.records", arr),
        F.try_variant_get(v, "$.results", arr),
        F.when(v.isNull() | F.is_variant_null(v) | is_empty, F.array().cast(arr)),
        F.array(v))


def array_of_objects(df: DataFrame, order: list[str], most: int = 10_000) -> DataFrame:
    """A6 ``ARRAY_AGG(OBJECT_CONSTRUCT(*))``: a small result (a top-k, a status list) as one array of
    objects, in ``order``.  More than ``most`` rows are an error: the whole input becomes one row."""
    packed = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in df.columns]).alias("obj"))
    items = F.transform("a", lambda x: x["obj"])
    return df.limit(most + 1).agg(F.sort_array(F.collect_list(packed)).alias("a")).select(
        F.when(F.size("a") > most, F.raise_error(F.lit(f"more than {most} rows for one array"))).otherwise(items).alias("items"))


# ---------------------------------------------------------------- JSON report
def write_report(spark: SparkSession, records: DataFrame, path: str, header: dict) -> DataFrame:
    """``{export_timestamp, run_id, listing_filter, subscription_count, subscriptions}``.

    Records go to ``<path>/subscriptions`` as JSON lines written by every task and are counted
    while they are written.  The header is one row at ``<path>/header`` with the count and the
    records' schema, so nothing is inferred when the report is read and a field that is null in
    every record stays.  Returns the header row without the schema."""
    seen = Observation()
    records.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/subscriptions")
    schema = records.schema
    names = StructType([StructField(k, StringType()) for k in header])
    head = spark.createDataFrame([tuple(header.values())], names).withColumn("subscription_count", F.lit(seen.get["n"]).cast("long"))
    head.withColumn("subscription_schema", F.lit(schema.json())).coalesce(1).write.mode("overwrite").json(f"{path}/header")
    kinds = StructType([*names, StructField("subscription_count", LongType())])
    return spark.read.schema(kinds).json(f"{path}/header")


def read_report(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """The report's records as rows.

    A folder with a ``header`` is our layout and is read with the schema that the header holds.
    Anything else is one multi-line document with a ``subscriptions`` array, of the record
    ``schema`` given; without one its fields are inferred from the document."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/header")
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        if schema is None:
            held = spark.read.schema("subscription_schema string").json(f"{path}/header").first()[0]      # one row
            schema = StructType.fromJson(json.loads(held))
        return spark.read.schema(schema).json(f"{path}/subscriptions")
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        record = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        r = r.schema(StructType([StructField("subscriptions", ArrayType(record))]))
    return r.json(path).select(F.explode("subscriptions").alias("s")).select("s.*")
