"""Previous-row lookup over a global order without one giant window group.

``lag(x) OVER (PARTITION BY day ORDER BY ts)`` puts a whole day into one
task; if one day holds a third of the data that task is the job.  Here the
rows are range-partitioned on the order columns (balanced by sampling), the
lag is taken inside each range, and the first row of every range borrows the
last row of the nearest earlier non-empty range (a lag over a table with one
row per range).  The group condition (same day) is then a plain filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trellis.session import cut_lineage

ROWS_A_RANGE = 100_000     # rows that one range, and the task that reads it, has on average at most


def global_lag(df: DataFrame, order: list[str], cols: list[str], n_ranges: int | None = None,
               prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` for every ``c`` in ``cols``: the value on the previous row by ``order``
    (``order`` must be a total order, e.g. end with a unique id).

    Ranges are as many as keep each near ``ROWS_A_RANGE`` rows where these are more than the cores, else left to Spark."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if n_ranges is None and (needed := -(-df.count() // ROWS_A_RANGE)) > cores:
        n_ranges = needed

    # the range id must be one fixed value per row for both uses below (AQE may
    # coalesce the range partitions differently in two plan branches), so the
    # narrow projection is written once to the shared checkpoint folder
    byrange = df.repartitionByRange(n_ranges, *order) if n_ranges else df.repartitionByRange(*order)
    ranged = cut_lineage(byrange.withColumn("_rng", F.spark_partition_id()))
    w = Window.partitionBy("_rng").orderBy(*order)
    inner = ranged.repartition(n_ranges, "_rng") if n_ranges and n_ranges > cores else ranged
    for c in cols + order:
        inner = inner.withColumn(f"_lag_{c}", F.lag(c).over(w))
    inner = inner.withColumn("_first", F.row_number().over(w) == 1)
    # last row of each range, handed to the next non-empty range: a table of one row per range
    last = ranged.groupBy("_rng").agg(F.max_by(F.struct(*[F.col(c) for c in cols + order]),
                                               F.struct(*[F.col(c) for c in order])).alias("_own"))
    fix = last.select("_rng", F.lag("_own").over(Window.orderBy("_rng")).alias("_last"))
    out = inner.join(F.broadcast(fix), "_rng", "left")
    sel = [F.col(c) for c in df.columns]
    for c in cols:
        sel.append(F.when(F.col("_first"), F.col(f"_last.{c}")).otherwise(F.col(f"_lag_{c}")).alias(prefix + c))
    for c in order:
        if c not in cols:
            sel.append(F.when(F.col("_first"), F.col(f"_last.{c}")).otherwise(F.col(f"_lag_{c}")).alias(prefix + c))
    return out.select(*sel)
