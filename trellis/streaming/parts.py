"""Part-by-part incremental load with Structured Streaming.

``readStream`` over a folder of CSV parts, ``files_per_batch`` files per micro-batch,
``trigger(availableNow=True)`` so the query stops when the folder is drained.  Each micro-batch
is merged into the graph held in the catalog; the streaming checkpoint records which parts are
done, so a failed run resumes after the last finished part and a finished part is never applied
twice (earlier parts stay when a later one fails).

``stream_merge_parts`` takes the merges as data.  It looks up only the rows that a batch can
touch and commits them as keyed deltas, so a batch writes as many rows as it touches.  A version
notes its batch: a batch that was committed before the run died is passed over when it comes
again.  ``stream_load_parts`` takes any function from graph to graph and writes changed tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trellis.catalog import Catalog
from trellis.model import NODE_ID, Graph
from trellis.operators.merge import _as_col, _endpoint, merge_nodes, merge_rels_by_id
from trellis.session import cut_lineage, stored
from trellis.sources.csv import READ_OPTS


@dataclass(frozen=True)
class NodeMerge:
    """MERGE (n:label {key}) of each row, with ON CREATE, ON MATCH and SET values."""

    label: str
    key: dict
    set_: dict = field(default_factory=dict)
    on_create: dict = field(default_factory=dict)
    on_match: dict = field(default_factory=dict)

    def apply(self, g: Graph, rows: DataFrame, order: list[Column]) -> tuple[Graph, tuple, DataFrame, list[str]]:
        keys = list(self.key)
        old = g.nodes.get(self.label)
        met = rows.select(*[_as_col(v).alias(k) for k, v in self.key.items()]).dropna().distinct()
        small = g if old is None else replace(g, nodes={**g.nodes, self.label: old.join(met, keys, "left_semi")})
        # every row of the small table is met by the batch or made by it
        after, _ = merge_nodes(small, self.label, rows, self.key, self.on_create, self.on_match, self.set_, order)
        touched = cut_lineage(after.nodes[self.label])
        if old is not None:
            rest = old.join(met, keys, "left_anti")
            after = replace(after, nodes={**after.nodes, self.label: rest.unionByName(touched, allowMissingColumns=True)})
        else:
            after = replace(after, nodes={**after.nodes, self.label: touched})
        return after, ("node", self.label), touched, [NODE_ID] if NODE_ID in touched.columns else keys


@dataclass(frozen=True)
class RelMerge:
    """MATCH both ends, MERGE (a)-[r:rel_type {key_props}]->(b) of each row."""

    rel_type: str
    src_label: str
    dst_label: str
    src_on: dict
    dst_on: dict
    key_props: dict = field(default_factory=dict)
    set_: dict = field(default_factory=dict)
    on_create: dict = field(default_factory=dict)
    on_match: dict = field(default_factory=dict)

    def apply(self, g: Graph, rows: DataFrame, order: list[Column]) -> tuple[Graph, tuple, DataFrame, list[str]]:
        rk = (self.rel_type, self.src_label, self.dst_label)
        old = g.rels.get(rk)
        small = g
        if old is not None:
            ends = _endpoint(g, rows, self.src_label, self.src_on, "__src").select(F.col("__src").alias("src")).distinct()
            small = replace(g, rels={**g.rels, rk: old.join(ends, "src", "left_semi")})
        after, touched = merge_rels_by_id(small, *rk, rows, self.src_on, self.dst_on, self.key_props, self.on_create, self.on_match, self.set_, order)
        keys = ["src", "dst", *self.key_props]
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        touched = cut_lineage(touched.select(*after.rels[rk].columns))       # the merge runs once
        table = touched
        if old is not None:
            old = old.withColumn("rel_id", F.col("rel_id").cast("string"))
            found = touched.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            table = old.join(found, same, "left_anti").unionByName(touched, allowMissingColumns=True)
        return replace(after, rels={**after.rels, rk: table}), ("rel", *rk), touched, keys


def _stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int, header: bool) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("header", str(header).lower())
    for k, v in READ_OPTS.items():
        r = r.option(k, v)
    return r.csv(folder)


def stream_merge_parts(spark: SparkSession, folder: str, schema: T.StructType, catalog: Catalog, graph_name: str,
                       merges: list[NodeMerge | RelMerge], checkpoint: str, files_per_batch: int = 1, header: bool = False,
                       order_by: list[Column] | None = None) -> int:
    """Apply ``merges`` to each batch of part files, in order; returns the number of batches applied.

    Among rows of one key in a batch the last wins, by ``order_by``, else by part name; then by
    the row's values."""
    stream = _stream(spark, folder, schema, files_per_batch, header).withColumn("part", F.col("_metadata.file_path"))
    order = [*(order_by or [F.col("part")]), *[F.col(c) for c in schema.names]]
    applied = []

    def each(batch: DataFrame, batch_id: int) -> None:
        note = f"{checkpoint}#{batch_id}"
        if catalog.note(graph_name) == note:          # committed by a run that died before its checkpoint
            return
        try:
            g = catalog.load(graph_name)
        except KeyError:
            g = Graph()
        batch = stored(batch, "batch")                # every merge reads it; the files are parsed once
        touched: dict[tuple, tuple[DataFrame, list[str]]] = {}
        for m in merges:
            g, table, rows, keys = m.apply(g, batch, order)
            if table in touched:                      # touched twice in a batch: the later row counts
                before, _ = touched[table]
                met = rows.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
                same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
                rows = before.join(met, same, "left_anti").unionByName(rows, allowMissingColumns=True)
            touched[table] = (rows, keys)
        catalog.append(graph_name, g, touched, note)
        applied.append(batch_id)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(applied)


def stream_load_parts(spark: SparkSession, folder: str, schema: T.StructType, catalog: Catalog, graph_name: str,
                      apply: Callable[[Graph, DataFrame], Graph], checkpoint: str, header: bool = False,
                      files_per_batch: int = 1) -> int:
    """Apply ``apply(graph, batch_rows)`` per batch of part files; returns the number of batches run."""
    stream = _stream(spark, folder, schema, files_per_batch, header)
    seen = []

    def each(batch: DataFrame, batch_id: int) -> None:
        try:
            g = catalog.load(graph_name)
        except KeyError:
            g = Graph()
        g2 = apply(g, batch)
        catalog.save(graph_name, g2)
        seen.append(batch_id)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(seen)
