"""Property graph held as DataFrames.

* one node DataFrame per label: the key column(s) plus typed property columns;
* one relationship DataFrame per (type, source label, target label):
  ``rel_id, src, dst`` plus property columns.  ``src``/``dst`` hold the
  endpoint key (a struct when the label has a key of several columns).
* a label whose keys are not unique, or that has none, tells its nodes apart by a
  surrogate id (column ``_node_id``); relationship ends then hold that id, and keys
  are looked up as properties.  ``merge.create_nodes`` turns a label into one.

A ``Graph`` is immutable; every mutation returns a new ``Graph`` whose
DataFrames are new logical plans.  Nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_ID = "_node_id"     # column of a label whose nodes are told apart by an id of their own

RelKey = tuple[str, str, str]  # (type, src_label, dst_label)


def key_expr(keys: tuple[str, ...], prefix: str = "") -> Column:
    if len(keys) == 1:
        return F.col(prefix + keys[0])
    return F.struct(*[F.col(prefix + k).alias(k) for k in keys])


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    rels: dict[RelKey, DataFrame] = field(default_factory=dict)
    # (type, src_label, dst_label, "src"|"dst"): that end always names an existing node,
    # so a pattern that reads nothing of that node need not join it
    integrity: frozenset = frozenset()

    # ------------------------------------------------------------ building
    def with_nodes(self, label: str, df: DataFrame, key) -> Graph:
        key = (key,) if isinstance(key, str) else tuple(key)
        nodes = dict(self.nodes)
        nodes[label] = df
        keys = dict(self.keys)
        keys[label] = key
        if label in self.nodes:      # a new node set: earlier promises about this label no longer hold
            return replace(self, nodes=nodes, keys=keys, integrity=frozenset(
                x for x in self.integrity if label != (x[1] if x[3] == "src" else x[2])))
        return replace(self, nodes=nodes, keys=keys)

    def with_rels(self, rel_type: str, src_label: str, dst_label: str, df: DataFrame,
                  src_exists: bool = False, dst_exists: bool = False) -> Graph:
        missing = {"rel_id", "src", "dst"} - set(df.columns)
        if missing:
            raise ValueError(f"relationship frame lacks {sorted(missing)}")
        rels = dict(self.rels)
        key = (rel_type, src_label, dst_label)
        rels[key] = df
        integ = {x for x in self.integrity if x[:3] != key}
        if src_exists:
            integ.add(key + ("src",))
        if dst_exists:
            integ.add(key + ("dst",))
        return replace(self, rels=rels, integrity=frozenset(integ))

    def guaranteed(self, rel_type: str | None, near_label: str | None, far_label: str, direction: str) -> bool:
        """Does every relationship reached in this step end at an existing ``far_label`` node?"""
        if direction == "both":
            return False
        tabs = (self.rel_tables(rel_type, near_label, far_label) if direction == "out"
                else self.rel_tables(rel_type, far_label, near_label))
        end = "dst" if direction == "out" else "src"
        return bool(tabs) and all(k + (end,) in self.integrity for k, _ in tabs)

    def without(self, label: str | None = None, rel: RelKey | None = None) -> Graph:
        nodes = {k: v for k, v in self.nodes.items() if k != label}
        keys = {k: v for k, v in self.keys.items() if k != label}
        rels = {k: v for k, v in self.rels.items() if k != rel and (label is None or label not in k[1:])}
        return Graph(nodes, keys, rels, frozenset(x for x in self.integrity if x[:3] in rels))

    # ------------------------------------------------------------ lookups
    def id_col(self, label: str, prefix: str = "") -> Column:
        """What tells the nodes of a label apart and what relationship ends hold: the key, or the surrogate id."""
        if self.surrogate(label):
            return F.col(prefix + NODE_ID)
        return key_expr(self.keys[label], prefix)

    def surrogate(self, label: str) -> bool:
        return NODE_ID in self.nodes[label].columns

    def labels(self) -> list[str]:
        return sorted(self.nodes)

    def rel_types(self) -> list[str]:
        return sorted({t for t, _, _ in self.rels})

    def rel_tables(self, rel_type: str | None = None, src_label: str | None = None,
                   dst_label: str | None = None) -> list[tuple[RelKey, DataFrame]]:
        out = []
        for (t, s, d), df in sorted(self.rels.items(), key=lambda kv: kv[0]):
            if rel_type is not None and t != rel_type:
                continue
            if src_label is not None and s != src_label:
                continue
            if dst_label is not None and d != dst_label:
                continue
            out.append(((t, s, d), df))
        return out

    # ------------------------------------------------------------ introspection
    def props(self, label: str) -> list[str]:
        """Property names of a label: all columns but a surrogate id."""
        return [c for c in self.nodes[label].columns if c != NODE_ID]

    def _spark(self) -> SparkSession:
        for df in (*self.nodes.values(), *self.rels.values()):
            return df.sparkSession
        return SparkSession.getActiveSession()

    def all_nodes(self) -> DataFrame:
        """M2 ``MATCH (n) RETURN n``: one row per node of every label."""
        parts = [self._spark().createDataFrame([], "label string, id string, props string")]
        for label in self.labels():
            parts.append(self.nodes[label].select(
                F.lit(label).alias("label"),
                self.id_col(label).cast("string").alias("id"),
                F.to_json(F.struct(*self.props(label))).alias("props")))
        return reduce(DataFrame.unionAll, parts[1:] or parts)

    def all_rels(self) -> DataFrame:
        """M7 ``MATCH ()-[r]->() RETURN r``: every relationship, type-tagged; no rows without any."""
        parts = [df.select(F.lit(t).alias("type"), F.lit(s).alias("src_label"),
                           F.lit(d).alias("dst_label"), F.col("rel_id").cast("string").alias("rel_id"),
                           F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
                 for (t, s, d), df in self.rel_tables()]
        none = "type string, src_label string, dst_label string, rel_id string, src string, dst string"
        return reduce(DataFrame.unionAll, parts) if parts else self._spark().createDataFrame([], none)

    def stats(self) -> DataFrame:
        """One row (node_count, relationship_count); zero for what the graph lacks."""
        def counted(frames) -> DataFrame:
            ones = [df.select(F.lit(1).alias("x")) for df in frames] or [self._spark().createDataFrame([], "x int")]
            return reduce(DataFrame.unionAll, ones)

        # both counts come from one aggregate over the tagged rows
        rows = counted(self.nodes.values()).withColumn("node", F.lit(True)).unionAll(
            counted(self.rels.values()).withColumn("node", F.lit(False)))
        return rows.agg(F.count_if(F.col("node")).alias("node_count"), F.count_if(~F.col("node")).alias("relationship_count"))

    def inspect(self) -> DataFrame:
        """Labels, relationship types and the property keys that hold any value."""
        spark = self._spark()
        names = ([("label", lb) for lb in self.labels()]
                 + [("relationshipType", t) for t in self.rel_types()])
        fixed = spark.createDataFrame(names, "kind string, name string")
        parts = [fixed]
        sources = [(self.nodes[lb], self.props(lb)) for lb in self.labels()]
        sources += [(df, [c for c in df.columns if c not in ("rel_id", "src", "dst")])
                    for _, df in self.rel_tables()]
        for df, cols in sources:
            if not cols:
                continue
            # one pass per table: max(isNotNull) per column, then unpivot
            flags = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in cols])
            stacked = flags.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("name"), F.col(c).alias("present")) for c in cols])).alias("s"))
            parts.append(stacked.where("s.present").select(
                F.lit("propertyKey").alias("kind"), F.col("s.name").alias("name")))
        return reduce(DataFrame.unionAll, parts).distinct()

    def schema_context(self) -> DataFrame:
        """Inspect + stats as one JSON object (the input a text-to-query model reads)."""
        ins = self.inspect()
        lists = ins.groupBy().agg(
            F.sort_array(F.collect_list(F.when(F.col("kind") == "label", F.col("name")))).alias("labels"),
            F.sort_array(F.collect_list(F.when(F.col("kind") == "relationshipType", F.col("name")))).alias("relationship_types"),
            F.sort_array(F.collect_list(F.when(F.col("kind") == "propertyKey", F.col("name")))).alias("property_keys"))
        # the lists are bounded by the schema (labels, types, columns), not by the data
        both = lists.crossJoin(F.broadcast(self.stats()))
        return both.select(F.to_json(F.struct(
            "labels", "relationship_types", "property_keys", "node_count", "relationship_count")).alias("schema_context"),
            *[F.col(c) for c in ("labels", "relationship_types", "property_keys", "node_count", "relationship_count")])

    def match(self, var: str, label: str | None = None, **props):
        from trellis.operators.match import Match
        return Match.start(self, var, label, **props)
