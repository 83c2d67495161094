"""Graph and table mutation without MERGE INTO.

Upsert plan: (a) collapse the input to one row per key with ``max_by`` over a
total order (partial aggregation, so a key repeated a billion times is
reduced map-side); (b) ``full_outer`` join with the current rows on the key;
(c) one ``when`` per property: created rows take ON CREATE values, matched
rows take ON MATCH values, untouched rows keep theirs.  Running the same
merge twice gives the same result (G10) because (a) is deterministic and (c)
is idempotent for values taken from the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.model import NODE_ID, Graph
from trellis.session import cut_lineage

Value = Column | Callable[[Callable[[str], Column]], Column]


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.col(v)


# ---------------------------------------------------------------- CREATE
def with_node_ids(graph: Graph, label: str) -> Graph:
    """The same graph with the nodes of ``label`` told apart by a surrogate id, not by their key.

    Ids are made from the key by an expression, on the nodes and on every relationship end, so
    nothing is joined or written.  The key stays a property."""
    if graph.surrogate(label):
        return graph
    keys = graph.keys[label]
    nodes = graph.nodes[label]
    kind = nodes.select(graph.id_col(label).alias("k")).schema["k"].dataType

    def text(c: Column) -> Column:
        c = c.cast(kind)
        return F.concat(F.lit("k:"), F.to_json(c) if len(keys) > 1 else c.cast("string"))

    rels = {}
    for (t, s, d), df in graph.rels.items():
        for end, at in (("src", s), ("dst", d)):
            if at == label:
                df = df.withColumn(end, text(F.col(end)))
        rels[t, s, d] = df
    return replace(graph, nodes={**graph.nodes, label: nodes.withColumn(NODE_ID, text(graph.id_col(label)))}, rels=rels)


def create_nodes(graph: Graph, label: str, df: DataFrame, key=None) -> Graph:
    """G1 ``CREATE (:L {...})``: always adds, also a node whose key exists.

    Every created node gets an id of its own (surrogate), so relationships of an older node of
    the same key stay that node's alone.  The new rows are checkpointed, so the ids are given
    once.  A new label needs no key."""
    new = df.withColumn(NODE_ID, F.concat(F.lit(f"n:{uuid.uuid4().hex[:12]}:"), F.monotonically_increasing_id().cast("string")))
    new = cut_lineage(new)
    if label not in graph.nodes:
        return graph.with_nodes(label, new, () if key is None else key)
    graph = with_node_ids(graph, label)
    return graph.with_nodes(label, graph.nodes[label].unionByName(new, allowMissingColumns=True), graph.keys[label])


def _endpoint(graph: Graph, rows: DataFrame, label: str, on: dict, out: str) -> DataFrame:
    """Join input rows to the nodes of ``label`` whose properties equal row values
    (inner: no match → no relationship; several matches → one per node)."""
    nodes = graph.nodes[label]
    sel = nodes.select(graph.id_col(label).alias(out), *[F.col(p).alias(f"{out}__{p}") for p in on])
    cond = None
    for p, v in on.items():
        c = F.col(f"{out}__{p}") == _as_col(v)
        cond = c if cond is None else cond & c
    joined = rows.join(sel, cond, "inner")
    return joined.drop(*[f"{out}__{p}" for p in on])


def create_rels(graph: Graph, rel_type: str, src_label: str, dst_label: str, rows: DataFrame,
                src_on: dict, dst_on: dict, props: dict | None = None, rel_id: Column | None = None,
                both_directions: bool = False) -> Graph:
    """G2 ``MATCH (a {..}), (b {..}) CREATE (a)-[:T {..}]->(b)`` for every input row.

    Without a caller ``rel_id`` each input row is numbered before any shuffle, below a
    prefix of this call, so ids differ between calls; the numbers are stable as long as
    the input is a deterministic scan."""
    props = props or {}
    rows = rows.withColumn("__rid", rel_id if rel_id is not None else F.concat(
        F.lit(f"{uuid.uuid4().hex[:12]}:"), F.monotonically_increasing_id().cast("string")))
    j = _endpoint(graph, rows, src_label, src_on, "__src")
    j = _endpoint(graph, j, dst_label, dst_on, "__dst")
    cols = [F.col("__rid").alias("rel_id"), F.col("__src").alias("src"), F.col("__dst").alias("dst")]
    cols += [_as_col(v).alias(k) for k, v in props.items()]
    new = j.select(*cols)
    g = _append_rels(graph, (rel_type, src_label, dst_label), new)
    if both_directions:
        rev = new.select(F.concat(F.col("rel_id").cast("string"), F.lit("~r")).alias("rel_id"),
                         F.col("dst").alias("src"), F.col("src").alias("dst"),
                         *[F.col(k) for k in props])
        key = (rel_type, dst_label, src_label)
        if key == (rel_type, src_label, dst_label):
            new = new.withColumn("rel_id", F.col("rel_id").cast("string")).unionByName(rev)
            g = _append_rels(graph, key, new)
        else:
            g = _append_rels(g, key, rev)
    return g


def _append_rels(graph: Graph, key, new: DataFrame) -> Graph:
    """Add rows to a relationship table; ids of different types become text."""
    if key in graph.rels:
        old = graph.rels[key]
        if old.schema["rel_id"].dataType != new.schema["rel_id"].dataType:
            old, new = (x.withColumn("rel_id", F.col("rel_id").cast("string")) for x in (old, new))
        new = old.unionByName(new, allowMissingColumns=True)
    return graph.with_rels(*key, new)


# ---------------------------------------------------------------- MERGE
def _collapse(rows: DataFrame, keys: list[str], values: list[str], order_by: list[Column] | None) -> DataFrame:
    """One row per key; the last row by ``order_by`` wins, else the greatest value struct."""
    if not values:
        return rows.select(*keys).distinct()
    vals = F.struct(*[F.col(v) for v in values])
    agg = F.max_by(vals, F.struct(*order_by)) if order_by else F.max(vals)
    return rows.groupBy(*keys).agg(agg.alias("__in")).select(*keys, "__in.*")


def upsert(current: DataFrame | None, rows: DataFrame, keys: list[str],
           on_create: dict[str, Value], on_match: dict[str, Value],
           order_by: list[Column] | None = None, null_safe: bool = False) -> tuple[DataFrame, DataFrame]:
    """Core keyed upsert.  ``rows`` already holds the key columns by their
    target names.  Returns (new table, touched rows with a ``created`` flag)."""
    # input values are evaluated on the input rows; callables run after the join
    # an ON MATCH value may also be ``(value, combine)``: ``combine(new, old)`` after the join
    combine = {k: v[1] for k, v in on_match.items() if isinstance(v, tuple)}
    on_match = {k: (v[0] if isinstance(v, tuple) else v) for k, v in on_match.items()}
    eager_c = {k: v for k, v in on_create.items() if isinstance(v, Column)}
    eager_m = {k: v for k, v in on_match.items() if isinstance(v, Column)}
    lazy_m = {k: v for k, v in on_match.items() if not isinstance(v, Column)}
    # a plain SET gives both branches the same expression: carry it once
    shared = {k for k, v in eager_m.items() if k in eager_c and v is eager_c[k]}
    eager_m = {k: v for k, v in eager_m.items() if k not in shared}
    prepared = rows.select(*[F.col(k) for k in keys],
                           *[v.alias(f"__c_{k}") for k, v in eager_c.items()],
                           *[v.alias(f"__m_{k}") for k, v in eager_m.items()],
                           *([F.struct(*order_by).alias("__ord")] if order_by else []))
    if not null_safe:
        # [choice] a node key cannot be null (Cypher refuses to MERGE on null); such rows do nothing
        for k in keys:
            prepared = prepared.where(F.col(k).isNotNull())
    values = [f"__c_{k}" for k in eager_c] + [f"__m_{k}" for k in eager_m]
    new = _collapse(prepared, keys, values, [F.col("__ord")] if order_by else None)
    new = new.withColumn("__new", F.lit(True))
    props = []
    if current is not None:
        props = [c for c in current.columns if c not in keys]
    for k in list(on_create) + list(on_match):
        if k not in props and k not in keys:
            props.append(k)
    if current is None:
        cur = new.select(*keys).where(F.lit(False))
        for p in props:         # types come from the input
            typ = next((new.schema[c].dataType for c in (f"__c_{p}", f"__m_{p}") if c in new.columns), "string")
            cur = cur.withColumn(p, F.lit(None).cast(typ))
        current = cur
    cur = current.withColumn("__old", F.lit(True))
    for p in props:
        if p not in current.columns:
            cur = cur.withColumn(p, F.lit(None))
    if null_safe:
        cond = None
        for k in keys:
            c = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
            cond = c if cond is None else cond & c
        j = cur.alias("o").join(new.alias("n"), cond, "full_outer")
        key_cols = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    else:
        j = cur.alias("o").join(new.alias("n"), keys, "full_outer")
        key_cols = [F.col(k) for k in keys]
    created = F.col("o.__old").isNull()
    matched = F.col("o.__old").isNotNull() & F.col("n.__new").isNotNull()

    def old(p: str) -> Column:
        return F.col(f"o.{p}")

    out_cols = []
    for p in props:
        v = old(p)
        if p in on_match:
            mv = (F.col(f"n.__c_{p}") if p in shared else
                  F.col(f"n.__m_{p}") if p in eager_m else lazy_m[p](old))
            if p in combine:
                mv = combine[p](mv, old(p))
            v = F.when(matched, mv).otherwise(v)
        if p in on_create:
            v = F.when(created, F.col(f"n.__c_{p}")).otherwise(v)
        out_cols.append(v.alias(p))
    merged = j.select(*key_cols, *out_cols, created.alias("__created"), F.col("n.__new").alias("__touched"))
    table = merged.drop("__created", "__touched")
    touched = merged.where(F.col("__touched").isNotNull()).drop("__touched").withColumnRenamed("__created", "created")
    return table, touched


def merge_nodes(graph: Graph, label: str, rows: DataFrame, key: dict, on_create: dict | None = None,
                on_match: dict | None = None, set_: dict | None = None,
                order_by: list[Column] | None = None) -> tuple[Graph, DataFrame]:
    """G3/G4/G5/G8 ``MERGE (n:L {k: row.x}) ON CREATE SET .. ON MATCH SET .. SET ..``.

    ``key`` maps key property → input column/expression.  A plain SET applies
    to both branches.  Returns the new graph and the touched nodes (G8)."""
    on_create = dict(on_create or {})
    on_match = dict(on_match or {})
    for k, v in (set_ or {}).items():
        on_create.setdefault(k, v)
        on_match.setdefault(k, v)
    keys = list(key)
    keyed = rows.select("*", *[_as_col(v).alias(f"__k_{k}") for k, v in key.items()])
    keyed = keyed.drop(*[k for k in keys if k in rows.columns]).withColumnsRenamed(
        {f"__k_{k}": k for k in keys})
    if label in graph.nodes and tuple(keys) != graph.keys[label]:
        graph = with_node_ids(graph, label)             # found by another property: relationship ends stay as they are
    current = graph.nodes.get(label)
    table, touched = upsert(current, keyed, keys, on_create, on_match, order_by)
    if current is not None and NODE_ID in current.columns:
        made = F.coalesce(F.col(NODE_ID), F.concat(F.lit("m:"), F.to_json(F.struct(*keys))))
        return graph.with_nodes(label, table.withColumn(NODE_ID, made), graph.keys[label]), touched.drop(NODE_ID)
    return graph.with_nodes(label, table, keys), touched


def merge_rels(graph: Graph, rel_type: str, src_label: str, dst_label: str, rows: DataFrame,
               src_on: dict, dst_on: dict, key_props: dict | None = None,
               on_create: dict | None = None, on_match: dict | None = None, set_: dict | None = None,
               order_by: list[Column] | None = None) -> tuple[Graph, DataFrame]:
    """G6 ``MATCH (a..), (b..) MERGE (a)-[r:T {k: ..}]->(b)``: key = (src, dst, inline properties)."""
    graph, touched = merge_rels_by_id(graph, rel_type, src_label, dst_label, rows, src_on, dst_on, key_props, on_create, on_match, set_, order_by)
    return graph, touched.drop("rel_id")


def merge_rels_by_id(graph: Graph, rel_type: str, src_label: str, dst_label: str, rows: DataFrame,
                     src_on: dict, dst_on: dict, key_props: dict | None = None,
                     on_create: dict | None = None, on_match: dict | None = None, set_: dict | None = None,
                     order_by: list[Column] | None = None) -> tuple[Graph, DataFrame]:
    """``merge_rels`` whose touched relationships have their ``rel_id``."""
    key_props = key_props or {}
    on_create = dict(on_create or {})
    on_match = dict(on_match or {})
    for k, v in (set_ or {}).items():
        on_create.setdefault(k, v)
        on_match.setdefault(k, v)
    j = _endpoint(graph, rows, src_label, src_on, "__src")
    j = _endpoint(graph, j, dst_label, dst_on, "__dst")
    taken = {"src", "dst", *key_props}
    j = j.select(*[F.col(c) for c in j.columns if c not in taken],
                 F.col("__src").alias("src"), F.col("__dst").alias("dst"),
                 *[_as_col(v).alias(k) for k, v in key_props.items()])
    keys = ["src", "dst"] + list(key_props)
    rk = (rel_type, src_label, dst_label)
    current = graph.rels.get(rk)
    # existing relationships, parallel ones too, keep their id; created ones get a content hash of their key
    cur = current.withColumn("rel_id", F.col("rel_id").cast("string")) if current is not None else None
    table, touched = upsert(cur, j, keys, on_create, on_match, order_by, null_safe=True)
    new_id = F.sha2(F.to_json(F.struct(*[F.col(k) for k in keys])), 256)
    if current is not None:
        new_id = F.coalesce("rel_id", new_id)
    table, touched = (x.select(new_id.alias("rel_id"), *[c for c in x.columns if c != "rel_id"]) for x in (table, touched))
    return graph.with_rels(*rk, table), touched


def set_rel_property(graph: Graph, rel: tuple[str, str, str], name: str,
                     fn: Callable[[Callable[[str], Column], Callable[[str], Column], Callable[[str], Column]], Column]) -> Graph:
    """G7 ``MATCH (a)-[r]->(b) SET r.p = f(a, b, r)``."""
    t, s, d = rel
    edges = graph.rels[rel]
    sn = graph.nodes[s].select(graph.id_col(s).alias("__sid"), *[F.col(c).alias(f"__s_{c}") for c in graph.nodes[s].columns])
    dn = graph.nodes[d].select(graph.id_col(d).alias("__did"), *[F.col(c).alias(f"__d_{c}") for c in graph.nodes[d].columns])
    j = edges.join(sn, F.col("src") == F.col("__sid"), "left").join(dn, F.col("dst") == F.col("__did"), "left")
    val = fn(lambda p: F.col(f"__s_{p}"), lambda p: F.col(f"__d_{p}"), lambda p: F.col(p))
    out = j.select(*[F.col(c) for c in edges.columns if c != name], val.alias(name))
    return graph.with_rels(t, s, d, out)


# ---------------------------------------------------------------- tables
def upsert_table(target: DataFrame, source: DataFrame, keys: list[str],
                 order_by: list[Column] | None = None, update: list[str] | None = None) -> DataFrame:
    """T1 ``MERGE INTO t USING s ON key WHEN MATCHED UPDATE WHEN NOT MATCHED INSERT``."""
    cols = [c for c in source.columns if c not in keys]
    upd = update if update is not None else cols
    table, _ = upsert(target, source, keys, {c: F.col(c) for c in cols}, {c: F.col(c) for c in upd}, order_by)
    return table.select(*target.columns, *[c for c in table.columns if c not in target.columns])


def delete_keys(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """T2 ``DELETE FROM t WHERE key IN (...)``: an anti join (new version written by the caller)."""
    return target.join(doomed.select(*keys).distinct(), keys, "left_anti")


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """T4: add the missing properties only (typed nulls); existing ones untouched."""
    for name, typ in wanted.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(typ))
    return df
