"""Sources, sinks, catalog, streaming and table-layer queries (S*, G9 G11 G12, T*, X1, A6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trellis.catalog import Catalog
from trellis.functions import scalar as S
from trellis.model import Graph
from trellis.operators.merge import delete_keys, ensure_columns, merge_nodes, upsert_table
from trellis.operators.match import top_k
from trellis.plans import fixtures as fx
from trellis.plans.oracle_sql import cte
from trellis.plans.registry import register
from trellis.session import cut_lineage, scratch_path
from trellis.sources import csv as C
from trellis.sources import sinks as K
from trellis.streaming.parts import NodeMerge, RelMerge, stream_load_parts, stream_merge_parts

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _typed_customer(df, pos: bool = True):
    """Reviewed types for customer rows read as text (F1 toInteger, F2 toFloat)."""
    g = (lambda i: C.row(i)) if pos else (lambda i: F.col(CUSTOMER_COLS[i]))
    return df.select(S.to_integer(g(0)).alias("c_custkey"), g(1).alias("c_name"),
                     S.to_integer(g(2)).cast("int").alias("c_nationkey"), S.to_float(g(3)).alias("c_acctbal"),
                     g(4).alias("c_mktsegment"))


# ------------------------------------------------------------------ S1 S17 S18 S20
@register("scan_bound_table", ids="S1", sql=CUSTOMER_SQL)
def scan_bound_table(spark, sf):
    """reference('consumer_data_table'): the bound table, columns pruned at the scan."""
    return fx.table(spark, sf, "customer").select(*CUSTOMER_COLS)


@register("table_literal", ids="S17", sql="""
WITH pri(segment, priority) AS (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('FURNITURE', 3),
                                       ('HOUSEHOLD', 4), ('MACHINERY', 5))
SELECT p.priority, count(*) AS n FROM customer c JOIN pri p ON p.segment = c.c_mktsegment GROUP BY p.priority""")
def table_literal(spark, sf):
    """INSERT ... VALUES as a literal frame, joined to the customers."""
    pri = spark.createDataFrame([("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4),
                                 ("MACHINERY", 5)], "segment string, priority int")
    c = fx.table(spark, sf, "customer")
    # the literal has five rows: a broadcast of a fixed size
    return (c.join(F.broadcast(pri), c.c_mktsegment == pri.segment)
            .groupBy("priority").agg(F.count("*").alias("n")))


@register("ctas_not_null", ids="S18", sql=cte("usage_apps") + """
SELECT c_custkey, CAST(last_upgraded_on AS DATE) AS upgraded FROM usage_apps WHERE last_upgraded_on IS NOT NULL""")
def ctas_not_null(spark, sf):
    """CREATE TABLE t AS SELECT ... WHERE c IS NOT NULL (written to the shared folder, read back)."""
    path = scratch_path(spark, "ctas")
    apps = fx.usage_apps(spark, sf)
    apps.select("c_custkey", F.to_date("last_upgraded_on").alias("upgraded")) \
        .where(F.col("upgraded").isNotNull()).write.parquet(path)
    return spark.read.parquet(path)


@register("scan_like_in", ids="S20 F19", sql=cte("usage_events", "usage_apps") + """
SELECT 'events' AS source, event_type AS k, count(*) AS n FROM usage_events
WHERE listing_name LIKE '%GRAPH_APP%' AND event_type IN ('GET', 'TRIAL', 'PURCHASE') GROUP BY event_type
UNION ALL
SELECT 'apps', upgrade_state, count(*) FROM usage_apps WHERE package_name LIKE '%GRAPH_APP%' GROUP BY upgrade_state""")
def scan_like_in(spark, sf):
    """The two provider-view scans with the listing-name filter (LIKE) and the event IN list."""
    ev = fx.usage_events(spark, sf).where(F.col("listing_name").like(fx.LISTING_FILTER)
                                          & F.col("event_type").isin("GET", "TRIAL", "PURCHASE"))
    apps = fx.usage_apps(spark, sf).where(F.col("package_name").like(fx.LISTING_FILTER))
    a = ev.groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n")).select(
        F.lit("events").alias("source"), "k", "n")
    b = apps.groupBy(F.col("upgrade_state").alias("k")).agg(F.count("*").alias("n")).select(
        F.lit("apps").alias("source"), "k", "n")
    return a.unionByName(b)


# ------------------------------------------------------------------ S2-S6 F1 F2 F11
@register("csv_round_trip", ids="S2 S3 F1 F2", sql=CUSTOMER_SQL)
def csv_round_trip(spark, sf):
    """Unload customer to CSV parts (no header), read them back by position, cast back."""
    path = scratch_path(spark, "csv")
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS), path)
    return _typed_customer(C.read_positional(spark, path, len(CUSTOMER_COLS)))


@register("csv_header", ids="S4", sql=CUSTOMER_SQL)
def csv_header(spark, sf):
    """COPY INTO with SKIP_HEADER=1 and optional quotes, fixed schema."""
    path = scratch_path(spark, "csvh")
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS), path, header=True)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return C.read_header_csv(spark, path, schema)


@register("csv_positional", ids="S3 F1 F2 F11", sql="""
SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, CAST(NULL AS VARCHAR) AS missing,
       CAST(c_nationkey AS BIGINT) AS nation FROM customer""")
def csv_positional(spark, sf):
    """LOAD CSV ... AS row RETURN toInteger(row[0]), row[1], toFloat(row[3]), row[10] (past the end → null)."""
    path = scratch_path(spark, "csvp")
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS), path)
    rows = C.read_positional(spark, path, len(CUSTOMER_COLS))
    return rows.select(S.to_integer(C.row(0)).alias("k"), C.row(1).alias("name"), S.to_float(C.row(3)).alias("bal"),
                       C.row(10).alias("missing"), S.to_integer(C.row(2)).alias("nation"))


@register("csv_infer", ids="S5", sql=CUSTOMER_SQL)
def csv_infer(spark, sf):
    """Upload read as text, then the reviewed types."""
    path = scratch_path(spark, "csvi")
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS), path, header=True)
    df = C.read_inferred(spark, path, {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                                       "c_acctbal": "double", "c_mktsegment": "string"})
    return df.select(*CUSTOMER_COLS)


@register("csv_inline", ids="S6", sql="""
SELECT c_custkey, 0 AS line_no, c_name AS name, c_nationkey AS year FROM customer
UNION ALL SELECT c_custkey, 1, c_mktsegment, CAST(c_custkey AS INTEGER) FROM customer""")
def csv_inline(spark, sf):
    """csv_data carried in the request: two ``name,year`` lines per customer."""
    c = fx.table(spark, sf, "customer")
    docs = c.select("c_custkey", F.concat_ws("\n", F.concat_ws(",", "c_name", "c_nationkey"),
                                             F.concat_ws(",", "c_mktsegment", "c_custkey")).alias("csv_data"))
    out = C.inline_csv(docs, "csv_data", "name STRING, year INT", keep=["c_custkey"])
    return out.select("c_custkey", F.col("line_no").cast("int").alias("line_no"), "name", "year")


# ------------------------------------------------------------------ S7 S8 S9 X1
@register("multi_part_load", ids="S7 S9", sql="""
WITH pk AS (SELECT DISTINCT c_mktsegment AS part, c_nationkey AS k FROM customer),
fp AS (SELECT k, min(part) AS first FROM pk GROUP BY k)
SELECT part, count(*) FILTER (WHERE part = first) AS nodes_created,
       count(*) FILTER (WHERE part <> first) AS nodes_matched FROM pk JOIN fp USING (k) GROUP BY part""")
def multi_part_load(spark, sf):
    """MERGE (n:Nation {n_nationkey: toInteger(row[2])}) over customer parts, one part after the other
    in name order; per part: nodes created and matched."""
    path = scratch_path(spark, "parts")
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS), path, partition_by=["c_mktsegment"])
    # the part is the folder a row's file lies in
    rows = C.with_part(C.read_positional(spark, path, 4), path.rsplit("/", 1)[-1])
    rows = rows.withColumn("part", F.regexp_replace("part", "^c_mktsegment=", ""))
    g, summary = C.load_parts_merge_nodes(Graph(), rows, "Nation", {"n_nationkey": S.to_integer(C.row(2))})
    return summary.select("part", F.col("nodes_created").cast("bigint"), F.col("nodes_matched").cast("bigint"))


@register("rel_part_load", ids="S7 S9", sql="""
WITH r AS (SELECT 'd=' || CAST(o_orderkey % 4 AS VARCHAR) AS part, o_custkey AS c, o_orderkey AS o, o_orderpriority AS p, o_orderstatus = 'F' AS has_c FROM orders
           UNION ALL SELECT 'd=' || CAST((o_orderkey + 1) % 4 AS VARCHAR), o_custkey, o_orderkey, o_orderpriority, o_orderstatus <> 'O' FROM orders),
ck AS (SELECT DISTINCT part, c FROM r WHERE has_c), cf AS (SELECT c, min(part) AS first FROM ck GROUP BY c),
ok AS (SELECT DISTINCT part, o FROM r), of AS (SELECT o, min(part) AS first FROM ok GROUP BY o),
rk AS (SELECT DISTINCT r.part, r.c, r.o FROM r JOIN cf USING (c) JOIN of USING (o) WHERE r.part >= cf.first AND r.part >= of.first),
rf AS (SELECT c, o, min(part) AS first FROM rk GROUP BY c, o),
n AS (SELECT part, count(*) FILTER (WHERE part = first) AS made, count(*) FILTER (WHERE part <> first) AS met FROM (
        SELECT part, first FROM ck JOIN cf USING (c) UNION ALL SELECT part, first FROM ok JOIN of USING (o)) GROUP BY part),
e AS (SELECT part, count(*) FILTER (WHERE part = first) AS made, count(*) FILTER (WHERE part <> first) AS met FROM rk JOIN rf USING (c, o) GROUP BY part)
SELECT part, CAST(n.made AS BIGINT) AS nodes_created, CAST(n.met AS BIGINT) AS nodes_matched,
       CAST(coalesce(e.made, 0) AS BIGINT) AS rels_created, CAST(coalesce(e.met, 0) AS BIGINT) AS rels_matched,
       (SELECT count(*) FROM rf) AS rels_in_graph
FROM n LEFT JOIN e USING (part)""")
def rel_part_load(spark, sf):
    """Orders dealt to four part folders, each row in two of them; a row makes its order, its customer only if
    it holds one, and MATCH (c), (o) MERGE (c)-[:PLACED]->(o).  Where the customer comes in a later part only,
    the row does nothing.  Per part: nodes and relationships created and matched."""
    path = scratch_path(spark, "relparts")
    o = fx.table(spark, sf, "orders")
    row = lambda day, has: o.select(F.when(has, F.col("o_custkey")).alias("cust"), "o_custkey", "o_orderkey", "o_orderpriority",
                                    F.pmod(day, F.lit(4)).alias("d"))
    both = row(F.col("o_orderkey"), F.col("o_orderstatus") == "F").unionAll(row(F.col("o_orderkey") + 1, F.col("o_orderstatus") != "O"))
    C.unload_csv(both, path, partition_by=["d"])
    rows = C.with_part(C.read_positional(spark, path, 4), path.rsplit("/", 1)[-1])
    cust, order = S.to_integer(C.row(1)), S.to_integer(C.row(2))
    g, summary = C.load_parts(
        Graph(), rows,
        nodes=[{"label": "Customer", "key": {"c_custkey": S.to_integer(C.row(0))}},
               {"label": "Order", "key": {"o_orderkey": order}, "set_": {"priority": C.row(3)}}],
        rels=[{"rel_type": "PLACED", "src_label": "Customer", "dst_label": "Order", "src_on": {"c_custkey": cust}, "dst_on": {"o_orderkey": order}}])
    n = g.rels["PLACED", "Customer", "Order"].agg(F.count("*").alias("rels_in_graph"))
    return summary.crossJoin(F.broadcast(n))          # one row


@register("empty_load", ids="S8", sql="SELECT count(*) AS node_count, CAST(0 AS BIGINT) AS parts FROM customer")
def empty_load(spark, sf):
    """An empty source: nothing is loaded, the graph is unchanged, the summary is empty."""
    path = scratch_path(spark, "empty")
    fx.table(spark, sf, "customer").select(*CUSTOMER_COLS).where(F.lit(False)).write.csv(path)
    rows = C.read_positional(spark, path, 5).withColumn("part", F.lit("p0"))
    g = fx.trade_graph(spark, sf)
    g2, summary = C.load_parts_merge_nodes(g, rows, "Customer", {"c_custkey": S.to_integer(C.row(0))})
    n = g2.nodes["Customer"].agg(F.count("*").alias("node_count"))
    return n.crossJoin(F.broadcast(summary.agg(F.count("*").alias("parts"))))


@register("stream_part_load", ids="X1", sql=CUSTOMER_SQL)
def stream_part_load(spark, sf):
    """Part files as micro-batches (one file per trigger, availableNow), merged into a cataloged graph."""
    base = scratch_path(spark, "stream")
    parts = f"{base}/parts"
    C.unload_csv(fx.table(spark, sf, "customer").select(*CUSTOMER_COLS).repartition(3, "c_custkey"), parts)
    cat = Catalog(spark, f"{base}/catalog")

    def apply(g, batch):
        typed = _typed_customer(batch.withColumn("row", F.array(*[F.col(c) for c in batch.columns])))
        g2, _ = merge_nodes(g, "Customer", typed, {"c_custkey": F.col("c_custkey")},
                            set_={c: F.col(c) for c in CUSTOMER_COLS[1:]})
        return g2

    stream_load_parts(spark, parts, C.positional_schema(5), cat, "customers", apply, f"{base}/checkpoint")
    return cat.load("customers").nodes["Customer"].select(*CUSTOMER_COLS)


@register("stream_delta_load", ids="X1 S7", sql="""
SELECT CAST(c AS BIGINT) AS c_custkey, count(DISTINCT o) AS n_orders, CAST(max(o_orderdate) AS DATE) AS last_order FROM (
  SELECT o_custkey AS c, o_orderkey AS o, o_orderdate FROM orders) GROUP BY c""")
def stream_delta_load(spark, sf):
    """Order parts as micro-batches of two files, merged as keyed deltas: each batch writes the rows it touches.
    Customers keep their last order date; relationships repeat over the batches and stay one."""
    base = scratch_path(spark, "delta")
    o = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    # every order stands in two files
    C.unload_csv(o.repartition(5, "o_orderkey").unionAll(o.repartition(3, "o_orderkey")), f"{base}/parts")
    cat = Catalog(spark, f"{base}/catalog")
    cust, order, day = F.col("_c0").cast("bigint"), F.col("_c1").cast("bigint"), F.col("_c2").cast("date")
    later = lambda new, old: F.greatest(new, old)
    merges = [NodeMerge("Customer", {"c_custkey": cust}, on_create={"last": day}, on_match={"last": (day, later)}),
              NodeMerge("Order", {"o_orderkey": order}),
              RelMerge("PLACED", "Customer", "Order", {"c_custkey": cust}, {"o_orderkey": order})]
    stream_merge_parts(spark, f"{base}/parts", C.positional_schema(3), cat, "orders", merges, f"{base}/checkpoint", files_per_batch=2,
                       order_by=[day])
    g = cat.load("orders")
    n = g.rels["PLACED", "Customer", "Order"].groupBy(F.col("src").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return g.nodes["Customer"].join(n, "c_custkey").select("c_custkey", "n_orders", F.col("last").alias("last_order"))


# ------------------------------------------------------------------ G9 G11 G12
@register("catalog_list_delete", ids="G11 G12", sql="""
SELECT 'handoff' AS graph_name, (SELECT count(DISTINCT user_id) FROM events) AS node_count
UNION ALL SELECT 'trade', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
  + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders)""")
def catalog_list_delete(spark, sf):
    """Save three graphs, delete one, list the rest with the nodes each holds."""
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    cat.save("trade", fx.trade_graph(spark, sf))
    cat.save("handoff", fx.handoff_graph(spark, sf))
    old, _ = fx.customer_halves(spark, sf)
    cat.save("scratch", Graph().with_nodes("Customer", old, "c_custkey"))
    cat.delete("scratch")
    counts = None
    for name in ("trade", "handoff"):
        one = cat.load(name).stats().select(F.lit(name).alias("graph_name"), "node_count")
        counts = one if counts is None else counts.unionAll(one)
    # the list decides which graphs stand in the result
    return cat.list().join(counts, "graph_name", "left")


@register("replace_graph", ids="G9", sql=cte("halves") + """
SELECT 'Customer' AS label, c_custkey, c_acctbal, CAST(2 AS INTEGER) AS version FROM cust_new""")
def replace_graph(spark, sf):
    """Delete-then-load as a new version: the old half is replaced by the new half."""
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    old, new = fx.customer_halves(spark, sf)
    cat.save("customers", Graph().with_nodes("Customer", old, "c_custkey"))
    v = cat.save("customers", Graph().with_nodes("Customer", new, "c_custkey"))
    g = cat.load("customers")
    return g.nodes["Customer"].select(F.lit("Customer").alias("label"), "c_custkey", "c_acctbal", F.lit(v).cast("int").alias("version"))


# ------------------------------------------------------------------ S10-S14 F17 F24
@register("write_back", ids="S10 S11 F17", sql="""
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey, c_name, c_acctbal FROM customer""")
def write_back(spark, sf):
    """graph_query(g, q, {write: {outputTable}}): ROW_INDEX in the result order, ROW_DATA VARIANT."""
    out = scratch_path(spark, "writeback")
    rows = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    summary = K.write_rows(rows, out, ["c_custkey"])
    assert summary.columns == ["output_table", "row_count", "note"]
    back = spark.read.parquet(out)
    return back.select("row_index",
                       F.variant_get("row_data", "$.c_custkey", "bigint").alias("c_custkey"),
                       F.variant_get("row_data", "$.c_name", "string").alias("c_name"),
                       F.variant_get("row_data", "$.c_acctbal", "double").alias("c_acctbal"))


def _output_table(spark) -> str:
    """A table name of this call."""
    return f"spark_catalog.default.trellis_out_{uuid.uuid4().hex[:12]}"


@register("write_back_table", ids="S10 S12", sql="""
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey, c_name, c_acctbal FROM customer""")
def write_back_table(spark, sf):
    """graph_query(g, q, {write: {outputTable}}) through a catalog table: written, read back by its name, dropped."""
    name = _output_table(spark)
    rows = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    K.query_result(rows, {"write": {"outputTable": name}}, ["c_custkey"])
    get = lambda c, kind: F.variant_get("row_data", f"$.{c}", kind).alias(c)
    back = cut_lineage(spark.table(name).select("row_index", get("c_custkey", "bigint"), get("c_name", "string"), get("c_acctbal", "double")))
    spark.sql(f"DROP TABLE {name}")
    return back


@register("write_summary", ids="S11 S12", sql="""
SELECT true AS named_table, count(*) AS row_count, true AS same_rows FROM customer""")
def write_summary(spark, sf):
    """The summary row of a write: the table that was written, as named, and its rows."""
    name = _output_table(spark)
    s = K.query_result(fx.table(spark, sf, "customer"), {"WRITE": {"output_table": name}}, ["c_custkey"])
    got = s.first()                                    # one row
    written = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(got["output_table"] == name, got["row_count"], got["row_count"] == written)],
                                 "named_table boolean, row_count long, same_rows boolean")


_RESULT_TEXT = """CASE WHEN o_orderstatus = 'P' THEN NULL
  WHEN o_orderpriority = '1-URGENT' THEN '[{"k":' || o_orderkey || '},{"k":' || o_custkey || '}]'
  WHEN o_orderpriority = '2-HIGH' THEN '{"data":[{"k":' || o_orderkey || '}]}'
  WHEN o_orderpriority = '3-MEDIUM' THEN '{"records":[{"k":' || o_orderkey || '},{"k":' || o_custkey || '}]}'
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{"results":[]}'
  ELSE '{"data":' || o_orderkey || ',"k":' || o_custkey || '}' END"""


@register("normalize_rows", ids="S13", sql="""
SELECT o_orderkey, 0 AS pos, o_orderkey AS k FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT o_orderkey, 1, o_custkey FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM')
UNION ALL SELECT o_orderkey, 0, o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW'""")
def normalize_rows(spark, sf):
    """Result texts of every shape (array, {data}, {records}, {results}, object, null) → rows."""
    o = fx.table(spark, sf, "orders")
    text = F.expr(_RESULT_TEXT)
    v = K.parse_or_raw(text)
    rows = o.select("o_orderkey", F.posexplode(K.normalize_result(v)).alias("pos", "elem"))
    return rows.select("o_orderkey", F.col("pos").cast("int").alias("pos"),
                       F.variant_get("elem", "$.k", "bigint").alias("k"))


@register("raw_result", ids="S14 F24", sql="""
SELECT conv_id, turn, CASE WHEN json_valid(x) THEN 'parsed' ELSE 'raw' END AS kind,
       CASE WHEN json_valid(x) THEN NULL ELSE length(x) END AS raw_len,
       CASE WHEN json_valid(x) THEN turn END AS parsed_turn
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text
        WHEN turn % 2 = 0 THEN '{"write":{"turn":' || turn || '}}' ELSE '{"WRITE":{"turn":' || turn || '}}' END AS x
      FROM conversations) WHERE x IS NOT NULL""")
def raw_result(spark, sf):
    """Unparseable result text becomes {"raw_result": text}; options read under two spellings."""
    c = fx.table(spark, sf, "conversations")
    x = F.when(F.col("role") == "user", F.col("text")).when(
        F.col("turn") % 2 == 0, F.concat(F.lit('{"write":{"turn":'), F.col("turn").cast("string"), F.lit("}}"))).otherwise(
        F.concat(F.lit('{"WRITE":{"turn":'), F.col("turn").cast("string"), F.lit("}}")))
    v = K.parse_or_raw(x)
    raw = F.try_variant_get(v, "$.raw_result", "string")
    opt = S.option_lookup(v, ["write", "WRITE"])
    return c.select("conv_id", "turn", v.alias("v"), raw.alias("raw"), opt.alias("opt")).where(F.col("v").isNotNull()) \
        .select("conv_id", "turn", F.when(F.col("raw").isNull(), "parsed").otherwise("raw").alias("kind"),
                F.length("raw").alias("raw_len"), F.try_variant_get("opt", "$.turn", "bigint").alias("parsed_turn"))


# ------------------------------------------------------------------ A6 S15 S16 A14
@register("array_of_objects", ids="A6", sql="""
SELECT count(*) AS n_items, string_agg(c_name, ',' ORDER BY c_acctbal DESC, c_custkey) AS names FROM (
  SELECT c_name, c_acctbal, c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)""")
def array_of_objects(spark, sf):
    """Top 10 customers by balance, as one array of objects (a bounded result)."""
    c = fx.table(spark, sf, "customer")
    top = top_k(c, 10, ("c_acctbal", "desc"), ("c_custkey", "asc"))
    arr = K.array_of_objects(top.withColumn("neg", -F.col("c_acctbal")), ["neg", "c_custkey"])
    return arr.select(F.size("items").cast("bigint").alias("n_items"),
                      F.array_join(F.transform("items", lambda x: x["c_name"]), ",").alias("names"))


@register("table_upsert_kv", ids="T1 F12 F20", sql=cte("halves") + """
SELECT coalesce(n.k, o.k) AS key, coalesce(n.v, o.v) AS value FROM
  (SELECT upper('c' || c_custkey) AS k, c_acctbal AS v FROM cust_old) o FULL OUTER JOIN
  (SELECT upper('c' || c_custkey) AS k, c_acctbal AS v FROM cust_new) n ON o.k = n.k""")
def table_upsert_kv(spark, sf):
    """MERGE INTO app_metadata USING s ON key WHEN MATCHED UPDATE WHEN NOT MATCHED INSERT."""
    old, new = fx.customer_halves(spark, sf)
    kv = lambda df: df.select(F.upper(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("key"),
                              F.col("c_acctbal").alias("value"))
    t = upsert_table(kv(old).withColumn("updated_on", F.current_timestamp()),
                     kv(new).withColumn("updated_on", F.current_timestamp()), ["key"])
    return t.select("key", "value")


@register("delete_key", ids="T2", sql="""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def delete_key(spark, sf):
    """DELETE FROM customers WHERE key IN (customers with a finished order)."""
    c = fx.table(spark, sf, "customer").select("c_custkey")
    doomed = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("c_custkey"))
    return delete_keys(c, doomed, ["c_custkey"])


@register("lookup_object", ids="T3 F12 F16", sql="""
SELECT to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}) AS obj
FROM nation WHERE n_name = upper('nation_7')""")
def lookup_object(spark, sf):
    """Key lookup returned as an object (the key normalised with UPPER)."""
    n = fx.table(spark, sf, "nation")
    return n.where(F.col("n_name") == F.upper(F.lit("nation_7"))).select(
        S.object_text(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")).alias("obj"))


@register("ensure_columns", ids="T4", sql="""
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS cloud_region, CAST(NULL AS VARCHAR) AS hs_status FROM customer""")
def ensure_columns_q(spark, sf):
    """Add the missing properties only."""
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_name")
    return ensure_columns(c, {"c_custkey": "bigint", "cloud_region": "string", "hs_status": "string"})
