"""CSV in and out.

Our own part files keep SQL null and the empty string apart (``nullValue``
``\\N``, ``emptyValue`` ``""``) and quote with ``"`` escaped by ``"``.  Rows are
read by position (``row[i]``, 0-based, all strings) or by header name.
Reads are splittable by default (large files are read by many tasks).  Values
holding a newline need ``multiline=True``, which makes each file one task, so
our writer keeps parts small (one part per partition).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trellis.functions.scalar import row_item
from trellis.model import Graph
from trellis.operators.merge import merge_nodes, merge_rels
from trellis.session import stored

WRITE_OPTS = {"escape": '"', "quote": '"', "nullValue": "\\N", "emptyValue": '""'}
READ_OPTS = {"escape": '"', "quote": '"', "nullValue": "\\N", "emptyValue": ""}


def unload_csv(df: DataFrame, path: str, header: bool = False, partition_by: list[str] | None = None) -> str:
    """S2 ``copy_bound_table_to_stage``: uncompressed CSV, one part per partition, in parallel."""
    w = df.write.mode("overwrite").option("header", str(header).lower())
    for k, v in WRITE_OPTS.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def positional_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(n)])


# one field of a line with the comma before it: quoted (a quote inside is doubled) or bare
_FIELD = ',(?:"(?:[^"]|"")*+"|[^,]*+)'


def split_line(line: Column) -> Column:
    """``ARRAY<STRING>`` of all fields of a CSV line, however many; a bare empty field is null."""
    def value(f: Column) -> Column:
        f = F.regexp_replace(f, "^,", "")
        bare = F.when(F.length(f) > 0, f)
        quoted = F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        out = F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), quoted).otherwise(bare)
        return F.when(out != READ_OPTS["nullValue"], out)

    # without a quote in the line every comma ends a field
    plain = F.transform(F.split(line, ","), lambda f: F.when((F.length(f) > 0) & (f != READ_OPTS["nullValue"]), f))
    return F.when(~F.contains(line, F.lit('"')), plain).otherwise(
        F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0)), value))


def read_positional(spark: SparkSession, path: str, n_cols: int, header: bool = False,
                    multiline: bool = False) -> DataFrame:
    """S3 ``LOAD CSV FROM ... AS row``: every field a string, addressed by position.

    Adds ``row`` (``ARRAY<STRING>``) so ``row[i]`` past the end is null (F11).  ``row`` has all
    fields of the line, also those past ``n_cols``.  With ``header`` or ``multiline`` the file is
    read by the CSV reader, which knows ``n_cols`` fields; a longer row is then an error."""
    if not header and not multiline:
        lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        df = lines.withColumn("row", split_line(F.col("value")))
        rest = [c for c in lines.columns if c != "value"]        # partition columns of the folder
        return df.select(*[F.get("row", F.lit(i)).alias(f"_c{i}") for i in range(n_cols)], *rest, "row")
    known = positional_schema(n_cols)
    schema = T.StructType([*known.fields, T.StructField("_line", T.StringType(), True)])
    r = (spark.read.schema(schema).option("header", str(header).lower()).option("multiLine", str(multiline).lower())
         .option("columnNameOfCorruptRecord", "_line").option("enforceSchema", "true"))
    for k, v in READ_OPTS.items():
        r = r.option(k, v)
    df = r.csv(path)
    # the reader keeps the text of a row whose number of fields differs; only longer ones lose a value
    longer = F.col("_line").isNotNull() & (F.size(split_line(F.regexp_replace("_line", "[\\r\\n]+", " "))) > n_cols)
    fields = F.array(*[F.col(f"_c{i}") for i in range(n_cols)])
    checked = F.when(longer, F.raise_error(F.concat(F.lit(f"a row has more than {n_cols} fields: "), F.col("_line")))).otherwise(fields)
    return df.withColumn("row", checked).drop("_line")


def row(i: int) -> Column:
    """``row[i]`` on a frame from ``read_positional``."""
    return row_item("row", i)


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                    multiline: bool = False) -> DataFrame:
    """S4 ``COPY INTO ... SKIP_HEADER=1 FIELD_OPTIONALLY_ENCLOSED_BY='"'`` with a fixed schema."""
    r = spark.read.schema(schema).option("header", "true").option("multiLine", str(multiline).lower())
    for k, v in READ_OPTS.items():
        r = r.option(k, v)
    return r.csv(path)


def _header_reader(spark: SparkSession):
    r = spark.read.option("header", "true")
    for k, v in READ_OPTS.items():
        r = r.option(k, v)
    return r


def propose_types(spark: SparkSession, path: str, sampling_ratio: float = 0.1) -> dict[str, str]:
    """Column types guessed from a sample, for review; no data is read by them."""
    guess = _header_reader(spark).option("inferSchema", "true").option("samplingRatio", str(sampling_ratio)).csv(path)
    return {f.name: f.dataType.simpleString() for f in guess.schema.fields}


def read_inferred(spark: SparkSession, path: str, reviewed: dict[str, str]) -> DataFrame:
    """Read every field as text, then apply the reviewed types (see ``propose_types``);
    ``try_cast`` leaves a bad value null, a column without a reviewed type stays text."""
    df = _header_reader(spark).csv(path)
    return df.select(*(F.col(c).try_cast(reviewed[c]).alias(c) if c in reviewed else F.col(c) for c in df.columns))


def inline_csv(df: DataFrame, text_col: str, schema_ddl: str, keep: list[str] | None = None) -> DataFrame:
    """CSV text carried in a column (``csv_data``): one row per line, parsed with a schema."""
    keep = keep or []
    lines = df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    lines = lines.where(F.length("line") > 0)
    parsed = lines.select(*keep, "line_no", F.from_csv(F.col("line"), schema_ddl).alias("r"))
    return parsed.select(*keep, "line_no", "r.*")


# ---------------------------------------------------------------- multi-part loads
def with_part(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Tag each row with its part (S7, F22): the file name, or with ``folder`` (a folder
    name) the entry right below that folder, e.g. a ``key=value`` partition folder."""
    if folder is None:
        return df.withColumn("part", F.col("_metadata.file_name"))
    pattern = r"(?:^|/)" + re.escape(folder) + r"/+([^/]+)"
    return df.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def load_parts_merge_nodes(graph: Graph, rows: DataFrame, label: str, key: dict[str, Column],
                           set_: dict[str, Column] | None = None, part_col: str = "part") -> tuple[Graph, DataFrame]:
    """Parts applied one after the other in name order, computed in one pass.

    A key is *created* by the first part (by name) that holds it when the
    graph did not have it, and *matched* by every other part holding it.  The
    final graph is the merge of all rows with later parts winning.  Returns the
    new graph and the summary ``(part, nodes_created, nodes_matched)``; an
    empty input gives an empty summary and the graph unchanged (S8)."""
    keys = list(key)
    keyed = rows.select(F.col(part_col).alias("part"), *[v.alias(k) for k, v in key.items()])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    keyed = keyed.where(~any_null).distinct()
    first = keyed.groupBy(*keys).agg(F.min("part").alias("first"))
    j = keyed.join(first, keys)
    if label in graph.nodes:
        pre = graph.nodes[label].select(*keys).distinct().withColumn("pre", F.lit(True))
        j = j.join(pre, keys, "left")
    else:
        j = j.withColumn("pre", F.lit(None).cast("boolean"))
    created = F.col("pre").isNull() & (F.col("part") == F.col("first"))
    summary = j.groupBy("part").agg(F.count_if(created).alias("nodes_created"),
                                    F.count_if(~created).alias("nodes_matched"))
    order = [F.col(part_col)] + [F.col(c) for c in rows.columns if c != part_col]
    g2, _ = merge_nodes(graph, label, rows, key, set_=set_, order_by=order)
    return g2, summary


def load_parts(graph: Graph, rows: DataFrame, nodes: list[dict], rels: list[dict], part_col: str = "part") -> tuple[Graph, DataFrame]:
    """S7-S9 with relationships: parts applied one after the other in name order, in one pass.

    ``nodes``: dicts with ``label``, ``key`` and optional ``set_`` (MERGE of the nodes of a row);
    ``rels``: dicts with ``rel_type, src_label, dst_label, src_on, dst_on`` and optional
    ``key_props, set_`` (MATCH both ends by key, MERGE the relationship).  In each part the nodes
    come before the relationships.

    A node exists from the first part that holds its key, or from the start if the graph has it.
    A relationship row does something only from the part on in which both its ends exist; the
    first such part creates the relationship, if the graph did not have it, and the later ones
    match it.  So one pass per table attributes every row to its part: no part waits for another.

    Returns the graph and ``(part, nodes_created, nodes_matched, rels_created, rels_matched)``,
    a row for each part; keys are counted once in a part."""
    part = F.col(part_col)
    rows = stored(rows, "part-rows")         # every step below reads them; the files are parsed once
    counts = [rows.select(part.alias("part")).distinct().select("part", *[F.lit(0).cast("long").alias(c) for c in _COUNTS])]
    order = [part] + [F.col(c) for c in rows.columns if c != part_col]
    known: dict[str, DataFrame] = {}         # by label: key columns, first part ('' if the graph had it)
    held: dict[str, DataFrame] = {}
    for n in nodes:
        label, key = n["label"], n["key"]
        keyed = rows.select(part.alias("part"), *[v.alias(k) for k, v in key.items()]).dropna(subset=list(key)).distinct()
        held[label] = keyed if label not in held else held[label].unionByName(keyed).distinct()
    for label, keyed in held.items():
        keys = [c for c in keyed.columns if c != "part"]
        seen = keyed.groupBy(*keys).agg(F.min("part").alias("first"))
        if label in graph.nodes:
            old = graph.nodes[label].select(*keys).dropna().distinct().withColumn("old", F.lit(True))
            seen = (seen.join(old, keys, "full").select(*keys, F.when(F.col("old"), F.lit("")).otherwise(F.col("first")).alias("first")))
        seen = known[label] = stored(seen, "part-keys")
        created = F.col("part") == F.col("first")
        counts.append(keyed.join(seen, keys).groupBy("part").agg(
            F.count_if(created).alias("nodes_created"), F.count_if(~created).alias("nodes_matched"),
            F.lit(0).cast("long").alias("rels_created"), F.lit(0).cast("long").alias("rels_matched")))
    g = graph
    for n in nodes:
        g, _ = merge_nodes(g, n["label"], rows, n["key"], set_=n.get("set_"), order_by=order)
    for r in rels:
        ready = rows
        for label, on, end in ((r["src_label"], r["src_on"], "src"), (r["dst_label"], r["dst_on"], "dst")):
            if label in known:
                seen = known[label]
            else:
                seen = graph.nodes[label].select(*graph.keys[label]).dropna().distinct().withColumn("first", F.lit(""))
            keys = [c for c in seen.columns if c != "first"]
            if set(on) != set(keys):
                raise ValueError(f"relationship ends are found by the key of {label}: {keys}")
            seen = seen.select(*[F.col(k).alias(f"__{end}_{k}") for k in keys], F.col("first").alias(f"__{end}_first"))
            match = None
            for k in keys:
                c = F.col(f"__{end}_{k}") == (on[k] if isinstance(on[k], Column) else F.col(on[k]))
                match = c if match is None else match & c
            ready = ready.join(seen, match).where(part >= F.col(f"__{end}_first")).drop(*[f"__{end}_{k}" for k in keys], f"__{end}_first")
        ready = stored(ready, "part-ready")  # counted and merged
        props = r.get("key_props") or {}
        values = {**{f"src_{k}": v for k, v in r["src_on"].items()}, **{f"dst_{k}": v for k, v in r["dst_on"].items()}, **props}
        keyed = ready.select(part.alias("part"), *[(v if isinstance(v, Column) else F.col(v)).alias(k) for k, v in values.items()]).distinct()
        names = list(values)
        first = keyed.groupBy(*names).agg(F.min("part").alias("first"))
        rk = (r["rel_type"], r["src_label"], r["dst_label"])
        if rk in graph.rels:
            ends = []
            for label, on, end in ((rk[1], r["src_on"], "src"), (rk[2], r["dst_on"], "dst")):
                ends.append(graph.nodes[label].select(graph.id_col(label).alias(f"__{end}"), *[F.col(k).alias(f"{end}_{k}") for k in on]))
            old = (graph.rels[rk].join(ends[0], F.col("src") == F.col("__src")).join(ends[1], F.col("dst") == F.col("__dst"))
                   .select(*names).distinct().withColumn("old", F.lit(True)))
            same = [F.col(f"f.{c}").eqNullSafe(F.col(f"o.{c}")) for c in names]
            cond = same[0]
            for c in same[1:]:
                cond = cond & c
            first = (first.alias("f").join(old.alias("o"), cond, "left")
                     .select(*[F.col(f"f.{c}").alias(c) for c in names], F.when(F.col("old"), F.lit("")).otherwise(F.col("first")).alias("first")))
        cond = None
        for c in names:
            x = F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}"))
            cond = x if cond is None else cond & x
        created = F.col("part") == F.col("first")
        counts.append(keyed.alias("k").join(first.alias("f"), cond).groupBy("part").agg(
            F.lit(0).cast("long").alias("nodes_created"), F.lit(0).cast("long").alias("nodes_matched"),
            F.count_if(created).alias("rels_created"), F.count_if(~created).alias("rels_matched")))
        g, _ = merge_rels(g, *rk, ready, r["src_on"], r["dst_on"], key_props=props, set_=r.get("set_"), order_by=order)
    both = counts[0]
    for c in counts[1:]:
        both = both.unionByName(c)
    return g, both.groupBy("part").agg(*[F.sum(c).alias(c) for c in _COUNTS])


_COUNTS = ("nodes_created", "nodes_matched", "rels_created", "rels_matched")
