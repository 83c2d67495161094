"""Graph catalog on a shared folder.

Layout: ``<root>/<graph>/v<n>/{_claim, nodes/<label>, rels/<type>__<src>__<dst>, _meta, _committed}``.
A saver claims a number by creating ``_claim``, which fails if the file is there, so two savers
never share a version.  ``_committed`` is created last; the live version is the highest one
that has it.  Nothing is ever overwritten: a saver that dies before its commit leaves a number
that is passed over, and the version before stays live.

A table may consist of a base and keyed deltas (``append``): a delta holds only the rows that a
change touched.  Reading takes, for each key, the row of the newest delta that has it; when a
table has ``MAX_DELTAS`` deltas, the next change writes it as a new base.

File listing goes through the Hadoop FileSystem API, so the root may be any cluster file system.
"""

from __future__ import annotations

import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.model import Graph

MAX_DELTAS = 8
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
_META = "kind string, name string, src string, dst string, extra string, row_key string, path string, number int, note string"


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # frames handed out by load(): a version that keeps one of them refers to its files
        # instead of copying them, so an incremental load rewrites only what it touched
        # (the frame is kept so its id cannot be reused; reuse only within the same graph)
        self._origin: dict[int, tuple[DataFrame, str, list[tuple[str, str]]]] = {}

    # ------------------------------------------------------------ helpers
    def _exists(self, p: str) -> bool:
        return self._fs.exists(self._Path(p))

    def _create(self, p: str) -> bool:
        """Create an empty file; False if it is there already."""
        try:
            self._fs.create(self._Path(p), False).close()
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception) or self._exists(p):
                return False
            raise

    def _folder(self, name: str) -> str:
        if not _NAME.fullmatch(name):
            raise ValueError(f"graph name {name!r}: letters, digits, '_', '.' and '-' only, a letter or digit first")
        return f"{self.root}/{name}"

    def _numbers(self, name: str) -> list[int]:
        p = self._folder(name)
        if not self._exists(p):
            return []
        found = [st.getPath().getName() for st in self._fs.listStatus(self._Path(p)) if st.isDirectory()]
        return sorted(int(n[1:]) for n in found if n.startswith("v") and n[1:].isdigit())

    def _current(self, name: str) -> int | None:
        """The highest committed version."""
        for v in reversed(self._numbers(name)):
            if self._exists(f"{self._folder(name)}/v{v}/_committed"):
                return v
        return None

    def _claim(self, name: str) -> int:
        """A version number of our own."""
        v = max(self._numbers(name), default=0) + 1
        while not self._create(f"{self._folder(name)}/v{v}/_claim"):
            v += 1
        return v

    # ------------------------------------------------------------ API
    def list(self) -> DataFrame:
        """G11 ``graph_list()``: one row per graph with a live version."""
        names = []
        if self._exists(self.root):
            for st in self._fs.listStatus(self._Path(self.root)):
                n = st.getPath().getName()
                if st.isDirectory() and _NAME.fullmatch(n) and self._current(n) is not None:
                    names.append((n,))
        return self.spark.createDataFrame(sorted(names), "graph_name string")

    def save(self, name: str, graph: Graph, note: str = "") -> int:
        """Write a new version of ``name`` (G9 replace = save over an existing name).

        Tables unchanged since ``load`` are referenced, not copied; the version becomes live
        only after every table of it is written."""
        return self._write(name, graph, {}, note)

    def append(self, name: str, graph: Graph, touched: dict, note: str = "") -> int:
        """Write a new version that adds to the live one the rows that a change touched.

        ``touched`` maps ("node", label) or ("rel", type, src, dst) to (rows, key columns): whole
        rows, one for each key, which replace those of the same key.  ``graph`` is the graph after
        the change; its other tables are as in ``save``."""
        return self._write(name, graph, touched, note)

    def _write(self, name: str, graph: Graph, touched: dict, note: str) -> int:
        live = {} if not touched else self._tables(name)
        v = self._claim(name)
        base = f"{self._folder(name)}/v{v}"
        meta: list[tuple] = []

        def place(table: tuple, df: DataFrame, sub: str, extra: str) -> None:
            kind, *rest = table
            head = (kind, rest[0], *(rest[1:] or ("", "")), extra)
            if table in touched:
                rows, keys = touched[table]
                have = live.get(table, [])
                if have and len(have) <= MAX_DELTAS and all(k in ("", ",".join(keys)) for k, _ in have):
                    rows.write.parquet(f"{base}/{sub}")
                    have = have + [(",".join(keys), f"{base}/{sub}")]
                    meta.extend((*head, k, path, i, note) for i, (k, path) in enumerate(have))
                    return
            seen = self._origin.get(id(df))
            if seen is not None and seen[0] is df and seen[1] == name:
                meta.extend((*head, k, path, i, note) for i, (k, path) in enumerate(seen[2]))
                return
            df.write.parquet(f"{base}/{sub}")
            meta.append((*head, "", f"{base}/{sub}", 0, note))

        for label, df in graph.nodes.items():
            place(("node", label), df, f"nodes/{label}", ",".join(graph.keys[label]))
        for (t, s, d), df in graph.rels.items():
            ends = [e for (tt, ss, dd, e) in graph.integrity if (tt, ss, dd) == (t, s, d)]
            place(("rel", t, s, d), df, f"rels/{t}__{s}__{d}", ",".join(sorted(ends)))
        if not meta:
            meta.append(("none", "", "", "", "", "", "", 0, note))
        self.spark.createDataFrame(meta, _META).coalesce(1).write.json(f"{base}/_meta")
        self._create(f"{base}/_committed")
        return v

    def _meta(self, name: str) -> list:
        v = self._current(name)
        if v is None:
            raise KeyError(f"no graph {name!r}")
        # one row per file set of a label or relationship table: schema-sized, not data-sized
        return sorted(self.spark.read.schema(_META).json(f"{self._folder(name)}/v{v}/_meta").collect(), key=lambda m: m["number"])

    def _tables(self, name: str) -> dict[tuple, list[tuple[str, str]]]:
        """(row key, path) of the base and the deltas of each table of the live version."""
        out: dict[tuple, list[tuple[str, str]]] = {}
        if self._current(name) is not None:
            for m in self._meta(name):
                table = ("node", m["name"]) if m["kind"] == "node" else ("rel", m["name"], m["src"], m["dst"])
                out.setdefault(table, []).append((m["row_key"] or "", m["path"]))
        return out

    def note(self, name: str) -> str:
        """The note of the live version; empty without one."""
        return "" if self._current(name) is None else (self._meta(name)[0]["note"] or "")

    def _read(self, name: str, parts: list[tuple[str, str]]) -> DataFrame:
        """A base with its deltas: the newest row of each key."""
        if len(parts) == 1:
            df = self.spark.read.parquet(parts[0][1])
        else:
            keys = parts[-1][0].split(",")
            base, *deltas = [self.spark.read.parquet(p) for _, p in parts]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                          [f.withColumn("_delta", F.lit(i)) for i, f in enumerate(deltas)])
            newest = rows.groupBy(*keys).agg(F.max("_delta").alias("_newest")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
            # the base is only tested against the keys of the deltas, the deltas among themselves
            rows = rows.join(newest, same & (F.col("_delta") == F.col("_newest")), "left_semi").drop("_delta")
            df = base.join(newest, same, "left_anti").unionByName(rows, allowMissingColumns=True)
        self._origin[id(df)] = (df, name, parts)
        return df

    def load(self, name: str) -> Graph:
        g, meta = Graph(), self._meta(name)
        tables = self._tables(name)
        first = {(m["kind"], m["name"], m["src"] or "", m["dst"] or ""): m for m in reversed(meta)}
        for m in first.values():
            if m["kind"] == "node":
                df = self._read(name, tables["node", m["name"]])
                g = g.with_nodes(m["name"], df, tuple(k for k in (m["extra"] or "").split(",") if k))
        for m in first.values():
            if m["kind"] == "rel":
                ends = set((m["extra"] or "").split(","))
                g = g.with_rels(m["name"], m["src"], m["dst"], self._read(name, tables["rel", m["name"], m["src"], m["dst"]]),
                                src_exists="src" in ends, dst_exists="dst" in ends)
        return g

    def delete(self, name: str) -> bool:
        """G12 ``graph_delete(name)``: drop every version (versions of this graph may share
        folders with each other, never with another graph)."""
        return bool(self._fs.delete(self._Path(self._folder(name)), True))

    def versions(self, name: str) -> DataFrame:
        """Committed versions; the highest is live."""
        out = [(v,) for v in self._numbers(name) if self._exists(f"{self._folder(name)}/v{v}/_committed")]
        return self.spark.createDataFrame(out, "version int").withColumn(
            "live", F.col("version") == F.lit(self._current(name) or -1))
