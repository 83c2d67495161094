"""Pattern matching as a builder of DataFrame joins (no query text parser).

``g.match("c", "Customer").out("r", "PLACED", "o", "Order")`` is the pattern
``(c:Customer)-[r:PLACED]->(o:Order)``.  Every bound variable contributes
columns named ``<var>__<property>`` plus ``<var>___id`` and ``<var>___label``;
``m.c("c.c_name")`` resolves a Cypher-style reference to its column,
``m.c("c")`` to the node id and ``m.c("labels(c)")`` to its label.  The result is an ordinary
DataFrame, so Catalyst prunes unused properties down to the parquet scans,
pushes property filters into them and picks the join strategy (AQE turns a
shuffle join into a broadcast only when run-time sizes allow it).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.model import Graph
from trellis.session import cut_lineage

SEP = "__"
TIMES = "__times"       # how many matches a row of counted trails stands for
# columns the edge view adds next to rel_id (a relationship property may not use them)
RESERVED_EDGE_COLUMNS = {"a", "b", "type", "tab", "near_label", "far_label"}


def _node_frame(graph: Graph, var: str, labels: list[str]) -> DataFrame:
    frames = []
    for label in labels:
        df = graph.nodes[label]
        frames.append(df.select(
            graph.id_col(label).alias(f"{var}{SEP}_id"),
            F.lit(label).alias(f"{var}{SEP}_label"),
            *[F.col(c).alias(f"{var}{SEP}{c}") for c in graph.props(label)]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def may_share(a, b) -> bool:
    """Can two steps over these types (one, several or None for all) bind the same relationship?"""
    if a is None or b is None:
        return True
    return bool(set([a] if isinstance(a, str) else a) & set([b] if isinstance(b, str) else b))


def _eq_filter(var: str, props: dict) -> Column | None:
    conds = [F.col(f"{var}{SEP}{k}") == (v if isinstance(v, Column) else F.lit(v)) for k, v in props.items()]
    return reduce(lambda a, b: a & b, conds) if conds else None


def edge_identity(prefix: str = "") -> Column:
    """A relationship among those of several tables: (table, id)."""
    return F.struct(F.col(f"{prefix}tab").alias("tab"), F.col(f"{prefix}rel_id").cast("string").alias("rel_id")).alias("rel_id")


def edge_tables(graph: Graph, types: list[str | None], near_label: str | None, far_labels: list[str] | None,
                direction: str) -> int:
    """How many relationship tables a step over these types reads."""
    keys = set()
    for t in types:
        for (rt, s, d), _ in graph.rel_tables(t):
            for way in (["out", "in"] if direction == "both" else [direction]):
                near, far = (s, d) if way == "out" else (d, s)
                if (near_label is None or near == near_label) and (far_labels is None or far in far_labels):
                    keys.add((rt, s, d))
    return len(keys)


def edge_frame(graph: Graph, rel_type: str | None, near_label: str | None,
               far_labels: list[str] | None, direction: str) -> tuple[DataFrame, list[str]]:
    """Relationships seen from the near end: ``rel_id, a (near id), b (far id),
    type, tab (the relationship table), near_label, far_label, props``.

    ``direction`` is ``out`` (near is the source), ``in`` or ``both``; for
    ``both`` each relationship appears once per direction with the same
    ``rel_id`` and a self loop appears once (M9).
    """
    parts, labels = [], set()
    dirs = ["out", "in"] if direction == "both" else [direction]
    ids = {df.schema["rel_id"].dataType for _, df in graph.rel_tables(rel_type)}
    for d in dirs:
        for (t, s, dl), df in graph.rel_tables(rel_type):
            near, far = (s, dl) if d == "out" else (dl, s)
            if near_label is not None and near != near_label:
                continue
            if far_labels is not None and far not in far_labels:
                continue
            clash = RESERVED_EDGE_COLUMNS & set(df.columns)
            if clash:
                raise ValueError(f"relationship property names {sorted(clash)} are reserved")
            a, b = ("src", "dst") if d == "out" else ("dst", "src")
            e = df.select(F.col("rel_id").cast("string").alias("rel_id") if len(ids) > 1 else F.col("rel_id"), F.col(a).alias("a"), F.col(b).alias("b"),
                          F.lit(t).alias("type"), F.lit("|".join((t, s, dl))).alias("tab"),
                          F.lit(near).alias("near_label"), F.lit(far).alias("far_label"),
                          *[F.col(c) for c in df.columns if c not in ("rel_id", "src", "dst")])
            if direction == "both" and d == "in" and near == far:       # a self loop; equal ids of two labels are none
                e = e.where(F.col("a") != F.col("b"))
            parts.append(e)
            labels.add(far)
    if not parts:
        raise ValueError(f"no relationships of type {rel_type!r} from {near_label!r}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts), sorted(labels)


class Match:
    def __init__(self, graph: Graph, df: DataFrame, nodes: dict, rels: dict, paths: dict | None = None,
                 pending: dict | None = None, counted: bool = False):
        self.graph = graph
        self.df = df
        self.nodes = nodes  # var -> list of labels
        self.rels = rels    # var -> type
        self.paths = paths or {}
        # node variables known to exist (declared integrity) whose properties are
        # joined only when first referenced
        self.pending = pending or {}
        # a row stands for as many matches as its column TIMES says
        self.counted = counted

    # ------------------------------------------------------------ starting points
    @classmethod
    def start(cls, graph: Graph, var: str, label: str | None = None, **props) -> Match:
        labels = [label] if label else graph.labels()
        df = _node_frame(graph, var, labels)
        cond = _eq_filter(var, props)
        if cond is not None:
            df = df.where(cond)
        return cls(graph, df, {var: labels}, {})

    @classmethod
    def from_rows(cls, graph: Graph, rows: DataFrame, var: str = "row") -> Match:
        """``LOAD CSV ... AS row`` / ``UNWIND $rows AS row``: input rows as a variable."""
        df = rows.select(*[F.col(c).alias(f"{var}{SEP}{c}") for c in rows.columns])
        return cls(graph, df, {}, {})

    # ------------------------------------------------------------ references
    def _materialize(self, var: str) -> None:
        label = self.pending.pop(var)
        self.df = self.df.join(_node_frame(self.graph, var, [label]), f"{var}{SEP}_id", "inner")

    def c(self, ref: str) -> Column:
        """``var.prop`` → property column; ``var`` → node id (or path node list);
        ``labels(var)`` → the node's label."""
        if ref.startswith("labels(") and ref.endswith(")"):
            return F.col(f"{ref[7:-1]}{SEP}_label")
        if "." in ref:
            var, prop = ref.split(".", 1)
            if var in self.pending:
                self._materialize(var)
            return F.col(f"{var}{SEP}{prop}")
        if ref in self.paths:
            return F.col(f"{ref}{SEP}nodes")
        return F.col(f"{ref}{SEP}_id")

    def _new(self, df, nodes=None, rels=None, paths=None, pending=None) -> Match:
        return Match(self.graph, df, nodes or self.nodes, rels or self.rels, paths or self.paths,
                     dict(self.pending if pending is None else pending), self.counted)

    def _whole(self) -> None:
        if self.counted:
            raise ValueError("counted trails come last: their relationships and path are not known")

    def _last_node(self) -> str:
        return list(self.nodes)[-1]

    # ------------------------------------------------------------ clauses
    def where(self, cond: Column) -> Match:
        return self._new(self.df.where(cond))

    def bind(self, var: str, label: str, **props) -> Match:
        """Another ``MATCH (var:label {k: v})``.  Values may be columns of bound
        variables (M14, row-driven match: an equi join).  With only literal
        values the new side is unrelated to the rows so far; that is
        refused: all pairs of two sides is not a join.  Bind both ends from one
        row instead (``from_rows`` and two linked ``bind`` calls)."""
        frame = _node_frame(self.graph, var, [label])
        literal = {k: v for k, v in props.items() if not isinstance(v, Column)}
        linked = {k: v for k, v in props.items() if isinstance(v, Column)}
        lit_cond = _eq_filter(var, literal)
        if lit_cond is not None:
            frame = frame.where(lit_cond)
        nodes = dict(self.nodes)
        nodes[var] = [label]
        if linked:
            cond = reduce(lambda a, b: a & b, [F.col(f"{var}{SEP}{k}") == v for k, v in linked.items()])
            return self._new(self.df.join(frame, cond, "inner"), nodes=nodes)
        raise ValueError(f"MATCH ({var}:{label}) shares no value with the rows so far; link it by a column")

    def join(self, other: Match) -> Match:
        """Consecutive MATCH clauses (M13): inner join on the shared variables."""
        self._whole()
        other._whole()
        shared = [v for v in other.nodes if v in self.nodes] + [v for v in other.rels if v in self.rels]
        if not shared:
            raise ValueError("no shared variable")
        keys = [f"{v}{SEP}{'_id' if v in other.nodes else 'rel_id'}" for v in shared]
        # ids are unique per label and per relationship table only
        finer = [f"{v}{SEP}{'_label' if v in other.nodes else 'tab'}" for v in shared]
        keys += [c for c in finer if c in self.df.columns and c in other.df.columns]
        drop = [c for c in other.df.columns if c in self.df.columns and c not in keys]
        df = self.df.join(other.df.drop(*drop), keys, "inner")
        # a node is pending as long as neither side has joined its properties
        pending = {v: x for m, o in ((self, other), (other, self)) for v, x in m.pending.items()
                   if v not in o.nodes or v in o.pending}
        return self._new(df, nodes={**self.nodes, **other.nodes}, rels={**self.rels, **other.rels},
                         paths={**self.paths, **other.paths}, pending=pending)

    def hop(self, rel_var: str | None, rel_type: str | None, node_var: str, label: str | None = None,
            direction: str = "out", frm: str | None = None, rel_props: dict | None = None, **node_props) -> Match:
        """One relationship step ``(frm)-[rel_var:rel_type]->(node_var:label)``."""
        self._whole()
        frm = frm or self._last_node()
        near = self.nodes[frm][0] if len(self.nodes[frm]) == 1 else None
        bound = node_var in self.nodes
        far_labels = [label] if label else (self.nodes[node_var] if bound else None)
        e, labels = edge_frame(self.graph, rel_type, near, far_labels, direction)
        rv = rel_var or f"_r{len(self.rels)}"
        e = e.select(*[F.col(c).alias(f"{rv}{SEP}{c}") for c in e.columns])
        at = F.col(f"{frm}{SEP}_id") == F.col(f"{rv}{SEP}a")
        if near is None:        # ids are unique per label only
            at &= F.col(f"{frm}{SEP}_label") == F.col(f"{rv}{SEP}near_label")
        df = self.df.join(e, at, "inner")
        if rel_props:
            df = df.where(_eq_filter(rv, rel_props))
        # relationship isomorphism: two relationship variables never bind the same relationship
        for other, t in self.rels.items():
            if may_share(rel_type, t):
                same_id = F.col(f"{other}{SEP}rel_id").cast("string") == F.col(f"{rv}{SEP}rel_id").cast("string")
                if df.schema[f"{other}{SEP}rel_id"].dataType == df.schema[f"{rv}{SEP}rel_id"].dataType:
                    same_id = F.col(f"{other}{SEP}rel_id") == F.col(f"{rv}{SEP}rel_id")
                df = df.where((F.col(f"{other}{SEP}tab") != F.col(f"{rv}{SEP}tab")) | ~same_id)
        for other, t in self.paths.items():  # ... nor one inside a variable-length segment
            if may_share(rel_type, t):
                df = df.where(~self._on_path(df, other, rv))
        nodes = dict(self.nodes)
        pending = dict(self.pending)
        if bound:
            df = df.where(F.col(f"{node_var}{SEP}_id") == F.col(f"{rv}{SEP}b"))
            if len(self.nodes[node_var]) > 1:
                df = df.where(F.col(f"{node_var}{SEP}_label") == F.col(f"{rv}{SEP}far_label"))
        elif (not node_props and len(labels) == 1
              and self.graph.guaranteed(rel_type, near, labels[0], direction)):
            df = df.withColumn(f"{node_var}{SEP}_id", F.col(f"{rv}{SEP}b"))
            nodes[node_var] = labels
            pending[node_var] = labels[0]
        else:
            frame = _node_frame(self.graph, node_var, labels)
            cond = _eq_filter(node_var, node_props)
            if cond is not None:
                frame = frame.where(cond)
            df = df.join(frame, (F.col(f"{node_var}{SEP}_id") == F.col(f"{rv}{SEP}b"))
                         & (F.col(f"{node_var}{SEP}_label") == F.col(f"{rv}{SEP}far_label")), "inner")
            nodes[node_var] = labels
        rels = dict(self.rels)
        rels[rv] = rel_type
        return self._new(df, nodes=nodes, rels=rels, pending=pending)

    @staticmethod
    def _on_path(df: DataFrame, path: str, rel: str) -> Column:
        """Is the relationship one of the path's?  A path over several tables holds pairs (table, id)."""
        held = F.col(f"{path}{SEP}rels")
        kind = df.schema[f"{path}{SEP}rels"].dataType.elementType.simpleString()
        if kind.startswith("struct"):
            return F.array_contains(held, F.struct(F.col(f"{rel}{SEP}tab").alias("tab"),
                                                   F.col(f"{rel}{SEP}rel_id").cast("string").alias("rel_id")))
        same_table = F.col(f"{rel}{SEP}tab") == F.col(f"{path}{SEP}tab")
        return same_table & F.array_contains(held.cast("array<string>"), F.col(f"{rel}{SEP}rel_id").cast("string"))

    def out(self, rel_var, rel_type, node_var, label=None, **kw) -> Match:
        return self.hop(rel_var, rel_type, node_var, label, "out", **kw)

    def inc(self, rel_var, rel_type, node_var, label=None, **kw) -> Match:
        return self.hop(rel_var, rel_type, node_var, label, "in", **kw)

    def both(self, rel_var, rel_type, node_var, label=None, **kw) -> Match:
        return self.hop(rel_var, rel_type, node_var, label, "both", **kw)

    def var_hop(self, rel_type, node_var: str, label: str | None, min_hops: int, max_hops: int,
                direction: str = "out", path: str | None = None, frm: str | None = None,
                carry: str | None = None, keep: list[str] | None = None) -> Match:
        """``(frm)-[:T*min..max]->(node_var)`` with trail semantics.

        ``rel_type`` may be one type, a list or None for all.  Only ids travel through the
        levels; properties are joined once at the end.  ``carry`` names a far-node property
        gathered along the path (F10 ``[n IN nodes(path) | n.p]``); where a trail passes
        several labels, a node without it adds null.

        ``keep`` lists all references to the far node that later clauses make (``x``, ``x.p``,
        ``labels(x)``), where these read neither path nor relationships: trails that agree in them
        become one row, and ``rows()`` counts it as often."""
        from trellis.operators.paths import counted_trails, labelled_trails, trail_tables

        self._whole()
        frm = frm or self._last_node()
        near = self.nodes[frm]
        tables = trail_tables(self.graph, rel_type)
        starts = self.df.select(F.col(f"{frm}{SEP}_id").alias("id"),
                                (F.lit(near[0]) if len(near) == 1 else F.col(f"{frm}{SEP}_label")).alias("label")).distinct()
        pv = path or f"_p{len(self.paths)}"
        several = len({x for (_, s, d), _ in tables for x in (s, d)} | set(near)) > 1
        text = (lambda c: c.cast("string")) if several else (lambda c: c)
        at = text(F.col(f"{frm}{SEP}_id")) == F.col("start")
        if several and len(near) > 1:
            at &= F.col(f"{frm}{SEP}_label") == F.col("start_label")
        ends = sorted({x for (_, s, d), _ in tables for x in ((d,) if direction == "out" else (s,) if direction == "in" else (s, d))}
                      | (set(near) if min_hops == 0 else set()))
        far = [label] if label else [x for x in ends if x in self.graph.nodes] or near
        frame = _node_frame(self.graph, node_var, far)
        nodes = dict(self.nodes)
        nodes[node_var] = far
        paths = dict(self.paths)
        paths[pv] = rel_type
        if keep is not None:
            if path or carry:
                raise ValueError("counted trails have no path")
            kept = [self._new(self.df, nodes=nodes).c(x) for x in keep]
            shared = [v for v, o in self.rels.items() if may_share(rel_type, o)]
            others = [v for v, o in self.paths.items() if may_share(rel_type, o)]
            if max_hops is not None and not others and (not shared and max_hops <= 2 or len(shared) == 1 and max_hops <= 1 and several):
                frame = frame.select(F.col(f"{node_var}{SEP}_id").alias("end"), F.col(f"{node_var}{SEP}_label").alias("end_label"), *kept)
                names = [c for c in frame.columns if c not in ("end", "end_label")]
                count = lambda by_rel: counted_trails(self.graph, starts, rel_type, near, min_hops, max_hops, direction, frame, by_rel)
                df = self.df.join(count(False).withColumnRenamed("n", TIMES), at, "inner")
                for v in shared:        # the trails that are the bound relationship itself do not count
                    own = count(True).select(F.col("start").alias("__s"), F.col("start_label").alias("__l"), F.col("rel_id.tab").alias("__t"),
                                             F.col("rel_id.rel_id").alias("__r"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)], "n")
                    same = ((F.col("start") == F.col("__s")) & (F.col("start_label") == F.col("__l")) & (F.col(f"{v}{SEP}tab") == F.col("__t"))
                            & F.col(f"{v}{SEP}rel_id").cast("string").eqNullSafe(F.col("__r")))
                    for i, c in enumerate(names):
                        same &= F.col(c).eqNullSafe(F.col(f"__k{i}"))
                    df = (df.join(own, same, "left").withColumn(TIMES, F.col(TIMES) - F.coalesce("n", F.lit(0)))
                          .where(F.col(TIMES) > 0))
                df = df.select(*self.df.columns, *names, TIMES)
            else:
                # longer trails, or several bound relationships to avoid: made, then counted
                made = self.var_hop(rel_type, node_var, label, min_hops, max_hops, direction, frm=frm)
                names = list(dict.fromkeys(made.df.select(*kept).columns))
                df = (made.df.groupBy(*[F.col(c) for c in dict.fromkeys([*self.df.columns, *names])])
                      .agg(F.count("*").alias(TIMES)))
            return Match(self.graph, df, nodes, self.rels, paths, dict(self.pending), True)
        on = text(F.col(f"{node_var}{SEP}_id")) == F.col("cur")
        if several:
            on &= F.col(f"{node_var}{SEP}_label") == F.col("cur_label")
        t = labelled_trails(self.graph, starts, rel_type, near, min_hops, max_hops, direction, carry, (self.df, at), (frame, on))
        df = t.select(*self.df.columns, F.col("start").alias(f"{pv}{SEP}start"), F.col("start_label").alias(f"{pv}{SEP}start_label"),
                      F.col("cur").alias(f"{pv}{SEP}end"), F.col("cur_label").alias(f"{pv}{SEP}end_label"),
                      F.col("nodes").alias(f"{pv}{SEP}nodes"), F.col("rels").alias(f"{pv}{SEP}rels"),
                      F.col("hops").alias(f"{pv}{SEP}length"),
                      F.lit("|".join(tables[0][0]) if len(tables) == 1 else "").alias(f"{pv}{SEP}tab"),
                      *([F.col("carried").alias(f"{pv}{SEP}carried")] if carry else []), *frame.columns)
        # relationships of one pattern are distinct: the segment avoids the ones already bound
        for other, o in self.rels.items():
            if may_share(rel_type, o):
                df = df.where(~self._on_path(df, pv, other))
        for other, o in self.paths.items():
            if may_share(rel_type, o):
                df = df.where(~F.arrays_overlap(self._pairs(df, pv), self._pairs(df, other)))
        return self._new(df, nodes=nodes, paths=paths)

    @staticmethod
    def _pairs(df: DataFrame, path: str) -> Column:
        """The relationships of a path as pairs (table, id)."""
        held = F.col(f"{path}{SEP}rels")
        if df.schema[f"{path}{SEP}rels"].dataType.elementType.simpleString().startswith("struct<tab:"):
            return held
        return F.transform(held, lambda x: F.struct(F.col(f"{path}{SEP}tab").alias("tab"), x.cast("string").alias("rel_id")))

    def path_object(self, path: str) -> Match:
        """The path as an object: column ``<path>__object`` STRUCT<nodes, rels, hops>.

        ``nodes`` and ``rels`` hold a struct for each place, in order: label or type, id, and
        all properties as a map of text (labels have different columns).  All places of all
        paths are joined with the nodes once and with the relationships once."""
        from trellis.operators.paths import trail_tables

        g = self.graph
        df = self.df.withColumn("__path", F.monotonically_increasing_id())
        df = cut_lineage(df)                    # the numbers must stay as they are
        typed = df.schema[f"{path}{SEP}nodes"].dataType.elementType.simpleString().startswith("struct<label:")

        def as_map(frame: DataFrame, names: list[str]) -> Column:
            pairs = [x for c in names for x in (F.lit(c), F.col(c).cast("string"))]
            return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")

        tables = trail_tables(g, self.paths[path])
        labels = sorted({x for (_, s, d), _ in tables for x in (s, d)} | {x for x in g.nodes if not tables})
        nodes = reduce(DataFrame.unionByName, [g.nodes[x].select(
            F.lit(x).alias("label"), g.id_col(x).cast("string").alias("id"), as_map(g.nodes[x], g.props(x)).alias("props")) for x in labels])
        rels = [r.select(F.lit("|".join(k)).alias("tab"), F.lit(k[0]).alias("type"), F.col("rel_id").cast("string").alias("id"),
                         as_map(r, [c for c in r.columns if c not in ("rel_id", "src", "dst")]).alias("props")) for k, r in tables]
        at = df.select("__path", F.posexplode(f"{path}{SEP}nodes").alias("pos", "n"))
        at = at.select("__path", "pos", *([F.col("n.label").alias("label"), F.col("n.id").alias("id")] if typed
                                          else [F.lit(labels[0]).alias("label"), F.col("n").cast("string").alias("id")]))
        ordered = lambda kind: F.array_sort(F.collect_list(F.struct("pos", F.struct(kind, "id", "props").alias("x"))),
                                            lambda a, b: a["pos"] - b["pos"])
        seen = (at.join(nodes, ["label", "id"]).groupBy("__path").agg(ordered("label").alias("n")))
        out = df.join(seen, "__path")
        if rels:
            at = df.select("__path", F.posexplode(self._pairs(df, path)).alias("pos", "r")).select(
                "__path", "pos", F.col("r.tab").alias("tab"), F.col("r.rel_id").alias("id"))
            used = at.join(reduce(DataFrame.unionByName, rels), ["tab", "id"]).groupBy("__path").agg(ordered("type").alias("r"))
            out = out.join(used, "__path", "left")
            steps = F.coalesce(F.transform("r", lambda x: x["x"]), F.array().cast("array<struct<type:string,id:string,props:map<string,string>>>"))
        else:
            steps = F.array().cast("array<struct<type:string,id:string,props:map<string,string>>>")
        obj = F.struct(F.transform("n", lambda x: x["x"]).alias("nodes"), steps.alias("rels"), F.col(f"{path}{SEP}length").alias("hops"))
        return self._new(out.withColumn(f"{path}{SEP}object", obj).drop("__path", "n", "r"))

    # ------------------------------------------------------------ RETURN
    def rows(self) -> Column:
        """``count(*)`` of the matches."""
        return F.sum(TIMES) if self.counted else F.count(F.lit(1))

    def ret(self, *refs: str, distinct: bool = False, **named) -> DataFrame:
        if not distinct:
            self._whole()
        cols = [self.c(r).alias(r.split(".", 1)[-1]) for r in refs]
        cols += [(v if isinstance(v, Column) else self.c(v)).alias(k) for k, v in named.items()]
        out = self.df.select(*cols)
        return out.distinct() if distinct else out

    def agg(self, keys: dict, **aggs: Column) -> DataFrame:
        """Cypher's implicit grouping: the non-aggregate RETURN items are the keys."""
        grp = [(v if isinstance(v, Column) else self.c(v)).alias(k) for k, v in keys.items()]
        return self.df.groupBy(*grp).agg(*[v.alias(k) for k, v in aggs.items()])


def cypher_order(df: DataFrame, *specs) -> DataFrame:
    """ORDER BY with Cypher null placement: null sorts greatest."""
    cols = []
    for s in specs:
        name, how = (s, "asc") if isinstance(s, str) else s
        c = F.col(name) if isinstance(name, str) else name
        cols.append(c.desc_nulls_first() if how == "desc" else c.asc_nulls_last())
    return df.orderBy(*cols)


def top_k(df: DataFrame, k: int, *specs) -> DataFrame:
    """ORDER BY ... LIMIT k, planned as TakeOrderedAndProject (a per-partition
    top-k, then a merge of k rows per partition)."""
    return cypher_order(df, *specs).limit(k)
