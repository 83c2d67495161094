"""Paths as iterative DataFrame jobs.

Search state is fixed in width: a label says how far a node is and which node came before it,
never the route.  Rounds are synchronous, so a label of ``hops`` h was made in round h from a
label of hops h - 1, and the rows of all rounds together (the history) hold every route.
``routes`` reads them back by pointer doubling, for the asked targets only: as many joins as
the longest route has binary digits.

A round joins only the rows won in the round before with the relationships, reduces the
candidates with a partial aggregate, beside what is known of the nodes.  What a round
wins is checkpointed as a small frame of its own (``History``), so a lost executor repeats one
round at most.  The driver sees one count per round.

Hubs: the relationships are written once.  Those of a node with more than ``HUB`` of them are
dealt to salts, and a state row of that node is copied to each (``Edges.step``), so no task
joins more than about ``HUB`` relationships for one state row.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trellis.model import Graph
from trellis.operators.match import edge_frame, edge_identity, edge_tables
from trellis.session import bounded_count, cut_lineage, stored

HUB = 100_000          # relationships of a node that one task joins
ROWS_A_TASK = 1_000_000    # trails that one task makes
KEPT_A_TASK = 250_000      # of shorter trails that are written and read again: a task reads what one has written


class Edges:
    """Relationships ``a, b, ...`` written once, those of hubs spread over salts."""

    def __init__(self, e: DataFrame, per: int | None = None):
        self.per = per or HUB
        e = stored(e, "edges")
        if "w" in e.columns and not e.where(F.col("w") < 0).isEmpty():
            raise ValueError("negative weights are not supported")
        # at most one row for each ``per`` relationships
        self.hubs = (e.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > self.per)
                     .select("a", F.ceil(F.col("n") / self.per).cast("int").alias("salts")))
        self.split = not self.hubs.isEmpty()
        if self.split:
            self.hubs = stored(self.hubs, "hubs")
            others = [c for c in e.columns if c != "a"]
            e = (e.join(self.hubs, "a", "left")
                 .withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*others), F.col("salts")).cast("int"), F.lit(0))).drop("salts"))
            e = stored(e, "edges")
        self.df = e

    def step(self, rows: DataFrame, at: str = "id") -> DataFrame:
        """``rows`` joined with the relationships that leave their node ``at``."""
        if not self.split:
            return rows.join(self.df, F.col(at) == F.col("a"))
        hubs = self.hubs.select(F.col("a").alias("hub"), "salts")
        rows = (rows.join(hubs, F.col(at) == F.col("hub"), "left")
                .withColumn("row_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))))
        return (rows.join(self.df, (F.col(at) == F.col("a")) & (F.col("row_salt") == F.col("salt")))
                .drop("hub", "salts", "row_salt", "salt"))


def _edges(graph: Graph, rel_type, label, direction, weight: Column | None = None,
           cost: Column | None = None, collapse: bool = False) -> DataFrame | None:
    """``a, b, rel_id[, w][, c]`` of relationship types from ``label`` to ``label``; None if there are none.

    Ids are unique per relationship table only, so where several tables come together
    ``rel_id`` is the pair (table, id)."""
    types = [rel_type] if isinstance(rel_type, str) or rel_type is None else list(rel_type)
    several = edge_tables(graph, types, label, [label] if label else None, direction) > 1
    parts = []
    for t in types:
        if not edge_tables(graph, [t], label, [label] if label else None, direction):
            continue
        e, labels = edge_frame(graph, t, label, [label] if label else None, direction)
        cols = [edge_identity() if several else F.col("rel_id"), F.col("a"), F.col("b")]
        if weight is not None:
            cols.append(weight.cast("double").alias("w"))
        if cost is not None:
            cols.append(cost.cast("double").alias("c"))
        parts.append(e.select(*cols))
    if not parts:
        return None
    e = reduce(DataFrame.unionByName, parts)
    if weight is not None:
        e = e.where(F.col("w").isNotNull())  # [choice] a relationship without weight is not traversable
    if cost is not None:
        e = e.where(F.col("c").isNotNull())
    if collapse and weight is not None and cost is None:
        # parallel relationships: only the cheapest (then smallest id) can be on a best path
        e = (e.groupBy("a", "b")
             .agg(F.min(F.struct("w", "rel_id")).alias("m"))
             .select(F.col("m.rel_id").alias("rel_id"), "a", "b", F.col("m.w").alias("w")))
    return e


def _id_match(graph: Graph, label: str, prop: str, values) -> DataFrame:
    """Nodes whose ``prop`` equals one of ``values`` compared as text (the wrapper
    quotes the value, so ``'1'`` matches a string property ``1``)."""
    vals = values if isinstance(values, (list, tuple)) else [values]
    df = graph.nodes[label]
    return df.where(F.col(prop).cast("string").isin([str(v) for v in vals])).select(
        graph.id_col(label).alias("id"))


# ---------------------------------------------------------------- trails
def trail_tables(graph: Graph, rel_type) -> list[tuple[tuple[str, str, str], DataFrame]]:
    types = [rel_type] if isinstance(rel_type, str) or rel_type is None else list(rel_type)
    return [kv for t in types for kv in graph.rel_tables(t)]


def trails(graph: Graph, starts: DataFrame, rel_type, near_label, far_label, min_hops: int,
           max_hops: int, direction: str = "out", carry: str | None = None) -> DataFrame:
    """``labelled_trails`` from ``starts.start``, nodes of one label."""
    label = near_label or far_label
    return labelled_trails(graph, starts.select(F.lit(label).alias("label"), F.col("start").alias("id")), rel_type, [label],
                           min_hops, max_hops, direction, carry)


def _reachable(tables: list, near_labels: list[str], max_hops: int, direction: str) -> set[tuple[str, str, str]]:
    """The tables that a trail of at most ``max_hops`` from ``near_labels`` can use."""
    at, used = set(near_labels), set()
    for _ in range(max_hops):
        far = set()
        for key, _df in tables:
            ways = [(key[1], key[2]), (key[2], key[1])]
            for n, f in (ways if direction == "both" else ways[:1] if direction == "out" else ways[1:]):
                if n in at:
                    used.add(key)
                    far.add(f)
        at = far
    return used


def _trail_edges(graph: Graph, rel_type, near_labels: list[str], max_hops: int, direction: str) -> tuple[list[str], DataFrame | None]:
    """(labels that trails over the types know, relationships ``rel_id, a, b, near, far`` that they can use)."""
    tables = trail_tables(graph, rel_type)
    labels = sorted({x for (_, s, d), _ in tables for x in (s, d)} | set(near_labels))
    types = sorted({t for (t, _, _), _ in tables})
    if len(labels) == 1:
        e = _edges(graph, types, labels[0], direction)
        return labels, None if e is None else e.withColumn("near", F.lit(labels[0])).withColumn("far", F.lit(labels[0]))
    # a table that no trail from these labels meets is not read
    used = _reachable(tables, near_labels, max_hops, direction)
    near = replace(graph, rels={k: v for k, v in graph.rels.items() if k in used})
    parts = [edge_frame(near, t, None, None, direction)[0] for t in sorted({t for t, _, _ in used})]
    return labels, reduce(DataFrame.unionByName, [x.select(
        F.struct("tab", F.col("rel_id").cast("string").alias("rel_id")).alias("rel_id"), F.col("a").cast("string").alias("a"),
        F.col("b").cast("string").alias("b"), F.col("near_label").alias("near"), F.col("far_label").alias("far")) for x in parts]) if parts else None


def spread(rows: DataFrame, made: int, *keys: str, a_task: int | None = None) -> DataFrame:
    """``rows`` dealt by ``keys`` so that a task makes about ``a_task`` (``ROWS_A_TASK``) of ``made`` rows; left alone
    where as many tasks as the cores make no more.  The session's shuffle partitions say nothing: those of few bytes
    are put together, however many rows they make."""
    n = -(-made // (a_task or ROWS_A_TASK))
    return rows.repartition(n, *keys) if n > rows.sparkSession.sparkContext.defaultParallelism else rows


def _made(left: DataFrame, at: list[str], right: DataFrame, on: list[str]) -> int:
    """How many rows a join of the two makes, a row of ``left`` that meets none counted as one; from counts a key,
    without making them."""
    x = left.groupBy(*[F.col(c).alias(f"l{i}") for i, c in enumerate(at)]).agg(F.count("*").alias("nl"))
    y = right.groupBy(*[F.col(c).alias(f"r{i}") for i, c in enumerate(on)]).agg(F.count("*").alias("nr"))
    cond = reduce(lambda a, b: a & b, [F.col(f"l{i}") == F.col(f"r{i}") for i in range(len(at))])
    return x.join(y, cond, "left").agg(F.sum(F.col("nl") * F.coalesce("nr", F.lit(1))).alias("n")).first()["n"] or 0


def labelled_trails(graph: Graph, starts: DataFrame, rel_type, near_labels: list[str], min_hops: int,
                    max_hops: int, direction: str = "out", carry: str | None = None,
                    head: tuple[DataFrame, Column] | None = None, tail: tuple[DataFrame, Column] | None = None) -> DataFrame:
    """All trails (no relationship twice) of ``min..max`` hops from ``starts`` (label, id).

    A trail may pass nodes of any label and relationships of all tables of the types.  Where
    these tables know one label only, the ids alone travel; else a node is the pair (label, id)
    and a relationship the pair (table, id), with ids as text.  ``near_labels`` are the labels
    that ``starts`` may have.

    ``head`` and ``tail`` are frames to join with the trails and the conditions, on ``start`` and
    ``start_label``, on ``cur`` and ``cur_label``.  Trails of every length meet ``head`` before their
    last hop and ``tail`` on its relationships, so the rows returned are never shuffled, and the shorter
    trails that they are made from are dealt by the number of rows made.

    Output ``start, start_label, cur, cur_label, nodes, rels, hops[, carried]`` and the columns of both."""
    if max_hops is None:
        raise ValueError("variable-length trails need an upper bound; use bfs() for unbounded search")
    labels, e = _trail_edges(graph, rel_type, near_labels, max_hops, direction)
    if len(labels) == 1:
        node = F.col("start")
        frontier = starts.select(F.col("id").alias("start"), F.lit(labels[0]).alias("start_label"))
    else:
        node = F.struct(F.col("start_label").alias("label"), F.col("start").alias("id"))
        frontier = starts.select(F.col("id").cast("string").alias("start"), F.col("label").alias("start_label"))
    rel_kind = (e.schema["rel_id"].dataType.simpleString() if e is not None
                else "string" if len(labels) == 1 else "struct<tab:string,rel_id:string>")
    frontier = frontier.select("start", "start_label", F.col("start").alias("cur"), F.col("start_label").alias("cur_label"),
                               F.array(node).alias("nodes"), F.array().cast(f"array<{rel_kind}>").alias("rels"), F.lit(0).alias("hops"))
    if carry:
        values = [graph.nodes[x].select(
            (graph.id_col(x) if len(labels) == 1 else graph.id_col(x).cast("string")).alias("pid"), F.lit(x).alias("plabel"),
            (F.col(carry) if carry in graph.nodes[x].columns else F.lit(None)).alias("pval")) for x in labels if x in graph.nodes]
        props = reduce(DataFrame.unionByName, values)
        frontier = (frontier.join(props, (F.col("start") == F.col("pid")) & (F.col("start_label") == F.col("plabel")))
                    .select(*frontier.columns, F.array(F.col("pval")).alias("carried")))
        if e is not None:
            e = e.join(props, (F.col("b") == F.col("pid")) & (F.col("far") == F.col("plabel"))).drop("pid", "plabel")

    own = frontier.columns
    with_head = lambda f: f if head is None else head[0].join(f, head[1])
    with_tail = lambda f: f if tail is None else f.join(tail[0], tail[1])
    at, on = (["cur"], ["a"]) if len(labels) == 1 else (["cur", "cur_label"], ["a", "near"])
    levels = [with_tail(with_head(frontier))] if min_hops == 0 else []
    if e is None or max_hops < 1:
        return reduce(DataFrame.unionAll, levels or [with_tail(with_head(frontier.where(F.lit(False))))])
    e = cut_lineage(e)          # every level joins it
    far = F.col("b") if len(labels) == 1 else F.struct(F.col("far").alias("label"), F.col("b").alias("id"))

    def step(rows: DataFrame, edges: DataFrame, made: int, a_task: int | None = None) -> DataFrame:
        cond = reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in zip(at, on)])
        cols = {"cur": F.col("b"), "cur_label": F.col("far"), "nodes": F.concat(F.col("nodes"), F.array(far)),
                "rels": F.concat(F.col("rels"), F.array(F.col("rel_id"))), "hops": F.col("hops") + 1}
        if carry:
            cols["carried"] = F.concat(F.col("carried"), F.array(F.col("pval")))
        out = spread(rows, made, *at, a_task=a_task).join(edges, cond).where(~F.array_contains(F.col("rels"), F.col("rel_id")))
        more = [c for c in (*rows.columns, *edges.columns) if c not in own and c not in e.columns]
        return out.select(*[cols.get(c, F.col(c)).alias(c) for c in own], *more)

    last = e
    if tail is not None:     # its condition names the trail's end
        last = (e.select("*", F.col("b").alias("cur"), F.col("far").alias("cur_label")).join(tail[0], tail[1]).drop("cur", "cur_label"))
    for k in range(1, max_hops + 1):
        made = _made(frontier, at, e, on) if k > 1 else e.count()
        if k >= min_hops:
            levels.append(step(with_head(spread(frontier, made, "start")), last, made))
        if k < max_hops:
            frontier = cut_lineage(step(frontier, e, made, KEPT_A_TASK))
    return reduce(lambda x, y: x.unionByName(y), levels)


def counted_trails(graph: Graph, starts: DataFrame, rel_type, near_labels: list[str], min_hops: int, max_hops: int,
                   direction: str, ends: DataFrame, by_rel: bool = False) -> DataFrame:
    """How many trails of ``min..max`` hops (2 at most) lead from each of ``starts`` (label, id) to the rows
    of ``ends`` (end, end_label, more columns) with the same values in the other columns.

    No trail is made: the relationships of each hop are counted by the node between them, and the pairs
    that are one relationship twice are taken off.  ``by_rel`` counts the trails of one hop by their
    relationship as well (``rel_id``).  Output ``start, start_label``, the other columns of ``ends``, ``n``."""
    if max_hops > 2 or (by_rel and max_hops > 1):
        raise ValueError("trails are counted for two hops at most")
    labels, e = _trail_edges(graph, rel_type, near_labels, max_hops, direction)
    text = (lambda c: c.cast("string")) if len(labels) > 1 else (lambda c: c)
    kept = [c for c in ends.columns if c not in ("end", "end_label")]
    ends = ends.withColumn("end", text(F.col("end")))
    starts = starts.select(text(F.col("id")).alias("start"), F.col("label").alias("start_label"))
    out = ["start", "start_label", *(["rel_id"] if by_rel else []), *kept]
    levels, made = [], 0
    if min_hops == 0 and not by_rel:
        levels.append(starts.join(ends, (F.col("start") == F.col("end")) & (F.col("start_label") == F.col("end_label")))
                      .select(*out, F.lit(1).cast("long").alias("n")))
    if e is not None and max_hops > 0:
        e = cut_lineage(e.where(F.col("rel_id").isNotNull()))        # no trail holds a relationship without an id
        last = e.join(ends, (F.col("b") == F.col("end")) & (F.col("far") == F.col("end_label"))).drop("end", "end_label")
        here = (F.col("start") == F.col("a")) & (F.col("start_label") == F.col("near"))
        if min_hops <= 1:
            into = last.groupBy("a", "near", *out[2:]).agg(F.count("*").alias("n"))
            levels.append(starts.join(into, here).select(*out, "n"))
        if max_hops == 2:
            first = starts.join(e, here).select("start", "start_label", F.col("b").alias("mid"), F.col("far").alias("mid_label"), "rel_id")
            goes = (F.col("mid") == F.col("a")) & (F.col("mid_label") == F.col("near"))
            into = last.groupBy("a", "near", *kept).agg(F.count("*").alias("n2"))
            one = first.groupBy("start", "start_label", "mid", "mid_label").agg(F.count("*").alias("n1"))
            made = _made(one, ["mid", "mid_label"], into, ["a", "near"])
            levels.append(spread(one, made, "mid", "mid_label").join(into, goes).select(*out, (F.col("n1") * F.col("n2")).alias("n")))
            twice = last.withColumnRenamed("rel_id", "again")
            levels.append(first.join(twice, goes & (F.col("rel_id") == F.col("again"))).select(*out, F.lit(-1).cast("long").alias("n")))
    if not levels:
        levels.append(starts.crossJoin(ends).where(F.lit(False)).select(
            "start", "start_label", *([F.lit(None).cast("struct<tab:string,rel_id:string>").alias("rel_id")] if by_rel else []), *kept,
            F.lit(0).cast("long").alias("n")))
    rows = spread(reduce(DataFrame.unionByName, levels), made, "start")
    return rows.groupBy(*out).agg(F.sum("n").alias("n")).where(F.col("n") > 0)


# ---------------------------------------------------------------- routes
def routes(history: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (source, id, hops, ...) with ``route``: the nodes from the source to ``id``.

    ``history`` has ``source, id, hops, pred``: at most one row for each (source, id, hops), and
    the node before it at hops - 1.  Jumps of 1, 2, 4, ... steps are joined up from it; each
    place of each route is then reached by the jumps of its binary digits."""
    longest = wanted.agg(F.max("hops")).first()[0] or 0
    jumps = [cut_lineage(history.where("hops > 0").select("source", "id", "hops", F.col("pred").alias("jump")))]
    while 2 ** len(jumps) <= longest:
        one, k = jumps[-1], 2 ** (len(jumps) - 1)
        two = one.select("source", F.col("id").alias("mid"), F.col("hops").alias("mid_hops"), F.col("jump").alias("to"))
        jumps.append(cut_lineage(one.withColumn("mid_hops", F.col("hops") - k).withColumnRenamed("jump", "mid")
                            .join(two, ["source", "mid", "mid_hops"]).select("source", "id", "hops", F.col("to").alias("jump"))))
    keys = ["source", "id", "hops"]
    at = (wanted.select(*keys).distinct()
          .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("hops"))))
          .withColumn("left", F.col("hops") - F.col("place")).withColumn("node", F.col("id")).withColumn("node_hops", F.col("hops")))
    for k in range(len(jumps) - 1, -1, -1):
        goes = F.col("left").bitwiseAND(F.lit(2 ** k)) > 0
        jump = jumps[k].select("source", F.col("id").alias("from"), F.col("hops").alias("node_hops_k"), "jump")
        at = (at.withColumn("from", F.when(goes, F.col("node"))).withColumn("node_hops_k", F.when(goes, F.col("node_hops")))
              .join(jump, ["source", "from", "node_hops_k"], "left")
              .withColumn("node", F.when(goes, F.col("jump")).otherwise(F.col("node")))
              .withColumn("node_hops", F.when(goes, F.col("node_hops") - 2 ** k).otherwise(F.col("node_hops")))
              .drop("from", "node_hops_k", "jump"))
    found = at.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "node"))).alias("r"))
    return wanted.join(found.select(*keys, F.transform("r", lambda x: x["node"]).alias("route")), keys)


def _start(sources: DataFrame, **more: Column) -> DataFrame:
    return sources.select("id").distinct().select(
        F.col("id").alias("source"), "id", *[v.alias(k) for k, v in more.items()], F.col("id").alias("pred"))


class History:
    """The rows won in each round, each checkpointed on its own; after ``every`` rounds they become one.

    A frame that is only kept would hold the plans of all rounds before it, twice."""

    def __init__(self, first: DataFrame, every: int = 8):
        self.every = every
        self.done = cut_lineage(first)
        self.recent: list[DataFrame] = []

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.recent, self.done)

    def add(self, won: DataFrame) -> tuple[DataFrame, int]:
        """Keep the rows of a round: (them, how many)."""
        won = cut_lineage(won)
        n = won.count()
        if n:
            self.recent.append(won)
        if len(self.recent) >= self.every:
            self.done, self.recent = cut_lineage(self.rows()), []
        return won, n

    def close(self) -> DataFrame:
        return cut_lineage(self.rows()) if self.recent else self.done


# ---------------------------------------------------------------- BFS
def bfs(graph: Graph, sources: DataFrame, rel_type, label: str, direction: str = "out",
        max_depth: int | None = None, with_route: bool = True, hub: int | None = None) -> DataFrame:
    """Unweighted shortest paths from every ``sources.id`` (multi-source).

    Output ``source, id, depth[, route]`` (route = node ids, ties resolved by the
    smallest predecessor id at every step).  Without relationships only the sources are reached."""
    first = _start(sources, hops=F.lit(0))
    e = _edges(graph, rel_type, label, direction)
    seen = History(first)
    if e is not None:
        e = Edges(e.select("a", "b").distinct(), hub)
        frontier, depth = seen.done, 0
        while max_depth is None or depth < max_depth:
            depth += 1
            cand = (e.step(frontier).groupBy("source", F.col("b").alias("id")).agg(F.min("a").alias("pred")))
            new = (cand.join(seen.rows().select("source", "id"), ["source", "id"], "left_anti")
                   .select("source", "id", F.lit(depth).alias("hops"), "pred"))
            frontier, n = seen.add(new)
            if n == 0:
                break
    history = seen.close()
    out = routes(history, history.select("source", "id", "hops")) if with_route else history
    return out.select("source", "id", F.col("hops").alias("depth"), *(["route"] if with_route else []))


def between(graph: Graph, source: DataFrame, target: DataFrame, rel_type, label: str, direction: str = "both",
            max_depth: int | None = None, hub: int | None = None, trace: list | None = None) -> DataFrame:
    """P1, pair form ``shortestPath((a)-[:T*]-(b))``: one shortest route between two nodes.

    ``source`` and ``target`` have one row ``id`` each.  Two searches grow level by level, from
    the source along the relationships and from the target against them; each round grows the
    one with the smaller frontier, and the first level that meets the other side ends both, so
    nothing beyond the meeting is built.  Among all shortest routes the one is taken whose
    nodes, from the target back, are the smallest ids (the rule of ``bfs``): the levels of the
    target's side are marked from the meeting nodes on, then each node takes its smallest
    marked neighbour.  Output ``source, target, depth, route``; no row if there is no route.
    ``trace`` receives (side, level, rows) of each round."""
    back = {"out": "in", "in": "out", "both": "both"}[direction]
    one, other = _edges(graph, rel_type, label, direction), _edges(graph, rel_type, label, back)
    ends = source.select(F.col("id").alias("source")).limit(1), target.select(F.col("id").alias("target")).limit(1)
    nothing = ends[0].withColumn("target", F.col("source")).withColumn("depth", F.lit(0)).withColumn("route", F.array("source"))
    same = source.select("id").join(target.select("id"), "id", "left_semi")
    if not same.isEmpty() or one is None:
        return nothing.join(same.select(F.col("id").alias("source")), "source", "left_semi")
    steps = [Edges(one.select("a", "b").distinct(), hub), Edges(other.select("a", "b").distinct(), hub)]
    sides = [History(_start(source, hops=F.lit(0))), History(_start(target, hops=F.lit(0)))]
    frontier, size, level = [sides[0].done, sides[1].done], [1, 1], [0, 0]
    met = None
    while met is None:
        if max_depth is not None and sum(level) >= max_depth:
            break
        s = 0 if size[0] <= size[1] else 1
        level[s] += 1
        cand = steps[s].step(frontier[s]).groupBy("source", F.col("b").alias("id")).agg(F.min("a").alias("pred"))
        new = (cand.join(sides[s].rows().select("id"), "id", "left_anti")
               .select("source", "id", F.lit(level[s]).alias("hops"), "pred"))
        frontier[s], size[s] = sides[s].add(new)
        if trace is not None:
            trace.append(("source" if s == 0 else "target", level[s], size[s]))
        if size[s] == 0:
            break
        hit = frontier[s].select("id").join(sides[1 - s].rows().select("id"), "id", "left_semi")
        if not hit.isEmpty():
            met = cut_lineage(hit)
    forward, backward = sides[0].close(), sides[1].close()
    if met is None:
        return nothing.where(F.lit(False))
    total = level[0] + level[1]
    # marked: nodes of the target's side on a shortest route, from the meeting level to the target
    marked = cut_lineage(met.join(backward.where(F.col("hops") == level[1]), "id", "left_semi").select("id"))
    later = []
    for k in range(level[1] - 1, -1, -1):
        nearer = backward.where(F.col("hops") == k).select(F.col("id").alias("near"))
        step = (steps[0].step(marked).join(nearer, F.col("b") == F.col("near"), "left_semi")
                .groupBy(F.col("b").alias("id")).agg(F.min("a").alias("pred")))
        step = cut_lineage(step.withColumn("hops", F.lit(total - k)))
        later.append(step)
        marked = step.select("id")
    start = forward.where("hops = 0").select("source")
    history = forward.select("source", "id", "hops", "pred")
    for step in later:
        history = history.unionByName(step.join(start).select("source", "id", "hops", "pred"))     # one source row
    wanted = later[-1].join(start).select("source", "id", "hops") if later else history.join(target.select("id"), "id", "left_semi").select("source", "id", "hops")
    return routes(cut_lineage(history), wanted).select("source", F.col("id").alias("target"), F.col("hops").alias("depth"), "route")


# ---------------------------------------------------------------- weighted
def _relax(sources: DataFrame, e: Edges, max_rounds: int | None, prune_targets: DataFrame | None = None) -> DataFrame:
    """Label-correcting search: the history ``source, id, dist, hops, pred``.

    A candidate wins if it is cheaper than all labels of its node so far; the label of a node
    is its cheapest, of fewest hops.  Hops grow with the rounds, so equal weights keep the
    route of fewest hops, and ties resolve to the smallest predecessor id."""
    rounds = 0
    seen = History(_start(sources, dist=F.lit(0.0), hops=F.lit(0)))
    changed = seen.done
    if prune_targets is not None:
        prune_targets = cut_lineage(prune_targets.where(F.col("id").isNotNull()).distinct())
        n_targets = prune_targets.count()
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        cand = e.step(changed).select("source", F.col("b").alias("id"), (F.col("dist") + F.col("w")).alias("dist"), F.col("a").alias("pred"))
        if prune_targets is not None:
            # only a source that has reached every target has a bound: its dearest target
            best = (seen.rows().join(prune_targets, "id", "left_semi").groupBy("source", "id").agg(F.min("dist").alias("dist"))
                    .groupBy("source").agg(F.max("dist").alias("bound"), F.count("*").alias("reached"))
                    .where(F.col("reached") == n_targets).drop("reached"))
            cand = (cand.join(best, "source", "left")
                    .where(F.col("bound").isNull() | (F.col("dist") <= F.col("bound"))).drop("bound"))
        # one aggregate of fixed-width rows: what is known of a node beside the best offer to it
        known = seen.rows().select("source", "id", F.col("dist").alias("known"))
        won = (cand.select("source", "id", F.struct("dist", "pred").alias("offer")).unionByName(known, allowMissingColumns=True)
               .groupBy("source", "id").agg(F.min("offer").alias("offer"), F.min("known").alias("known"))
               .where(F.col("offer").isNotNull() & (F.col("known").isNull() | (F.col("offer.dist") < F.col("known"))))
               .select("source", "id", "offer.dist", F.lit(rounds).alias("hops"), "offer.pred"))
        changed, n = seen.add(won)
        if n == 0:
            break
    return seen.close()


def _best(history: DataFrame) -> DataFrame:
    """The cheapest label of each node; of equal ones that of fewest hops."""
    return (history.groupBy("source", "id").agg(F.min(F.struct("dist", "hops", "pred")).alias("m"))
            .select("source", "id", "m.*"))


def weighted_paths(graph: Graph, sources: DataFrame, rel_type, label: str, weight: Column,
                   direction: str = "out", max_len: int | None = None,
                   targets: DataFrame | None = None, with_route: bool = True, hub: int | None = None) -> DataFrame:
    """Cheapest paths from each ``sources.id``.

    ``max_len`` bounds the hops (P6): after k synchronous rounds a label is the
    best over paths of at most k relationships.  ``targets`` (``id``) prunes, once a source
    has reached all of them, candidates that are dearer than its dearest target; only their
    labels and routes are returned.  Output ``source, id, dist, hops, pred[, route]``."""
    e = _edges(graph, rel_type, label, direction, weight=weight, collapse=True)
    if e is None:
        history = cut_lineage(_start(sources, dist=F.lit(0.0), hops=F.lit(0)))
    else:
        history = _relax(sources, Edges(e, hub), max_len, targets.select("id") if targets is not None else None)
    best = _best(history)
    if targets is not None:
        best = best.join(targets.select("id"), "id", "left_semi")
    best = cut_lineage(best.select("source", "id", "dist", "hops", "pred"))
    return routes(history, best) if with_route else best


def _with_values(graph: Graph, label: str, prop: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``route`` turned from node ids into the ``prop`` of the nodes."""
    names = graph.nodes[label].select(graph.id_col(label).alias("nid"), F.col(prop).alias("pv"))
    place = rows.select(*keys, F.posexplode("route").alias("pos", "nid"))
    named = (place.join(names, "nid").groupBy(*keys)
             .agg(F.sort_array(F.collect_list(F.struct("pos", "pv"))).alias("r")))
    return rows.drop("route").join(named.select(*keys, F.transform("r", lambda x: x["pv"]).alias("route")), keys)


def shortest_path(graph: Graph, label: str, prop: str, source_value, target_value, rel_type,
                  weight_prop: str | None, direction: str = "out", max_len: int | None = None) -> DataFrame:
    """The ``shortest_path(graph, label, prop, source, target, rel_type, weight)``
    call: ``pathWeight`` and ``route`` (the ``prop`` of every node on it), one
    row per (source node, target node) pair that is connected."""
    src = _id_match(graph, label, prop, source_value)
    dst = _id_match(graph, label, prop, target_value)
    w = F.col(weight_prop) if weight_prop else F.lit(1)
    hits = weighted_paths(graph, src, rel_type, label, w, direction, max_len, targets=dst)
    named = _with_values(graph, label, prop, hits.select("source", "id", "dist", "route"), ["source", "id"])
    return named.select(F.col("dist").alias("pathWeight"), "route", "source", F.col("id").alias("target"))


def shortest_path_between(graph: Graph, label: str, prop: str, source_value, target_value, rel_type,
                          direction: str = "both", max_len: int | None = None) -> DataFrame:
    """``shortestPath((a {prop: source})-[:T*..max_len]-(b {prop: target}))``: ``length`` and ``route``
    (the ``prop`` of every node on it).  The values must name one node each."""
    ends = [_id_match(graph, label, prop, v) for v in (source_value, target_value)]
    for x in ends:
        if bounded_count(x, 1) > 1:
            raise ValueError(f"several {label} nodes share this {prop}; shortest_path returns one row per pair")
    found = between(graph, *ends, rel_type, label, direction, max_len)
    return _with_values(graph, label, prop, found, ["source", "target"]).select(F.col("depth").alias("length"), "route")


def constrained_paths(graph: Graph, sources: DataFrame, rel_type, label: str, weight: Column,
                      cost: Column, max_cost: float, direction: str = "out",
                      max_rounds: int | None = None, with_route: bool = True, hub: int | None = None) -> DataFrame:
    """P5: cheapest ``weight`` subject to total ``cost <= max_cost``.

    Every node keeps its Pareto set of ``(dist, cost)`` labels.  A candidate wins if no label
    of its node so far is at most as dear in both, nor another candidate of the round: the
    running minimum of costs, in order of weight, excludes the row itself.
    Output: best label per (source, id)."""
    history = _start(sources, dist=F.lit(0.0), cost=F.lit(0.0), hops=F.lit(0), pred_cost=F.lit(0.0))
    e = _edges(graph, rel_type, label, direction, weight=weight, cost=cost)
    seen = History(history)
    if e is not None:
        e = Edges(e, hub)
        changed, rounds = seen.done, 0
        order = Window.partitionBy("source", "id").orderBy("dist", "cost", "new")       # an old label before an equal new one
        prior = order.rowsBetween(Window.unboundedPreceding, -1)
        while max_rounds is None or rounds < max_rounds:
            rounds += 1
            step = e.step(changed.withColumnRenamed("cost", "spent")).withColumn("cost", F.col("spent") + F.col("c"))
            # only the best label per (node, cost) can be Pareto-optimal: a partial min before the window
            cand = (step.where(F.col("cost") <= F.lit(max_cost)).groupBy("source", F.col("b").alias("id"), "cost")
                    .agg(F.min(F.struct((F.col("dist") + F.col("w")).alias("dist"), F.col("a").alias("pred"), F.col("spent").alias("pred_cost"))).alias("m"))
                    .select("source", "id", "cost", "m.*", F.lit(True).alias("new")))
            met = cand.select("source", "id").distinct()
            old = (seen.rows().join(met, ["source", "id"], "left_semi").groupBy("source", "id", "cost").agg(F.min("dist").alias("dist"))
                   .select("source", "id", "cost", "dist", F.lit(False).alias("new")))
            won = (cand.unionByName(old, allowMissingColumns=True)
                   .withColumn("lowest", F.min("cost").over(prior))
                   .where(F.col("new") & (F.col("lowest").isNull() | (F.col("cost") < F.col("lowest"))))
                   .select("source", "id", "dist", "cost", F.lit(rounds).alias("hops"), "pred_cost", "pred"))
            changed, n = seen.add(won)
            if n == 0:
                break
    history = seen.close()
    # best label per node: a partial min, not a window
    rank = ["dist", "cost", "hops", "pred"]
    best = cut_lineage(history.groupBy("source", "id").agg(F.min(F.struct(*rank)).alias("m")).select("source", "id", "m.*"))
    if not with_route:
        return best
    # a label's place in the history is its node and cost
    spot = lambda i, c: F.struct(F.col(i).alias("id"), F.col(c).alias("cost"))
    keyed = history.select("source", spot("id", "cost").alias("id"), "hops", spot("pred", "pred_cost").alias("pred"))
    found = routes(keyed, best.select("source", spot("id", "cost").alias("id"), "hops"))
    found = found.select("source", F.col("id.id").alias("id"), F.transform("route", lambda x: x["id"]).alias("route"))
    return best.join(found, ["source", "id"]).select("source", "id", *rank, "route")


def _run_trails(start: DataFrame, e: Edges, max_len: int, keep: int | None, useful=None) -> DataFrame:
    """Trails of 1 to ``max_len`` relationships from ``start`` (source): ``source, cur, nodes, rels, dist``.

    ``keep`` holds only so many of the lightest per node and level; ``useful(trails, hops)``
    drops trails that no wanted one begins with."""
    rel_kind = e.df.schema["rel_id"].dataType.simpleString()
    frontier = start.select("source", F.col("source").alias("cur"), F.array("source").alias("nodes"),
                            F.array().cast(f"array<{rel_kind}>").alias("rels"), F.lit(0.0).alias("dist"))
    levels = []
    for n in range(1, max_len + 1):
        step = (e.step(frontier, "cur").where(~F.array_contains(F.col("rels"), F.col("rel_id")))
                .select("source", F.col("b").alias("cur"), F.concat("nodes", F.array("b")).alias("nodes"),
                        F.concat("rels", F.array("rel_id")).alias("rels"), (F.col("dist") + F.col("w")).alias("dist")))
        if useful is not None:
            step = useful(step, n)
        if keep is not None:
            step = top_k_per_group(step, ["source", "cur"], ["dist", "nodes", "rels"], keep).drop("rank")
        frontier = cut_lineage(step)
        levels.append(frontier)
    return reduce(DataFrame.unionAll, levels)


def k_paths(graph: Graph, sources: DataFrame, rel_type, label: str, weight: Column, k: int,
            max_len: int, direction: str = "out", hub: int | None = None) -> DataFrame:
    """The ``k`` cheapest trails of at most ``max_len`` hops per (source, target), for all targets.

    A first run keeps the ``k`` lightest partial trails of each node and level.  Its arrivals are
    real trails, so the weight of a node's k-th bounds what can be in the answer there (no bound
    for a node with fewer).  The room of a node with r hops left is the largest weight that a
    partial trail may have there and still reach some node within that node's bound: the node's
    own bound, or the room of a follower with r - 1 hops left less the weight of the way.  The full
    run drops partial trails beyond the room, so no dominated trail is listed or continued, and
    nothing that could be in the answer is dropped."""
    e = _edges(graph, rel_type, label, direction, weight=weight)
    start = sources.select(F.col("id").alias("source")).distinct()
    if e is None:
        none = start.select("source", F.col("source").alias("cur"), F.array("source").alias("nodes"), F.array("source").alias("rels"),
                            F.lit(0.0).alias("dist"), F.lit(0).alias("hops"), F.lit(1).alias("rank"))
        return none.where(F.lit(False))
    e = Edges(e, hub)
    first = _run_trails(start, e, max_len, k)
    # at most k arrivals a level and node
    kth = F.get(F.sort_array(F.collect_list("dist")), F.lit(k - 1))
    bound = cut_lineage(first.groupBy("source", F.col("cur").alias("id")).agg(F.coalesce(kth, F.lit(float("inf"))).alias("room")))
    rooms = [bound]
    for _ in range(1, max_len):
        ahead = (e.df.select("a", "b", "w").join(rooms[-1].withColumnRenamed("id", "b"), "b")
                 .groupBy("source", F.col("a").alias("id")).agg(F.max(F.col("room") - F.col("w")).alias("room")))
        rooms.append(cut_lineage(bound.unionByName(ahead).groupBy("source", "id").agg(F.max("room").alias("room"))))
    slack = F.col("room") + F.abs("room") * 1e-12

    def useful(trails_now: DataFrame, hops: int) -> DataFrame:
        room = rooms[max_len - hops].select("source", F.col("id").alias("cur"), "room")
        return trails_now.join(room, ["source", "cur"]).where(F.col("dist") <= slack).drop("room").select(*trails_now.columns)

    found = _run_trails(start, e, max_len, None, useful)
    here = found.join(bound.select("source", F.col("id").alias("cur"), "room"), ["source", "cur"]).where(F.col("dist") <= slack).drop("room")
    here = here.select("source", "cur", "nodes", "rels", "dist", F.size("rels").alias("hops"))
    return top_k_per_group(here, ["source", "cur"], ["dist", "hops", "nodes", "rels"], k)


def top_k_per_group(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """Exact top-k per key: rank inside (key, salt) first, then over <= k*salt rows per key.

    As many salts as shuffle partitions, so a hot key is ranked by all tasks first."""
    salt_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    first = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (first.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
            .drop("_salt", "_r"))


# ---------------------------------------------------------------- one call with all options
def _least_to(targets: DataFrame, back: Edges, max_len: int | None) -> DataFrame:
    """``id, w, c, h``: the least weight, cost and hops from each node to the nearest target.

    One relaxation for all three: it runs against the relationships from the targets, with the
    measure in place of the source."""
    measures = targets.select("id").distinct().select(F.explode(F.array(*map(F.lit, "wch"))).alias("source"), "id")
    first = measures.select("source", "id", F.lit(0.0).alias("dist"), F.lit(0).alias("hops"))
    seen = History(first)
    changed, rounds = seen.done, 0
    price = F.when(F.col("source") == "w", F.col("w")).when(F.col("source") == "c", F.col("c")).otherwise(F.lit(1.0))
    while max_len is None or rounds < max_len:
        rounds += 1
        cand = (back.step(changed).withColumn("next", F.col("dist") + price)
                .groupBy("source", F.col("b").alias("id")).agg(F.min("next").alias("dist")))
        known = seen.rows().groupBy("source", "id").agg(F.min("dist").alias("known"))
        won = (cand.join(known, ["source", "id"], "left").where(F.col("known").isNull() | (F.col("dist") < F.col("known")))
               .select("source", "id", "dist", F.lit(rounds).alias("hops")))
        changed, n = seen.add(won)
        if n == 0:
            break
    least = lambda m: F.min(F.when(F.col("source") == m, F.col("dist"))).alias(f"to_{m}")
    return cut_lineage(seen.close().groupBy("id").agg(*[least(m) for m in "wch"]))


def best_paths(graph: Graph, label: str, prop: str, source_value, target_value, rel_types, weight: Column | None = None,
               cost: Column | None = None, max_cost: float | None = None, max_len: int | None = None, path_count: int = 1,
               direction: str = "out", hub: int | None = None, source_where: Column | None = None,
               target_where: Column | None = None) -> DataFrame:
    """One call with all path options: the ``path_count`` cheapest trails from each source node to
    each target node, of at most ``max_len`` relationships and a total ``cost`` of at most ``max_cost``.
    The ends are the nodes whose ``prop`` has the given value, or those that meet ``source_where``
    and ``target_where``.

    Exact in three steps.  (1) A search back from the targets gives each node's least weight,
    cost and hops to a target.  A partial trail whose own sums plus these pass a limit can never
    end well and is dropped; nothing else is.  (2) A first run keeps only the ``path_count``
    lightest partial trails of each node.  Its arrivals are real trails, so the weight of the
    last of ``path_count`` bounds the answer from above.  (3) The full run drops a partial trail
    also when its weight plus the least weight to a target passes that bound: a dominated trail
    is never finished.  Without ``max_len`` the runs end because a trail uses no relationship
    twice.  Ties: weight, then hops, then the node ids and relationship ids in order.

    Output ``source, target, rank, pathWeight, pathCost, hops, route`` (the ``prop`` of the nodes)."""
    weight, cost = F.lit(1.0) if weight is None else weight, F.lit(0.0) if cost is None else cost
    sources, targets = (cut_lineage((_id_match(graph, label, prop, v) if where is None else
                                     graph.nodes[label].where(where).select(graph.id_col(label).alias("id"))).distinct())
                        for v, where in ((source_value, source_where), (target_value, target_where)))
    back = {"out": "in", "in": "out", "both": "both"}[direction]
    e = _edges(graph, rel_types, label, direction, weight=weight, cost=cost)
    columns = ["source", "target", "rank", "pathWeight", "pathCost", "hops", "route"]
    if e is None:
        empty = sources.select(F.col("id").alias("source"), F.col("id").alias("target"), F.lit(1).alias("rank"), F.lit(0.0).alias("pathWeight"),
                               F.lit(0.0).alias("pathCost"), F.lit(0).alias("hops"), F.array("id").alias("route"))
        return empty.where(F.lit(False)).select(*columns)
    rel_kind = e.schema["rel_id"].dataType.simpleString()
    e = Edges(e, hub)
    least = _least_to(targets, Edges(_edges(graph, rel_types, label, back, weight=weight, cost=cost), hub), max_len)
    limits = F.lit(True)
    if max_cost is not None:
        limits &= F.col("cost") + F.col("to_c") <= F.lit(max_cost)
    if max_len is not None:
        limits &= F.col("hops") + F.col("to_h") <= F.lit(max_len)
    rank = ["dist", "hops", "nodes", "rels"]
    start = (sources.join(least, "id").select(
        F.col("id").alias("source"), F.col("id").alias("cur"), F.lit(0.0).alias("dist"), F.lit(0.0).alias("cost"), F.lit(0).alias("hops"),
        F.array("id").alias("nodes"), F.array().cast(f"array<{rel_kind}>").alias("rels"), "to_c", "to_h").where(limits))
    ends = targets.select(F.col("id").alias("cur"))

    def run(bound: DataFrame | None, keep: int | None) -> DataFrame:
        """Trails that arrive at a target."""
        frontier, arrived, n = cut_lineage(start.drop("to_c", "to_h")), [], 0
        while max_len is None or n < max_len:
            n += 1
            step = (e.step(frontier, "cur").where(~F.array_contains(F.col("rels"), F.col("rel_id")))
                    .select("source", F.col("b").alias("cur"), (F.col("dist") + F.col("w")).alias("dist"), (F.col("cost") + F.col("c")).alias("cost"),
                            (F.col("hops") + 1).alias("hops"), F.concat("nodes", F.array("b")).alias("nodes"), F.concat("rels", F.array("rel_id")).alias("rels")))
            step = step.join(least, F.col("cur") == least["id"]).drop("id").where(limits)
            if bound is not None:
                step = (step.join(bound, "source", "left")
                        .where(F.col("bound").isNull() | (F.col("dist") + F.col("to_w") <= F.col("bound") * (1 + 1e-12))).drop("bound"))
            step = step.drop("to_w", "to_c", "to_h")
            if keep is not None:
                step = top_k_per_group(step, ["source", "cur"], rank, keep).drop("rank")
            frontier = cut_lineage(step)
            arrived.append(frontier.join(ends, "cur", "left_semi"))
            if frontier.isEmpty():
                break
        return reduce(DataFrame.unionByName, arrived)

    first = run(None, path_count).groupBy("source", "cur").agg(F.sort_array(F.collect_list("dist")).alias("d"))
    # a pair has at most path_count arrivals a round here
    pairs = first.where(F.size("d") >= path_count).select("source", F.get("d", F.lit(path_count - 1)).alias("w"))
    n_targets = targets.count()
    bound = (pairs.groupBy("source").agg(F.count("*").alias("n"), F.max("w").alias("bound"))
             .where(F.col("n") == n_targets).select("source", "bound"))
    best = top_k_per_group(run(cut_lineage(bound), None), ["source", "cur"], rank, path_count)
    rows = best.select("source", F.col("cur").alias("target"), "rank", F.col("dist").alias("pathWeight"), F.col("cost").alias("pathCost"), "hops",
                       F.col("nodes").alias("route"))
    return _with_values(graph, label, prop, cut_lineage(rows), ["source", "target", "rank"]).select(*columns)
