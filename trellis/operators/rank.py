"""PageRank and degree ranking.

PageRank is a fixed-round (or tolerance) loop; each round is
``ranks ⋈ edges → groupBy(dst).sum`` (partial aggregation, so a node with a
third of all in-links is summed map-side before the shuffle).  The mass of
nodes without out-links is handed back evenly, so scores sum to 1.  The
dangling mass and the L1 change are single numbers read per round; ranks are kept
per round and checkpointed to the shared folder every few rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.model import Graph
from trellis.operators.match import top_k
from trellis.operators.paths import Edges
from trellis.session import RoundState, cut_lineage


def page_rank(graph: Graph, label: str, rel_type: str, damping: float = 0.85, max_rounds: int = 20,
              tol: float | None = None, hub: int | None = None) -> DataFrame:
    """``CALL algo.pageRank(label, rel_type) YIELD node, score`` → ``id, score``.

    Only nodes of ``label`` and relationships of ``rel_type`` with both ends
    among them; parallel relationships count once [choice]."""
    nodes = graph.nodes[label].select(graph.id_col(label).alias("id")).distinct()
    nodes = cut_lineage(nodes)
    n = nodes.count()
    if n == 0:
        return nodes.withColumn("score", F.lit(0.0))
    edges = None
    for (t, s, d), df in graph.rel_tables(rel_type, label, label):
        part = df.select("src", "dst")
        edges = part if edges is None else edges.unionAll(part)
    if edges is None:                                    # no relationships: even scores
        return nodes.withColumn("score", F.lit(1.0 / n))
    ids = nodes.select(F.col("id").alias("k"))
    edges = (edges.join(ids, F.col("src") == F.col("k"), "left_semi")
             .join(ids, F.col("dst") == F.col("k"), "left_semi").distinct())
    outdeg = edges.groupBy("src").agg(F.count("*").alias("deg"))
    # written once, the relationships of a hub dealt to salts
    edges_w = Edges(edges.join(outdeg, "src").select(F.col("src").alias("a"), "dst", (1.0 / F.col("deg")).alias("inv")), hub)
    # nodes without out-links carry a flag, so their mass is one sum over the ranks (no join)
    flagged = cut_lineage(
        nodes.join(outdeg.select(F.col("src").alias("id"), F.lit(False).alias("dangling")), "id", "left")
        .select("id", F.coalesce("dangling", F.lit(True)).alias("dangling")))
    ranks = flagged.withColumn("score", F.lit(1.0 / n))
    base = (1.0 - damping) / n
    keeper = RoundState(every=5)
    dangling_mass = F.sum(F.when(F.col("dangling"), F.col("score")).otherwise(F.lit(0.0)))
    dangling = ranks.agg(dangling_mass).first()[0] or 0.0
    for _ in range(max_rounds):
        contrib = (edges_w.step(ranks)
                   .groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("score") * F.col("inv")).alias("c")))
        # the node list comes from the written frame: each round reads the previous ranks once,
        # so the plan grows by one round, not twofold
        new = (flagged.join(contrib, "id", "left")
               .select("id", "dangling", (F.lit(base) + F.lit(damping) * (F.coalesce(F.col("c"), F.lit(0.0))
                                                                           + F.lit(dangling / n))).alias("score")))
        new = keeper.keep(new)
        # one job per round: it fills the kept ranks and reads the mass to hand back
        dangling = new.agg(dangling_mass).first()[0] or 0.0
        if tol is not None:
            delta = (new.alias("a").join(ranks.alias("b"), "id")
                     .agg(F.sum(F.abs(F.col("a.score") - F.col("b.score")))).first()[0])
            ranks = new
            if delta < tol:
                break
        else:
            ranks = new
    ranks = ranks.select("id", "score")
    return cut_lineage(ranks)


def page_rank_top(graph: Graph, label: str, rel_type: str, prop: str, k: int, **kw) -> DataFrame:
    """P10 ``page_rank(graph, label, rel_type, prop, k)``: ``node, score`` top k."""
    ranks = page_rank(graph, label, rel_type, **kw)
    props = graph.nodes[label].select(graph.id_col(label).alias("id"), F.col(prop).alias("node"))
    # the scores as they are decide; they are rounded for output only
    best = top_k(ranks.join(props, "id").select("node", "score"), k, ("score", "desc"), ("node", "asc"))
    return best.select("node", F.round("score", 9).alias("score"))


def degree(graph: Graph, label: str, rel_type: str | None = None, direction: str = "out") -> DataFrame:
    """A3: relationship count per node (``out``, ``in`` or ``both``); nodes without any get 0."""
    parts = []
    for (t, s, d), df in graph.rel_tables(rel_type):
        if direction in ("out", "both") and s == label:
            parts.append(df.select(F.col("src").alias("id")))
        if direction in ("in", "both") and d == label:
            parts.append(df.select(F.col("dst").alias("id")))
    if not parts:
        return graph.nodes[label].select(graph.id_col(label).alias("id"), F.lit(0).cast("long").alias("degree"))
    ends = parts[0]
    for p in parts[1:]:
        ends = ends.unionAll(p)
    counts = ends.groupBy("id").agg(F.count("*").alias("degree"))
    nodes = graph.nodes[label].select(graph.id_col(label).alias("id"))
    return nodes.join(counts, "id", "left").select("id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))
