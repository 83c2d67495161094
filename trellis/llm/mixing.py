"""Mixing sources to target weights over a domain / language / source tree.

Each level has weights.  The token budget of the root is dealt to the domains by weight, a
domain's budget to its languages, a language's to its sources.  A node can take at most its
capacity (tokens below it times ``max_epochs``).  What it cannot take goes to its siblings
by weight (water filling) and only if all of them are full to the siblings of its parent:
capacities are summed bottom-up first, so a parent never gets more than its children hold.

A leaf repeats its documents for as many whole epochs as its budget holds; the rest is the
token prefix of one more epoch, in an order seeded by (seed, epoch, doc_id).  The prefix ends
before the first document that would exceed it.  Its end is found in two steps, so that a
leaf with a third of all rows is never sorted in one task: tokens are summed per 4,096
ranges of the order, and only the range that holds the end is walked.

The result is one row per leaf: whole epochs and the key at which the last epoch ends.  A
document's number of copies follows from its own key and its leaf's row.

Defined results: null level values are a leaf value of their own (the empty string); a null
text has no tokens; a leaf without tokens is left out; rows with equal ids stand or fall
together; weights not named are 1, and a weight of 0 leaves the node out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trellis.llm.common import register, store, table, words

SEED = 17
MAX_EPOCHS = 3
DOMAIN_WEIGHTS = {"web": 3, "books": 4, "forum": 2, "news": 2}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 2}
BROADCAST_ROWS = 100_000


def domain_of(source: Column) -> Column:
    """Domain of a source: by the number its name ends with; without one, ``web``."""
    n = F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int")
    return (F.when(n % 4 == 1, "books").when(n % 4 == 2, "forum").when(n % 4 == 3, "news").otherwise("web"))


def _weight(level: str, weights: Mapping[str, float]) -> Column:
    out = F.lit(1.0)
    for value, w in weights.items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def water_fill(nodes: DataFrame, parent: Sequence[str], order: str) -> DataFrame:
    """Deal ``parent_budget`` to the nodes below one parent by ``weight``, none above its
    ``capacity``; adds ``budget``."""
    below = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    by_ratio = below.orderBy("ratio", order)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (nodes.withColumn("ratio", F.col("capacity") / F.col("weight"))
            .withColumn("level_here", (F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
                        / F.sum("weight").over(onward))
            .withColumn("full", F.col("ratio") <= F.col("level_here"))
            .withColumn("level", (F.col("parent_budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0.0)).over(below))
                        / F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(below))
            .withColumn("budget", F.when(F.col("full"), F.col("capacity"))
                        .otherwise(F.greatest(F.lit(0.0), F.least(F.col("capacity"), F.col("level") * F.col("weight")))))
            .drop("ratio", "level_here", "full", "level", "parent_budget"))


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]],
                 max_epochs: int, target_tokens: int | None = None) -> DataFrame:
    """Budget in tokens of each leaf; ``leaves`` has the levels and ``avail`` tokens."""
    leaves = leaves.filter("avail > 0").withColumn("capacity", (F.col("avail") * max_epochs).cast("double"))
    for level in levels:
        leaves = leaves.filter(_weight(level, weights.get(level, {})) > 0)
    parents = None
    for depth, level in enumerate(levels):
        up, here = list(levels[:depth]), list(levels[:depth + 1])
        nodes = (leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity"), F.sum("avail").alias("tokens"))
                 .withColumn("weight", _weight(level, weights.get(level, {}))))
        if parents is None:  # the root's budget
            root = Window.partitionBy(F.lit(0))
            want = F.sum("tokens").over(root) if target_tokens is None else F.lit(target_tokens)
            nodes = nodes.withColumn("parent_budget", F.least(want.cast("double"), F.sum("capacity").over(root)))
        else:
            nodes = nodes.join(parents, up)
        parents = water_fill(nodes, up, level).select(*here, F.col("budget").alias("parent_budget"))
    return (leaves.join(parents, list(levels))
            .select(*levels, "avail", F.floor(F.col("parent_budget") + 1e-6).cast("long").alias("budget"))
            .withColumn("full_epochs", F.least(F.floor(F.col("budget") / F.col("avail")), F.lit(max_epochs)).cast("long"))
            .withColumn("rest", F.when(F.col("full_epochs") == max_epochs, 0)
                        .otherwise(F.col("budget") - F.col("full_epochs") * F.col("avail")).cast("long")))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in a seeded epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def plan_mixture(docs: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], *,
                 max_epochs: int = MAX_EPOCHS, seed: int = SEED, target_tokens: int | None = None) -> DataFrame:
    """One row per leaf: its budget, whole epochs and the end of its last epoch.

    ``docs`` has doc_id, the level columns (not null) and n_tokens."""
    levels = list(levels)
    leaves = docs.groupBy(*levels).agg(F.sum("n_tokens").alias("avail"))
    budgets = store(leaf_budgets(leaves, levels, weights, max_epochs, target_tokens), "mix-leaves")
    keyed = (docs.join(budgets.filter("rest > 0").select(*levels, "full_epochs", "rest"), levels)
             .withColumn("key", order_key(seed, F.col("full_epochs"), F.col("doc_id")))
             .withColumn("range", F.substring("key", 1, 3)))
    upto = Window.partitionBy(*levels).orderBy("range")
    ranges = (keyed.groupBy(*levels, "rest", "range").agg(F.sum("n_tokens").alias("n"))
              .withColumn("upto", F.sum("n").over(upto)))
    cut = (ranges.filter("upto > rest").groupBy(*levels, "rest")
           .agg(F.min(F.struct("range", "upto", "n")).alias("c"))
           .select(*levels, "rest", F.col("c.range").alias("range"), (F.col("c.upto") - F.col("c.n")).alias("sofar")))
    in_range = (Window.partitionBy(*levels).orderBy("key")
                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = (keyed.drop("rest").join(cut, [*levels, "range"])
            .withColumn("used", F.col("sofar") + F.sum("n_tokens").over(in_range))
            .groupBy(*levels).agg(F.max(F.when(F.col("used") <= F.col("rest"), F.col("key"))).alias("last_key")))
    return store(budgets.join(cut.select(*levels, F.col("range").alias("cut_range")), levels, "left")
                 .join(last, levels, "left"), "mix-plan")


def copies_of(docs: DataFrame, plan: DataFrame, levels: Sequence[str], seed: int = SEED) -> DataFrame:
    """``docs`` with ``copies``, the number of epochs a document is in; those in none are gone.

    The plan has one row per leaf; it is broadcast only up to a counted bound."""
    small = plan.select(*levels, "full_epochs", "rest", "cut_range", "last_key")
    if plan.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    key = order_key(seed, F.col("full_epochs"), F.col("doc_id"))
    # without a range beyond the rest, the whole epoch fits
    taken = (F.col("rest") > 0) & (F.col("cut_range").isNull() | (key < F.col("cut_range"))
                                   | (key <= F.coalesce("last_key", F.lit(""))))
    return (docs.join(small, list(levels))
            .withColumn("copies", F.col("full_epochs") + taken.cast("long"))
            .filter("copies > 0").drop("full_epochs", "rest", "cut_range", "last_key"))


LEVELS = ("mix_domain", "mix_lang", "mix_source")


def with_levels(docs: DataFrame) -> DataFrame:
    """documents with the level columns of the tree."""
    return docs.withColumns({"mix_domain": domain_of(F.col("source")),
                             "mix_lang": F.coalesce("lang", F.lit("")),
                             "mix_source": F.coalesce("source", F.lit(""))})


def token_digest(docs: DataFrame) -> DataFrame:
    """doc_id, levels and number of words: the pass over the texts."""
    return with_levels(docs).select("doc_id", *LEVELS, F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


WEIGHTS = {"mix_domain": DOMAIN_WEIGHTS, "mix_lang": LANG_WEIGHTS}

def mix(docs: DataFrame) -> DataFrame:
    """The mixture: each document, with all its columns, once for each epoch it is in.

    Copies are found from the leaf's row of the plan, so texts are not shuffled."""
    digest = store(token_digest(docs), "mix-digest")
    plan = plan_mixture(digest, LEVELS, WEIGHTS)
    names = docs.columns
    rows = with_levels(docs.select("doc_id", "lang", "source", F.struct(*names).alias("mix_row")))
    return (copies_of(rows, plan, LEVELS)
            .select("mix_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("mix_epoch"))
            .select(*(F.col("mix_row")[c].alias(c) for c in names)))


OP1_SQL = """
WITH d AS (
  SELECT doc_id,
         CASE TRY_CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) % 4
              WHEN 1 THEN 'books' WHEN 2 THEN 'forum' WHEN 3 THEN 'news' ELSE 'web' END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS avail, (sum(n_tokens) * 3)::DOUBLE AS capacity
         FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
root AS (SELECT least(sum(avail)::DOUBLE, sum(capacity)) AS parent_budget FROM leaf),
d0 AS (SELECT domain, sum(capacity) AS capacity,
              CASE domain WHEN 'web' THEN 3.0::DOUBLE WHEN 'books' THEN 4.0 WHEN 'forum' THEN 2.0 WHEN 'news' THEN 2.0 ELSE 1.0 END AS weight
       FROM leaf GROUP BY domain),
d1 AS (SELECT *, capacity / weight AS ratio FROM d0, root),
d2 AS (SELECT *, ratio <= (parent_budget - coalesce(sum(capacity) OVER (ORDER BY ratio, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY ratio, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM d1),
d3 AS (SELECT *, (parent_budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ())
                 / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0) AS lvl FROM d2),
domains AS (SELECT domain, CASE WHEN is_full THEN capacity ELSE greatest(0, least(capacity, lvl * weight)) END AS parent_budget FROM d3),
l0 AS (SELECT domain, lang, sum(capacity) AS capacity,
              CASE lang WHEN 'en' THEN 6.0::DOUBLE WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'es' THEN 2.0 ELSE 1.0 END AS weight
       FROM leaf GROUP BY domain, lang),
l1 AS (SELECT *, capacity / weight AS ratio FROM l0 JOIN domains USING (domain)),
l2 AS (SELECT *, ratio <= (parent_budget - coalesce(sum(capacity) OVER (PARTITION BY domain ORDER BY ratio, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (PARTITION BY domain ORDER BY ratio, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM l1),
l3 AS (SELECT *, (parent_budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY domain))
                 / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain), 0) AS lvl FROM l2),
langs AS (SELECT domain, lang, CASE WHEN is_full THEN capacity ELSE greatest(0, least(capacity, lvl * weight)) END AS parent_budget FROM l3),
s1 AS (SELECT leaf.*, parent_budget, 1.0::DOUBLE AS weight, capacity / 1.0 AS ratio FROM leaf JOIN langs USING (domain, lang)),
s2 AS (SELECT *, ratio <= (parent_budget - coalesce(sum(capacity) OVER (PARTITION BY domain, lang ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (PARTITION BY domain, lang ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM s1),
s3 AS (SELECT *, (parent_budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY domain, lang))
                 / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain, lang), 0) AS lvl FROM s2),
budgets AS (SELECT domain, lang, source, avail,
                   floor(CASE WHEN is_full THEN capacity ELSE greatest(0, least(capacity, lvl * weight)) END + 1e-6)::BIGINT AS budget FROM s3),
b AS (SELECT *, least(budget // avail, 3) AS full_epochs,
             CASE WHEN budget // avail >= 3 THEN 0 ELSE budget % avail END AS rest FROM budgets),
k AS (SELECT d.*, full_epochs, rest, md5('17:' || full_epochs || ':' || coalesce(doc_id::VARCHAR, '')) AS key FROM d JOIN b USING (domain, lang, source)),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM k)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       (full_epochs + CASE WHEN rest > 0 AND used <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM r WHERE full_epochs + CASE WHEN rest > 0 AND used <= rest THEN 1 ELSE 0 END > 0
"""


@register("op1_mix_weights", OP1_SQL)
def op1_mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mixture and how many epochs each is in."""
    digest = store(token_digest(table(spark, sf_dir, "documents")), "mix-digest")
    plan = plan_mixture(digest, LEVELS, WEIGHTS)
    return copies_of(digest, plan, LEVELS).select(
        "doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"),
        F.col("mix_source").alias("source"), "n_tokens", "copies")
