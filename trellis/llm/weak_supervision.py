"""Label model of weak supervision, in DataFrame operations.

Voters say 1 (yes), -1 (no) or 0 (abstain).  Expectation-maximisation finds how reliable
each voter is and how probable each row is a yes.  Rows with equal votes are equal to the
model, so it works on the table of vote patterns with their row counts (at most 3^voters
rows however many rows there are); each round is one aggregate of that table.

The model is the usual conditionally independent one.  A voter's reliability is how often it
says yes and how often no on rows of each class; the log-odds of yes are the log-odds of the
class share plus, for each vote, the log of the ratio of these rates.  A yes never counts
against and a no never counts in favour, so that the two classes cannot swap; an abstention
counts nothing.  Rates are smoothed by one row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import store


@dataclass(frozen=True)
class LabelModel:
    """Log-odds of the class share, and of each voter's yes and no."""

    prior: float
    weights: Mapping[str, tuple[float, float]]

    def log_odds(self, vote: Mapping[str, Column] | None = None) -> Column:
        out = F.lit(self.prior)
        for name, (yes, no) in self.weights.items():
            v = vote[name] if vote else F.col(name)
            out = out + F.when(v > 0, yes).when(v < 0, no).otherwise(0.0)
        return out

    def probability(self, vote: Mapping[str, Column] | None = None) -> Column:
        """Posterior probability of yes."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(vote)))


def fit_label_model(votes: DataFrame, voters: Sequence[str], *, share: float = 0.8,
                    yes_rates: tuple[float, float] = (0.7, 0.3), no_rates: tuple[float, float] = (0.02, 0.4),
                    rounds: int = 15, tolerance: float = 1e-3) -> LabelModel:
    """Fit to all rows of ``votes`` (columns ``voters``, whole numbers -1, 0, 1; optional row
    weight ``n``).  ``yes_rates`` and ``no_rates`` are the start rates on rows of the class
    yes and no.  An empty table returns the start values."""
    n = F.sum("n") if "n" in votes.columns else F.count("*")
    patterns = store(votes.groupBy(*voters).agg(n.cast("double").alias("n")), "vote-patterns")
    ratio = lambda a, b: round(math.log(a / b), 6)
    model = LabelModel(ratio(share, 1 - share), dict.fromkeys(voters, (ratio(*yes_rates), ratio(*no_rates))))
    for _ in range(rounds):
        rated = patterns.withColumn("yes", F.col("n") * model.probability()).withColumn("no", F.col("n") - F.col("yes"))
        sums = [F.sum(c).alias(c) for c in ("yes", "no")]
        sums += [F.sum(F.when(F.col(v) * side > 0, F.col(c)).otherwise(0.0)).alias(f"{v}|{side}|{c}")
                 for v in voters for side in (1, -1) for c in ("yes", "no")]
        got = rated.agg(*sums).first().asDict()  # one row of sums
        if got["yes"] is None:
            break

        def weight(v: str, side: int) -> float:
            w = ratio((got[f"{v}|{side}|yes"] + 1) / (got["yes"] + 2), (got[f"{v}|{side}|no"] + 1) / (got["no"] + 2))
            return max(0.0, w * side) * side

        after = LabelModel(ratio(got["yes"] + 1, got["no"] + 1), {v: (weight(v, 1), weight(v, -1)) for v in voters})
        moved = max(abs(x - y) for v in voters for x, y in zip(after.weights[v], model.weights[v]))
        model = after
        if moved < tolerance:
            break
    return model
