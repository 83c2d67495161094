"""Registered queries of this subpackage."""

from __future__ import annotations

from trellis.llm import conversation_repair, decontaminate, jaccard_join, license_scan, minhash_dedup, mixing, ngram_lm, pii, quality_model, quality_rules, sharding, spelling, token_counts  # noqa: F401
from trellis.llm.common import ORACLE, QUERIES


def load():
    """(queries, DuckDB SQL)."""
    return QUERIES, ORACLE
