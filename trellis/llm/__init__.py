"""Operators for training-data pipelines: mixing, token counts, personal data, sharding,
licence scans, near duplicates, quality, decontamination, language-model scoring, conversation repair and
spelling variants.

Nothing else in the library imports this subpackage.  ``queries.load()`` gives the
registered queries and their DuckDB SQL.
"""
