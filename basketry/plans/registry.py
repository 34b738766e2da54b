"""All registered queries: name to (query, SQL or None)."""

from __future__ import annotations

from basketry.plans import card_queries, index_queries, ingest_queries, model_queries, rule_queries, silver_queries, view_queries

QUERIES = {**index_queries.QUERIES, **silver_queries.QUERIES, **view_queries.QUERIES, **model_queries.QUERIES, **rule_queries.QUERIES, **ingest_queries.QUERIES, **card_queries.QUERIES}
