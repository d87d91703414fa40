"""All queries of the library outside ``llm`` by name, with the SQL that says the same where there is one."""

from __future__ import annotations

from . import corpus_queries, event_queries, evidence_queries, inference_queries, interval_queries, ledger_queries, quality_queries, series_queries, streaming_queries

_MODULES = (series_queries, interval_queries, corpus_queries, event_queries, inference_queries, evidence_queries, ledger_queries, streaming_queries, quality_queries)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
