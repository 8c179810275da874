"""All queries of the reference's own operators, by inventory name."""

from __future__ import annotations

from weekloom.plans import more_queries, reader_queries, registry, retrieval_queries, scalar_queries, vector_queries, view_queries, weekly_queries  # noqa: F401


def queries() -> dict[str, registry.Query]:
    return registry.QUERIES


def oracle_sql() -> dict[str, str]:
    return {name: registry.with_tables(sql() if callable(sql) else sql, *needs) for name, (sql, needs) in registry.SQL.items()}
