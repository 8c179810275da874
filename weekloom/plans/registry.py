"""Named queries and the SQL that says the same, built from shared WITH clauses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom import session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Query -> SQL, or what makes it, and the tables that it needs; these may be defined in modules that are read later.
SQL: dict[str, tuple[str | Callable[[], str], tuple[str, ...]]] = {}

#: Logical tables as DuckDB SQL: name -> (tables it needs, body).
WITH: dict[str, tuple[tuple[str, ...], str]] = {}
#: Those that DuckDB computes once even where they are read more than once.
COSTLY = {"weekly_keywords", "freq", "z", "occ", "cent_flat", "features", "members_of", "week_groups", "group_links", "link_walk"}


def define(name: str, body: str, *needs: str) -> None:
    WITH[name] = (needs, body)


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(WITH[name][0], seen)
            seen.append(name)
    return seen


def with_tables(select: str, *needs: str) -> str:
    if not needs:
        return select
    names = _ordered(needs, [])
    kind = "WITH RECURSIVE " if any("RECURSIVE" in WITH[n][1] for n in names) else "WITH "
    how = lambda n: " MATERIALIZED" if n in COSTLY else ""
    return kind + ",\n".join(f"{n} AS{how(n)} ({WITH[n][1].replace('/*RECURSIVE*/', '')})" for n in names) + "\n" + select


def query(name: str, sql: str | Callable[[], str] | None = None, *needs: str) -> Callable[[Query], Query]:
    """Registers a query under its inventory name."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, folder: f(session.prepare(spark), folder)
        if sql:
            SQL[name] = sql, needs
        return f

    return add
