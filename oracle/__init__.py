"""Independent ANSI SQL for every registered query, run by DuckDB on the same tables."""

from __future__ import annotations

import re

from oracle import analytics, loading, star


def _with(query: str, tables: dict[str, str]) -> str:
    """Put the WITH entries a query needs in front of it, in definition order."""
    needed: set[str] = set()
    pending = [query]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & tables.keys() - needed:
            needed.add(name)
            pending.append(tables[name])
    parts = [f"{name} AS ({sql})" for name, sql in tables.items() if name in needed]
    return f"WITH {', '.join(parts)} {query}" if parts else query


def all_queries() -> dict[str, str]:
    tables = {**star.TABLES, **loading.TABLES}
    queries = {**analytics.QUERIES, **loading.QUERIES}
    views = {n: sql for n, sql in queries.items() if n.startswith("vw_")}
    queries |= {f"cat_{n}": sql for n, sql in views.items()}
    queries |= {f"inc_{n}": sql for n, sql in views.items() if "compras" not in n}
    return {name: _with(sql, tables) for name, sql in queries.items()}
