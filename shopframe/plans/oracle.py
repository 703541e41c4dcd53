"""Builds DuckDB oracle SQL: the surrogate views as CTEs, then the query body."""

from __future__ import annotations

from collections.abc import Sequence

from shopframe.plans import retail, star

VIEW_SQL = {**retail.SQL, **star.SQL}
VIEW_DEPS = {**retail.DEPS, **star.DEPS}


def with_views(views: Sequence[str], body: str, ctes: Sequence[tuple[str, str]] = ()) -> str:
    """``WITH <views in dependency order>, <extra ctes> <body>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in VIEW_DEPS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)

    for v in views:
        visit(v)
    parts = [f"{n} AS ({VIEW_SQL[n]}\n)" for n in order] + [f"{n} AS ({s}\n)" for n, s in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
