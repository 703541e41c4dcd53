"""Registry of named queries: a Spark plan over ``Tables`` plus its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class Entry:
    name: str
    build: Callable  # Tables -> DataFrame
    sql: str | None  # DuckDB SQL over the raw tables, None when not SQL-expressible


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[..., DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco
