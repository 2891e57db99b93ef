"""Registered queries: name -> (Spark callable, DuckDB oracle text or None).

Every callable takes ``(spark, sf_dir)``, reads the driver's tables (or views
Spark derives from them) and returns a lazy DataFrame.  ``oracle`` is the
equivalent DuckDB SQL over the same tables; ``None`` marks operators whose
check is a rows-only check plus pytest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    oracle: str | None
    ids: tuple[str, ...]  # SURVEY section 2 ids covered


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None, *ids: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, oracle, ids)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills REGISTRY
    from .queries import register_all  # noqa: F401
    return REGISTRY
