"""Helpers to write generated column lists as SQL expression text.

A ``Column`` built from many small Python calls costs dozens of py4j round
trips per column while the plan is being built; one ``F.expr`` string costs a
few.  Generated lists (measure sums, zero fills, rule CASE chains) therefore
use SQL text.  The result on the executors is the same expression tree.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def qn(name: str) -> str:
    """Back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def e(text: str) -> Column:
    return F.expr(text)


def sums(measures: Iterable[str], suffix: str = "", cast: dict[str, str] | None = None) -> list[Column]:
    """``sum(m) AS m<suffix>`` for every measure (optionally cast)."""
    out = []
    for m in measures:
        s = f"sum({qn(m)})"
        if cast and m in cast:
            s = f"CAST({s} AS {cast[m]})"
        out.append(F.expr(f"{s} AS {qn(m + suffix)}"))
    return out


def scaled(measures: Iterable[str], factor: str) -> list[Column]:
    """``m * factor AS m``."""
    return [F.expr(f"{qn(m)} * {qn(factor)} AS {qn(m)}") for m in measures]
