"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zero_fill(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """U1 helper: add each missing measure as a typed 0 (``measures`` maps
    name -> SQL type) so two fact shapes can be stacked."""
    missing = [F.expr(f"CAST(0 AS {t}) AS `{m}`") for m, t in measures.items() if m not in df.columns]
    return df.select("*", *missing) if missing else df


def union_facts(left: DataFrame, right: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """UNION ALL of two fact tables, each zero-filled to the other's
    measures (replaces a full outer join)."""
    l2, r2 = zero_fill(left, measures), zero_fill(right, measures)
    return l2.unionByName(r2)


def append_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """U3 (and F12 with ``allow_missing``): stack by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def distinct_keys(tables: Sequence[DataFrame], key: str, country: str | None = None,
                  country_col: str = "country_code") -> DataFrame:
    """Union of one key column over several tables, then DISTINCT.
    The country filter and the projection reach each parquet scan."""
    parts = []
    for t in tables:
        if country is not None:
            t = t.where(F.col(country_col) == country)
        parts.append(t.select(key))
    return append_all(parts).distinct()


def sorted_dates(df: DataFrame, col: str) -> DataFrame:
    """Ascending list of distinct values (the ORDER BY is the feature)."""
    return df.select(col).distinct().orderBy(col)
