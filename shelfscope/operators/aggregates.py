"""Aggregation operators that are steps of their own.

The sums, conditional counts, distinct counts and collections of A1-A9 and A11
are written where the reports use them (``plans/clean_room.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_drop_null_keys(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                       extra: Sequence[Column] = ()) -> DataFrame:
    """A10: pandas ``groupby().sum()`` semantics: groups with a NULL key are
    dropped; the sum of an all-NULL group is 0."""
    cond = None
    for k in keys:
        c = F.col("`" + k + "`").isNotNull()
        cond = c if cond is None else cond & c
    kept = df.where(cond) if cond is not None else df
    return kept.groupBy(*[F.col("`" + k + "`") for k in keys]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols], *extra)
