"""Window operators and reporting-window assignment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_COLS = ("time_window_start", "time_window_end")


def _date(d: str | dt.date) -> Column:
    return F.lit(str(d)).cast("date")


def assign_window(df: DataFrame, ts: str, start: str | dt.date, end: str | dt.date,
                  days: int | None = None) -> DataFrame:
    """Keep events with ``start <= ts < end`` and tag each with its reporting
    window.  ``days=None``: one window [start, end).  Otherwise consecutive
    windows of ``days`` days from ``start``, the last clipped at ``end``
    (so one job computes what the reference runs as one request per window)."""
    s, e = f"DATE'{start}'", f"DATE'{end}'"
    t = f"`{ts}`"
    kept = df.where(F.expr(f"{t} >= CAST({s} AS TIMESTAMP_NTZ) AND {t} < CAST({e} AS TIMESTAMP_NTZ)"))
    if days is None:
        ws, we = s, e
    else:
        ws = f"date_add({s}, CAST(floor(datediff(CAST({t} AS DATE), {s}) / {int(days)}) * {int(days)} AS INT))"
        we = f"least(date_add({ws}, {int(days)}), {e})"
    return kept.select("*", F.expr(f"{ws} AS {WINDOW_COLS[0]}"), F.expr(f"{we} AS {WINDOW_COLS[1]}"))


def rank_first_touch(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (),
                     name: str = "rn") -> DataFrame:
    """ROW_NUMBER per key by first time; ``tiebreak`` makes it repeatable."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    return df.withColumn(name, F.row_number().over(w))
