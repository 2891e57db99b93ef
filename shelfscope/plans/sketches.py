"""Reach from stored sketches (A4, A5).

Distinct users do not add up over days, so an exact count of any new span reads the events again.  A theta sketch of the
users of one day and group is written once; sketches unite, so the reach of any span, and of users that two groups
share, comes from them alone: a few kilobytes a day and group instead of the events.  Up to 2^``lg`` users of a span
the result is exact; beyond, its relative standard error is ``1 / sqrt(2^lg)``.  The reports of ``clean_room`` count
exactly and stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import q
from ..operators.windows import WINDOW_COLS, assign_window

LG = 14  # 16,384 users exactly, 0.8 % beyond; 128 kB a sketch at most
MEASURES = ("impressions", "clicks", "spend")


def daily_reach(traffic: DataFrame, dims: Sequence[str], ts: str = "event_dt", user: str = "user_id", lg: int = LG,
                measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row a day and group: ``users`` (the sketch) and the sums of ``measures``.  Sketches are combined map-side, so a
    hot group is one small buffer a task.  Events without a user count in the measures only; NULL is a group; a group
    without any user has an empty sketch; no events: no rows."""
    return traffic.groupBy(q(ts).cast("date").alias("day"), *[q(c) for c in dims]).agg(
        F.theta_sketch_agg(q(user), lg).alias("users"), *[F.sum(q(m)).alias(m) for m in measures])


def write_daily(sketches: DataFrame, path: str) -> str:
    """The table of ``daily_reach``, one folder a day; a load replaces the days that it carries."""
    (sketches.hint("rebalance", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(path))
    return path


def reach_of_spans(sketches: DataFrame, dims: Sequence[str], start, end, window_days: int | None = None, lg: int = LG,
                   measures: Sequence[str] = MEASURES) -> DataFrame:
    """Reach and measures by reporting window (as ``windows.assign_window`` cuts [start, end)) and any of the stored dims."""
    spans = assign_window(sketches.withColumn("day", F.col("day").cast("timestamp_ntz")), "day", start, end, window_days)
    return spans.groupBy(*WINDOW_COLS, *[q(c) for c in dims]).agg(
        F.theta_sketch_estimate(F.theta_union_agg("users", lg)).alias("reach"), *[F.sum(q(m)).alias(m) for m in measures])


def shared_reach(sketches: DataFrame, group: str, values: Sequence[object], dims: Sequence[str], start, end,
                 window_days: int | None = None, lg: int = LG) -> DataFrame:
    """Users that every one of ``values`` of the column ``group`` reached, by window and ``dims``: the intersection of the
    groups' united sketches.  The error is ``1 / sqrt(2^lg)`` of the users of all of them, not of the shared ones; a window in
    which one of the values has no row has none."""
    spans = assign_window(sketches.withColumn("day", F.col("day").cast("timestamp_ntz")).where(q(group).isin(list(values))),
                          "day", start, end, window_days)
    by = [*WINDOW_COLS, *dims]
    united = spans.groupBy(*[q(c) for c in by], q(group)).agg(F.theta_union_agg("users", lg).alias("users"))
    return united.groupBy(*[q(c) for c in by]).agg(
        F.when(F.count("*") == len(set(values)), F.theta_sketch_estimate(F.theta_intersection_agg("users"))).otherwise(0).alias("reach"))
