"""Load planning over calendar tables.

The reference builds Python date lists and loops one request at a time.
Here a "request" is a row (a key with its dates) and every planner is a
column expression or a ``DataFrame -> DataFrame`` step, so one job plans all
keys, countries and reports at once.  Exploding a range is done per row with
``sequence`` (no driver loop, no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY, WEEK = "DAY", "WEEK"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def daily_windows(df: DataFrame, start: str | Column, end: str | Column,
                  out: tuple[str, str] = ("window_start", "window_end")) -> DataFrame:
    """Half-open day windows ``[d, d+1)`` for ``start <= d < end``;
    nothing when ``start >= end``."""
    s, e = _c(start), _c(end)
    d = F.explode(F.sequence(s, F.date_sub(e, 1)))
    return (df.where(s < e).select("*", d.alias(out[0]))
              .withColumn(out[1], F.date_add(F.col(out[0]), 1)))


def interval_windows(df: DataFrame, start: str | Column, end: str | Column, n: int = 10,
                     out: tuple[str, str] = ("interval_start", "interval_end")) -> DataFrame:
    """Closed windows of ``n`` days from ``start``; the last one is
    clipped at ``end``; nothing when ``start > end``."""
    s, e = _c(start), _c(end)
    starts = F.sequence(s, e, F.expr(f"INTERVAL {int(n)} DAY"))
    return (df.where(s <= e).select("*", F.explode(starts).alias(out[0]))
              .withColumn(out[1], F.least(F.date_add(F.col(out[0]), n - 1), e)))


def lookback_dates(df: DataFrame, last: str | Column, n: int | Column, period: str = DAY,
                   out: str = "wanted_date") -> DataFrame:
    """``last - i*step`` for ``i in 0..n-1`` (DAY step 1, WEEK step 7)."""
    step = 1 if period == DAY else 7
    nn = _c(n) if isinstance(n, (str, Column)) else F.lit(n)
    i = F.explode(F.sequence(F.lit(0), nn - 1))
    return (df.where(nn > 0).select("*", i.alias("__i"))
              .withColumn(out, F.date_sub(_c(last), F.col("__i") * step)).drop("__i"))


def backfill_count(last: str | Column, start: str | Column, period: str = DAY) -> Column:
    """Number of look-back steps for a back-fill: whole days (DAY) or
    whole weeks (WEEK) between ``start`` and ``last``.  The start date itself
    is therefore not produced (kept as in the reference)."""
    days = F.datediff(_c(last), _c(start))
    return days if period == DAY else F.floor(days / 7).cast("int")


def missing_dates(wanted: DataFrame, landed: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """P5 (J7): wanted minus landed, by key and date, in ascending order."""
    return wanted.join(landed, [*keys, date], "left_anti").orderBy(*keys, date)


def period_window(date: str | Column, period: str = DAY) -> tuple[Column, Column]:
    """The request window of a period end date: DAY [d, d], WEEK [d-6, d]."""
    d = _c(date)
    return (d if period == DAY else F.date_sub(d, 6)), d


def last_saturday(date: str | Column) -> Column:
    """The last Saturday on or before a day."""
    return F.next_day(F.date_sub(_c(date), 7), "Sat")


def lookback_start(end: str | Column, n: int, period: str = DAY) -> Column:
    """First day of a look-back of ``n`` periods ending at ``end``."""
    return F.date_sub(_c(end), n - 1 if period == DAY else 7 * n - 1)


# Days back from today where the service may have data (DAY
# reports), by report; WEEK reports end on the last Saturday.
AVAILABILITY_LAG_DAYS = {"default": 2, "sp_inventory": 4, "sp_search_terms": 3}


def availability_anchor(today: str | Column, report: str = "default", period: str = DAY) -> Column:
    """The latest period end worth asking for: today minus the report's lag
    (DAY) or the last Saturday on or before today (WEEK); used as the anchor
    of ``latest_available``."""
    t = _c(today) if isinstance(today, Column) else F.lit(today).cast("date")
    if period == WEEK:
        return last_saturday(t)
    return F.date_sub(t, AVAILABILITY_LAG_DAYS.get(report, AVAILABILITY_LAG_DAYS["default"]))


def latest_available(avail: DataFrame, keys: Sequence[str], period: str, n_rows: str,
                     anchor: str | Column, out: str = "latest_available") -> DataFrame:
    """Greatest period <= anchor that has data, per key (replaces the
    reference's walk-back probing of the service)."""
    a = _c(anchor) if isinstance(anchor, Column) else F.lit(anchor).cast("date")
    ok = (F.col(n_rows) > 0) & (F.col(period) <= a)
    return avail.groupBy(*keys).agg(F.max(F.when(ok, F.col(period))).alias(out))


def daily_dates(df: DataFrame, start: str | Column, end: str | Column, out: str = "day") -> DataFrame:
    """P10: every day of an inclusive range; a start after the end fails the
    job (the reference rejects it)."""
    s, e = _c(start), _c(end)
    guarded = F.when(s > e, F.raise_error(F.lit("start date is later than end date"))).otherwise(s)
    return df.select("*", F.explode(F.sequence(guarded, e)).alias(out))


def snapshot_is_new(snap: DataFrame, keys: Sequence[str], date: str, landed: DataFrame,
                    landed_date: str, out: str = "snapshot_date") -> DataFrame:
    """Latest snapshot date per key, kept only when that key has not
    landed that date yet (``landed`` holds the same key columns; NULL keys are
    compared like values)."""
    latest = snap.groupBy(*keys).agg(F.max(date).alias(out))
    have = landed.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(landed_date).alias("__date"))
    same = F.col(out).eqNullSafe(F.col("__date"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return latest.join(have, same, "left_anti")


def global_rank(df: DataFrame, key: str, out: str = "key_rank") -> DataFrame:
    """Exact 1-based rank of distinct keys in ascending order, distributed.

    Keys are range-partitioned (balanced by sampling), the partition id is
    frozen by a reliable checkpoint in the cluster's checkpoint folder, each
    partition numbers its own keys, and a prefix sum over the per-partition
    counts (one row per partition, so its broadcast is bounded by the
    partition count) shifts them.  No single-partition window over the keys."""
    keys = df.select(key).distinct().where(F.col(key).isNotNull())
    ranged = keys.repartitionByRange(key).withColumn("__pid", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    local = ranged.withColumn("__rn", F.row_number().over(Window.partitionBy("__pid").orderBy(key)))
    return (local.join(F.broadcast(offsets), "__pid")
                 .select(key, (F.col("__off") + F.col("__rn")).cast("bigint").alias(out)))


def key_batches(df: DataFrame, key: str, size: int = 20, sep: str = ",") -> DataFrame:
    """Distinct keys in ascending order cut into batches of ``size``,
    each batch as one separator-joined string (one service call each)."""
    r = global_rank(df, key, "__rank")
    b = r.withColumn("batch_id", F.floor((F.col("__rank") - 1) / size).cast("bigint"))
    return b.groupBy("batch_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.col(key))), lambda x: x.cast("string")),
                     sep).alias("batch_keys"),
        F.count(F.lit(1)).alias("batch_size"))


def alias_country(c: str | Column, to: str = "GB") -> Column:
    """UK and GB name the same market; map one onto the other."""
    col = _c(c)
    frm = "UK" if to == "GB" else "GB"
    return F.when(col == frm, F.lit(to)).otherwise(col)
