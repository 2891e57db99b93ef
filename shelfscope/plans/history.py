"""R14, history of dimension snapshots: which version of an item or store was valid on a day.

A feed hands out the whole dimension again and again.  ``snapshot_history`` turns the successive snapshots into validity
intervals: a version holds from the first snapshot that shows it until the next snapshot that shows another one or
none.  ``join_valid`` joins facts with the version valid on their day: versions are carried forward into every month
they touch, so it is an equi-join on key and month, with a few versions each, instead of a range join; a key that
holds much of the facts is spread over its months, and over more tasks by AQE's skew join.  It is a merge join: the planner sees
the size of the versions before they are carried forward, and would send many times that through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot_history(snapshots: DataFrame, keys: Sequence[str], date: str, attributes: Sequence[str]) -> DataFrame:
    """Rows (keys, date, attributes), one set of rows for each snapshot date -> (keys, attributes, valid_from, valid_to).

    ``valid_to`` is the first day on which the version no longer holds, null for the one of the last snapshot.  A key that a snapshot
    lacks has no version from that snapshot on until it comes back, as a version of its own even if nothing changed.  Null
    attributes and keys compare as equal.  Of rows that repeat a key within a snapshot the greatest one counts."""
    version = F.struct(*attributes)
    one = snapshots.groupBy(*keys, date).agg(F.max(version).alias("__v"))
    # one row a snapshot, numbered; small beside the keys, which are never broadcast
    dates = snapshots.select(F.col(date).alias("__d")).distinct()
    order = Window.orderBy("__d")
    dates = dates.select("__d", F.row_number().over(order).alias("__n"), F.lead("__d").over(order).alias("__next"))
    # a number given: AQE merges no tasks, since rows that compress well look like few
    n = int(snapshots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    j = one.join(F.broadcast(dates), F.col(date) == F.col("__d")).repartition(n, *keys)
    by = Window.partitionBy(*keys).orderBy("__n")
    same = (F.lag("__n").over(by) == F.col("__n") - 1) & F.lag("__v").over(by).eqNullSafe(F.col("__v"))
    j = j.withColumn("__new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    j = j.withColumn("__run", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = j.groupBy(*keys, "__run").agg(F.first("__v").alias("__v"), F.min(date).alias("valid_from"), F.max_by("__next", "__n").alias("valid_to"))
    return out.select(*keys, "__v.*", "valid_from", "valid_to")


def join_valid(facts: DataFrame, history: DataFrame, keys: Sequence[str], day: str, how: str = "left") -> DataFrame:
    """``facts`` with the attributes of the version valid on ``day``.  ``how`` left: facts without a valid version keep null
    attributes; inner: they go.  Null keys match null keys; a null day matches nothing."""
    attributes = [c for c in history.columns if c not in (*keys, "valid_from", "valid_to")]
    bounds = facts.agg(F.max(day).alias("__last"))  # an open version is carried up to the facts' last month
    month = lambda c: F.trunc(c, "month")
    h = history.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *attributes, F.col("valid_from").cast("date").alias("__from"),
                       F.col("valid_to").cast("date").alias("__to"))
    end = F.coalesce(F.date_sub("__to", 1), F.greatest(bounds.select(F.col("__last").cast("date")).scalar(), F.col("__from")))
    h = h.withColumn("__month", F.explode(F.sequence(month(F.col("__from")), month(end), F.expr("interval 1 month"))))
    f = facts.withColumn("__at", F.col(day).cast("date"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    on += [month(F.col("__at")) == F.col("__month"), F.col("__at") >= F.col("__from"), F.col("__to").isNull() | (F.col("__at") < F.col("__to"))]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return f.join(h.hint("merge"), cond, how).select(*[f[c] for c in facts.columns], *attributes)
