"""Reach from stored sketches against exact counts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from shelfscope.plans import sketches as sk

START, END = "2024-01-01", "2024-01-15"


def _traffic(spark, users, rows):
    return spark.range(rows).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id % 336 AS INT)) AS event_dt",
        f"CASE WHEN id % 50 <> 0 THEN xxhash64(id) % {users} END AS user_id",
        "CASE WHEN id % 3 < 2 THEN 'hot' WHEN id % 9 = 2 THEN NULL ELSE concat('c', id % 4) END AS kind",
        "1L AS impressions", "id % 2 AS clicks", "id AS spend")


def _exact(t, days):
    w = t.withColumn("n", F.floor(F.datediff(F.col("event_dt").cast("date"), F.lit(START).cast("date")) / days))
    return {(r.n, r.kind): r for r in w.groupBy("n", "kind").agg(F.count_distinct("user_id").alias("reach"), F.sum("spend").alias("spend")).collect()}


def test_small_spans_are_exact(spark, tmp_dir):
    t = _traffic(spark, 3000, 40_000)
    path = sk.write_daily(sk.daily_reach(t, ["kind"]), os.path.join(tmp_dir, "s"))
    sk.write_daily(sk.daily_reach(t.where("event_dt >= '2024-01-10'"), ["kind"]), path)  # a load replaces its days
    daily = spark.read.parquet(path)
    for days in (7, 14, 5):
        want = _exact(t, days)
        got = sk.reach_of_spans(daily, ["kind"], START, END, days).collect()
        assert len(got) == len(want)
        for r in got:
            n = (r.time_window_start - dt.date(2024, 1, 1)).days // days
            assert (r.reach, r.spend) == (want[n, r.kind].reach, want[n, r.kind].spend)
    # coarser dims from the same table
    assert sk.reach_of_spans(daily, [], START, END).first().reach == t.select("user_id").na.drop().distinct().count()


def test_error_of_large_spans(spark):
    t, lg = _traffic(spark, 1 << 40, 300_000), 10
    daily = sk.daily_reach(t, ["kind"], lg=lg)
    want = _exact(t, 14)
    for r in sk.reach_of_spans(daily, ["kind"], START, END, lg=lg).collect():
        exact = want[0, r.kind].reach
        assert exact > 10_000 and 0 < abs(r.reach - exact) < 5 * exact / 2 ** (lg / 2)


def test_shared_users(spark):
    t = _traffic(spark, 3000, 40_000)
    users = [{r.user_id for r in t.where(F.col("kind") == k).select("user_id").na.drop().collect()} for k in ("hot", "c1")]
    daily = sk.daily_reach(t, ["kind"])
    assert sk.shared_reach(daily, "kind", ["hot", "c1"], [], START, END).first().reach == len(users[0] & users[1])
    assert [r.reach for r in sk.shared_reach(daily, "kind", ["hot", "absent"], [], START, END).collect()] == [0]


def test_no_users_and_no_events(spark):
    t = _traffic(spark, 3000, 1000)
    none = sk.daily_reach(t.withColumn("user_id", F.lit(None).cast("bigint")), ["kind"])
    assert {r.reach for r in sk.reach_of_spans(none, ["kind"], START, END).collect()} == {0}
    assert sk.reach_of_spans(sk.daily_reach(t.limit(0), ["kind"]), ["kind"], START, END).count() == 0
