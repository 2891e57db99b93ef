import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import planning as p


def _d(s):
    return dt.date.fromisoformat(s)


def test_interval_windows_clip_last(spark):
    df = spark.createDataFrame([(_d("2024-01-01"), _d("2024-01-25"))], "s date, e date")
    out = [(str(r.interval_start), str(r.interval_end)) for r in p.interval_windows(df, "s", "e", 10).collect()]
    assert out == [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-25")]


def test_daily_windows_half_open(spark):
    df = spark.createDataFrame([(_d("2024-01-01"), _d("2024-01-03")), (_d("2024-01-05"), _d("2024-01-05"))],
                               "s date, e date")
    out = [(str(r.window_start), str(r.window_end)) for r in p.daily_windows(df, "s", "e").collect()]
    assert out == [("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03")]


def test_backfill_excludes_start(spark):
    df = spark.createDataFrame([(_d("2024-01-01"), _d("2024-01-04"))], "s date, last date")
    df = df.withColumn("n", p.backfill_count("last", "s", p.DAY))
    out = sorted(str(r.wanted_date) for r in p.lookback_dates(df, "last", "n", p.DAY).collect())
    assert out == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_last_saturday(spark):
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]  # Fri, Sat, Sun, Mon
    df = spark.createDataFrame([(_d(x),) for x in days], "d date")
    out = [str(r.s) for r in df.select(p.last_saturday("d").alias("s")).collect()]
    assert out == ["2023-12-30", "2024-01-06", "2024-01-06", "2024-01-06"]


def test_daily_dates_rejects_reversed_range(spark):
    df = spark.createDataFrame([(_d("2024-01-03"), _d("2024-01-01"))], "s date, e date")
    with pytest.raises(Exception, match="later than end"):
        p.daily_dates(df, "s", "e").collect()


def test_key_batches_cover_all_keys(spark):
    df = spark.range(0, 95).withColumnRenamed("id", "k")
    out = p.key_batches(df, "k", 20).orderBy("batch_id").collect()
    assert [r.batch_size for r in out] == [20, 20, 20, 20, 15]
    assert out[0].batch_keys == ",".join(str(i) for i in range(20))


def test_availability_anchor(spark):
    df = spark.range(1).select(
        p.availability_anchor("2024-01-10").alias("a"), p.availability_anchor("2024-01-10", "sp_inventory").alias("b"),
        p.availability_anchor("2024-01-10", period=p.WEEK).alias("c"))
    r = df.first()
    assert (str(r.a), str(r.b), str(r.c)) == ("2024-01-08", "2024-01-06", "2024-01-06")
