"""Sides of joins that look small to the planner and are not: no broadcast of them, and no single task for all their rows."""
import datetime as dt
import glob
import json
import time

from pyspark.sql import functions as F

from shelfscope import fixtures as fx
from shelfscope.functions.brand import classify_indexed
from shelfscope.plans import history as hist
from shelfscope.plans import reports
from shelfscope.queries import reports as queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_indexed_rules_broadcast_nothing(spark):
    rows = spark.createDataFrame([("a", "red ring 1", "c"), ("b", None, "blue widgets"), (None, None, None)], "advertiser string, creative string, campaign string")
    rules = spark.createDataFrame([(2, "ring", "R"), (1, "blue widgets", "B"), (3, "a", "A"), (4, None, "N")], "rule_no int, pattern string, label string")
    out = classify_indexed(rows, rules)
    assert "Broadcast" not in plan(out)
    assert sorted(x.brand for x in out.collect()) == ["B", "R", "UNCLASSIFIED"]


def test_versions_are_not_broadcast_when_carried_forward(spark):
    day = dt.date(2024, 1, 1)
    h = spark.createDataFrame([(1, "x", day, None), (None, "y", day, dt.date(2024, 3, 1))], "k int, t string, valid_from date, valid_to date")
    f = spark.createDataFrame([(1, dt.date(2025, 1, 5)), (None, dt.date(2024, 2, 5)), (None, dt.date(2024, 3, 5))], "k int, day date")
    out = hist.join_valid(f, h, ["k"], "day")
    assert "SortMergeJoin" in plan(out) and "Broadcast" not in plan(out)
    assert sorted(str(x.t) for x in out.collect()) == ["None", "x", "y"]


def test_snapshot_history_broadcasts_dates_only_and_keeps_its_tasks(spark):
    rows = [(k, dt.date(2024, m, 1), "a" if m < 3 else "b") for k in range(50) for m in (1, 2, 3)]
    out = hist.snapshot_history(spark.createDataFrame(rows, "k int, d date, t string"), ["k"], "d", ["t"])
    assert "REPARTITION_BY_NUM" in plan(out) and plan(out).split("Final Plan")[0].count("BroadcastExchange") == 1
    assert out.count() == 100


def test_campaigns_are_not_broadcast(spark, tmp_dir):
    spark.range(20).selectExpr("id AS event_id", "timestamp'2024-01-01 00:00:00' AS ts", "id % 3 AS user_id", "'click' AS event_type", "1.0D AS value",
                               "'{\"k\": 5}' AS props").write.parquet(f"{tmp_dir}/events.parquet")
    spark.range(4).selectExpr("id AS p_partkey", "'red ring' AS p_name", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_dir}/part.parquet")
    for df in (fx.ad_events(spark, tmp_dir), fx.ad_base(spark, tmp_dir)):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
        assert df.count() == 20


def test_large_groups_become_several_documents(spark, tmp_dir, monkeypatch):
    from shelfscope.queries import io
    from shelfscope.sources.files import read_report_json
    monkeypatch.setattr(io, "DOC_RECORDS", 100)
    rec = spark.range(1000).selectExpr("id", "concat('\"', id, '}') AS text")
    io._land_documents(rec, f"{tmp_dir}/docs", F.lit("one"), "rows", 1000)
    docs = [json.load(open(f)) for f in glob.glob(f"{tmp_dir}/docs/doc=*/part-*")]
    assert len(docs) == 10 and max(len(x["rows"]) for x in docs) < 200
    assert sorted(x["id"] for d in docs for x in d["rows"]) == list(range(1000))
    schema = rec.select(F.array(F.struct(*rec.columns)).alias("rows")).schema
    back = read_report_json(spark, f"{tmp_dir}/docs", key="rows", schema=schema)
    assert sorted(tuple(x) for x in back.collect()) == sorted(tuple(x) for x in rec.collect())


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_documents_are_landed_in_slices_that_leave_no_shuffles(spark, tmp_dir, monkeypatch):
    from shelfscope.queries import io
    from shelfscope.sources.files import read_report_json
    monkeypatch.setattr(io, "DOC_RECORDS", 100)
    monkeypatch.setattr(io, "SLICE_RECORDS", 300)
    rec = spark.range(2000).selectExpr("id % 1000 AS id", "id AS x").groupBy("id").agg(F.sum("x").alias("x"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(key, None), shuffle_files(spark)
    io._land_documents(rec, f"{tmp_dir}/docs", F.when(F.col("id") > 500, "two").otherwise("one"), "rows", 1000, by=["id"], compression="gzip")
    until = time.time() + 20  # files go in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and spark.conf.get(key, None) == kept
    files = glob.glob(f"{tmp_dir}/docs/doc=*/part-*")
    assert len(files) == 20 and all(f.endswith(".gz") for f in files)
    schema = rec.select(F.array(F.struct(*rec.columns)).alias("rows")).schema
    back = read_report_json(spark, f"{tmp_dir}/docs", key="rows", schema=schema)
    assert sorted(tuple(x) for x in back.collect()) == sorted(tuple(x) for x in rec.collect())


def test_vendor_report_documents_are_gzip_and_not_written_again(spark, tmp_dir, monkeypatch):
    from shelfscope.queries import io
    from shelfscope.sources import splits
    monkeypatch.setattr(io, "_scratch", lambda _, name: f"{tmp_dir}/{name}")
    monkeypatch.setattr(splits, "_written", lambda *_: 1 / 0)
    out = io.s1_vendor_report_documents(spark, "/root/testdata/sf0.001")
    assert all(f.endswith(".gz") for f in glob.glob(f"{tmp_dir}/landing-sales-documents/doc=*/part-*"))
    want = fx.vendor_sales_records(spark, "/root/testdata/sf0.001")
    assert out.count() == want.count() > 0


def test_repeat_purchase_spreads_rows_over_tasks_that_follow_the_input(spark):
    from shelfscope.operators.joins import tasks_for
    assert tasks_for(spark.range(1000), rows=10) == 100
    assert tasks_for(spark.range(0)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(1, "a", c, o, 1.0) for c in (1, 2, None) for o in (10, 10, None)] + [(1, "a", 3, o, 2.0) for o in (20, 21)] + [(None, None, 9, 1, 3.0)]
    df = spark.createDataFrame(rows, "period int, item string, customer int, o int, rev double")
    out = reports.repeat_purchase(df, "item", "customer", "o", "rev", tasks=37)
    text = plan(out)
    assert text.count("37), REPARTITION_BY_NUM") == 2
    got = {x.item: tuple(x)[2:] for x in out.collect()}
    assert got == {"a": (5, 4, 25.0, 4.0, 4.0 * 100 / 13), None: (1, 1, 0.0, 0.0, 0.0)}


def test_r11_neither_broadcasts_orders_nor_sums_in_the_scan(spark):
    text = plan(queries.r11_repeat_purchase(spark, "/root/testdata/sf0.001"))
    assert "Broadcast" not in text and text.count("REPARTITION_BY_NUM") == 4


def test_market_insight_shuffles_fine_grains_once(spark):
    day = dt.date
    rows = [(day(2023, 2, 28), "a", 1, 2), (day(2023, 2, 28), "a", 3, 2), (day(2024, 2, 28), "a", 6, 1), (day(2024, 2, 29), "a", 2, 1),
            (day(2024, 2, 29), None, 2, 5), (day(2023, 2, 27), "a", 9, 9), (None, "a", 5, 5), (day(2025, 2, 28), None, 0, 0), (day(2026, 2, 28), None, 1, 1)]
    df = spark.createDataFrame(rows, "period date, d string, value int, units int").withColumn("value", F.col("value").cast("decimal(18,2)"))
    for tasks in (None, 5):
        out = reports.market_insight(df, ["d"], tasks=tasks)
        assert "SortMergeJoin" not in plan(out)
        got = {(str(x.period), x.d): tuple(x)[2:] for x in out.collect()}
        assert got == {("2023-02-28", "a"): (4, 4, None, None, None, None, 1), ("2024-02-28", "a"): (6, 1, 4, 4, 0.5, -0.75, 1),
                       ("2024-02-29", "a"): (2, 1, 4, 4, -0.5, -0.75, 0.5), ("2024-02-29", None): (2, 5, None, None, None, None, 0.5),
                       ("2023-02-27", "a"): (9, 9, None, None, None, None, 1), ("None", "a"): (5, 5, None, None, None, None, 1),
                       ("2025-02-28", None): (0, 0, None, None, None, None, None),
                       ("2026-02-28", None): (1, 1, 0, 0, None, None, 1)}


def test_r9_daily_moves_lines_three_times(spark):
    """To their orders, to their parts and to their dimensions; the totals read the last shuffle again."""
    out = queries.r9_market_insight_daily(spark, "/root/testdata/sf0.001")
    out.collect()
    text = plan(out).split("Initial Plan")[0]
    assert "ReusedExchange" in text and "part" in text and text.count("parquet [l_") == 1
