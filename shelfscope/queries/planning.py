"""Registered load-planning queries.

Request tables are derived from the driver's tables: users' event days,
customers' order days, parts' and suppliers' ship days; "landed" dates are
the days that really have rows.  Each planner therefore runs over all keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import planning as p
from ..registry import register

ANCHOR = "2000-01-01"
LOOKBACK = {p.DAY: 15, p.WEEK: 49}  # look-back limits named in the reference's config

# ---------------------------------------------------------------------------
# request tables (Spark side)


def _user_days(spark, d):
    return (fx.table(spark, d, "events").groupBy("user_id")
            .agg(F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")))


def _part_last(spark, d):
    return (fx.table(spark, d, "lineitem").groupBy("l_partkey")
            .agg(F.max("l_shipdate").cast("date").alias("last_day")))


# SQL counterparts
USER_DAYS = "SELECT user_id, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1"
PART_LAST = "SELECT l_partkey, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem GROUP BY 1"
SUPP_RANGE = ("SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day "
              "FROM lineitem GROUP BY 1")


@register("p1_daily_windows", f"""
WITH u AS ({USER_DAYS})
SELECT user_id, first_day, last_day, CAST(first_day + CAST(i AS INTEGER) AS DATE) AS window_start,
       CAST(first_day + CAST(i AS INTEGER) + 1 AS DATE) AS window_end
FROM (SELECT *, unnest(range(0, date_diff('day', first_day, last_day))) AS i FROM u WHERE first_day < last_day)
""", "P1")
def p1_daily_windows(spark, d):
    return p.daily_windows(_user_days(spark, d), "first_day", "last_day")


@register("p2_interval_windows", """
WITH c AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
           FROM orders GROUP BY 1)
SELECT o_custkey, first_day, last_day, CAST(first_day + CAST(i AS INTEGER) AS DATE) AS interval_start,
       least(CAST(first_day + CAST(i AS INTEGER) + 9 AS DATE), last_day) AS interval_end
FROM (SELECT *, unnest(range(0, date_diff('day', first_day, last_day) + 1, 10)) AS i FROM c WHERE first_day <= last_day)
""", "P2")
def p2_interval_windows(spark, d):
    c = (fx.table(spark, d, "orders").groupBy("o_custkey")
         .agg(F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day")))
    return p.interval_windows(c, "first_day", "last_day", 10)


def _lookback_sql(period: str) -> str:
    step = 1 if period == p.DAY else 7
    return f"""
WITH pl AS ({PART_LAST})
SELECT l_partkey, last_day, CAST(last_day - CAST(i * {step} AS INTEGER) AS DATE) AS wanted_date
FROM (SELECT *, unnest(range(0, {LOOKBACK[period]})) AS i FROM pl)"""


@register("p3_lookback_dates_day", _lookback_sql(p.DAY), "P3")
def p3_lookback_dates_day(spark, d):
    return p.lookback_dates(_part_last(spark, d), "last_day", LOOKBACK[p.DAY], p.DAY)


@register("p3_lookback_dates_week", _lookback_sql(p.WEEK), "P3")
def p3_lookback_dates_week(spark, d):
    return p.lookback_dates(_part_last(spark, d), "last_day", LOOKBACK[p.WEEK], p.WEEK)


def _backfill_sql(period: str) -> str:
    n = ("date_diff('day', first_day, last_day)" if period == p.DAY
         else "CAST(floor(date_diff('day', first_day, last_day) / 7) AS INTEGER)")
    step = 1 if period == p.DAY else 7
    return f"""
WITH s AS ({SUPP_RANGE})
SELECT l_suppkey, first_day, last_day, n_steps, CAST(last_day - CAST(i * {step} AS INTEGER) AS DATE) AS wanted_date
FROM (SELECT *, unnest(range(0, n_steps)) AS i FROM (SELECT *, CAST({n} AS INTEGER) AS n_steps FROM s) WHERE n_steps > 0)"""


def _backfill(spark, d, period):
    s = (fx.table(spark, d, "lineitem").groupBy("l_suppkey")
         .agg(F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_shipdate").cast("date").alias("last_day")))
    s = s.withColumn("n_steps", p.backfill_count("last_day", "first_day", period).cast("int"))
    return p.lookback_dates(s, "last_day", "n_steps", period)


@register("p4_backfill_dates_day", _backfill_sql(p.DAY), "P4")
def p4_backfill_dates_day(spark, d):
    return _backfill(spark, d, p.DAY)


@register("p4_backfill_dates_week", _backfill_sql(p.WEEK), "P4")
def p4_backfill_dates_week(spark, d):
    return _backfill(spark, d, p.WEEK)


@register("p5_missing_dates", f"""
WITH wanted AS ({_lookback_sql(p.DAY)}),
landed AS (SELECT DISTINCT l_partkey, CAST(l_shipdate AS DATE) AS wanted_date FROM lineitem)
SELECT w.* FROM wanted w WHERE NOT EXISTS (
  SELECT 1 FROM landed l WHERE l.l_partkey = w.l_partkey AND l.wanted_date = w.wanted_date)
""", "P5", "J7")
def p5_missing_dates(spark, d):
    wanted = p.lookback_dates(_part_last(spark, d), "last_day", LOOKBACK[p.DAY], p.DAY)
    landed = fx.table(spark, d, "lineitem").select("l_partkey", F.col("l_shipdate").cast("date").alias("wanted_date"))
    return p.missing_dates(wanted, landed, ["l_partkey"], "wanted_date")


@register("p6_period_window", f"""
SELECT l_partkey, wanted_date, wanted_date AS day_start, wanted_date AS day_end,
       CAST(wanted_date - 6 AS DATE) AS week_start, wanted_date AS week_end
FROM ({_lookback_sql(p.WEEK)})
""", "P6")
def p6_period_window(spark, d):
    w = p.lookback_dates(_part_last(spark, d), "last_day", LOOKBACK[p.WEEK], p.WEEK)
    ds, de = p.period_window("wanted_date", p.DAY)
    ws, we = p.period_window("wanted_date", p.WEEK)
    return w.select("l_partkey", "wanted_date", ds.alias("day_start"), de.alias("day_end"),
                    ws.alias("week_start"), we.alias("week_end"))


@register("p7_last_saturday", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
       CAST(CAST(o_orderdate AS DATE) - CAST((dayofweek(o_orderdate) + 1) % 7 AS INTEGER) AS DATE) AS week_end
FROM orders
""", "P7")
def p7_last_saturday(spark, d):
    o = fx.table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", day.alias("order_day"), p.last_saturday(day).alias("week_end"))


@register("p8_lookback_start", f"""
SELECT l_partkey, last_day, CAST(last_day - {LOOKBACK[p.DAY] - 1} AS DATE) AS day_start,
       CAST(last_day - {7 * LOOKBACK[p.WEEK] - 1} AS DATE) AS week_start
FROM ({PART_LAST})
""", "P8")
def p8_lookback_start(spark, d):
    pl = _part_last(spark, d)
    return pl.select("l_partkey", "last_day",
                     p.lookback_start("last_day", LOOKBACK[p.DAY], p.DAY).alias("day_start"),
                     p.lookback_start("last_day", LOOKBACK[p.WEEK], p.WEEK).alias("week_start"))


@register("p9_latest_available", f"""
WITH avail AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS period, count(*) AS n_rows FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, max(CASE WHEN n_rows > 0 AND period <= DATE '{ANCHOR}' THEN period END) AS latest_available
FROM avail GROUP BY 1
""", "P9")
def p9_latest_available(spark, d):
    avail = (fx.table(spark, d, "lineitem")
             .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("period"))
             .agg(F.count(F.lit(1)).alias("n_rows")))
    return p.latest_available(avail, ["l_suppkey"], "period", "n_rows", ANCHOR)


@register("p10_daily_dates", f"""
WITH u AS ({USER_DAYS})
SELECT user_id, first_day, last_day, CAST(first_day + CAST(i AS INTEGER) AS DATE) AS day
FROM (SELECT *, unnest(range(0, date_diff('day', first_day, last_day) + 1)) AS i FROM u)
""", "P10")
def p10_daily_dates(spark, d):
    return p.daily_dates(_user_days(spark, d), "first_day", "last_day")


@register("p11_snapshot_is_new", """
WITH latest AS (SELECT l_suppkey, CAST(max(l_shipdate) AS DATE) AS snapshot_date FROM lineitem GROUP BY 1)
SELECT * FROM latest WHERE (l_suppkey, snapshot_date) NOT IN (
  SELECT (l_suppkey, CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_linenumber % 2 = 1)
""", "P11", "A12")
def p11_snapshot_is_new(spark, d):
    # a supplier's snapshots with an odd line have landed; other suppliers' have not
    li = fx.table(spark, d, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return p.snapshot_is_new(li, ["l_suppkey"], "ship_day", li.where(F.col("l_linenumber") % 2 == 1), "ship_day")


@register("p12_key_batches", """
WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS rk FROM (SELECT DISTINCT p_partkey FROM part))
SELECT CAST(floor((rk - 1) / 20) AS BIGINT) AS batch_id,
       string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS batch_keys, count(*) AS batch_size
FROM r GROUP BY 1
""", "P12")
def p12_key_batches(spark, d):
    return p.key_batches(fx.table(spark, d, "part"), "p_partkey", 20)


# The market codes used with the derived customer markets.
MARKETS = ["UK", "GB", "US", "DE", "ES", "CN"]


def _market_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MARKETS))
    return f"CASE c_nationkey % {len(MARKETS)} {whens} END"


@register("p13_alias_country", f"""
SELECT c_custkey, country_code,
  CASE WHEN country_code = 'UK' THEN 'GB' ELSE country_code END AS country_gb,
  CASE WHEN country_code = 'GB' THEN 'UK' ELSE country_code END AS country_uk
FROM (SELECT c_custkey, {_market_sql()} AS country_code FROM customer)
""", "P13")
def p13_alias_country(spark, d):
    c = fx.table(spark, d, "customer")
    code = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("c_nationkey") % len(MARKETS)) + 1)
    return c.select("c_custkey", code.alias("country_code")).select(
        "c_custkey", "country_code", p.alias_country("country_code", "GB").alias("country_gb"),
        p.alias_country("country_code", "UK").alias("country_uk"))
