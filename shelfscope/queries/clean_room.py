"""Registered clean-room reports (Q1-Q4) over the derived ad views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.brand import FIXTURE_BRAND_RULES, REFERENCE_BRAND_RULES, classify_indexed
from ..oracles import clean_room as o
from ..fixture_sql import with_views
from ..plans import clean_room as q
from ..plans import sketches as sk
from ..registry import register
from ..session import scratch_path

# The events cover January 2024; one window covers all of it.
START, END = "2024-01-01", "2024-02-01"
WEEK = 7


def _ads(spark, d):
    base = fx.ad_base(spark, d)
    return fx.ad_traffic(spark, d, base), fx.ad_conversions(spark, d, base)


@register("q1_campaign_value", o.campaign_value_sql(START, END, None, FIXTURE_BRAND_RULES),
          "Q1", "A1", "A2", "A3", "A4", "A5", "A6", "A7", "A13", "J2", "J4", "U1", "U4", "C23", "C24")
def q1_campaign_value(spark, d):
    t, c = _ads(spark, d)
    return q.campaign_value(t, c, START, END, rules=FIXTURE_BRAND_RULES)


@register("q1_campaign_value_weekly", o.campaign_value_sql(START, END, WEEK, FIXTURE_BRAND_RULES),
          "Q1", "P1", "P2")
def q1_campaign_value_weekly(spark, d):
    t, c = _ads(spark, d)
    return q.campaign_value(t, c, START, END, window_days=WEEK, rules=FIXTURE_BRAND_RULES)


@register("q1_campaign_value_reference_rules", o.campaign_value_sql(START, END, None, REFERENCE_BRAND_RULES),
          "Q1", "A2")
def q1_campaign_value_reference_rules(spark, d):
    t, c = _ads(spark, d)
    return q.campaign_value(t, c, START, END, rules=REFERENCE_BRAND_RULES)


@register("q2_ad_type_overlap", o.ad_type_overlap_sql(START, END, None, FIXTURE_BRAND_RULES),
          "Q2", "A8", "J3", "J5")
def q2_ad_type_overlap(spark, d):
    t, c = _ads(spark, d)
    return q.ad_type_overlap(t, c, START, END, as_text=True, rules=FIXTURE_BRAND_RULES)


@register("q2_ad_type_overlap_weekly", o.ad_type_overlap_sql(START, END, WEEK, FIXTURE_BRAND_RULES), "Q2")
def q2_ad_type_overlap_weekly(spark, d):
    t, c = _ads(spark, d)
    return q.ad_type_overlap(t, c, START, END, window_days=WEEK, as_text=True, rules=FIXTURE_BRAND_RULES)


@register("q3_path_to_purchase", o.path_to_purchase_sql(START, END, None, FIXTURE_BRAND_RULES),
          "Q3", "A9", "W1", "J5")
def q3_path_to_purchase(spark, d):
    t, c = _ads(spark, d)
    return q.path_to_purchase(t, c, START, END, as_text=True, rules=FIXTURE_BRAND_RULES)


@register("q3_path_to_purchase_weekly", o.path_to_purchase_sql(START, END, WEEK, FIXTURE_BRAND_RULES), "Q3")
def q3_path_to_purchase_weekly(spark, d):
    t, c = _ads(spark, d)
    return q.path_to_purchase(t, c, START, END, window_days=WEEK, as_text=True, rules=FIXTURE_BRAND_RULES)


@register("q4_subscription_sales", o.subscription_sales_sql(), "Q4", "A11")
def q4_subscription_sales(spark, d):
    return q.subscription_sales(fx.conversions_all(spark, d))


@register("a2_indexed_rules", """
WITH creatives AS (SELECT p_partkey, p_brand AS advertiser, CASE WHEN p_partkey % 9 <> 0 THEN p_name || ' ' || p_partkey END AS creative,
                     'cmp ' || upper(p_name) || ' ' || p_size AS campaign FROM part),
rules AS (SELECT p_partkey AS rule_no, substr(lower(p_name || ' ' || p_partkey), 1 + p_partkey % 7) AS pattern, p_brand || '/' || p_type AS label FROM part),
texts AS (SELECT DISTINCT lower(creative) AS text FROM creatives UNION SELECT lower(campaign) FROM creatives UNION SELECT lower(advertiser) FROM creatives),
hits AS (SELECT text, min(rule_no) AS rule_no FROM texts JOIN rules ON contains(text, pattern) GROUP BY text),
firsts AS (SELECT p_partkey, min(rule_no) AS rule_no FROM creatives JOIN hits ON text IN (lower(advertiser), lower(creative), lower(campaign)) GROUP BY p_partkey)
SELECT c.*, coalesce(label, 'UNCLASSIFIED') AS brand
FROM creatives c LEFT JOIN firsts f ON f.p_partkey = c.p_partkey LEFT JOIN rules r ON r.rule_no = f.rule_no""", "A2")
def a2_indexed_rules(spark, d):
    """As many rules as parts (a part's name and number, from one of its first letters on), over all parts."""
    p, name = fx.table(spark, d, "part"), F.concat_ws(" ", "p_name", "p_partkey")
    creatives = p.select("p_partkey", F.col("p_brand").alias("advertiser"), F.when(F.col("p_partkey") % 9 != 0, name).alias("creative"),
                         F.concat(F.lit("cmp "), F.upper("p_name"), F.lit(" "), F.col("p_size").cast("string")).alias("campaign"))
    rules = p.select(F.col("p_partkey").alias("rule_no"), F.concat_ws("/", "p_brand", "p_type").alias("label"),
                     F.lower(name).substr((F.col("p_partkey") % 7 + 1).cast("int"), F.lit(1000)).alias("pattern"))
    return classify_indexed(creatives, rules)


SPAN_SQL = f"""SELECT *, DATE '{START}' + INTERVAL (date_diff('day', DATE '{START}', CAST(event_dt AS DATE)) // {WEEK} * {WEEK}) DAY AS lo
  FROM ad_traffic WHERE event_dt >= TIMESTAMP '{START}' AND event_dt < TIMESTAMP '{END}'"""


@register("a4_reach_from_sketches", with_views(f"""
SELECT CAST(lo AS DATE) AS time_window_start, CAST(least(lo + INTERVAL {WEEK} DAY, DATE '{END}') AS DATE) AS time_window_end,
  'own' AS kind, ad_product_type, count(DISTINCT user_id) AS reach, CAST(sum(clicks) AS BIGINT) AS clicks FROM span GROUP BY lo, ad_product_type
UNION ALL SELECT DATE '{START}', DATE '{END}', 'own', ad_product_type, count(DISTINCT user_id), CAST(sum(clicks) AS BIGINT) FROM span GROUP BY ad_product_type
UNION ALL SELECT DATE '{START}', DATE '{END}', 'shared', NULL, count(*), NULL FROM (
  SELECT user_id FROM span WHERE user_id IS NOT NULL AND ad_product_type IN ('sponsored_products', 'sponsored_brands') GROUP BY user_id HAVING count(DISTINCT ad_product_type) = 2)
""", "ad_traffic", extra={"span": SPAN_SQL}), "A4", "A5")
def a4_reach_from_sketches(spark, d):
    """Sketches a day and ad type are written once; weeks, the month and the users that two ad types share come from them
    alone.  The SQL counts exactly, as the sketches do up to 2^14 users of a span (``tests/test_sketches.py`` measures the rest)."""
    traffic = fx.ad_traffic(spark, d)
    path = sk.write_daily(sk.daily_reach(traffic, ["ad_product_type"]), scratch_path(spark, f"reach-{uuid.uuid4().hex[:12]}"))
    daily = spark.read.parquet(path)
    cols = ["time_window_start", "time_window_end", "kind", "ad_product_type", "reach", "clicks"]
    weeks, month = (sk.reach_of_spans(daily, ["ad_product_type"], START, END, n, measures=["clicks"]).withColumn("kind", F.lit("own")) for n in (WEEK, None))
    shared = sk.shared_reach(daily, "ad_product_type", ["sponsored_products", "sponsored_brands"], [], START, END).withColumns(
        {"kind": F.lit("shared"), "ad_product_type": F.lit(None).cast("string"), "clicks": F.lit(None).cast("long")})
    return weeks.select(cols).union(month.select(cols)).union(shared.select(cols))
