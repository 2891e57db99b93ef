"""Registered declared reports (R1-R14) over ad events and TPC-H-style
sales tables.  R2's oracle uses DuckDB's ASOF JOIN (an independent way to
find the last click)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixture_sql import with_views
from ..operators.joins import tasks_for
from ..operators.planning import last_saturday
from ..operators.setops import append_all
from ..plans import reports as r
from ..registry import register
from ..session import scratch_path

DAYS = r.WINDOW_DAYS


def _attr_sums_sql(dims: str = "campaign_id", view: str = "attributed", ntb: bool = False) -> str:
    what = {"purchases": "1", "sales": "sales", "units": "units"}
    cols = []
    for n in DAYS:
        for names, cond in ((("purchases", "sales", "unitsSoldClicks"), "true"),
                            (("purchasesSameSku", "attributedSalesSameSku", "unitsSoldSameSku"), "sku = advertised_sku"),
                            (("purchasesOtherSku", "salesOtherSku", "unitsSoldOtherSku"), "sku <> advertised_sku")):
            for name, v in zip(names, what.values()):
                typ = "DOUBLE" if v == "sales" else "BIGINT"
                cols.append(f"CAST(coalesce(sum({v}) FILTER (lag_us <= {n} * 86400000000 AND {cond}), 0) AS {typ}) AS {name}{n}d")
    if ntb:
        for name, v in zip(("newToBrandPurchases", "newToBrandSales", "newToBrandUnitsSold"), what.values()):
            typ = "DOUBLE" if v == "sales" else "BIGINT"
            cols.append(f"CAST(coalesce(sum({v}) FILTER (lag_us <= 14 * 86400000000 AND ntb), 0) AS {typ}) AS {name}")
    return f"SELECT click_day, {dims}, " + ",\n  ".join(cols) + f"\nFROM {view} GROUP BY click_day, {dims}"


CLICK_COLS = ("click_ts", "campaign_id", "campaign_name", "advertised_sku", "ad_group", "targeting", "placement")


def _touches(spark, d, ntb: bool = False, views: bool = False):
    """Clicks (and views) and purchases from one filtered scan of the events."""
    kinds = ["click", "view"] if views else ["click"]
    ev = fx.ad_events(spark, d).where(F.col("event_type").isin(*kinds, "purchase"))
    touch = F.col("event_type").isin(*kinds)
    mark = F.when(touch, F.col("event_type")).alias("touch") if views else touch.alias("is_click")
    both = ev.select(
        "event_id", "user_id", "ts", "day", mark, F.when(~touch, F.col("brand")).alias("brand"),
        F.when(~touch, F.col("bought_item")).alias("sku"), F.when(~touch, F.col("value")).alias("sales"),
        F.when(~touch, F.lit(1) + F.col("event_id") % 3).cast("bigint").alias("units"),
        *[F.when(touch, F.col(src)).alias(c) for c, src in zip(CLICK_COLS, (
            "ts", "campaign_id", "campaign_name", "campaign_id", "ad_group", "targeting", "placement"))])
    if not ntb:
        return both
    bought = F.col("touch").isNull() if views else ~F.col("is_click")
    buys = r.flag_new_to_brand(both.where(bought))
    return buys.unionByName(both.where(~bought).withColumn("ntb", F.lit(False)))


@register("r2_attribution_windows", with_views(_attr_sums_sql(), "attributed"), "R2", "R3")
def r2_attribution_windows(spark, d):
    return r.attributed_sums(r.attribute(_touches(spark, d), CLICK_COLS))


# ---------------------------------------------------------------------------
# Declared reports.  Columns of the specs that the events can give; budgets, statuses, bids, reading
# royalties, cart, list and search measures have no source here.

WINDOWED = [f"{m}{n}d" for m in ("purchases", "sales", "unitsSoldClicks", "purchasesSameSku", "attributedSalesSameSku",
                                 "unitsSoldSameSku") for n in DAYS]
OTHER = [f"{m}{n}d" for m in ("purchasesOtherSku", "salesOtherSku", "unitsSoldOtherSku") for n in DAYS]
COST = ["impressions", "clicks", "cost", "spend", "clickThroughRate", "costPerClick"]
RATIOS = ["acosClicks7d", "acosClicks14d", "roasClicks7d", "roasClicks14d"]
VIDEO = ["videoFirstQuartileViews", "videoMidpointViews", "videoThirdQuartileViews", "videoCompleteViews",
         "video5SecondViews", "video5SecondViewRate", "viewabilityRate"]
BRAND = [m + s for m in ("newToBrandPurchases", "newToBrandSales", "newToBrandUnitsSold") for s in ("", "Clicks", "Percentage")]
SOLD = ["purchases", "purchasesClicks", "purchasesPromoted", "sales", "salesClicks", "salesPromoted"]
DISPLAY = ["impressions", "impressionsViews", "clicks", "cost", "viewabilityRate", "viewClickThroughRate", *VIDEO[:4],
           *[m + s for m in ("newToBrandPurchases", "newToBrandSales", "newToBrandUnitsSold") for s in ("", "Clicks")],
           "purchases", "purchasesClicks", "purchasesPromotedClicks", "sales", "salesClicks", "salesPromotedClicks", "unitsSold",
           "unitsSoldClicks"]
REACH = list(r.REACH_MEASURES)
SPECS = {
    "r1_sp_campaigns_report": (["campaigns"], ["date", "campaignId", "campaignName", *COST, *WINDOWED, "acosClicks14d", "roasClicks14d"]),
    "r1_sp_advertised_product": (["advertiser"], ["date", "campaignId", "campaignName", "adGroupName", "advertisedAsin",
                                 "advertisedSku", *COST, *WINDOWED, "salesOtherSku7d", "unitsSoldOtherSku7d", *RATIOS]),
    "r1_sp_purchased_product": (["asin"], ["date", "campaignId", "campaignName", "adGroupName", "advertisedAsin", "advertisedSku",
                                "keyword", "purchasedAsin", *[c for c in WINDOWED if c.startswith(("purchases1", "purchases7",
                                "purchases3", "sales", "unitsSoldClicks"))], *OTHER]),
    "r1_sp_targeting": (["targeting"], ["date", "campaignId", "campaignName", "adGroupName", "targeting", "keyword", *COST, *WINDOWED,
                        "salesOtherSku7d", "unitsSoldOtherSku7d", *RATIOS]),
    "r1_sb_ad_group": (["adGroup"], ["date", "campaignId", "campaignName", "adGroupName", "impressions", "clicks", "cost", *VIDEO, *BRAND,
                       "newToBrandPurchasesRate", "purchases", "purchasesClicks", "purchasesPromoted", "sales", "salesClicks",
                       "salesPromoted", "unitsSold", "unitsSoldClicks"]),
    "r1_sb_placement": (["campaignPlacement"], ["date", "campaignId", "campaignName", "placementClassification", "impressions", "clicks",
                        "cost", "clickThroughRate", *VIDEO, "purchases", "sales", "unitsSold"]),
    "r1_sb_targeting": (["targeting"], ["date", "campaignId", "campaignName", "adGroupName", "keywordText", "targetingText",
                        "targetingExpression", "impressions", "clicks", "cost", *BRAND, "newToBrandPurchasesRate", *SOLD, "unitsSold"]),
    "r1_sb_purchased_product": (["purchasedAsin"], ["date", "campaignId", "campaignName", "adGroupName", "purchasedAsin",
                                *[f"newToBrand{m}14d" for m in ("Purchases", "PurchasesPercentage", "Sales", "SalesPercentage",
                                "UnitsSold", "UnitsSoldPercentage")], "orders14d", "ordersClicks14d", "sales14d", "salesClicks14d",
                                "unitsSold14d", "unitsSoldClicks14d"]),
    "r1_sd_campaigns": (["campaign"], ["date", "campaignId", "campaignName", *DISPLAY, *REACH]),
    "r1_sd_targeting": (["targeting"], ["date", "campaignId", "campaignName", "adGroupName", "targetingText", "targetingExpression",
                        *DISPLAY]),
    "r1_sd_advertised_product": (["advertiser"], ["date", "campaignId", "campaignName", "adGroupName", "promotedAsin", "promotedSku",
                                 *DISPLAY, *REACH]),
}
VIEWABLE_AT, FIVE_SECONDS_AT = 10, 20  # percent of the ad: half a second and five seconds of a 25-second ad, roughly
# the same names as SQL: dimension of a column, and the measures that are not plain sums
_DIM = {"campaignId": "campaign_id", "campaignName": "campaign_name", "adGroupName": "ad_group", "targeting": "targeting",
        "keyword": "targeting", "placementClassification": "placement", "advertisedAsin": "advertised_sku",
        "advertisedSku": "advertised_sku", "purchasedAsin": "sku", "promotedAsin": "advertised_sku", "promotedSku": "advertised_sku",
        "keywordText": "targeting", "targetingText": "targeting", "targetingExpression": "targeting"}


def _ratio(a: str, b: str, times: str = "") -> str:
    return f"CASE WHEN coalesce(sum({b}), 0) = 0 THEN NULL ELSE CAST(coalesce(sum({a}), 0) AS DOUBLE){times} / CAST(sum({b}) AS DOUBLE) END"


def _column_sql(c: str, display: bool) -> str:
    if c in REACH:
        return f"any_value({c})"
    ratios = {"clickThroughRate": ("clicks", "impressions"), "costPerClick": ("cost", "clicks"),
              "viewabilityRate": ("viewable", "impressions"), "viewClickThroughRate": ("clicks", "viewable"),
              "video5SecondViewRate": ("video5SecondViews", "impressions"),
              "newToBrandPurchasesRate": ("newToBrandPurchases", "impressions")}
    ratios |= {f"acosClicks{n}d": ("cost", f"sales{n}d") for n in DAYS} | {f"roasClicks{n}d": (f"sales{n}d", "cost") for n in DAYS}
    if c in ratios:
        return _ratio(*ratios[c])
    brand = ("newToBrandPurchases", "newToBrandSales", "newToBrandUnitsSold")
    if "Percentage" in c:
        m = c.removesuffix("14d").removesuffix("Percentage")
        return _ratio(m, dict(zip(brand, ("purchases14d", "sales14d", "unitsSoldClicks14d")))[m], " * 100.0")
    same = {"spend": "cost", "purchases": "purchases14d", "purchasesClicks": "purchases14d", "purchasesPromoted": "purchasesSameSku14d",
            "sales": "sales14d", "salesClicks": "sales14d", "salesPromoted": "attributedSalesSameSku14d",
            "unitsSold": "unitsSoldClicks14d", "unitsSoldClicks": "unitsSoldClicks14d", "impressionsViews": "viewable",
            "purchasesPromotedClicks": "purchasesSameSku14d", "salesPromotedClicks": "attributedSalesSameSku14d",
            "orders14d": "purchases14d", "ordersClicks14d": "purchases14d", "salesClicks14d": "sales14d",
            "unitsSold14d": "unitsSoldClicks14d", **{f"{m}Clicks": m for m in brand}, **{f"{m}14d": m for m in brand}}
    by_view = {"purchases": "v_purchases", "sales": "v_sales", "unitsSold": "v_units",
               **dict(zip(brand, ("v_ntb", "v_ntb_sales", "v_ntb_units")))}
    total = f"coalesce(sum({same.get(c, c)}), 0)" + (f" + coalesce(sum({by_view[c]}), 0)" if display and c in by_view else "")
    typ = "DOUBLE" if "ales" in c or c in ("cost", "spend") else "BIGINT"
    return f"CAST({total} AS {typ})"


def _spec_sql(group_by, columns, display) -> str:
    dims = list(dict.fromkeys(x for g in group_by for x in r.GRAINS[g]))
    names = ", ".join(dims)
    traffic_dims = ", ".join({"advertised_sku": "campaign_id AS advertised_sku", "sku": "NULL AS sku"}.get(x, x) for x in dims)
    steps = ", ".join(f"CAST(event_type <> 'purchase' AND progress >= {at} AS INTEGER) AS {m}" for m, at in r.FUNNEL_STEPS.items())
    extra = {
        "bought": """SELECT p.*, user_id IS NOT NULL AND ts = min(ts) OVER (PARTITION BY user_id, brand) AS ntb FROM ad_purchases p""",
        "credited": """SELECT a.*, b.ntb, n.campaign_name FROM attributed a JOIN bought b USING (event_id)
          JOIN (SELECT DISTINCT campaign_id, campaign_name FROM ad_events) n ON n.campaign_id = a.campaign_id""",
        "won": _attr_sums_sql(names, "credited", ntb=True),
        "shown": f"""SELECT day AS date, {traffic_dims}, 1 AS impressions, CAST(event_type = 'click' AS INTEGER) AS clicks,
          CASE WHEN event_type = 'click' THEN value ELSE 0 END AS cost, {steps},
          CAST(progress >= {VIEWABLE_AT} AS INTEGER) AS viewable, CAST(progress >= {FIVE_SECONDS_AT} AS INTEGER) AS video5SecondViews
        FROM ad_events WHERE event_type IN ('view', 'click')""" + (" AND false" if "sku" in dims else ""),
        # a day and campaign of other events alone has a row of zeros too
        "quiet": f"SELECT DISTINCT day AS date, {traffic_dims} FROM ad_events" + (" WHERE false" if "sku" in dims else ""),
    }
    parts = ["SELECT * FROM quiet", "SELECT * FROM shown", "SELECT click_day AS date, * EXCLUDE (click_day) FROM won"]
    if display:  # purchases without a click in 14 days go to the last view of these days
        extra["seen"] = f"""SELECT user_id, ts AS seen_at, day, {traffic_dims} FROM ad_events WHERE event_type = 'view'"""
        extra["by_view"] = f"""SELECT v.day AS date, {", ".join("v." + x for x in dims)}, 1 AS v_purchases, b.sales AS v_sales, b.units AS v_units,
            CAST(b.ntb AS INTEGER) AS v_ntb, CASE WHEN b.ntb THEN b.sales ELSE 0 END AS v_ntb_sales, CASE WHEN b.ntb THEN b.units ELSE 0 END AS v_ntb_units
          FROM bought b ASOF JOIN seen v ON b.user_id = v.user_id AND b.ts >= v.seen_at
          WHERE date_diff('microsecond', v.seen_at, b.ts) <= 14 * 86400000000
            AND b.event_id NOT IN (SELECT event_id FROM attributed WHERE lag_us <= 14 * 86400000000)"""
        parts.append("SELECT * FROM by_view")
    extra["facts"] = " UNION ALL BY NAME ".join(parts)
    source = "facts"
    if set(columns) & set(REACH):  # every user counts on the first day of the row's dimensions
        extra["firsts"] = f"""SELECT {names}, day, row_number() OVER (PARTITION BY {names}, user_id ORDER BY day) = 1 AND user_id IS NOT NULL AS new
          FROM (SELECT user_id, day, {traffic_dims} FROM ad_events WHERE event_type IN ('view', 'click'))"""
        extra["reach"] = f"""SELECT date, {names}, coalesce(CAST(sum(n) OVER w AS BIGINT), 0) AS cumulativeReach,
            CASE WHEN coalesce(sum(n) OVER w, 0) = 0 THEN NULL ELSE CAST(sum(i) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE) END AS impressionsFrequencyAverage
          FROM (SELECT f.date, {", ".join("f." + x for x in dims)}, count(*) FILTER (WHERE new) AS n, count(new) AS i
                FROM (SELECT DISTINCT date, {names} FROM facts) f LEFT JOIN firsts s
                  ON s.day = f.date AND {" AND ".join(f"s.{x} IS NOT DISTINCT FROM f.{x}" for x in dims)} GROUP BY ALL)
          WINDOW w AS (PARTITION BY {names} ORDER BY date)"""
        source = f"facts JOIN reach USING (date, {names})"
    cols = ", ".join(f"date" if c == "date" else f"{_DIM[c]} AS {c}" if c in _DIM else f"{_column_sql(c, display)} AS {c}" for c in columns)
    return with_views(f"SELECT {cols} FROM {source} GROUP BY date, {names}", "ad_events", "ad_purchases", "attributed", extra=extra)


def _report(name, without=()) -> r.ReportSpec:
    group_by, columns = SPECS[name]
    return r.ReportSpec(group_by, [c for c in columns if c not in without], display="_sd_" in name)


def _brand_needed(*specs) -> bool:
    return any(m.startswith("newToBrand") for s in specs for m in s.needs())


def _traffic(spark, d):
    return fx.ad_events(spark, d).withColumn("advertised_sku", F.col("campaign_id"))


def _declared(name):
    spec = _report(name)

    def run(spark, d):
        ev, dims = _traffic(spark, d), spec.dims()
        touched = _touches(spark, d, _brand_needed(spec), spec.display)
        won = (r.attribute_views if spec.display else r.attribute)(touched, CLICK_COLS)
        facts = r.ad_facts(ev, won, dims, VIEWABLE_AT, FIVE_SECONDS_AT, spec.needs())
        reach = None
        if set(spec.columns) & set(REACH):
            reach = r.cumulative_reach(ev.where(F.col("event_type").isin("view", "click")), key=dims)
        return r.run_report(facts, spec, summed=True, reach=reach)
    run.__name__ = name
    return run


for _name, (_group, _columns) in SPECS.items():
    register(_name, _spec_sql(_group, _columns, "_sd_" in _name), "R1", "R4", *(["R3"] if "product" in _name else []),
             *(["R2"] if "_sd_" in _name else []), *(["R7"] if set(_columns) & set(REACH) else []))(_declared(_name))

_ALL = "\nUNION ALL BY NAME\n".join(
    f"SELECT '{n}' AS report, * FROM ({_spec_sql(g, [c for c in cols if c not in REACH], '_sd_' in n)})" for n, (g, cols) in SPECS.items())


@register("r1_all_reports", _ALL, "R1", "R4")
def r1_all_reports(spark, d):
    """Every declared report from one scan of the facts (``run_reports``), one below the other."""
    specs = {n: _report(n, REACH) for n in SPECS}
    won = r.attribute_views(_touches(spark, d, ntb=True, views=True), CLICK_COLS)
    made = r.run_reports(_traffic(spark, d), won, specs, scratch_path(spark, f"reports-{uuid.uuid4().hex}"), VIEWABLE_AT, FIVE_SECONDS_AT)
    return append_all([df.select(F.lit(n).alias("report"), "*") for n, df in made.items()], allow_missing=True)


@register("r5_new_to_brand", with_views("""
SELECT day, campaign_id, count(*) AS purchases, count(*) FILTER (WHERE ntb) AS newToBrandPurchases,
  CAST(sum(CASE WHEN ntb THEN sales END) AS DOUBLE) AS newToBrandSales, CAST(sum(sales) AS DOUBLE) AS sales,
  CAST(sum(CASE WHEN ntb THEN units END) AS BIGINT) AS newToBrandUnitsSold, CAST(sum(units) AS BIGINT) AS unitsSold,
  count(*) FILTER (WHERE ntb) * 100.0 / count(*) AS newToBrandPurchasesPercentage,
  CAST(sum(CASE WHEN ntb THEN sales END) AS DOUBLE) * 100.0 / CAST(sum(sales) AS DOUBLE) AS newToBrandSalesPercentage,
  CAST(sum(CASE WHEN ntb THEN units END) AS DOUBLE) * 100.0 / CAST(sum(units) AS DOUBLE) AS newToBrandUnitsSoldPercentage
FROM (SELECT p.*, p.sku AS campaign_id,
        user_id IS NOT NULL AND p.ts = min(p.ts) OVER (PARTITION BY user_id, brand) AS ntb FROM ad_purchases p)
GROUP BY 1, 2""", "ad_purchases"), "R5")
def r5_new_to_brand(spark, d):
    p = fx.ad_purchases(fx.ad_events(spark, d)).withColumn("campaign_id", F.col("sku"))
    return r.new_to_brand(p)


def _funnel_sql() -> str:
    steps = ", ".join(f"count(*) FILTER (WHERE progress >= {t}) AS {n}" for n, t in r.FUNNEL_STEPS.items())
    return with_views(f"""
SELECT *, CASE WHEN impressions = 0 THEN NULL ELSE viewableImpressions / impressions END AS viewabilityRate,
  CASE WHEN impressions = 0 THEN NULL ELSE video5SecondViews / impressions END AS video5SecondViewRate,
  CASE WHEN viewableImpressions = 0 THEN NULL ELSE CAST(clicks AS DOUBLE) / viewableImpressions END AS viewClickThroughRate
FROM (SELECT day, campaign_id, count(*) AS impressions, {steps},
        count(*) FILTER (WHERE progress >= {VIEWABLE_AT}) AS viewableImpressions,
        count(*) FILTER (WHERE progress >= {FIVE_SECONDS_AT}) AS video5SecondViews,
        count(*) FILTER (WHERE event_type = 'click') AS clicks
      FROM ad_events WHERE event_type IN ('view', 'click') GROUP BY 1, 2)""", "ad_events")


@register("r6_view_funnel", _funnel_sql(), "R6")
def r6_view_funnel(spark, d):
    ev = fx.ad_events(spark, d).where(F.col("event_type").isin("view", "click"))
    return r.view_funnel(ev, VIEWABLE_AT, FIVE_SECONDS_AT)


@register("r7_cumulative_reach", with_views("""
SELECT d.campaign_id, d.day, d.impressions,
  (SELECT count(DISTINCT user_id) FROM imp i WHERE i.campaign_id = d.campaign_id AND i.day <= d.day) AS cumulativeReach,
  CAST((SELECT count(*) FROM imp i WHERE i.campaign_id = d.campaign_id AND i.day <= d.day) AS DOUBLE)
   / nullif((SELECT count(DISTINCT user_id) FROM imp i WHERE i.campaign_id = d.campaign_id AND i.day <= d.day), 0)
   AS impressionsFrequencyAverage
FROM d""", "ad_events", extra={
    "imp": "SELECT campaign_id, day, user_id FROM ad_events WHERE event_type IN ('view', 'click')",
    "d": "SELECT campaign_id, day, count(*) AS impressions FROM imp GROUP BY 1, 2"}), "R7")
def r7_cumulative_reach(spark, d):
    ev = fx.ad_events(spark, d).where(F.col("event_type").isin("view", "click"))
    return r.cumulative_reach(ev)


@register("r8_slot_share", with_views("""
SELECT day, placement, campaign_id, count(*) AS impressions,
  CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY day, placement) AS impressionShare
FROM ad_events WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3""", "ad_events"), "R8")
def r8_slot_share(spark, d):
    ev = fx.ad_events(spark, d).where(F.col("event_type").isin("view", "click"))
    return r.slot_share(ev)


MARKET_DIMS = ["segment", "nation"]


@register("r9_market_insight", """
WITH s AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, c_mktsegment AS segment, n_name AS nation,
             CAST(o_totalprice AS DECIMAL(18,2)) AS value, CAST(1 AS BIGINT) AS units
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT period, segment, nation, sum(value) AS dv, CAST(sum(units) AS BIGINT) AS u FROM s GROUP BY 1, 2, 3),
t AS (SELECT period, sum(dv) AS tot FROM g GROUP BY 1)
SELECT g.period, g.segment, g.nation, CAST(g.dv AS DOUBLE) AS dollar_volume, CAST(g.u AS DOUBLE) AS units,
  CAST(y.dv AS DOUBLE) AS dollar_volume_yago, CAST(y.u AS DOUBLE) AS units_yago,
  CASE WHEN y.dv IS NULL OR y.dv = 0 THEN NULL ELSE (CAST(g.dv AS DOUBLE) - CAST(y.dv AS DOUBLE)) / CAST(y.dv AS DOUBLE) END
    AS dollar_volume_yago_change,
  CASE WHEN y.u IS NULL OR y.u = 0 THEN NULL ELSE (CAST(g.u AS DOUBLE) - CAST(y.u AS DOUBLE)) / CAST(y.u AS DOUBLE) END
    AS units_yago_change,
  CAST(g.dv AS DOUBLE) / CAST(t.tot AS DOUBLE) AS dollar_volume_share
FROM g LEFT JOIN g y ON y.period = CAST(g.period - INTERVAL 12 MONTH AS DATE) AND y.segment = g.segment
  AND y.nation = g.nation
JOIN t ON t.period = g.period""", "R9")
def r9_market_insight(spark, d):
    o = fx.table(spark, d, "orders")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name")
    s = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"),
                 F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"),
                 F.col("o_totalprice").cast("decimal(18,2)").alias("value"), F.lit(1).cast("bigint").alias("units")))
    return r.market_insight(s, MARKET_DIMS)


DAY_DIMS = {"entity_brand_name": "p_brand", "department": "p_type", "classified_code": "l_returnflag", "super_category": "c_mktsegment",
            "category": "l_linestatus", "sub_category": "n_name"}


@register("r9_market_insight_daily", f"""
WITH s AS (SELECT CAST(l_shipdate AS DATE) AS period, {", ".join(f"{src} AS {c}" for c, src in DAY_DIMS.items())},
             CAST(l_extendedprice AS DECIMAL(18,2)) AS value, CAST(l_quantity AS BIGINT) AS units
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 11 <> 0),
g AS (SELECT * EXCLUDE (value, units), sum(value) AS dv, CAST(sum(units) AS BIGINT) AS u FROM s GROUP BY ALL)
SELECT g.period, {", ".join("g." + c for c in DAY_DIMS)}, CAST(g.dv AS DOUBLE) AS dollar_volume, CAST(g.u AS DOUBLE) AS units,
  CAST(y.dv AS DOUBLE) AS dollar_volume_yago, CAST(y.u AS DOUBLE) AS units_yago,
  CASE WHEN y.dv IS NULL OR y.dv = 0 THEN NULL ELSE (CAST(g.dv AS DOUBLE) - CAST(y.dv AS DOUBLE)) / CAST(y.dv AS DOUBLE) END
    AS dollar_volume_yago_change,
  CASE WHEN y.u IS NULL OR y.u = 0 THEN NULL ELSE (CAST(g.u AS DOUBLE) - CAST(y.u AS DOUBLE)) / CAST(y.u AS DOUBLE) END
    AS units_yago_change,
  CAST(g.dv AS DOUBLE) / CAST(sum(g.dv) OVER (PARTITION BY g.period) AS DOUBLE) AS dollar_volume_share
FROM g LEFT JOIN g y ON y.period = CAST(g.period - INTERVAL 12 MONTH AS DATE)
  AND {" AND ".join(f"y.{c} IS NOT DISTINCT FROM g.{c}" for c in DAY_DIMS)}""", "R9")
def r9_market_insight_daily(spark, d):
    # every eleventh part is not in the catalog: its brand and department are NULL
    p = fx.table(spark, d, "part").where(F.col("p_partkey") % 11 != 0).select("p_partkey", "p_brand", "p_type")
    li = fx.table(spark, d, "lineitem")
    n = tasks_for(li)
    # orders find their customer before the lines do, and a nation is a number until its name is a dimension
    o = (fx.table(spark, d, "orders").repartition(n, "o_custkey").hint("merge")
         .join(fx.table(spark, d, "customer").repartition(n, "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
         .select("o_orderkey", "c_mktsegment", "c_nationkey"))
    s = (li.repartition(n, "l_orderkey").hint("merge").join(o.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .repartition(n, "l_partkey").hint("merge").join(p.repartition(n, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left")
         .join(fx.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .select(F.col("l_shipdate").cast("date").alias("period"), *[F.col(src).alias(c) for c, src in DAY_DIMS.items()],
                 F.col("l_extendedprice").cast("decimal(18,2)").alias("value"), F.col("l_quantity").cast("bigint").alias("units")))
    return r.market_insight(s, list(DAY_DIMS), tasks=n)


@register("r11_repeat_purchase", """
WITH l AS (SELECT CAST(CAST(l_shipdate AS DATE) - CAST((dayofweek(l_shipdate) + 1) % 7 AS INTEGER) AS DATE) AS period,
             l_partkey AS item, o_custkey AS customer, l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT period, item, customer, count(DISTINCT l_orderkey) AS n_orders, sum(revenue) AS rev FROM l GROUP BY 1, 2, 3)
SELECT period, item, CAST(sum(n_orders) AS BIGINT) AS ORDERS, count(*) AS UNIQUECUSTOMERS,
  count(*) FILTER (WHERE n_orders > 1) * 100.0 / count(*) AS REPEATCUSTOMERSPCTTOTAL,
  CAST(coalesce(sum(CASE WHEN n_orders > 1 THEN rev END), 0) AS DOUBLE) AS REPEATPURCHASEREVENUE,
  CASE WHEN sum(rev) = 0 THEN NULL ELSE
    CAST(coalesce(sum(CASE WHEN n_orders > 1 THEN rev END), 0) AS DOUBLE) * 100.0 / CAST(sum(rev) AS DOUBLE) END
    AS REPEATPURCHASEREVENUEPCTTOTAL
FROM c GROUP BY 1, 2""", "R11")
def r11_repeat_purchase(spark, d):
    li = fx.table(spark, d, "lineitem")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    n = tasks_for(li)
    s = li.repartition(n, "l_orderkey").hint("merge").join(o.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        last_saturday(F.col("l_shipdate").cast("date")).alias("period"), F.col("l_partkey").alias("item"),
        F.col("o_custkey").alias("customer"), "l_orderkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("revenue"))
    return r.repeat_purchase(s, "item", "customer", "l_orderkey", "revenue", tasks=n)


@register("r12_search_term_ranks", """
WITH g AS (SELECT CASE WHEN p_partkey % 40 <> 0 THEN p_name END AS searchTerm, l_partkey AS clickedAsin, count(*) AS clicks,
             count(*) FILTER (WHERE l_returnflag <> 'R') AS conv
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
t AS (SELECT searchTerm, sum(clicks) AS tc, sum(conv) AS tv FROM g GROUP BY 1),
tr AS (SELECT *, CAST(rank() OVER (ORDER BY tc DESC) AS INTEGER) AS searchFrequencyRank FROM t)
SELECT g.searchTerm, g.clickedAsin, tr.searchFrequencyRank,
  CAST(rank() OVER (PARTITION BY g.searchTerm ORDER BY g.clicks DESC) AS INTEGER) AS clickShareRank,
  CAST(g.clicks AS DOUBLE) / CAST(tr.tc AS DOUBLE) AS clickShare,
  CASE WHEN tr.tv = 0 THEN NULL ELSE CAST(g.conv AS DOUBLE) / CAST(tr.tv AS DOUBLE) END AS conversionShare
FROM g JOIN tr ON g.searchTerm IS NOT DISTINCT FROM tr.searchTerm""", "R12")
def r12_search_term_ranks(spark, d):
    li = fx.table(spark, d, "lineitem")
    p = fx.table(spark, d, "part").select("p_partkey", "p_name")
    c = li.join(p, li.l_partkey == p.p_partkey).select(
        F.when(F.col("p_partkey") % 40 != 0, F.col("p_name")).alias("searchTerm"), F.col("l_partkey").alias("clickedAsin"),
        (F.col("l_returnflag") != "R").alias("converted"))
    return r.search_term_ranks(c)


@register("r13_item_day_facts", """
WITH d AS (SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS item, CAST(l_shipdate AS DATE) AS day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS orderedUnits,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev,
             sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)))) AS cogs
           FROM lineitem GROUP BY 1, 2),
q AS (SELECT item, """ + ", ".join(f"round(quantile_cont(CAST(orderedUnits AS DOUBLE), {p}), 6) AS {n}" for n, p in r.QUANTILES.items()) + """
      FROM d GROUP BY item)
SELECT d.item, d.day, d.orderedUnits, CAST(d.rev AS DOUBLE) AS orderedRevenue, CAST(d.cogs AS DOUBLE) AS shippedCogs,
  CASE WHEN d.rev = 0 THEN NULL ELSE CAST(d.rev - d.cogs AS DOUBLE) / CAST(d.rev AS DOUBLE) END AS netPpm, P70, P80, P90
FROM d JOIN q ON d.item IS NOT DISTINCT FROM q.item""", "R13")
def r13_item_day_facts(spark, d):
    li = fx.table(spark, d, "lineitem")
    rev = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = li.select(F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey")).alias("item"),
                      F.col("l_shipdate").cast("date").alias("day"),
                      F.col("l_quantity").cast("bigint").alias("units"), rev.alias("revenue"),
                      (rev * (F.lit(1).cast("decimal(18,2)") - F.col("l_discount").cast("decimal(18,2)"))).alias("cogs"))
    return r.item_day_facts(lines, "item", "day")


@register("r14_omni_star", """
SELECT n_name AS store_nation, p_type AS item_type, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2, 3""", "R14")
def r14_omni_star(spark, d):
    li = fx.table(spark, d, "lineitem").select(
        "l_partkey", "l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("bigint").alias("qty"))
    items = fx.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("item_type"))
    stores = (fx.table(spark, d, "supplier").join(fx.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
              .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("store_nation")))
    out = r.omni_star(li, items, stores, "l_partkey", "l_suppkey", ["store_nation", "item_type", "month"],
                      {"sales": "price", "units": "qty"})
    return out.withColumn("sales", F.col("sales").cast("double"))
