"""DuckDB text of the derived views in ``fixtures.py`` (oracle side).

Each entry is a CTE body; ``with_views(sql, *names)`` prefixes a query with
the views it needs (dependencies first).  Keep in step with fixtures.py.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}

VIEWS["campaign_events"] = """
SELECT *, event_id % (SELECT count(*) FROM part) AS campaign_no, event_id // (SELECT count(*) FROM part) AS campaign_round FROM events"""
DEPS["campaign_events"] = ()

VIEWS["ad_base"] = """
SELECT e.event_id, e.ts AS event_dt, e.event_type, e.value,
  CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE CAST(e.user_id AS VARCHAR) END AS user_id,
  p.p_brand AS advertiser, concat('ENT-', p.p_brand) AS entity_id,
  CASE WHEN p.p_partkey % 10 = 0 AND e.campaign_round % 2 = 1 THEN 'EUR' ELSE 'USD' END AS currency_iso_code,
  CASE WHEN p.p_partkey % 10 = 0 AND e.campaign_round % 2 = 1 THEN 'Europe/Berlin' ELSE 'America/New_York' END
    AS advertiser_timezone,
  CASE WHEN p.p_partkey % 2 = 0 THEN concat('cmp ', p.p_name) ELSE concat('cmp ', CAST(p.p_partkey AS VARCHAR)) END
    AS campaign,
  CAST(p.p_partkey AS VARCHAR) AS campaign_id_string,
  CASE WHEN e.event_id % 3 = 0 THEN p.p_name ELSE 'generic' END AS creative,
  CASE p.p_partkey % 4 WHEN 0 THEN 'sponsored_products' WHEN 1 THEN 'sponsored_display'
                       WHEN 2 THEN 'sponsored_brands' ELSE NULL END AS ad_product_type,
  DATE '2024-01-01' AS campaign_start_date, DATE '2024-01-31' AS campaign_end_date,
  CAST(DATE '2024-01-01' + CAST(p.p_partkey % 3 AS INTEGER) AS DATE) AS campaign_start_date_utc,
  CAST(DATE '2024-01-30' + CAST(p.p_partkey % 2 AS INTEGER) AS DATE) AS campaign_end_date_utc
FROM campaign_events e JOIN part p ON p.p_partkey = e.campaign_no"""
DEPS["ad_base"] = ("campaign_events",)

VIEWS["ad_traffic"] = """
SELECT event_dt, user_id, advertiser, entity_id, currency_iso_code, campaign, campaign_id_string, creative,
  ad_product_type, advertiser_timezone, campaign_start_date, campaign_end_date,
  campaign_start_date_utc, campaign_end_date_utc,
  CAST(1 AS BIGINT) AS impressions,
  CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS clicks,
  CAST(round(value * 100) AS BIGINT) * 1000000 AS spend
FROM ad_base WHERE event_type <> 'purchase'"""
DEPS["ad_traffic"] = ("ad_base",)

VIEWS["ad_conversions"] = """
SELECT event_dt, user_id, advertiser, advertiser_timezone, campaign, campaign_id_string, ad_product_type,
  campaign_start_date, campaign_end_date,
  CAST(1 + event_id % 3 AS BIGINT) AS detail_page_view,
  CAST(event_id % 2 AS BIGINT) AS brand_halo_detail_page_view,
  CAST(1 + event_id % 3 + event_id % 2 AS BIGINT) AS total_detail_page_view,
  CAST(1 AS BIGINT) AS purchases,
  CAST(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS brand_halo_purchases,
  CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS total_purchases,
  CAST(value AS DECIMAL(18,2)) AS product_sales,
  CASE WHEN event_id % 7 = 0 THEN CAST(value AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
    AS brand_halo_product_sales,
  CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(value AS DECIMAL(18,2)) END
    AS total_product_sales,
  CAST(1 + event_id % 4 AS BIGINT) AS units_sold,
  CAST(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END * 2 AS BIGINT) AS brand_halo_units_sold,
  CAST(1 + event_id % 4 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END * 2 AS BIGINT) AS total_units_sold,
  CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS new_to_brand_purchases,
  CAST(CASE WHEN event_id % 14 = 0 THEN 1 ELSE 0 END AS BIGINT) AS new_to_brand_brand_halo_purchases,
  CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 14 = 0 THEN 1 ELSE 0 END AS BIGINT)
    AS new_to_brand_total_purchases,
  CASE WHEN event_id % 4 = 0 THEN CAST(value AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
    AS new_to_brand_product_sales,
  CASE WHEN event_id % 4 = 0 AND event_id % 5 <> 0 THEN CAST(value AS DECIMAL(18,2))
       ELSE CAST(0 AS DECIMAL(18,2)) END AS new_to_brand_total_product_sales,
  CASE WHEN event_id % 14 = 0 THEN CAST(value AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
    AS new_to_brand_brand_halo_product_sales
FROM ad_base WHERE event_type = 'purchase'"""
DEPS["ad_conversions"] = ("ad_base",)

VIEWS["conversions_all"] = """
SELECT CAST(campaign_no AS VARCHAR) AS tracked_item, CAST(ts AS DATE) AS event_date_utc,
  CASE WHEN event_type = 'signup' THEN 'snsSubscription'
       WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'firstSnSOrder'
       WHEN event_type = 'purchase' THEN 'repeatSnSOrder'
       ELSE event_type END AS event_subtype,
  CASE WHEN event_id % 2 = 0 THEN 'USD' ELSE 'EUR' END AS purchase_currency,
  CAST(value AS DECIMAL(18,2)) AS total_product_sales, CAST(1 + event_id % 3 AS BIGINT) AS total_units_sold
FROM campaign_events"""
DEPS["conversions_all"] = ("campaign_events",)


VIEWS["ad_events"] = """
SELECT e.event_id, CASE WHEN e.event_id % 13 <> 0 THEN e.user_id END AS user_id, e.ts, CAST(e.ts AS DATE) AS day, e.event_type,
  CAST(e.value AS DECIMAL(18,2)) AS value,
  p.p_partkey AS campaign_id, 'cmp ' || p.p_name AS campaign_name, p.p_brand AS brand,
  CAST(json_extract_string(e.props, '$.k') AS INTEGER) + 1 AS progress,
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 3
       WHEN 0 THEN 'Top of Search' WHEN 1 THEN 'Rest of Search' ELSE 'Product Pages' END END AS placement,
  'grp ' || p.p_type AS ad_group, p.p_name AS targeting,
  CASE WHEN e.event_id % 2 = 0 THEN p.p_partkey ELSE p.p_partkey + 1 END AS bought_item
FROM campaign_events e JOIN part p ON p.p_partkey = e.campaign_no"""
DEPS["ad_events"] = ("campaign_events",)
VIEWS["ad_clicks"] = """
SELECT user_id, ts AS click_ts, campaign_id, campaign_id AS advertised_sku, ad_group, targeting, placement
FROM ad_events WHERE event_type = 'click'"""
DEPS["ad_clicks"] = ("ad_events",)
VIEWS["ad_purchases"] = """
SELECT event_id, user_id, ts, day, brand, bought_item AS sku, value AS sales, CAST(1 + event_id % 3 AS BIGINT) AS units
FROM ad_events WHERE event_type = 'purchase'"""
DEPS["ad_purchases"] = ("ad_events",)
VIEWS["attributed"] = """
SELECT p.*, c.click_ts, c.campaign_id, c.advertised_sku, c.ad_group, c.targeting, c.placement, CAST(c.click_ts AS DATE) AS click_day,
  date_diff('microsecond', c.click_ts, p.ts) AS lag_us
FROM ad_purchases p ASOF JOIN ad_clicks c ON p.user_id = c.user_id AND p.ts >= c.click_ts
WHERE date_diff('microsecond', c.click_ts, p.ts) <= 30 * 86400000000"""
DEPS["attributed"] = ("ad_purchases", "ad_clicks")


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH v1 AS (...), v2 AS (...) <sql>``; ``extra`` adds query-local CTEs
    after the views (in the given order).  ``sql`` must not start with WITH."""
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in _order(names)]
    parts += [f"{k} AS ({v}\n)" for k, v in (extra or {}).items()]
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql
