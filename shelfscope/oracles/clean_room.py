"""DuckDB oracle text for Q1-Q4, written from the report definitions.

Everything stays at the grain of single events as long as possible and is
summed once; the Spark plans reduce to user grain first.  Labels carry the
brand of a campaign's (window, id, currency, ...) rows; an event meets every
label row of its campaign id in its window.  Money is cast to DOUBLE after an
exact sum.
"""

from __future__ import annotations

from ..fixture_sql import with_views
from ..functions.brand import AD_TYPE_CODES, REFERENCE_BRAND_RULES, UNCLASSIFIED
from ..plans.clean_room import CONVERSION_MEASURES, MONEY_SCALE, USER_LEVEL_MEASURES

WS, WE = "time_window_start", "time_window_end"
FIELDS = ("advertiser", "creative", "campaign")


def _period(view: str, start: str, end: str, days: int | None) -> str:
    """Events of the report's span with the ends of their window (lo, hi)."""
    n = f"date_diff('day', DATE '{start}', DATE '{end}')" if days is None else str(days)
    return f"""SELECT v.* EXCLUDE (lo), CAST(lo AS DATE) AS lo, CAST(least(lo + INTERVAL ({n}) DAY, DATE '{end}') AS DATE) AS hi
      FROM (SELECT *, DATE '{start}' + INTERVAL (date_diff('day', DATE '{start}', CAST(event_dt AS DATE)) // {n} * {n}) DAY AS lo
            FROM {view} WHERE event_dt >= TIMESTAMP '{start}' AND event_dt < TIMESTAMP '{end}') v"""


def _brand(rules) -> str:
    """The first rule, in order, whose text any of the fields holds."""
    pats = ", ".join(f"{{'p': '{p}', 'brand': '{b}'}}" for p, b in rules)
    fields = " OR ".join(f"contains(lower({f}), r.p)" for f in FIELDS)
    return f"coalesce(list_filter([{pats}], lambda r: coalesce({fields}, false))[1].brand, '{UNCLASSIFIED}')"


def _base(start: str, end: str, days: int | None, rules) -> dict[str, str]:
    return {
        "seen": _period("ad_traffic", start, end, days),
        "won": _period("ad_conversions", start, end, days),
        "labels": f"""SELECT lo, campaign_id_string AS cid, currency_iso_code AS money, ad_product_type AS kind, max({_brand(rules)}) AS brand
      FROM seen GROUP BY lo, advertiser, campaign, cid, money, kind""",
    }


def _code(kind: str, rest: str) -> str:
    pairs = ", ".join(f"'{raw}': '{code}'" for raw, code in AD_TYPE_CODES)
    return f"coalesce(MAP {{{pairs}}}[{kind}], '{rest}')"


def _typed(m: str, expr: str) -> str:
    return f"CAST({expr} AS {'DOUBLE' if m.endswith('product_sales') else 'BIGINT'}) AS {m}_sum"


def campaign_value_sql(start: str, end: str, days: int | None = None, rules=REFERENCE_BRAND_RULES) -> str:
    none = ", ".join(f"0 AS {m}" for m in CONVERSION_MEASURES)
    measures = ", ".join(CONVERSION_MEASURES)
    touched = f"""SELECT lo, hi, brand, campaign, cid, money, {_code('l.kind', 'undefined_ad_type')} AS kind, user_id, spend, impressions, clicks, {none}
      FROM seen JOIN labels l USING (lo) WHERE cid = campaign_id_string AND user_id IS NOT NULL"""
    bought = f"""SELECT lo, hi, brand, campaign, cid, money,
        CASE WHEN coalesce(won.ad_product_type, 'DSP') = 'DSP' THEN 'DSP' ELSE {_code('won.ad_product_type', 'undefined_ad_type')} END,
        user_id, 0, 0, 0, {measures}
      FROM won JOIN labels l USING (lo) WHERE cid = campaign_id_string AND user_id IS NOT NULL"""
    sums = ",\n  ".join(_typed(m, f"sum({m})") for m in CONVERSION_MEASURES)
    body = f"""SELECT lo AS {WS}, hi AS {WE}, brand, campaign, cid AS campaign_id_string, money AS currency_iso_code, kind AS ad_product_type,
  CAST(sum(spend) AS DOUBLE) / {MONEY_SCALE} AS cost_sum, CAST(sum(impressions) AS BIGINT) AS impressions_sum,
  CAST(sum(clicks) AS BIGINT) AS clicks_sum, count(DISTINCT user_id) AS reach,
  {sums},
  count(DISTINCT user_id) FILTER (total_purchases > 0) AS shoppers_num,
  count(*) FILTER (total_purchases > 0) AS total_orders_count,
  any_value(f.first_day) AS campaign_start_date_utc, any_value(f.last_day) AS campaign_end_date_utc
FROM steps LEFT JOIN flights f USING (lo, cid) GROUP BY ALL"""
    extra = {**_base(start, end, days, rules), "steps": f"{touched}\n      UNION ALL {bought}",
             "flights": """SELECT lo, campaign_id_string AS cid, min(campaign_start_date_utc) AS first_day, max(campaign_end_date_utc) AS last_day
      FROM seen GROUP BY ALL"""}
    return with_views(body, "ad_traffic", "ad_conversions", extra=extra)


def _journeys(start: str, end: str, days: int | None, rules) -> dict[str, str]:
    """One row per window, brand, currency, ad type and user: when they were first
    reached, and the sums.  A campaign's conversions of a user are added to each
    of that user's exposure rows of the campaign, once for every currency they carry."""
    per = ", ".join(f"sum({m}) AS {m}" for m in USER_LEVEL_MEASURES)
    total = ", ".join(f"sum({m}) AS {m}" for m in USER_LEVEL_MEASURES)
    return {
        **_base(start, end, days, rules),
        "exposure": f"""SELECT lo, hi, brand, money, campaign, cid, {_code('seen.ad_product_type', 'SA_other')} AS kind, user_id,
        min(event_dt) AS since, sum(spend) AS spend, sum(impressions) AS impressions, sum(clicks) AS clicks
      FROM seen JOIN labels USING (lo) WHERE cid = campaign_id_string AND user_id IS NOT NULL GROUP BY ALL""",
        "credit": f"""SELECT lo, brand, money AS paid_in, campaign AS sold_by, cid, user_id, {per}
      FROM won JOIN labels USING (lo)
      WHERE cid = campaign_id_string AND user_id IS NOT NULL AND won.ad_product_type IS NOT NULL GROUP BY ALL""",
        "journey": f"""SELECT lo, hi, brand, money, kind, user_id, min(since) AS since, sum(spend) AS spend, sum(impressions) AS impressions,
        sum(clicks) AS clicks, {total}
      FROM exposure LEFT JOIN credit USING (lo, brand, cid, user_id) GROUP BY lo, hi, brand, money, kind, user_id""",
    }


def _journey_report(how: str, name: str) -> str:
    sums = ",\n  ".join(_typed(m, f"sum({m})") for m in USER_LEVEL_MEASURES)
    return f"""SELECT lo AS {WS}, hi AS {WE}, brand, money AS currency_iso_code, {how} AS {name},
  CAST(sum(spend) AS DOUBLE) / {MONEY_SCALE} AS costs, CAST(sum(impressions) AS BIGINT) AS impressions_sum,
  count(DISTINCT user_id) AS reach, CAST(sum(clicks) AS BIGINT) AS clicks_sum,
  {sums}
FROM journey JOIN users USING (lo, brand, user_id) GROUP BY ALL"""


def ad_type_overlap_sql(start: str, end: str, days: int | None = None, rules=REFERENCE_BRAND_RULES) -> str:
    extra = _journeys(start, end, days, rules)
    extra["users"] = "SELECT lo, brand, user_id, list_sort(list(DISTINCT kind)) AS kinds FROM journey GROUP BY ALL"
    return with_views(_journey_report("array_to_string(kinds, ',')", "ad_product_type_overlap"),
                      "ad_traffic", "ad_conversions", extra=extra)


def path_to_purchase_sql(start: str, end: str, days: int | None = None, rules=REFERENCE_BRAND_RULES) -> str:
    extra = _journeys(start, end, days, rules)
    extra["users"] = """SELECT lo, brand, user_id, list_sort(list({'since': since, 'kind': kind, 'money': money})) AS steps
      FROM journey GROUP BY ALL"""
    path = "array_to_string(list_transform(steps, lambda s, i: CAST(i AS VARCHAR) || ':' || s.kind), '>')"
    return with_views(_journey_report(path, "ad_product_path"), "ad_traffic", "ad_conversions", extra=extra)


def subscription_sales_sql() -> str:
    return with_views("""SELECT tracked_item, event_date_utc, event_subtype, purchase_currency,
  CAST(sum(total_product_sales) AS DOUBLE) AS subscription_product_sales,
  CAST(sum(total_units_sold) AS BIGINT) AS qty_subscription
FROM conversions_all
WHERE event_subtype IN ('snsSubscription', 'firstSnSOrder', 'repeatSnSOrder')
GROUP BY tracked_item, event_date_utc, event_subtype, purchase_currency""", "conversions_all")
