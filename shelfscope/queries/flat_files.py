"""Registered flat-file cleaning queries (Q9-Q15, C*) over file-shaped tables
Spark derives from orders / part / lineitem / customer (file name and row
position kept as columns)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import cleaning as cl
from ..plans import flat_files as ff
from ..registry import register
from ..schemas import HERO_COLUMNS

NOW = "2024-06-01 00:00:00"

# ---------------------------------------------------------------------------
# Q9 media plan (V5)

MEDIA_PLAN_SQL = """SELECT o_orderkey AS pos, 'f' || CAST(o_orderkey % 3 AS VARCHAR) AS file_name,
  CASE WHEN o_orderkey % 23 <> 0 THEN '2024-' || CAST(o_orderkey % 9000 AS VARCHAR) END AS ID,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) || ', ' || CAST(o_orderkey AS VARCHAR) || 'x,zz'
       WHEN 1 THEN CAST(o_custkey AS VARCHAR) || ' abc' WHEN 2 THEN 'abc' ELSE NULL END AS PZN FROM orders"""
CODES_SQL = """list_filter(list_transform(string_split(trim(PZN), ','), lambda x: regexp_extract(trim(x), '^(\\d+)', 1)),
                         lambda x: x <> '')"""


def _media_plan(spark, d):
    o = fx.table(spark, d, "orders")
    k = F.col("o_orderkey")
    pzn = (F.when(k % 4 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(", "), k.cast("string"), F.lit("x,zz")))
           .when(k % 4 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(" abc")))
           .when(k % 4 == 2, F.lit("abc")).otherwise(F.lit(None).cast("string")))
    return o.select(k.alias("pos"), F.concat(F.lit("f"), (k % 3).cast("string")).alias("file_name"),
                    F.when(k % 23 != 0, F.concat(F.lit("2024-"), (k % 9000).cast("string"))).alias("ID"), pzn.alias("PZN"))


@register("q9_media_plan", f"""
WITH mp AS ({MEDIA_PLAN_SQL}),
codes AS (SELECT *, {CODES_SQL} AS cl FROM mp),
ex AS (SELECT pos, file_name, ID,
         unnest(CASE WHEN cl IS NULL OR len(cl) = 0 THEN [NULL::VARCHAR] ELSE cl END) AS PZN,
         unnest(CASE WHEN cl IS NULL OR len(cl) = 0 THEN [0] ELSE generate_series(1, len(cl)) END) AS cpos
       FROM codes),
sfx AS (SELECT file_name, PZN,
          CASE WHEN count(*) OVER (PARTITION BY file_name, ID) > 1
               THEN ID || '-' || CAST(row_number() OVER (PARTITION BY file_name, ID ORDER BY pos, cpos) AS VARCHAR)
               ELSE ID END AS ID
        FROM ex)
SELECT DISTINCT file_name, ID, PZN FROM sfx""", "Q9", "C1", "C2", "C7", "W2", "W3", "U3")
def q9_media_plan(spark, d):
    return ff.media_plan(_media_plan(spark, d))


@register("c1_explode_codes", f"""
WITH mp AS ({MEDIA_PLAN_SQL}), codes AS (SELECT *, {CODES_SQL} AS cl FROM mp)
SELECT pos, file_name, ID, unnest(CASE WHEN cl IS NULL OR len(cl) = 0 THEN [NULL::VARCHAR] ELSE cl END) AS PZN
FROM codes""", "C1")
def c1_explode_codes(spark, d):
    return cl.explode_codes(_media_plan(spark, d), "PZN")


# ---------------------------------------------------------------------------
# Q10 sell-out wide -> long (V6), two deliveries; the first in file order wins

SELLOUT_IDS = ["PZN", "Name", "Hersteller", "Darreichungsform", "Packung", "AVP", "AEP"]
DATE_COLS = ["2024-01-01", "2024-01-02", "2024-01-03"]
REDELIVERY_MIN_SIZE = 25


def _sellout_wide(spark, d):
    p = fx.table(spark, d, "part")
    ids = [F.col("p_partkey").cast("string").alias("PZN"), F.col("p_name").alias("Name"),
           F.col("p_brand").alias("Hersteller"), F.col("p_type").alias("Darreichungsform"),
           F.col("p_size").cast("string").alias("Packung"), F.col("p_retailprice").cast("string").alias("AVP"),
           F.col("p_retailprice").cast("string").alias("AEP")]
    size = F.col("p_size").cast("double")

    def vals(k):
        return [F.when(F.col("p_size") < 10, F.lit(None).cast("double")).otherwise(size * k).alias(DATE_COLS[0]),
                (F.col("p_retailprice") * k).alias(DATE_COLS[1]), (size * 2 * k).alias(DATE_COLS[2])]

    a = p.select(*ids, *vals(1), F.lit("sellout_a").alias("file_name"), F.col("p_partkey").alias("pos"))
    b = p.where(F.col("p_size") > REDELIVERY_MIN_SIZE).select(
        *ids, *vals(2), F.lit("sellout_b").alias("file_name"), F.col("p_partkey").alias("pos"))
    return a.unionByName(b)


def _sellout_sql() -> str:
    ids = ("CAST(p_partkey AS VARCHAR) AS PZN, p_name AS Name, p_brand AS Hersteller, p_type AS Darreichungsform, "
           "CAST(p_size AS VARCHAR) AS Packung, CAST(p_retailprice AS VARCHAR) AS AVP, "
           "CAST(p_retailprice AS VARCHAR) AS AEP")

    def branch(k, f, where):
        vals = [f"CASE WHEN p_size < 10 THEN NULL ELSE CAST(p_size AS DOUBLE) * {k} END",
                f"p_retailprice * {k}", f"CAST(p_size AS DOUBLE) * 2 * {k}"]
        return " UNION ALL ".join(
            f"SELECT {ids}, '{dc}' AS Date, {v} AS Value, '{f}' AS file_name, p_partkey AS pos FROM part {where}"
            for dc, v in zip(DATE_COLS, vals))

    return f"""
WITH l AS ({branch(1, 'sellout_a', '')} UNION ALL {branch(2, 'sellout_b', f'WHERE p_size > {REDELIVERY_MIN_SIZE}')}),
r AS (SELECT *, row_number() OVER (PARTITION BY Name, PZN, Hersteller, Date ORDER BY file_name, pos) AS rn FROM l)
SELECT PZN, Name, Hersteller, Darreichungsform, Packung, AVP, AEP, Date, Value FROM r WHERE rn = 1"""


@register("q10_sellout_long", _sellout_sql(), "Q10", "C3", "C8")
def q10_sellout_long(spark, d):
    return ff.sellout_long(_sellout_wide(spark, d), SELLOUT_IDS)


# ---------------------------------------------------------------------------
# Q11 latest inventory: lineitem pivoted by line number, one file per ship day

LINES = range(1, 8)


def _inventory(spark, d):
    li = fx.table(spark, d, "lineitem")
    fname = F.concat(F.lit("inventory_"), F.date_format("l_shipdate", "dd.MM.yy"))
    menge = [F.sum(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(f"{k} Menge") for k in LINES]
    g = li.groupBy(fname.alias("file_name"), "l_orderkey", "l_partkey", "l_suppkey").agg(*menge)
    return g.select("file_name", F.col("l_partkey").cast("string").alias("PZN"),
                    F.col("l_suppkey").cast("string").alias("Pck."),
                    F.concat(F.lit("item "), F.col("l_partkey").cast("string")).alias("Bezeichnung"),
                    *[f"`{k} Menge`" for k in LINES])


@register("q11_latest_inventory", """
WITH latest AS (SELECT max(CAST(l_shipdate AS DATE)) AS d FROM lineitem),
rows AS (SELECT l_orderkey, l_partkey, l_suppkey,
    """ + ", ".join(f"sum(CASE WHEN l_linenumber = {k} THEN l_quantity END) AS m{k}" for k in LINES) + """
  FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT d FROM latest) GROUP BY 1, 2, 3)
SELECT CAST(l_partkey AS VARCHAR) AS PZN, CAST(l_suppkey AS VARCHAR) AS "Pck.",
  'item ' || CAST(l_partkey AS VARCHAR) AS Bezeichnung,
  coalesce(sum(""" + " + ".join(f"coalesce(m{k}, 0)" for k in LINES) + """), 0) AS ORDERED_UNITS,
  (SELECT d FROM latest) AS DATE
FROM rows GROUP BY 1, 2, 3""", "Q11", "C9", "A10")
def q11_latest_inventory(spark, d):
    return ff.latest_inventory(_inventory(spark, d))


# ---------------------------------------------------------------------------
# Q12 market sell-out (orders)

def _market(spark, d):
    o = fx.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("sell_date"),
        F.when(k % 7 == 0, F.lit("[NULL]")).otherwise(F.floor(F.col("o_totalprice") / 1000).cast("string"))
         .alias("units"),
        F.when(k % 11 == 0, F.lit("[NULL]")).otherwise(F.col("o_totalprice").cast("string")).alias("value_eur"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.date_format("o_orderdate", "yyyyMM")).alias("Year Month"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.element_at(F.array(*[F.lit(x) for x in ("n/a", "nan", "5d")]), (k % 3 + 1).cast("int")))
         .otherwise(F.year("o_orderdate").cast("string")).alias("Year"),
        F.when(k % 10 == 0, F.lit(" ")).when(k % 10 == 1, F.lit("NULL"))
         .otherwise(F.concat(F.lit(" SKU-"), F.col("o_custkey").cast("string"), F.lit(" "))).alias("SKU"))


@register("q12_market_sellout", f"""
WITH m AS (SELECT strftime(o_orderdate, '%Y%m%d') AS sell_date,
  CASE WHEN o_orderkey % 7 = 0 THEN '[NULL]' ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) END AS units,
  CASE WHEN o_orderkey % 11 = 0 THEN '[NULL]' ELSE CAST(o_totalprice AS VARCHAR) END AS value_eur,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y%m') END AS "Year Month",
  CASE WHEN o_orderpriority = '5-LOW' THEN (['n/a', 'nan', '5d'])[o_orderkey % 3 + 1] ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "Year",
  CASE WHEN o_orderkey % 10 = 0 THEN ' ' WHEN o_orderkey % 10 = 1 THEN 'NULL'
       ELSE ' SKU-' || CAST(o_custkey AS VARCHAR) || ' ' END AS SKU FROM orders)
SELECT strftime(strptime(sell_date, '%Y%m%d'), '%Y-%m-%d') AS sell_date,
  CASE WHEN units = '[NULL]' THEN NULL ELSE units END AS units,
  CASE WHEN value_eur = '[NULL]' THEN NULL ELSE value_eur END AS value_eur,
  CAST(coalesce(TRY_CAST("Year Month" AS DOUBLE), 0) AS INTEGER) AS "Year Month",
  TRY_CAST("Year" AS DOUBLE) AS "Year", trim(SKU) AS SKU,
  'DE' AS COUNTRY_CODE, TIMESTAMP '{NOW}' AS last_updated_timestamp
FROM m WHERE regexp_full_match("Year", '[0-9]+') AND trim(SKU) <> '' AND lower(trim(SKU)) <> 'null'
""", "Q12", "C10", "C12", "C13", "C14", "F15")
def q12_market_sellout(spark, d):
    return ff.market_sellout(_market(spark, d), "DE", NOW)


# ---------------------------------------------------------------------------
# Q13 promotions tables (orders x customer market)

MARKETS = ["UK", "GB", "US", "DE", "ES", "CN"]


def _promo_flat(spark, d):
    o = fx.table(spark, d, "orders")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    code = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("c_nationkey") % len(MARKETS)) + 1)
    return j.select(
        F.concat(code, F.lit("-")).alias(" country_code "),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("end_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("gmid"),
        F.col("o_orderkey").alias("promo_id"))


def _market_case() -> str:
    return "CASE c_nationkey % 6 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MARKETS)) + " END"


@register("q13_promotions_gb", f"""
SELECT replace({_market_case()} || '-', 'UK', 'GB') AS COUNTRY_CODE,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS START_DATE,
  CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) AS END_DATE,
  CASE WHEN o_orderstatus = 'P' OR o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS GMID,
  o_orderkey AS PROMO_ID
FROM orders JOIN customer ON o_custkey = c_custkey""", "Q13", "C15", "C17", "C21", "F5")
def q13_promotions_gb(spark, d):
    return ff.promotions_table(_promo_flat(spark, d), "GB")


def _promo_cn(spark, d):
    o = fx.table(spark, d, "orders")
    k = F.col("o_orderkey")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select(
        F.col("o_orderpriority").alias("brand"), F.concat(F.lit("dist-"), F.col("o_custkey").cast("string")).alias("distributor"),
        F.when(k % 5 == 0, F.lit("20240132")).otherwise(ymd).cast("bigint").alias("campaign_start_date"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 14), "yyyyMMdd").alias("campaign_end_date"),
        F.concat(F.lit("event "), k.cast("string")).alias("event name"), F.col("o_orderstatus").alias("platform"),
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"), F.lit("tmall").alias("sub_platform"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("gmid"))


@register("q13_promotions_cn", """
WITH s AS (SELECT o_orderpriority AS BRAND, 'dist-' || CAST(o_custkey AS VARCHAR) AS DISTRIBUTOR,
    strftime(TRY_STRPTIME(CASE WHEN o_orderkey % 5 = 0 THEN '20240132' ELSE strftime(o_orderdate, '%Y%m%d') END,
                          '%Y%m%d'), '%Y-%m-%d') AS sd,
    strftime(CAST(o_orderdate AS DATE) + 14, '%Y-%m-%d') AS ed,
    'event ' || CAST(o_orderkey AS VARCHAR) AS EVENT_NAME, o_orderstatus AS PLATFORM,
    'SKU-' || CAST(o_orderkey AS VARCHAR) AS SKU, 'tmall' AS SUB_PLATFORM,
    CASE WHEN o_orderstatus = 'P' OR o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS GMID FROM orders)
SELECT 'NA' AS ASIN, BRAND, 'CN' AS COUNTRY_CODE, DISTRIBUTOR, ed AS END_DATE, EVENT_NAME, GMID, PLATFORM,
  CAST(NULL AS DOUBLE) AS PROMO_DISCOUNT_PERC, sd AS START_DATE, SUB_PLATFORM, SKU FROM s""",
          "Q13", "C11", "C19", "C20")
def q13_promotions_cn(spark, d):
    return ff.promotions_table(_promo_cn(spark, d), "CN")


@register("q13_promotions_media_cn", """
SELECT o_orderpriority AS BRAND, 'dist-' || CAST(o_custkey AS VARCHAR) AS DISTRIBUTOR,
  strftime(TRY_STRPTIME(CASE WHEN o_orderkey % 5 = 0 THEN '20240132' ELSE strftime(o_orderdate, '%Y%m%d') END,
                        '%Y%m%d'), '%Y-%m-%d') AS CAMPAIGN_START_DATE,
  strftime(CAST(o_orderdate AS DATE) + 14, '%Y-%m-%d') AS CAMPAIGN_END_DATE,
  'event ' || CAST(o_orderkey AS VARCHAR) AS "EVENT NAME", o_orderstatus AS PLATFORM,
  'SKU-' || CAST(o_orderkey AS VARCHAR) AS SKU, 'tmall' AS SUB_PLATFORM,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS GMID FROM orders""", "Q13", "C11")
def q13_promotions_media_cn(spark, d):
    return ff.promotions_media(_promo_cn(spark, d), "CN")


# ---------------------------------------------------------------------------
# Q14 sell-in (orders)

@register("q14_sell_in_cn", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'CN' ELSE o_orderstatus END AS MARKET,
  right(ltrim(lpad(CAST(o_custkey * 1000 + o_orderkey % 1000 AS VARCHAR), 12, '0'), '0'), 6) AS GMID,
  o_orderkey AS ORDER_ID, o_totalprice AS NET_SALES
FROM orders""", "Q14", "C16", "C17", "F5")
def q14_sell_in_cn(spark, d):
    o = fx.table(spark, d, "orders")
    gm = F.lpad((F.col("o_custkey") * 1000 + F.col("o_orderkey") % 1000).cast("string"), 12, "0")
    src = o.select(F.when(F.col("o_orderstatus") == "F", F.lit("ZZ")).otherwise(F.col("o_orderstatus")).alias("market"),
                   gm.alias("gmid"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("net_sales"))
    return ff.sell_in(src, "CN")


# ---------------------------------------------------------------------------
# Q15 hero mapping (part)

JP = list(ff.JP_BRANDS_TRANSLATION)


def _jp_case() -> str:
    return ("CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(JP))
            + " ELSE p_brand END")


@register("q15_hero_mapping", f"""
SELECT 'JP' AS COUNTRY_CODE, CAST(NULL AS VARCHAR) AS CATEGORY, CAST(p_partkey AS VARCHAR) AS ASIN,
  'UPC' || CAST(p_partkey AS VARCHAR) AS UPC, 'EAN' || CAST(p_partkey AS VARCHAR) AS EAN,
  CASE p_partkey % 20 """ + " ".join(f"WHEN {i} THEN '{ff.JP_BRANDS_TRANSLATION[b]}'" for i, b in enumerate(JP))
          + f""" ELSE p_brand END AS BRAND,
  p_name AS PRODUCT_TITLE, CASE WHEN p_size < 5 THEN '' ELSE CAST(p_retailprice AS VARCHAR) END AS SHIPPED_COGS,
  p_type AS "SUB-BRAND", 'G' || CAST(p_partkey AS VARCHAR) AS GMID, 'L' || CAST(p_partkey AS VARCHAR) AS LMID,
  'Y' AS AVAILABILITY, CASE WHEN p_size > 40 THEN 'Y' ELSE 'N' END AS HERO, 'hero_2024-06-01.csv' AS FILENAME
FROM part""", "Q15", "C18", "C19", "F15", "S7")
def q15_hero_mapping(spark, d):
    p = fx.table(spark, d, "part")
    k = p.p_partkey.cast("string")
    jp = F.element_at(F.array(*[F.lit(b) for b in JP]), (F.col("p_partkey") % 20 + 1).cast("int"))
    brand = F.when(F.col("p_partkey") % 20 < len(JP), jp).otherwise(F.col("p_brand"))
    src = p.select(F.lit("JP").alias("COUNTRY_CODE"), k.alias("ASIN"), F.concat(F.lit("UPC"), k).alias("UPC"),
                   F.concat(F.lit("EAN"), k).alias("EAN"), brand.alias("BRAND"), F.col("p_name").alias("PRODUCT_TITLE"),
                   F.when(F.col("p_size") < 5, F.lit("-")).otherwise(F.col("p_retailprice").cast("string"))
                    .alias("SHIPPED_COGS"),
                   F.col("p_type").alias("SUB-BRAND"), F.concat(F.lit("G"), k).alias("GMID"),
                   F.concat(F.lit("L"), k).alias("LMID"), F.lit("Y").alias("AVAILABILITY"),
                   F.when(F.col("p_size") > 40, F.lit("Y")).otherwise(F.lit("N")).alias("HERO"))
    return ff.hero_mapping(src, HERO_COLUMNS, "hero_2024-06-01.csv")


# ---------------------------------------------------------------------------
# C25 free-form dates

@register("c25_format_date", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso_date FROM orders""", "C25")
def c25_format_date(spark, d):
    o = fx.table(spark, d, "orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(k % 4 == 1, F.date_format("o_orderdate", "dd.MM.yyyy"))
            .when(k % 4 == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    return o.select("o_orderkey", cl.format_date(text).alias("iso_date"))


# ---------------------------------------------------------------------------
# Warehouse table by name and per-country SQL text with parameters

SELL_IN_SQL = {  # per-country query text (bound parameter :min_total)
    "CN": {"sql_query": "SELECT CASE WHEN o_orderstatus = 'F' THEN 'ZZ' ELSE o_orderstatus END AS market, "
                        "lpad(CAST(o_custkey * 1000 + o_orderkey % 1000 AS STRING), 12, '0') AS gmid, "
                        "o_orderkey AS order_id, o_totalprice AS net_sales "
                        "FROM shelfscope_orders WHERE o_totalprice >= :min_total"},
}
MIN_TOTAL = 1000.0


@register("s6_sell_in_from_country_sql", f"""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'CN' ELSE o_orderstatus END AS MARKET,
  right(ltrim(lpad(CAST(o_custkey * 1000 + o_orderkey % 1000 AS VARCHAR), 12, '0'), '0'), 6) AS GMID,
  o_orderkey AS ORDER_ID, o_totalprice AS NET_SALES
FROM orders WHERE o_totalprice >= {MIN_TOTAL}""", "S5", "S6", "Q14")
def s6_sell_in_from_country_sql(spark, d):
    from ..sources.files import read_table, run_country_sql
    fx.table(spark, d, "orders").createOrReplaceTempView("shelfscope_orders")
    assert read_table(spark, {"table": "shelfscope_orders"}).columns  # S5: table by name
    return ff.sell_in(run_country_sql(spark, SELL_IN_SQL, "CN", {"min_total": MIN_TOTAL}), "CN")


@register("c22_market_filter_projection", f"""
SELECT c_custkey FROM customer WHERE ({_market_case()}) = 'GB'""", "C22")
def c22_market_filter_projection(spark, d):
    # customers whose derived market code is GB (same derivation as p13)
    c = fx.table(spark, d, "customer")
    code = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("c_nationkey") % len(MARKETS)) + 1)
    return c.where(code == "GB").select("c_custkey")


@register("u5_sorted_ship_dates", """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""", "U5")
def u5_sorted_ship_dates(spark, d):
    from ..operators.setops import sorted_dates
    li = fx.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("ship_day"))
    return sorted_dates(li, "ship_day")
