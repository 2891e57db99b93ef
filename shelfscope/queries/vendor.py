"""Registered vendor-report queries (Q5-Q8, F*, S12) over nested payloads
that Spark builds from lineitem / orders / part.  Oracles are flat SQL over
the same tables (joins instead of nesting + explode)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import normalize as nz
from ..plans import vendor as v
from ..registry import register
from ..sources.payload import NO_DATA_ERRORS, classify_payload

COUNTRY = "US"
NOW = "2024-06-01 00:00:00"
START, END = "2024-01-01", "2024-01-07"
OWN_MIN_SIZE = 25  # the vendor's own catalog: parts with p_size > 25

SALES_AGG = """SELECT l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day,
   sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev,
   sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)))) AS cogs,
   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
   count(*) FILTER (WHERE l_returnflag = 'R') AS returns,
   count(*) FILTER (WHERE l_linestatus = 'F') AS shipped
 FROM lineitem GROUP BY 1, 2"""


@register("q5_vendor_sales_report", f"""
WITH g AS ({SALES_AGG})
SELECT CAST(l_partkey AS VARCHAR) AS ASIN, '{COUNTRY}' AS COUNTRY_CODE, returns AS CUSTOMERRETURNS,
  CAST(day AS DATE) AS ENDDATE, TIMESTAMP '{NOW}' AS LAST_UPDATED_TIMESTAMP,
  CAST(rev AS DOUBLE) AS ORDEREDREVENUE, 'USD' AS ORDEREDREVENUE_CURRENCYCODE, units AS ORDEREDUNITS,
  CAST(cogs AS DOUBLE) AS SHIPPEDCOGS, 'USD' AS SHIPPEDCOGS_CURRENCYCODE,
  CAST(rev AS DOUBLE) AS SHIPPEDREVENUE, 'USD' AS SHIPPEDREVENUE_CURRENCYCODE,
  shipped AS SHIPPEDUNITS, CAST(day AS DATE) AS STARTDATE
FROM g""", "Q5", "F1", "F6", "F7", "F8", "F13", "F17", "F18")
def q5_vendor_sales_report(spark, d):
    return v.vendor_report(fx.vendor_sales_records(spark, d), COUNTRY, NOW)


@register("f3_promotions_report", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS PROMOTIONID, o_orderpriority AS TYPE,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'FA-' || CAST(o_custkey AS VARCHAR) END AS FUNDINGAGREEMENTID,
  CAST(o_orderdate AS TIMESTAMP) AS STARTDATETIME,
  CAST(l_partkey AS VARCHAR) AS ASIN, l_linenumber AS PRODUCTLINE, CAST(l_quantity AS BIGINT) AS UNITSSOLD,
  l_extendedprice AS REVENUE, '{COUNTRY}' AS COUNTRY_CODE, TIMESTAMP '{NOW}' AS LAST_UPDATED_TIMESTAMP
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""", "Q6", "F3", "F5", "F9", "F15")
def f3_promotions_report(spark, d):
    return v.promotions_report(fx.promotions_payload(spark, d), COUNTRY, NOW)


@register("f4_coupons_report", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS CAMPAIGNID, l_returnflag AS NAME,
  CAST(o_orderdate AS TIMESTAMP) AS STARTDATETIME,
  CASE WHEN l_orderkey IS NULL THEN NULL ELSE CAST(l_orderkey AS VARCHAR) || '-' || l_returnflag END AS COUPONID,
  CAST(l_partkey AS VARCHAR) AS ASIN, l_linenumber AS LINENUMBER, l_extendedprice AS TOTALDISCOUNT,
  '{COUNTRY}' AS COUNTRY_CODE, TIMESTAMP '{NOW}' AS LAST_UPDATED_TIMESTAMP,
  0 AS TOTALBUDGETSPENT, 0 AS TOTALBUDGETREMAINING, 0 AS TOTALBUDGET
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""", "Q6", "F4", "F14")
def f4_coupons_report(spark, d):
    # campaign and coupon both carry ``name``: the child's value replaces the
    # parent's in the flattened table (F3 rule)
    return v.coupons_report(fx.coupons_payload(spark, d), COUNTRY, NOW)


SEARCH_AGG = f"""SELECT p_type, p_name, l_partkey, CAST(min(l_linenumber) AS BIGINT) AS sfr, count(*) AS csr,
   CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS cs, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS cv
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"""


@register("q7_own_search_terms", f"""
WITH s AS ({SEARCH_AGG})
SELECT CAST(l_partkey AS VARCHAR) AS CLICKEDASIN, p_name AS CLICKEDITEMNAME, cs AS CLICKSHARE, csr AS CLICKSHARERANK,
  cv AS CONVERSIONSHARE, '{COUNTRY}' AS COUNTRY_CODE, p_type AS DEPARTMENTNAME, DATE '{END}' AS ENDDATE,
  TIMESTAMP '{NOW}' AS LAST_UPDATED_TIMESTAMP, sfr AS SEARCHFREQUENCYRANK, p_name AS SEARCHTERM,
  DATE '{START}' AS STARTDATE
FROM s JOIN (SELECT CAST(p_partkey AS VARCHAR) AS asin FROM part WHERE p_size > {OWN_MIN_SIZE}) c
  ON CAST(l_partkey AS VARCHAR) = c.asin""", "Q7", "F10", "F19", "J1")
def q7_own_search_terms(spark, d):
    own = fx.table(spark, d, "part").where(F.col("p_size") > OWN_MIN_SIZE).select(
        F.col("p_partkey").cast("string").alias("asin"))
    return v.own_search_terms(fx.search_terms_payload(spark, d), own, START, END, COUNTRY, NOW)


@register("q8_build_catalog", f"""
WITH wanted AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS asin FROM lineitem)
SELECT CAST(p_partkey AS VARCHAR) AS ASIN, p_name AS BRAND, p_name AS ITEMNAME, p_type AS MANUFACTURER,
  p_type AS PRODUCTCATEGORY_DISPLAYNAME, lower(p_type) AS PRODUCTCATEGORY_VALUE, DATE '2024-01-15' AS RELEASEDATE,
  CAST(p_size AS VARCHAR) AS SIZE, p_brand AS BRANDCODE, p_type AS MANUFACTURERCODE,
  'BASIC' AS REPLENISHMENTCATEGORY, '{COUNTRY}' AS COUNTRY_CODE, TIMESTAMP '{NOW}' AS LAST_UPDATED_TIMESTAMP
FROM part WHERE CAST(p_partkey AS VARCHAR) IN (SELECT asin FROM wanted)""", "Q8", "U2", "F2", "F11")
def q8_build_catalog(spark, d):
    sales = v.vendor_report(fx.vendor_sales_records(spark, d), COUNTRY, NOW)
    own = fx.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("asin"))
    terms = v.own_search_terms(fx.search_terms_payload(spark, d), own, START, END, COUNTRY, NOW)
    return v.build_catalog(fx.catalog_items(spark, d), [sales, terms.withColumnRenamed("CLICKEDASIN", "ASIN")],
                           COUNTRY, NOW, key="asin")


_KNOWN = NO_DATA_ERRORS[0].replace("'", "''")


@register("s12_classify_payload", f"""
WITH days AS (SELECT CAST(d AS DATE) AS report_day FROM (
    SELECT unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS d
    FROM lineitem)),
n AS (SELECT CAST(l_shipdate AS DATE) AS report_day, count(*) AS n_records FROM lineitem GROUP BY 1)
SELECT days.report_day, coalesce(n.n_records, 0) AS n_records,
  CASE WHEN n.n_records IS NULL THEN '{_KNOWN}' END AS errorDetails,
  CASE WHEN n.n_records IS NULL THEN 'EMPTY' ELSE 'DATA' END AS payload_status
FROM days LEFT JOIN n ON days.report_day = n.report_day""", "S12")
def s12_classify_payload(spark, d):
    li = fx.table(spark, d, "lineitem").withColumn("report_day", F.col("l_shipdate").cast("date"))
    cal = li.agg(F.min("report_day").alias("s"), F.max("report_day").alias("e")).select(
        F.explode(F.sequence("s", "e")).alias("report_day"))
    n = li.groupBy("report_day").agg(F.count(F.lit(1)).alias("n_records"))
    docs = cal.join(n, "report_day", "left").select(
        "report_day", F.coalesce("n_records", F.lit(0)).alias("n_records"),
        F.when(F.col("n_records").isNull(), F.lit(NO_DATA_ERRORS[0])).alias("errorDetails"),
        # only emptiness matters to the classifier: a one-element marker
        F.when(F.col("n_records").isNull(), F.array().cast("array<int>"))
         .otherwise(F.array(F.lit(1))).alias("salesByAsin"))
    return classify_payload(docs, "salesByAsin", fail_on_error=True).drop("salesByAsin")


@register("f5_upper_trim_columns", f"""
SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_mktsegment AS SEGMENT FROM customer""", "F5", "F16")
def f5_upper_trim_columns(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias(" c_name "), "c_mktsegment")
    c = nz.rename_columns(c, {"c_mktsegment": "segment", "not_there": "x"})
    return nz.upper_columns(c, trim=True)


@register("f12_union_missing_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS asin, p_brand AS brand, CAST(NULL AS VARCHAR) AS color
FROM part WHERE p_size <= 25
UNION ALL
SELECT CAST(p_partkey AS VARCHAR) AS asin, p_brand AS brand, split_part(p_name, ' ', 1) AS color
FROM part WHERE p_size > 25""", "F12", "U3")
def f12_union_missing_columns(spark, d):
    # catalog answers arrive batch by batch; a later batch may carry a field
    # (here ``color``) the earlier ones lack
    p = fx.table(spark, d, "part")
    a = p.where(F.col("p_size") <= 25).select(F.col("p_partkey").cast("string").alias("asin"),
                                              F.col("p_brand").alias("brand"))
    b = p.where(F.col("p_size") > 25).select(F.col("p_partkey").cast("string").alias("asin"),
                                             F.col("p_brand").alias("brand"),
                                             F.split(F.col("p_name"), " ").getItem(0).alias("color"))
    return nz.union_missing([a, b])
