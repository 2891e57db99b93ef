"""Derived input views built by Spark from the driver's tables.

The reference ships no inputs; these views give its operators real tables of
the right shape (FIXTURES.md part C).  Every view is a lazy DataFrame over the
parquet tables, so its size grows with the scale factor.  The matching DuckDB
text of each view lives in ``fixture_sql.py``; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table (a lazy DataFrame)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: str, k: int) -> Column:
    return F.col(c) % F.lit(k)


def campaign_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event on its campaign.  Campaigns are the parts, all of them:
    ``campaign_no`` is event_id modulo the number of parts (a scalar subquery
    of the plan), ``campaign_round`` how often the numbers went round before."""
    n = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    return table(spark, sf_dir, "events").select(
        "*", (F.col("event_id") % n).alias("campaign_no"), F.floor(F.col("event_id") / n).alias("campaign_round"))


def _on_campaign(events: DataFrame, parts: DataFrame) -> DataFrame:
    """Events with their campaign's part.  A merge join: campaigns grow with the data, and the size of a compressed
    file makes them look small enough for a broadcast, one for each use, which all pass through the driver."""
    return events.join(parts.hint("merge"), F.col("p_partkey") == F.col("campaign_no"))


def ad_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: one row per event, attached to its campaign's part."""
    e = campaign_events(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    j = _on_campaign(e, p)
    two_cur = "(p_partkey % 10 = 0 AND campaign_round % 2 = 1)"
    return j.selectExpr(
        "event_id", "ts AS event_dt", "event_type", "value",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id",
        "p_brand AS advertiser", "concat('ENT-', p_brand) AS entity_id",
        f"CASE WHEN {two_cur} THEN 'EUR' ELSE 'USD' END AS currency_iso_code",
        f"CASE WHEN {two_cur} THEN 'Europe/Berlin' ELSE 'America/New_York' END AS advertiser_timezone",
        "CASE WHEN p_partkey % 2 = 0 THEN concat('cmp ', p_name) ELSE concat('cmp ', CAST(p_partkey AS STRING)) END"
        " AS campaign",
        "CAST(p_partkey AS STRING) AS campaign_id_string",
        "CASE WHEN event_id % 3 = 0 THEN p_name ELSE 'generic' END AS creative",
        "CASE p_partkey % 4 WHEN 0 THEN 'sponsored_products' WHEN 1 THEN 'sponsored_display'"
        " WHEN 2 THEN 'sponsored_brands' ELSE CAST(NULL AS STRING) END AS ad_product_type",
        "DATE'2024-01-01' AS campaign_start_date", "DATE'2024-01-31' AS campaign_end_date",
        "date_add(DATE'2024-01-01', CAST(p_partkey % 3 AS INT)) AS campaign_start_date_utc",
        "date_add(DATE'2024-01-30', CAST(p_partkey % 2 AS INT)) AS campaign_end_date_utc",
    )


def ad_traffic(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """V2: impressions/clicks; spend is an integer in 1e-8 currency units."""
    b = (base if base is not None else ad_base(spark, sf_dir)).where(F.col("event_type") != "purchase")
    return b.selectExpr(
        "event_dt", "user_id", "advertiser", "entity_id", "currency_iso_code", "campaign",
        "campaign_id_string", "creative", "ad_product_type", "advertiser_timezone",
        "campaign_start_date", "campaign_end_date", "campaign_start_date_utc", "campaign_end_date_utc",
        "CAST(1 AS BIGINT) AS impressions",
        "CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS clicks",
        "CAST(round(value * 100) AS BIGINT) * 1000000 AS spend",
    )


def ad_conversions(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """V3: attributed conversions (purchase events) with all 18 measures."""
    b = (base if base is not None else ad_base(spark, sf_dir)).where(F.col("event_type") == "purchase")
    sales = "CAST(value AS DECIMAL(18,2))"
    zero = "CAST(0 AS DECIMAL(18,2))"

    def flag(k: int) -> str:
        return f"CASE WHEN event_id % {k} = 0 THEN 1 ELSE 0 END"

    return b.selectExpr(
        "event_dt", "user_id", "advertiser", "advertiser_timezone", "campaign", "campaign_id_string",
        "ad_product_type", "campaign_start_date", "campaign_end_date",
        "CAST(1 + event_id % 3 AS BIGINT) AS detail_page_view",
        "CAST(event_id % 2 AS BIGINT) AS brand_halo_detail_page_view",
        "CAST(1 + event_id % 3 + event_id % 2 AS BIGINT) AS total_detail_page_view",
        "CAST(1 AS BIGINT) AS purchases",
        f"CAST({flag(7)} AS BIGINT) AS brand_halo_purchases",
        "CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS total_purchases",
        f"{sales} AS product_sales",
        f"CASE WHEN event_id % 7 = 0 THEN {sales} ELSE {zero} END AS brand_halo_product_sales",
        f"CASE WHEN event_id % 5 = 0 THEN {zero} ELSE {sales} END AS total_product_sales",
        "CAST(1 + event_id % 4 AS BIGINT) AS units_sold",
        f"CAST({flag(7)} * 2 AS BIGINT) AS brand_halo_units_sold",
        f"CAST(1 + event_id % 4 + {flag(7)} * 2 AS BIGINT) AS total_units_sold",
        f"CAST({flag(4)} AS BIGINT) AS new_to_brand_purchases",
        f"CAST({flag(14)} AS BIGINT) AS new_to_brand_brand_halo_purchases",
        f"CAST({flag(4)} + {flag(14)} AS BIGINT) AS new_to_brand_total_purchases",
        f"CASE WHEN event_id % 4 = 0 THEN {sales} ELSE {zero} END AS new_to_brand_product_sales",
        f"CASE WHEN event_id % 4 = 0 AND event_id % 5 <> 0 THEN {sales} ELSE {zero} END"
        " AS new_to_brand_total_product_sales",
        f"CASE WHEN event_id % 14 = 0 THEN {sales} ELSE {zero} END AS new_to_brand_brand_halo_product_sales",
    )


def conversions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: all conversions with subscription event subtypes."""
    e = campaign_events(spark, sf_dir)
    subtype = (F.when(F.col("event_type") == "signup", F.lit("snsSubscription"))
               .when((F.col("event_type") == "purchase") & (_mod("event_id", 3) == 0), F.lit("firstSnSOrder"))
               .when(F.col("event_type") == "purchase", F.lit("repeatSnSOrder"))
               .otherwise(F.col("event_type")))
    return e.select(
        F.col("campaign_no").cast("string").alias("tracked_item"),
        F.col("ts").cast("date").alias("event_date_utc"),
        subtype.alias("event_subtype"),
        F.when(_mod("event_id", 2) == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("purchase_currency"),
        F.col("value").cast("decimal(18,2)").alias("total_product_sales"),
        (F.lit(1) + _mod("event_id", 3)).cast("bigint").alias("total_units_sold"),
    )


# ---------------------------------------------------------------------------
# vendor report payloads (nested, as the report service returns them)

def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _money(amount: Column, currency: str = "USD") -> Column:
    return F.struct(amount.cast("double").alias("amount"), F.lit(currency).alias("currencyCode"))


def vendor_sales_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of a ``salesByAsin`` array: one per item and day, money as
    struct(amount, currencyCode) (exact decimal sums, then double)."""
    li = table(spark, sf_dir, "lineitem")
    day = F.date_format(F.col("l_shipdate"), "yyyy-MM-dd")
    rev = _dec("l_extendedprice")
    cogs = rev * (F.lit(1).cast("decimal(18,2)") - _dec("l_discount"))
    g = li.groupBy(F.col("l_partkey"), day.alias("day")).agg(
        F.sum(rev).alias("rev"), F.sum(cogs).alias("cogs"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
        F.count_if(F.col("l_returnflag") == "R").alias("returns"),
        F.count_if(F.col("l_linestatus") == "F").alias("shipped"))
    return g.select(
        F.col("l_partkey").cast("string").alias("asin"),
        F.col("day").alias("startDate"), F.col("day").alias("endDate"),
        _money(F.col("rev")).alias("orderedRevenue"),
        F.col("units").alias("orderedUnits"),
        _money(F.col("cogs")).alias("shippedCogs"),
        _money(F.col("rev")).alias("shippedRevenue"),
        F.col("shipped").alias("shippedUnits"),
        F.col("returns").alias("customerReturns"))


# A document never holds more than one salt's share of an order's lines: a
# deterministic hash of the line splits a very large order into this many
# documents (exploding them gives the same rows).
DOC_SALTS = 16


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(DOC_SALTS))


def promotions_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of ``promotions``: one per order (split by a line salt), with
    its lines as ``includedProducts`` (an order without lines has an empty
    array)."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    prod = F.struct(F.col("l_partkey").cast("string").alias("asin"),
                    F.col("l_linenumber").alias("productLine"),
                    F.col("l_quantity").cast("bigint").alias("unitsSold"),
                    F.col("l_extendedprice").alias("revenue"))
    lines = (li.groupBy("l_orderkey", _salt("l_partkey", "l_linenumber", "l_suppkey").alias("__salt"))
             .agg(F.collect_list(prod).alias("includedProducts")))
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("promotionId"),
        F.col("o_orderpriority").alias("type"),
        F.when(F.col("o_orderstatus") == "P", F.lit("null"))
         .otherwise(F.concat(F.lit("FA-"), F.col("o_custkey").cast("string"))).alias("fundingAgreementId"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("startDateTime"),
        F.coalesce(F.col("includedProducts"), F.array().cast(lines.schema["includedProducts"].dataType))
         .alias("includedProducts")))


def coupons_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of ``campaigns``: one per order and line salt (a large order is
    split over DOC_SALTS documents); coupons = a document's lines grouped by
    return flag; asins = the lines of each coupon.  An order without lines has one
    document without coupons."""
    li = table(spark, sf_dir, "lineitem")
    asin = F.struct(F.col("l_partkey").cast("string").alias("asin"),
                    F.col("l_linenumber").alias("lineNumber"),
                    F.col("l_extendedprice").alias("totalDiscount"))
    salt = _salt("l_partkey", "l_linenumber", "l_suppkey").alias("__salt")
    coupons = li.groupBy("l_orderkey", "l_returnflag", salt).agg(F.collect_list(asin).alias("asins"))
    coupon = F.struct(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_returnflag")).alias("couponId"),
                      F.col("l_returnflag").alias("name"), F.col("asins"))
    camps = coupons.groupBy("l_orderkey", "__salt").agg(F.collect_list(coupon).alias("coupons"))
    o = table(spark, sf_dir, "orders")
    return o.join(camps, o.o_orderkey == camps.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("campaignId"),
        F.col("o_orderpriority").alias("name"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("startDateTime"),
        F.col("coupons"))


def search_terms_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of ``dataByDepartmentAndSearchTerm``: term = part name,
    department = part type, one row per clicked item."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    g = (li.join(p, li.l_partkey == p.p_partkey)
         .groupBy("p_type", "p_name", "l_partkey")
         .agg(F.min("l_linenumber").cast("bigint").alias("searchFrequencyRank"),
              F.count(F.lit(1)).alias("clickShareRank"),
              F.sum(_dec("l_discount")).cast("double").alias("clickShare"),
              F.sum(_dec("l_tax")).cast("double").alias("conversionShare")))
    return g.select(F.col("p_type").alias("departmentName"), F.col("p_name").alias("searchTerm"),
                    "searchFrequencyRank", F.col("l_partkey").cast("string").alias("clickedAsin"),
                    F.col("p_name").alias("clickedItemName"), "clickShareRank", "clickShare", "conversionShare")


def catalog_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog ``items``: asin with one-element ``summaries`` and
    ``vendorDetails`` arrays (parts)."""
    p = table(spark, sf_dir, "part")
    summ = F.struct(F.col("p_brand").alias("brand"), F.col("p_name").alias("itemName"),
                    F.col("p_type").alias("manufacturer"),
                    F.struct(F.col("p_type").alias("displayName"),
                             F.lower(F.col("p_type")).alias("value")).alias("productCategory"),
                    F.lit("2024-01-15").alias("releaseDate"), F.col("p_size").cast("string").alias("size"))
    vend = F.struct(F.col("p_brand").alias("brandCode"), F.col("p_type").alias("manufacturerCode"),
                    F.lit("BASIC").alias("replenishmentCategory"), F.col("p_name").alias("brand"))
    return p.select(F.col("p_partkey").cast("string").alias("asin"),
                    F.array(summ).alias("summaries"), F.array(vend).alias("vendorDetails"))


# ---------------------------------------------------------------------------
# ad events for the declared reports (R*)

PLACEMENTS = ["Top of Search", "Rest of Search", "Product Pages"]


def ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event on its campaign: views and clicks are impressions, clicks
    cost their value, purchases buy an item; ``progress`` (1-100 from the
    event properties) drives the video funnel.  Some users and placements are
    not known (NULL).  Half of the clicks lead to the campaign's own item, the
    others buy the item of the next campaign number (``bought_item``)."""
    e = campaign_events(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = _on_campaign(e, p)
    prog = F.get_json_object("props", "$.k").cast("int")
    place = F.element_at(F.array(*[F.lit(x) for x in PLACEMENTS]), (prog % len(PLACEMENTS) + 1).cast("int"))
    return j.select(
        "event_id", F.when(_mod("event_id", 13) != 0, F.col("user_id")).alias("user_id"),
        "ts", F.col("ts").cast("date").alias("day"), "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.col("p_partkey").alias("campaign_id"), F.concat(F.lit("cmp "), F.col("p_name")).alias("campaign_name"),
        F.col("p_brand").alias("brand"), (prog + 1).alias("progress"),
        F.when(_mod("event_id", 17) != 0, place).alias("placement"),
        F.concat(F.lit("grp "), F.col("p_type")).alias("ad_group"), F.col("p_name").alias("targeting"),
        F.when(_mod("event_id", 2) == 0, F.col("p_partkey")).otherwise(F.col("p_partkey") + 1).alias("bought_item"))


def ad_clicks(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("ts").alias("click_ts"), "campaign_id", F.col("campaign_id").alias("advertised_sku"),
        "ad_group", "targeting", "placement")


def ad_purchases(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", "day", "brand", F.col("bought_item").alias("sku"),
        F.col("value").alias("sales"), (F.lit(1) + _mod("event_id", 3)).cast("bigint").alias("units"))
