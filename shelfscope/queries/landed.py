"""Registered queries over landed files of more than one layout: each lands
files that Spark derives from the driver's tables in a fresh folder of the shared
checkpoint folder and reads, archives or uploads them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import sinks
from ..plans import flat_files as ff
from ..registry import register
from ..sources import files as src
from .flat_files import LINES
from .io import _scratch


def _two_layouts(spark, d, root: str, name: str) -> list[str]:
    """Even parts as columns KEY, NAME; odd ones as NAME, KEY, SIZE."""
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("KEY"), F.col("p_name").alias("NAME"), F.col("p_size").alias("SIZE"))
    paths = [f"{root}/{name}_a_03.02.24.csv", f"{root}/{name}_b_03.02.24.csv"]
    p.where("KEY % 2 = 0").select("KEY", "NAME").write.option("header", True).csv(paths[0])
    p.where("KEY % 2 = 1").select("NAME", "KEY", "SIZE").write.option("header", True).csv(paths[1])
    return paths


LAYOUTS_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS KEY, p_name AS NAME,
  CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size AS VARCHAR) END AS SIZE FROM part"""


@register("s8_files_of_two_layouts", LAYOUTS_SQL, "S8", "C4")
def s8_files_of_two_layouts(spark, d):
    paths = _two_layouts(spark, d, _scratch(spark, "layouts"), "parts")
    return src.read_all(spark, paths).select("KEY", "NAME", "SIZE")


@register("s9_latest_dated_files", LAYOUTS_SQL.replace("FROM part", ", DATE '2024-02-03' AS file_date FROM part"), "S9")
def s9_latest_dated_files(spark, d):
    root = _scratch(spark, "dated")
    _two_layouts(spark, d, root, "parts")
    old = fx.table(spark, d, "part").select(F.lit("old").alias("KEY"), F.col("p_name").alias("NAME"))
    old.write.option("header", True).csv(f"{root}/parts_31.12.99.csv")  # later as text, earlier as a date
    return src.read_latest_dated(spark, root).select("KEY", "NAME", "SIZE", "file_date")


@register("s7_latest_weekly_file", """
SELECT strftime(max(CAST(CAST(l_shipdate AS DATE) - CAST((dayofweek(l_shipdate) + 1) % 7 AS INTEGER) AS DATE)), '%Y-%m-%d') AS file_date
FROM lineitem""", "S7", "K2")
def s7_latest_weekly_file(spark, d):
    from ..operators.planning import last_saturday
    li = fx.table(spark, d, "lineitem")
    weekly = (li.groupBy(last_saturday(F.col("l_shipdate").cast("date")).alias("ENDDATE"))
              .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("UNITS")))
    root = _scratch(spark, "weekly")
    sinks.write_dated_many(weekly, root, "sp_sales", "ENDDATE")
    return src.latest_file(spark, root).select("file_date")


@register("s11_landed_file_names", """
SELECT DISTINCT 'parts_' || v || '_03.02.24' AS name FROM part JOIN (VALUES ('a', 0), ('b', 1)) t(v, odd) ON p_partkey % 2 = odd""", "S11")
def s11_landed_file_names(spark, d):
    root = _scratch(spark, "names")
    _two_layouts(spark, d, root, "parts")
    return src.landed_names(spark, root)


@register("k4_archive_two_layouts", LAYOUTS_SQL, "K4")
def k4_archive_two_layouts(spark, d):
    root = _scratch(spark, "archive")
    paths = _two_layouts(spark, d, root, "parts")
    sinks.archive_csv(spark, paths, root + "/processed")
    return spark.read.parquet(root + "/processed").select("KEY", "NAME", "SIZE")


@register("k1_reports_by_date", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS day, o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY 1, 2""", "K1", "K6")
def k1_reports_by_date(spark, d):
    o = fx.table(spark, d, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("day"), F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("orders"))
    root = _scratch(spark, "by-date")
    sinks.write_by_date(o, root, "day")
    sinks.write_by_date(o.where("day >= '1996-01-01'"), root, "day")  # an incremental load replaces the dates it carries
    return (spark.read.option("header", True).schema("orders bigint, priority string, day date").csv(root)
            .select("day", "priority", "orders"))


@register("k3_upload_with_data_date", """
SELECT CAST(c_custkey AS VARCHAR) AS customer, c_name AS name FROM customer""", "K3")
def k3_upload_with_data_date(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_name").alias("name"))
    last = fx.table(spark, d, "orders").agg(F.max(F.col("o_orderdate").cast("date")).alias("day"))
    root = _scratch(spark, "upload")
    day = last.scalar()
    path = sinks.upload_with_data_date(c.withColumn("day", day), root, sinks.FEED_TEMPLATE, "US", "customers", "day")
    return src.read_report_csv(spark, path).select("customer", "name")


@register("r14_star_from_feeds", """
SELECT n_name AS store_nation, p_type AS item_type, p_brand AS brand, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2, 3, 4""", "R14", "K1")
def r14_star_from_feeds(spark, d):
    """One incremental feed (sales by month, a second load replaces the months it
    carries) and three snapshots (items, products, stores), landed and joined."""
    from ..plans import reports as r
    root = _scratch(spark, "omni")
    li = fx.table(spark, d, "lineitem").select(
        "l_partkey", "l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("bigint").alias("qty"))
    last = F.col("month") >= "1998-01-01"
    sinks.write_by_date(li.where(~last).unionByName(li.where(last).limit(5)), root + "/sales", "month", fmt="parquet")
    sinks.write_by_date(li.where(last), root + "/sales", "month", fmt="parquet")
    part = fx.table(spark, d, "part")
    snapshots = {"items": part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("item_type")),
                 "products": part.select(F.col("p_partkey").alias("product"), F.col("p_brand").alias("brand")),
                 "stores": fx.table(spark, d, "supplier").join(fx.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                 .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("store_nation"))}
    for name, df in snapshots.items():
        for load in (df.limit(3), df):  # a snapshot replaces the one before
            load.write.mode("overwrite").parquet(f"{root}/{name}")
    items, products, stores = (spark.read.parquet(f"{root}/{x}") for x in snapshots)
    items = items.join(products, F.col("l_partkey") == F.col("product")).drop("product")
    out = r.omni_star(spark.read.parquet(root + "/sales"), items, stores, "l_partkey", "l_suppkey",
                      ["store_nation", "item_type", "brand", "month"], {"sales": "price", "units": "qty"})
    return out.withColumn("sales", F.col("sales").cast("double"))


@register("s5_table_by_name", "SELECT p_partkey, p_name FROM part", "S5")
def s5_table_by_name(spark, d):
    name = "landed_" + _scratch(spark, "t").rsplit("-", 1)[1]
    fx.table(spark, d, "part").createOrReplaceTempView(name)
    return src.read_table(spark, {"database": "", "schema": "", "table": name}).select("p_partkey", "p_name")


# ---------------------------------------------------------------------------
# Q10 on files (C3, C4, C5, C8): every file has two header rows, its own dates and a footer

BUCKETS = 1  # least number of files of a delivery
ROWS_A_FILE = 2_000_000  # a file is written by one task (first row, footer) and read by many


def _sellout_files(spark, d, path: str, dates: list[str], factor: int, where: str) -> None:
    ids = ["PZN", "Name", "Hersteller", "Form", "Pack", "AVP", "AEP"]
    p = fx.table(spark, d, "part").where(where)
    n = max(BUCKETS, -(-p.count() // ROWS_A_FILE))
    rows = p.select(
        F.expr(f"pmod(xxhash64(p_partkey), {n})").alias("bucket"), F.col("p_partkey").alias("ord"),
        F.col("p_partkey").cast("string").alias("c0"), F.col("p_name").alias("c1"), F.col("p_brand").alias("c2"),
        F.col("p_type").alias("c3"), F.col("p_size").cast("string").alias("c4"), F.lit("1").alias("c5"), F.lit("2").alias("c6"),
        F.when(F.col("p_size") >= 10, F.col("p_size") * factor).cast("string").alias("c7"),
        F.when(F.col("p_size") % 9 == 0, F.lit("n/a")).otherwise((F.col("p_size") * 2 * factor).cast("string")).alias("c8"),
        F.lit("x").alias("c9"))
    files = rows.select("bucket").distinct()
    lit = lambda vals: [F.lit(v).alias(f"c{i}") for i, v in enumerate(vals)]
    head = files.select("bucket", F.lit(-1).cast("bigint").alias("ord"), *lit([*ids, None, None, None]))
    feet = [files.select("bucket", F.lit((1 << 62) + k).alias("ord"), *lit([w, *[None] * 9])) for k, w in enumerate(("Sum", "end"))]
    out = rows.unionByName(head).unionByName(feet[0]).unionByName(feet[1])
    names = [*"ABCDEFG", *dates, "Total"]
    (out.repartition(n, "bucket").sortWithinPartitions("bucket", "ord")
        .select("bucket", *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
        .write.option("header", True).partitionBy("bucket").csv(path))


def _sellout_files_sql() -> str:
    def rows(dates, factor, file, where):
        ids = "CAST(p_partkey AS VARCHAR) AS PZN, p_name AS Name, p_brand AS Hersteller, p_type AS Form, CAST(p_size AS VARCHAR) AS Pack, '1' AS AVP, '2' AS AEP"
        vals = (f"CASE WHEN p_size >= 10 THEN p_size * {factor} END", f"CASE WHEN p_size % 9 <> 0 THEN p_size * 2 * {factor} END")
        return [f"SELECT {ids}, '{day}' AS Date, CAST({v} AS DOUBLE) AS Value, {file} AS f FROM part WHERE {where}" for day, v in zip(dates, vals)]
    both = rows(["2024-01-01", "2024-01-02"], 1, 1, "true") + rows(["2024-01-02", "2024-02-01"], 3, 2, "p_size > 25")
    return f"""SELECT * EXCLUDE (f, nth) FROM (SELECT *, row_number() OVER (PARTITION BY Name, PZN, Hersteller, Date ORDER BY f) AS nth
      FROM ({" UNION ALL ".join(both)})) WHERE nth = 1"""


@register("q10_sellout_from_files", _sellout_files_sql(), "Q10", "C3", "C4", "C5", "C8")
def q10_sellout_from_files(spark, d):
    root = _scratch(spark, "sellout")
    _sellout_files(spark, d, root + "/1_january", ["2024-01-01", "2024-01-02"], 1, "true")
    _sellout_files(spark, d, root + "/2_february", ["2024-01-02", "2024-02-01"], 3, "p_size > 25")
    one, two = (src.read_two_row_header_csv(spark, f"{root}/{x}") for x in ("1_january", "2_february"))
    # deliveries in order: Spark names part files itself, so the delivery stands in front of the name
    groups = [g.withColumn("file_name", F.concat(F.lit(f"{k}/"), F.col("file_name"))) for k, gs in enumerate((one, two)) for g in gs]
    return ff.sellout_files_long(groups)


@register("q11_latest_inventory_files", """
WITH m AS (SELECT max(date_trunc('month', l_shipdate)) AS d FROM lineitem)
SELECT CAST(l_partkey AS VARCHAR) AS PZN, CAST(l_suppkey AS VARCHAR) AS "Pck.", 'item ' || CAST(l_partkey AS VARCHAR) AS Bezeichnung,
  sum(CAST(l_quantity AS DOUBLE)) AS ORDERED_UNITS, CAST((SELECT d FROM m) AS DATE) AS DATE
FROM lineitem WHERE date_trunc('month', l_shipdate) = (SELECT d FROM m) GROUP BY 1, 2, 3""", "Q11", "S9", "C6", "C9", "A10")
def q11_latest_inventory_files(spark, d):
    """One folder a month; the files of one half of the suppliers carry their
    names in the first row, under a header of other names."""
    li = fx.table(spark, d, "lineitem")
    month = F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "month"), "dd.MM.yy")
    names = ["PZN", "Pck.", "Bezeichnung", *[f"{k} Menge" for k in LINES]]
    rows = li.select(
        F.concat(F.lit("inventory_"), month, F.lit(".csv")).alias("file"), (F.col("l_suppkey") % 2).alias("odd"),
        F.xxhash64("l_orderkey", "l_linenumber").alias("deal"),
        F.lit(1).alias("ord"), F.col("l_partkey").cast("string").alias("c0"), F.col("l_suppkey").cast("string").alias("c1"),
        F.concat(F.lit("item "), F.col("l_partkey").cast("string")).alias("c2"),
        *[F.when(F.col("l_linenumber") == k, F.col("l_quantity")).cast("string").alias(f"c{2 + i}") for i, k in enumerate(LINES, 1)])
    root = _scratch(spark, "inventory")
    plain = rows.where("odd = 0").select("file", *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    sinks.gathered(plain, "file").write.option("header", True).partitionBy("file").csv(root + "/plain")
    odd = rows.where("odd = 1").drop("odd")
    pieces = odd.groupBy("file").agg(F.ceil(F.count("*") / ROWS_A_FILE).alias("pieces"))
    n = pieces.agg(F.sum("pieces")).first()[0] or 1
    head = pieces.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("ord"),
                         *[F.lit(v).alias(f"c{i}") for i, v in enumerate(names)])
    odd = odd.join(pieces, "file", "left").withColumn("piece", F.expr("pmod(deal, coalesce(pieces, 1))")).drop("deal", "pieces")
    # a file's first row must stay its first: one task a file here, of which a month has as many as its rows need
    (odd.unionByName(head).repartition(n, "file", "piece").sortWithinPartitions("file", "piece", "ord").drop("ord")
        .write.option("header", True).partitionBy("file", "piece").csv(root + "/named"))
    date, paths = src.latest_dated_paths(spark, root)
    rows = src.read_report_csv(spark, paths, keep_position=True, path_col="path")
    return ff.latest_inventory_files(rows, date)
