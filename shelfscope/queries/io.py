"""Registered source / stream queries: derived tables are landed as files
(JSON Lines gzip, ORC, CSV) in a fresh folder under the shared checkpoint
folder, read back with our readers, and normalised; each has the same
oracle as the direct query, so the file round trip is checked exactly."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..plans import flat_files as ff
from ..plans import vendor as v
from ..registry import REGISTRY, register
from ..session import scratch_path, shuffles_dropped
from ..sources import files as src
from ..streaming.ingest import start_ingest
from .flat_files import _market
from .vendor import COUNTRY, NOW

Q5_SQL = REGISTRY["q5_vendor_sales_report"].oracle
Q12_SQL = REGISTRY["q12_market_sellout"].oracle


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _land_sales_json(spark, d) -> tuple[str, object]:
    """One document per record: ``{"salesByAsin": [record]}`` (gzip JSON Lines)."""
    rec = fx.vendor_sales_records(spark, d)
    docs = rec.select(F.array(F.struct(*rec.columns)).alias("salesByAsin"))
    path = _scratch(spark, "landing-sales")
    docs.write.mode("overwrite").option("compression", "gzip").json(path)
    return path, docs.schema


@register("s1_vendor_report_from_json", Q5_SQL, "S1", "Q5")
def s1_vendor_report_from_json(spark, d):
    path, schema = _land_sales_json(spark, d)
    records = src.read_report_json(spark, path, key="salesByAsin", schema=schema, multi_line=False)
    return v.vendor_report(records, COUNTRY, NOW)


@register("s2_vendor_report_from_orc", Q5_SQL, "S2", "S4")
def s2_vendor_report_from_orc(spark, d):
    path = _scratch(spark, "landing-orc") + "/sales.orc"
    fx.vendor_sales_records(spark, d).write.mode("overwrite").orc(path)
    return v.vendor_report(src.read_report(spark, path), COUNTRY, NOW)


@register("s3_market_sellout_from_csv", Q12_SQL, "S3", "Q12")
def s3_market_sellout_from_csv(spark, d):
    path = _scratch(spark, "landing-csv")
    _market(spark, d).write.mode("overwrite").option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    raw = src.read_report_csv(spark, path, keep_position=True).drop(src.FILE_COL, src.POS_COL)
    return ff.market_sellout(raw, "DE", NOW)


@register("s3_market_sellout_skipped_rows", Q12_SQL, "S3", "S4", "Q12")
def s3_market_sellout_skipped_rows(spark, d):
    """A title line above the header of every file; the suffix picks the reader."""
    path = _scratch(spark, "landing-titled") + "/sellout.csv"
    m = _market(spark, d)
    (m.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path + ".plain"))
    titled = spark.read.text(path + ".plain").select("value", F.xxhash64(F.input_file_name()).alias("part"), F.monotonically_increasing_id().alias("n"))
    title = titled.groupBy("part").agg(F.min("n").alias("n")).select(F.lit('"Sell-out, all stores"').alias("value"), "part", (F.col("n") - 1).alias("n"))
    (titled.union(title).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortWithinPartitions("part", "n")
        .select("value", "part").write.partitionBy("part").text(path))
    raw = src.read_report(spark, path, skiprows=1)
    return ff.market_sellout(raw, "DE", NOW)


@register("t1_stream_vendor_report", Q5_SQL, "T1")
def t1_stream_vendor_report(spark, d):
    landing, schema = _land_sales_json(spark, d)
    out = _scratch(spark, "ingest-out")
    q = start_ingest(spark, landing, schema, "salesByAsin", out, COUNTRY, NOW,
                     checkpoint=_scratch(spark, "ingest-ckpt"), partition_by=None)
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@register("s11_landed_weekly_reports", """
SELECT DISTINCT strftime(CAST(CAST(l_shipdate AS DATE) - CAST((dayofweek(l_shipdate) + 1) % 7 AS INTEGER) AS DATE),
                         '%Y-%m-%d') AS landed_date
FROM lineitem""", "S11", "K1", "K2")
def s11_landed_weekly_reports(spark, d):
    from ..operators.planning import last_saturday
    from ..sinks import write_dated_many
    li = fx.table(spark, d, "lineitem")
    weekly = (li.groupBy(F.col("l_partkey").cast("string").alias("ASIN"),
                         last_saturday(F.col("l_shipdate").cast("date")).alias("ENDDATE"))
              .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("ORDEREDUNITS")))
    root = _scratch(spark, "landed-weekly") + "/vendor/US/sp_sales_weekly"
    write_dated_many(weekly, root, "sp_sales_weekly", "ENDDATE")
    return src.landed_dates(spark, root)


Q7_SQL = REGISTRY["q7_own_search_terms"].oracle


@register("s10_search_terms_from_json", Q7_SQL, "S10", "Q7")
def s10_search_terms_from_json(spark, d):
    from .vendor import END, OWN_MIN_SIZE, START
    rec = fx.search_terms_payload(spark, d)
    # one record per document (no grouping, so no document grows with the
    # data), gzip JSON Lines
    docs = rec.select(F.array(F.struct(*rec.columns)).alias("dataByDepartmentAndSearchTerm"))
    path = _scratch(spark, "landing-search-terms")
    docs.write.option("compression", "gzip").json(path)
    records = src.read_search_terms(spark, path, multi_line=False)
    own = fx.table(spark, d, "part").where(F.col("p_size") > OWN_MIN_SIZE).select(
        F.col("p_partkey").cast("string").alias("asin"))
    return v.own_search_terms(records, own, START, END, COUNTRY, NOW)


DOC_RECORDS = 500_000
SLICE_RECORDS = 30_000_000


def _land_documents(rec, path: str, group, key: str, rows: int, by=None, compression: str = "none") -> None:
    """JSON documents with many records in the array under ``key``, as the service hands them out: one a group, or several
    once the records (``rows`` at most) are more than a document should hold, since a task writes a document whole.

    Documents are dealt by the columns ``by`` (else all).  Beyond SLICE_RECORDS they are written in slices, a write each
    that makes its own records and drops its shuffles, so the disk holds one slice's shuffles beside the documents."""
    spark, by = rec.sparkSession, by or rec.columns
    parts, slices = max(1, -(-rows // DOC_RECORDS)), max(1, -(-rows // SLICE_RECORDS))
    part = F.pmod(F.xxhash64(*by), F.lit(parts))
    # a number given: a document's lines stay in one task, and tasks follow the documents
    n = -(-max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * parts) // slices)
    w = Window.partitionBy("doc")
    head = '{"reportSpecification":{"reportOptions":{"reportPeriod":"WEEK"}},"%s":[\n' % key
    value = F.to_json("record")
    line = F.concat(F.when(F.col("nth") == 1, head).otherwise(","), value, F.when(F.col("nth") == F.col("n"), "]}").otherwise(""))
    with shuffles_dropped(spark):
        for k in range(slices):
            some = rec.where(F.pmod(part, F.lit(slices)) == k) if slices > 1 else rec
            items = some.select(F.concat_ws("-", group, part.cast("string")).alias("doc"), F.struct(*rec.columns).alias("record"))
            items = items.repartition(n, "doc").withColumn("nth", F.row_number().over(w.orderBy(F.xxhash64(*[f"record.`{c}`" for c in by])))).withColumn("n", F.count("*").over(w))
            # columns are dealt and sorted, they become text as they are written
            (items.sortWithinPartitions("doc", "nth").select("doc", line.alias("value"))
                .write.mode("append").option("compression", compression).partitionBy("doc").text(path))


@register("s10_search_terms_documents", Q7_SQL, "S10", "S1", "Q7")
def s10_search_terms_documents(spark, d):
    """A few documents of any size, each cut into its elements by many tasks."""
    from .vendor import END, OWN_MIN_SIZE, START
    path = _scratch(spark, "landing-documents")
    rec = fx.search_terms_payload(spark, d)
    _land_documents(rec, path, F.split(F.coalesce("departmentName", F.lit("")), " ")[0], "dataByDepartmentAndSearchTerm",
                    fx.table(spark, d, "lineitem").count())
    own = fx.table(spark, d, "part").where(F.col("p_size") > OWN_MIN_SIZE).select(
        F.col("p_partkey").cast("string").alias("asin"))
    return v.own_search_terms(src.read_search_terms(spark, path), own, START, END, COUNTRY, NOW)


@register("s1_vendor_report_documents", Q5_SQL, "S1", "Q5")
def s1_vendor_report_documents(spark, d):
    """The vendor report as documents of many records (gzip, as the service sends them), under the schema of the document."""
    path = _scratch(spark, "landing-sales-documents")
    rec = fx.vendor_sales_records(spark, d)
    schema = rec.select(F.array(F.struct(*rec.columns)).alias("salesByAsin")).schema
    _land_documents(rec, path, F.pmod(F.xxhash64("asin"), F.lit(4)).cast("string"), "salesByAsin", fx.table(spark, d, "lineitem").count(),
                    by=["asin", "startDate"], compression="gzip")
    return v.vendor_report(src.read_report_json(spark, path, key="salesByAsin", schema=schema), COUNTRY, NOW)


@register("k5_latest_workflow_status", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS report_type,
  arg_max(CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END, ts) AS status, max(ts) AS ts
FROM events GROUP BY 1, 2""", "K5")
def k5_latest_workflow_status(spark, d):
    from ..sinks import latest_status
    # every event stands for one run of its report type on its day
    log = fx.table(spark, d, "events").selectExpr(
        "CAST(CAST(ts AS DATE) AS STRING) AS date", "event_type AS report_type",
        "CAST(event_id AS STRING) AS workflow_id",
        "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status", "ts")
    return latest_status(log)


@register("t1_stream_repull", Q5_SQL, "T1", "Q5")
def t1_stream_repull(spark, d):
    """Three pulls of overlapping periods, a batch each: the first with preliminary units, the second
    corrects the later periods and the last one, landed late, is older than both.  A large pull is handed out in several
    deliveries of whole months, a batch each; a delivery's files go when its batch is committed."""
    from ..streaming.ingest import period_slices, read_repull, remove, start_repull
    landing = _scratch(spark, "repull")
    rec = fx.vendor_sales_records(spark, d)
    wrong = rec.withColumn("orderedUnits", F.col("orderedUnits") + 1000)
    later = F.col("endDate") >= "1995-01-01"
    pulls = [("2024-01-02", rec.where(~later).unionByName(wrong.where(later))), ("2024-01-03", rec.where(later)), ("2024-01-01", wrong)]
    schema = rec.select(F.array(F.struct(*rec.columns)).alias("salesByAsin"), F.lit("").alias("pulledAt")).schema
    out, ckpt = _scratch(spark, "repull-out"), _scratch(spark, "repull-ckpt")
    days = fx.table(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("endDate"))
    deliveries = [some for some, _ in period_slices(days, F.substring("endDate", 1, 7), SLICE_RECORDS)]
    for at, rows in pulls:
        for some in deliveries:
            with shuffles_dropped(spark):
                rows.where(some).select(F.array(F.struct(*rec.columns)).alias("salesByAsin"), F.lit(at).alias("pulledAt")).write.mode("append").option("compression", "gzip").json(landing)
            q = start_repull(spark, landing, schema, "salesByAsin", out, ["asin", "startDate", "endDate"], "month", "pulledAt", checkpoint=ckpt,
                             transform=lambda b: b.withColumn("month", F.regexp_replace(F.substring("endDate", 1, 7), "-", "").cast("int")))
            q.awaitTermination()
            remove(spark, landing, inside=True)
    return v.vendor_report(read_repull(spark, out, "month").drop("pulled_at", "month"), COUNTRY, NOW)
