import gzip
import json
import os

from pyspark.sql import functions as F

from shelfscope import sinks
from shelfscope.sources import files as src
from shelfscope.streaming.ingest import start_ingest


def test_gzip_json_document_and_suffix_dispatch(spark, tmp_dir):
    doc = {"reportSpecification": {"x": 1},
           "salesByAsin": [{"asin": "A", "startDate": "2024-01-01", "orderedRevenue": {"amount": 1.5, "currencyCode": "USD"}},
                           {"asin": "B", "startDate": "2024-01-01", "orderedRevenue": {"amount": 2.0, "currencyCode": "USD"}}]}
    path = os.path.join(tmp_dir, "sales_2024-01-01.json.gz")
    with gzip.open(path, "wt") as f:
        json.dump(doc, f, indent=2)
    rows = src.read_report(spark, path, key="salesByAsin").orderBy("asin").collect()
    assert [r.asin for r in rows] == ["A", "B"] and rows[0].orderedRevenue.amount == 1.5


def test_csv_skip_rows_and_positions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "report.csv")
    with open(path, "w") as f:
        f.write("Report generated today\n\"a\",\"b,c\",\"d\"\n1,2,3\n4,5,6\n")
    df = src.read_report_csv(spark, path, skiprows=1, keep_position=True)
    assert df.columns[:3] == ["a", "b,c", "d"]
    assert [(r.a, r.pos) for r in df.orderBy("pos").collect()] == [("1", 1), ("4", 2)]


def test_unknown_suffix_fails(spark):
    import pytest
    with pytest.raises(ValueError):
        src.read_report(spark, "/tmp/x.xlsx")


def test_dated_files_latest_and_landed_dates(spark, tmp_dir):
    inv = os.path.join(tmp_dir, "inventory")
    os.makedirs(inv)
    for name, rows in [("inv_31.12.99.csv", "PZN,v\n1,2\n"), ("inv_01.01.05.csv", "PZN,v\n3,4\n5,6\n")]:
        with open(os.path.join(inv, name), "w") as f:
            f.write(rows)
    # string order would pick 31.12.99; parsed dates pick 2005
    latest = src.read_latest_dated(spark, inv, "dd.MM.yy")
    assert sorted(r.PZN for r in latest.collect()) == ["3", "5"]
    assert src.latest_file(spark, inv).first().file_date == "31.12.99"

    df = spark.createDataFrame([(1, "x")], "a int, b string")
    root = os.path.join(tmp_dir, "de")
    sinks.write_dated(df, root, "vendor", "US", "sp_sales", "2024-01-02")
    sinks.write_dated(df, root, "vendor", "US", "sp_sales", "2024-01-03")
    got = sorted(r.landed_date for r in src.landed_dates(spark, os.path.join(root, "vendor/US/sp_sales")).collect())
    assert got == ["2024-01-02", "2024-01-03"]


def test_sorted_dated_csv_and_archive(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    p = sinks.write_dated(df, tmp_dir, "vendor", "US", "t", "2024-01-02")
    back = spark.read.option("header", True).csv(p)
    assert back.columns == ["a", "b"]
    n = sinks.archive_csv(spark, [p], os.path.join(tmp_dir, "processed"))
    assert n == 1 and not os.path.exists(p)
    assert spark.read.parquet(os.path.join(tmp_dir, "processed")).count() == 1


def test_report_path_template():
    p = sinks.report_path("/r", sinks.SOURCE_TEMPLATE, "US", "campaign_ltv", "2024-03-07", source="cleanroom")
    assert p == "/r/de/cleanroom/US/campaign_ltv/campaign_ltv_07032024.csv"


def test_workflow_log_latest_status(spark, tmp_dir):
    import datetime as dt
    path = os.path.join(tmp_dir, "log")
    sinks.append_workflow_log(spark, [{"date": "d1", "report_type": "r", "workflow_id": "w1", "status": "FAILED",
                                       "ts": dt.datetime(2024, 1, 1, 1)}], path)
    sinks.append_workflow_log(spark, [{"date": "d1", "report_type": "r", "workflow_id": "w2", "status": "SUCCEEDED",
                                       "ts": dt.datetime(2024, 1, 1, 2)}], path)
    assert sinks.latest_status(spark.read.parquet(path)).first().status == "SUCCEEDED"


def test_stream_equals_batch_and_resumes(spark, tmp_dir):
    from shelfscope.plans.vendor import vendor_report
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    recs = [{"asin": f"A{i}", "startDate": "2024-01-0%d" % (1 + i % 3), "endDate": "2024-01-0%d" % (1 + i % 3),
             "orderedRevenue": {"amount": float(i), "currencyCode": "USD"}, "orderedUnits": i} for i in range(9)]
    with open(os.path.join(land, "b1.json"), "w") as f:
        for r in recs[:5]:
            f.write(json.dumps({"salesByAsin": [r]}) + "\n")
    schema = spark.read.json(os.path.join(land, "b1.json")).schema
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        q = start_ingest(spark, land, schema, "salesByAsin", out, "US", "2024-06-01 00:00:00", checkpoint=ck,
                         transform=lambda b: vendor_report(b, "US", "2024-06-01 00:00:00",
                                                           contract=["ASIN", "COUNTRY_CODE", "ENDDATE",
                                                                     "LAST_UPDATED_TIMESTAMP", "ORDEREDREVENUE",
                                                                     "ORDEREDREVENUE_CURRENCYCODE", "ORDEREDUNITS",
                                                                     "STARTDATE"]))
        q.awaitTermination()

    run()
    with open(os.path.join(land, "b2.json"), "w") as f:
        for r in recs[5:]:
            f.write(json.dumps({"salesByAsin": [r]}) + "\n")
    run()
    run()  # nothing new: no duplicate rows
    got = spark.read.parquet(out)
    assert got.count() == 9
    batch = spark.read.schema(schema).json(land).select(F.explode("salesByAsin").alias("r")).select("r.*")
    assert sorted(r.ASIN for r in got.collect()) == sorted(r.asin for r in batch.collect())


def test_report_sinks_k1_k3_k6(spark, tmp_dir):
    import datetime as dt
    df = spark.createDataFrame([(2, "b", dt.date(2024, 1, 2)), (1, "a", dt.date(2024, 1, 5))],
                               "z int, a string, d date")
    p1 = sinks.write_report(df, tmp_dir, sinks.SOURCE_TEMPLATE, "US", "sp_campaign", "2024-01-09")
    assert p1.endswith("de/ads/US/sp_campaign/sp_campaign_09012024.csv")
    assert spark.read.option("header", True).csv(p1).columns == ["z", "a", "d"]  # K6: unsorted
    p3 = sinks.upload_with_data_date(df, tmp_dir, sinks.FEED_TEMPLATE, "US", "omni_sales", "d")
    assert p3.endswith("de/omni_sales/US/omni_sales_05012024.csv")
    root = sinks.write_dated_many(df, os.path.join(tmp_dir, "many"), "t", "d")
    got = sorted(r.landed_date for r in src.landed_dates(spark, root).collect())
    assert got == ["2024-01-02", "2024-01-05"]


def test_sellout_file_two_header_rows_and_footer(spark, tmp_dir):
    from shelfscope.plans.flat_files import sellout_files_long
    path = os.path.join(tmp_dir, "sellout_01.02.24.csv")
    with open(path, "w") as f:
        f.write("A,B,C,D,E,F,G,2024-01-01,2024-01-02,Total\n")
        f.write("PZN,Name,Hersteller,Form,Pack,AVP,AEP,,,\n")
        f.write("1,aspirin,maker,tab,10,1.0,0.8,5,6,11\n")
        f.write("1,aspirin,maker,tab,10,1.0,0.8,7,8,15\n")   # later duplicate: first wins
        f.write("2,ibu,maker,tab,20,2.0,1.6,,3,3\n")
        f.write("Sum,,,,,,,12,17,29\n")
        f.write("generated by export,,,,,,,,,\n")
    [df] = src.read_two_row_header_csv(spark, path)
    assert df.columns[:7] == ["PZN", "Name", "Hersteller", "Form", "Pack", "AVP", "AEP"]
    assert "Total" not in df.columns
    long = sellout_files_long([df])
    got = sorted((r.PZN, r.Date, r.Value) for r in long.collect())
    assert got == [("1", "2024-01-01", 5.0), ("1", "2024-01-02", 6.0),
                   ("2", "2024-01-01", None), ("2", "2024-01-02", 3.0)]


def test_incremental_and_snapshot_writes(spark, tmp_dir):
    root = os.path.join(tmp_dir, "omni_sales")
    a = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int")
    b = spark.createDataFrame([("d2", 20), ("d3", 30)], "day string, v int")
    sinks.write_by_date(a, root, "day", fmt="parquet")
    sinks.write_by_date(b, root, "day", fmt="parquet")          # incremental: d1 kept, d2 replaced
    assert sorted((r.day, r.v) for r in spark.read.parquet(root).collect()) == [("d1", 1), ("d2", 20), ("d3", 30)]
    sinks.write_by_date(a, root, "day", fmt="parquet", incremental=False)  # snapshot: replaced
    assert sorted((r.day, r.v) for r in spark.read.parquet(root).collect()) == [("d1", 1), ("d2", 2)]


def test_archive_landed_keeps_listed_dates(spark, tmp_dir):
    table_dir = os.path.join(tmp_dir, "vendor", "US", "sp_sales")
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        sinks.write_dated(df, os.path.join(tmp_dir), "vendor", "US", "sp_sales", d)
    n = sinks.archive_landed(spark, table_dir, keep_dates=["2024-01-03"])
    assert n == 2
    left = sorted(x for x in os.listdir(table_dir) if x.endswith(".csv"))
    assert left == ["sp_sales_2024-01-03.csv"]
    assert spark.read.parquet(os.path.join(table_dir, "processed")).count() == 2
    # processed/ still counts as landed (the reference's prefix match)
    got = sorted(r.landed_date for r in src.landed_dates(spark, table_dir, exts=("csv", "parquet")).collect())
    assert got == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_positions_are_per_file_path_not_name(spark, tmp_dir):
    for sub, rows in (("US", "a,b\n1,2\n3,4\n"), ("GB", "a,b\n5,6\n")):
        os.makedirs(os.path.join(tmp_dir, sub))
        with open(os.path.join(tmp_dir, sub, "report.csv"), "w") as f:
            f.write(rows)
    df = src.read_report_csv(spark, [os.path.join(tmp_dir, "US", "report.csv"), os.path.join(tmp_dir, "GB", "report.csv")],
                             keep_position=True)
    assert sorted((r.a, r.pos) for r in df.collect()) == [("1", 1), ("3", 2), ("5", 1)]


def test_stream_whole_documents(spark, tmp_dir):
    land = os.path.join(tmp_dir, "docs")
    os.makedirs(land)
    for i in range(3):
        with gzip.open(os.path.join(land, f"sales_2024-01-0{i + 1}.json.gz"), "wt") as f:
            json.dump({"salesByAsin": [{"asin": f"A{i}", "n": i}, {"asin": f"B{i}", "n": i}]}, f, indent=2)
    schema = "salesByAsin array<struct<asin:string,n:bigint>>"
    from pyspark.sql.types import _parse_datatype_string
    out = os.path.join(tmp_dir, "out")
    q = start_ingest(spark, land, _parse_datatype_string(schema), "salesByAsin", out, "US",
                     checkpoint=os.path.join(tmp_dir, "ck"), transform=lambda b: b, partition_by=None,
                     multi_line=True)
    q.awaitTermination()
    assert sorted(r.asin for r in spark.read.parquet(out).collect()) == ["A0", "A1", "A2", "B0", "B1", "B2"]


def test_search_terms_projection_from_document(spark, tmp_dir):
    doc = {"reportSpecification": {"reportType": "x"},
           "dataByDepartmentAndSearchTerm": [
               {"departmentName": "Health", "searchTerm": "allergy", "searchFrequencyRank": 3, "clickedAsin": "A1",
                "clickedItemName": "pill", "clickShareRank": 1, "clickShare": 0.25, "conversionShare": 0.5,
                "extraField": "dropped"},
               {"departmentName": "Health", "searchTerm": "cold", "searchFrequencyRank": 9, "clickedAsin": "B2",
                "clickedItemName": "syrup", "clickShareRank": 2, "clickShare": 0.1, "conversionShare": 0.0}]}
    path = os.path.join(tmp_dir, "search_terms_2024-01-01.json.gz")
    with gzip.open(path, "wt") as f:
        json.dump(doc, f, indent=2)
    df = src.read_search_terms(spark, path)
    from shelfscope.schemas import SEARCH_TERMS_FIELDS
    assert df.columns == SEARCH_TERMS_FIELDS
    rows = sorted((r.searchTerm, r.searchFrequencyRank, r.clickShare) for r in df.collect())
    assert rows == [("allergy", 3, 0.25), ("cold", 9, 0.1)]


def test_files_of_different_layouts(spark, tmp_dir):
    """Every file is read under its own header; the archive keeps values under their names."""
    import pytest
    files = {"t_2024-01-01.csv": "A,B\n1,2\n", "t_2024-01-02.csv": "B,A\n20,10\n", "t_2024-01-03.csv": "A,B,C\n100,200,300\n"}
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    paths = [os.path.join(tmp_dir, n) for n in files]
    want = {("1", "2", None), ("10", "20", None), ("100", "200", "300")}
    assert {(r.A, r.B, r.C) for r in src.read_all(spark, paths).collect()} == want
    out = os.path.join(tmp_dir, "processed")
    assert sinks.archive_csv(spark, paths, out, delete_source=False) == 3
    assert sinks.archive_csv(spark, paths, out) == 3  # a repeated run replaces, it does not add
    assert not any(os.path.exists(p) for p in paths)
    assert {(r.A, r.B, r.C) for r in spark.read.parquet(out).collect()} == want
    clash = [os.path.join(tmp_dir, x, "same_1.csv") for x in "ab"]
    for p in clash:
        os.makedirs(os.path.dirname(p))
        with open(p, "w") as f:
            f.write("A\n1\n")
    with pytest.raises(ValueError):
        sinks.archive_csv(spark, clash, out)


def test_archive_reads_its_sources_once(spark, tmp_dir, monkeypatch):
    """Names with blanks and signs, a file without rows; a disturbed count is looked into and is no failure, a lost row is one."""
    import pytest

    def land():
        for name, text in {"a b+c_1.csv": "A\n1\n1\n", "t%_2.csv": "B,A\n20,\n", "none_3.csv": "A\n"}.items():
            with open(os.path.join(tmp_dir, name), "w") as f:
                f.write(text)
        return [os.path.join(tmp_dir, n) for n in ("a b+c_1.csv", "t%_2.csv", "none_3.csv")]
    out, again = os.path.join(tmp_dir, "processed"), []
    real = sinks._row_hash
    monkeypatch.setattr(sinks, "_row_hash", lambda df, cols: again.append(1) or real(df, cols))
    assert sinks.archive_csv(spark, land(), out) == 3 and not again
    assert sorted((r.A or "", r.B or "") for r in spark.read.parquet(out).collect()) == [("", "20"), ("1", ""), ("1", "")]

    class Twice:  # as if a task had counted its rows twice
        def __init__(self):
            self.get = {"n": 6, "h": None}
    monkeypatch.setattr(sinks, "Observation", Twice)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.observe", lambda df, *_: df)
    paths = land()
    assert sinks.archive_csv(spark, paths, out) == 3 and len(again) == 2
    paths = land()
    monkeypatch.setattr(sinks, "gathered", lambda df, *cols: df.limit(2))
    with pytest.raises(RuntimeError):
        sinks.archive_csv(spark, paths, os.path.join(tmp_dir, "short"))
    assert all(os.path.exists(p) for p in paths)


def test_one_large_date_is_written_by_many_tasks(spark, tmp_dir):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(400_000).selectExpr("date'2024-01-01' AS day", "id", "uuid() AS v")
        root = sinks.write_by_date(df, os.path.join(tmp_dir, "o"), "day", fmt="parquet")
        assert len([f for f in os.listdir(os.path.join(root, "day=2024-01-01")) if f.endswith(".parquet")]) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
