import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from shelfscope.operators import normalize as nz


def test_explode_struct_keeps_empty_and_null_parents(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", []), (3, "c", [Row(sku="x", name="cx")]),
         (4, "d", [Row(sku="y", name="dy"), Row(sku="z", name="dz")])],
        "id int, name string, items array<struct<sku:string,name:string>>")
    out = nz.explode_struct(df, "items").orderBy("id", "sku").collect()
    assert [(r.id, r.sku) for r in out] == [(1, None), (2, None), (3, "x"), (4, "y"), (4, "z")]
    # the child's ``name`` replaces the parent's
    assert [r.name for r in out] == [None, None, "cx", "dy", "dz"]


def test_explode_path_two_levels(spark):
    df = spark.createDataFrame(
        [("c1", [Row(cid="k1", asins=[Row(asin="a1"), Row(asin="a2")]), Row(cid="k2", asins=[])]), ("c2", [])],
        "campaign string, coupons array<struct<cid:string, asins:array<struct<asin:string>>>>")
    out = sorted((r.campaign, r.cid, r.asin) for r in nz.explode_path(df, ["coupons", "asins"]).collect())
    assert out == [("c1", "k1", "a1"), ("c1", "k1", "a2"), ("c1", "k2", None), ("c2", None, None)]


def test_amount_replaces_existing_column_and_currency(spark):
    df2 = spark.createDataFrame([("A1", 5.0, 10.5, "USD", "2024-01-31", "bad-date")],
                                "asin string, cost double, `cost.amount` double, `cost.currencyCode` string, "
                                "startDate string, endDate string")
    out = nz.normalize_report_names(df2, "report")
    assert sorted(out.columns) == ["ASIN", "COST", "COST_CURRENCYCODE", "ENDDATE", "STARTDATE"]
    r = out.first()
    assert r.COST == 10.5 and r.COST_CURRENCYCODE == "USD"
    assert str(r.STARTDATE) == "2024-01-31" and r.ENDDATE is None  # lenient date cast


def test_flatten_structs_dotted_names(spark):
    df = spark.createDataFrame([("A1", Row(amount=1.5, currencyCode="EUR"), [1])],
                               "asin string, cost struct<amount:double,currencyCode:string>, tags array<int>")
    flat = nz.flatten_structs(df)
    assert flat.columns == ["asin", "cost.amount", "cost.currencyCode", "tags"]


def test_flatten_and_first_element(spark):
    df = spark.createDataFrame([("A", [Row(brand="b1", itemName="n1")], [Row(brand="v1")]),
                                ("B", [], None)],
                               "asin string, summaries array<struct<brand:string,itemName:string>>, "
                               "vendorDetails array<struct<brand:string>>")
    flat = nz.first_elems_flat(df, {"summaries": "summaries", "vendorDetails": "vendorDetails"}, ["asin"])
    assert flat.columns == ["asin", "summaries.brand", "summaries.itemName", "vendorDetails.brand"]
    out = nz.strip_prefix(flat)
    # later column wins the BRAND clash
    assert sorted(out.columns) == ["ASIN", "BRAND", "ITEMNAME"]
    rows = {r.ASIN: r for r in out.collect()}
    assert rows["A"].BRAND == "v1" and rows["B"].BRAND is None


def test_contract_check(spark):
    df = spark.createDataFrame([(1, 2)], "B int, A int")
    assert nz.assert_columns(df, ["A", "B"]) is df
    with pytest.raises(nz.ContractError):
        nz.assert_columns(df, ["A", "C"])
    assert nz.assert_columns(df.withColumn("X", F.lit(1)), ["A", "B"], strict=False).columns == ["A", "B"]


def test_ensure_columns_only_adds_missing(spark):
    df = spark.createDataFrame([(7,)], "TOTALBUDGET int")
    out = nz.ensure_columns(df, {"TOTALBUDGET": 0, "TOTALBUDGETSPENT": 0}).first()
    assert out.TOTALBUDGET == 7 and out.TOTALBUDGETSPENT == 0


def test_null_tokens_and_rename(spark):
    df = spark.createDataFrame([("null", "-"), ("x", "1")], "a string, b string")
    out = nz.null_tokens(nz.null_tokens(df, ["a"], ["null"]), ["b"], ["-"], "").collect()
    assert [(r.a, r.b) for r in out] == [(None, ""), ("x", "1")]
    assert nz.rename_columns(df, {"a": "z", "missing": "q"}).columns == ["z", "b"]
