import pytest
from pyspark.sql import functions as F

from shelfscope.functions import cleaning as cl
from shelfscope.operators.aggregates import sum_drop_null_keys


def test_explode_codes_and_duplicate_ids(spark):
    df = spark.createDataFrame(
        [(1, "f1", "A", "123"), (2, "f1", "B", "123 abc, 45"), (3, "f1", "C", "abc"), (4, "f1", "D", ""),
         (5, "f1", "E", None), (6, "f1", "A", "9"), (1, "f2", "A", "7")],
        "pos int, file_name string, ID string, PZN string")
    x = cl.explode_codes(df, "PZN", pos_name="cpos")
    got = sorted((r.file_name, r.pos, r.PZN) for r in x.collect())
    assert got == [("f1", 1, "123"), ("f1", 2, "123"), ("f1", 2, "45"), ("f1", 3, None), ("f1", 4, None),
                   ("f1", 5, None), ("f1", 6, "9"), ("f2", 1, "7")]
    s = cl.suffix_duplicate_ids(x, "ID", "pos", ["cpos"], "file_name")
    ids = sorted((r.file_name, r.pos, r.ID) for r in s.collect())
    # A twice in f1 -> A-1, A-2 by row order; B twice (two codes) -> B-1, B-2; f2's A untouched
    assert ("f1", 1, "A-1") in ids and ("f1", 6, "A-2") in ids and ("f2", 1, "A") in ids
    assert sorted(i for f, p, i in ids if p == 2) == ["B-1", "B-2"]


def test_unpivot_keeps_nulls_and_keep_first(spark):
    df = spark.createDataFrame([("n", "p", "h", 1.0, None, "f1", 1), ("n", "p", "h", 5.0, 6.0, "f2", 1)],
                               "Name string, PZN string, Hersteller string, `2024-01-01` double, `2024-01-02` double, "
                               "file_name string, pos int")
    long = cl.unpivot_dates(df, ["Name", "PZN", "Hersteller", "file_name", "pos"])
    assert long.count() == 4
    first = cl.dedup_keep_first(long, ["Name", "PZN", "Hersteller", "Date"], ["file_name", "pos"])
    assert sorted((r.Date, r.Value) for r in first.collect()) == [("2024-01-01", 1.0), ("2024-01-02", None)]


def test_bucketed_row_number_is_exact(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1000).alias("pos"))
    got = cl.row_number_bucketed(df, ["k"], "pos", bucket=16)
    from pyspark.sql import Window
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    assert sorted(map(tuple, got.select("k", "pos", "rn").collect())) == sorted(map(tuple, want.collect()))


def test_sum_suffix_and_null_keys(spark):
    df = spark.createDataFrame([("a", "1", 1.0, None), ("a", "1", None, None), (None, "1", 3.0, 1.0)],
                               "PZN string, `Pck.` string, `x Menge` double, `y Menge` double")
    s = cl.sum_suffix(df, "Menge", "T")
    assert [r.T for r in s.collect()] == [1.0, 0.0, 4.0]
    g = sum_drop_null_keys(s, ["PZN", "Pck."], ["T"]).collect()
    assert [(r.PZN, r.T) for r in g] == [("a", 1.0)]


def test_iso_dates_strict_and_lenient(spark):
    df = spark.createDataFrame([("20240131",), ("20240132",), ("",), (None,)], "d string")
    lenient = [r.x for r in df.select(cl.iso_date("d", strict=False).alias("x")).collect()]
    assert lenient == ["2024-01-31", None, None, None]
    with pytest.raises(Exception):
        df.select(cl.iso_date("d", strict=True)).collect()
    ok = spark.createDataFrame([("20240131",)], "d string").select(cl.iso_date("d").alias("x")).first().x
    assert ok == "2024-01-31"


def test_keys_and_codes(spark):
    df = spark.createDataFrame([(" ",), ("NULL",), ("null",), (None,), (" k1 ",)], "SKU string")
    assert [r.SKU for r in cl.require_key(df, "SKU").collect()] == ["k1"]
    n = spark.createDataFrame([(0.0,), (None,), (12.0,)], "g double")
    assert [r.x for r in n.select(cl.code_text("g").alias("x")).collect()] == ["", "", "12"]
    c = spark.createDataFrame([("000123456789",), ("000",), ("00042",)], "g string")
    assert [r.x for r in c.select(cl.code_right("g", 6).alias("x")).collect()] == ["456789", "", "42"]


def test_two_digit_years_follow_posix(spark):
    df = spark.createDataFrame([("31.12.99",), ("01.01.05",), ("x",)], "t string")
    got = [str(r.d) if r.d else None for r in df.select(cl.date_ddmmyy("t").alias("d")).collect()]
    assert got == ["1999-12-31", "2005-01-01", None]


def test_format_date_formats(spark):
    df = spark.createDataFrame([("2024-03-05",), ("05.03.2024",), ("03/05/2024",), ("20240305",), ("nope",)], "t string")
    assert [r.x for r in df.select(cl.format_date("t").alias("x")).collect()] == ["2024-03-05"] * 4 + [None]


def test_header_rows_and_footer(spark):
    df = spark.createDataFrame([(1, "f", "PZN", "x"), (2, "f", "1", "a"), (3, "f", "2", "b"), (4, "f", "tot", "t"),
                                (5, "f", "sum", "s")], "pos int, file_name string, PZN string, v string")
    body = cl.skip_embedded_header(cl.skip_footer(df, "pos", "file_name", 2), "PZN")
    assert [r.PZN for r in body.orderBy("pos").collect()] == ["1", "2"]


def test_embedded_header_row_names_the_columns(spark):
    df = spark.createDataFrame([(1, "a", "PZN", "Menge"), (2, "a", "1", "5"), (1, "b", "7", "x"), (2, "b", "8", "y")],
                               "pos int, file_name string, c0 string, c1 string")
    out = cl.promote_embedded_header(df, "file_name", "pos")
    rows = {(r.file_name, r.pos, r.c0, r.c1, r.PZN, r.Menge) for r in out.collect()}
    assert rows == {("a", 1, None, None, "1", "5"), ("b", 1, "7", "x", None, None), ("b", 2, "8", "y", None, None)}


def test_null_ids_and_lenient_numbers(spark):
    df = spark.createDataFrame([(1, "f", None), (2, "f", "x"), (3, "f", "x"), (4, "f", None)], "pos int, file_name string, id string")
    out = cl.suffix_duplicate_ids(df, "id", "pos", file_col="file_name")
    assert sorted((r.pos, r.id) for r in out.collect()) == [(1, None), (2, "x-1"), (3, "x-2"), (4, None)]
    df = spark.createDataFrame([("2024",), ("nan",), ("NaN",), ("5d",), (" 7 ",), ("1e2",), (None,), ("",)], "y string")
    assert [r.y for r in cl.require_numeric(df, "y").collect()] == [2024.0, 7.0, 100.0]
    wide = spark.createDataFrame([("a", "1", "n/a")], "id string, d1 string, d2 string")
    assert {r.Value for r in cl.unpivot_dates(wide, ["id"]).collect()} == {"1", "n/a"}
    assert {r.Value for r in cl.unpivot_dates(wide, ["id"], lenient=True).collect()} == {1.0, None}
