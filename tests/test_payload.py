import pytest
from pyspark.sql import functions as F

from shelfscope.sources.payload import NO_DATA_ERRORS, NO_DATA_REQUEST_ERROR, classify_payload


def test_payload_outcomes(spark):
    df = spark.createDataFrame(
        [(1, NO_DATA_ERRORS[0], None, None), (2, None, NO_DATA_REQUEST_ERROR + " 2024-01-01", None),
         (3, None, None, []), (4, None, None, [1, 2]), (5, NO_DATA_ERRORS[1], "x", [1])],
        "id int, errorDetails string, reportRequestError string, salesByAsin array<int>")
    out = {r.id: r.payload_status for r in classify_payload(df, "salesByAsin").collect()}
    assert out == {1: "EMPTY", 2: "EMPTY", 3: "EMPTY", 4: "DATA", 5: "EMPTY"}


def test_unknown_error_fails_the_job(spark):
    df = spark.createDataFrame([(1, "something else", [1])], "id int, errorDetails string, salesByAsin array<int>")
    assert classify_payload(df, "salesByAsin").first().payload_status == "ERROR"
    with pytest.raises(Exception, match="report error"):
        classify_payload(df, "salesByAsin", fail_on_error=True).collect()
