"""Report payload outcome.

A report document either holds records, or says "no data" (known error texts
or an empty array) -- skipped -- or carries another error, which must fail
the load.  Classified per document as a column, so a folder of many reports
is checked in one job; ``fail_on_error`` turns unknown errors into a job
failure with ``raise_error``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The service's "no data" messages the loader skips (not yet
# available, client error on a date without data, prohibited date range).
NO_DATA_ERRORS = [
    "Error in report request: The report data for the requested date range is not yet available. "
    "Try submitting this createReport request at a later time, or modify dataEndTime to be an earlier date.",
    "A client error occurred. Please double check that your parameters are valid and fulfill the "
    "requirements of the report type.",
    "Error in report request: The values for dataStartTime and dataEndTime provided in the createReport "
    "request describe a prohibited date range that does not align with the requirements for the specified "
    "reportPeriod. An example of a prohibited date range includes a dataStartTime that is not a Sunday or a "
    "dataEndTime that is not a Saturday when reportPeriod=WEEK. dataStartTime and dataEndTime must also abide "
    "by the maximum lookback window and reporting period limits that vary by reportPeriod. Reference the "
    "documentation on GitHub for this report type for more information.",
]
NO_DATA_REQUEST_ERROR = "Data is not available for the specified end date. Please specify an end date on or before"

EMPTY, DATA, ERROR = "EMPTY", "DATA", "ERROR"


def payload_status(error_col: str | None, request_error_col: str | None, records_col: str,
                   known: Sequence[str] = NO_DATA_ERRORS, known_request: str = NO_DATA_REQUEST_ERROR) -> Column:
    err = F.col(error_col) if error_col else F.lit(None).cast("string")
    req = F.col(request_error_col) if request_error_col else F.lit(None).cast("string")
    empty = (err.isin(list(known)) | F.coalesce(req.contains(known_request), F.lit(False))
             | (F.coalesce(F.size(F.col(records_col)), F.lit(-1)) == 0))
    return F.when(empty, F.lit(EMPTY)).when(err.isNotNull(), F.lit(ERROR)).otherwise(F.lit(DATA))


def classify_payload(df: DataFrame, records_col: str, error_col: str | None = "errorDetails",
                     request_error_col: str | None = "reportRequestError",
                     fail_on_error: bool = False) -> DataFrame:
    """Adds ``payload_status``: EMPTY (skip), DATA, or ERROR (fails the job
    when ``fail_on_error``)."""
    cols = set(df.columns)
    st = payload_status(error_col if error_col in cols else None,
                        request_error_col if request_error_col in cols else None, records_col)
    if fail_on_error:
        err = F.col(error_col) if error_col in cols else F.lit("unknown error")
        st = F.when(st == ERROR, F.raise_error(F.concat(F.lit("report error: "), err))).otherwise(st)
    return df.withColumn("payload_status", st)
