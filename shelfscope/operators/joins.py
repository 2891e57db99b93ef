"""Join operators.

No broadcast hints on data-derived sides: AQE broadcasts a side whose
measured shuffle size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and keeps a sort-merge join otherwise -- the size check with a fallback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


TASK_ROWS = 1 << 19  # rows of the largest table that a task sorts or sums: some hundred bytes each


def tasks_for(table: DataFrame, rows: int = TASK_ROWS) -> int:
    """How many tasks hold at most ``rows`` rows each of a stored table (its count
    comes from the files' footers), at least the session's shuffle partitions.
    ``repartition`` by such a number bounds a task's memory whatever the size of
    the input, and AQE merges no tasks since rows that compress well look like few."""
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // rows))


def filter_to_catalog(df: DataFrame, catalog: DataFrame, left_key: str, cat_key: str = "asin",
                      semi: bool = False) -> DataFrame:
    """Keep report rows whose item is in the catalog.  The reference's
    inner join repeats a row per duplicate catalog entry (kept by default);
    ``semi=True`` keeps each row once."""
    cat = catalog.select(F.col(cat_key).alias("__cat_key"))
    cond = F.col(left_key) == F.col("__cat_key")
    if semi:
        return df.join(cat, cond, "left_semi")
    return df.join(cat, cond, "inner").drop("__cat_key")
