"""Helpers shared by the operators: table reads, shared tables, column names."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver runs
    it from (a cluster ships it with --py-files; the entry then does no harm)."""
    env = spark.sparkContext.environment
    # workers hand freed Arrow memory back to the system; they share a container with the JVM
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "2")
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def give_back() -> None:
    """Hand freed memory of a Python worker back to the system: workers live on from stage to stage, beside the JVM."""
    import ctypes
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  Cuts the lineage:
    a lost executor costs the tasks it ran, not the stages before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    # plain fields: metadata of the columns' origin would make self-joins ambiguous
    return spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
