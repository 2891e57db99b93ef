"""SparkSession helpers.

Library code never builds its own session: every public function takes the
caller's ``SparkSession`` (or a DataFrame) so cluster settings stay with the
caller.  ``local_session`` is only for tests, the bench and ad-hoc runs.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a local run needs to behave like the cluster plan we design for:
# AQE on (runtime coalescing, skew-join splitting, broadcast conversion on
# measured sizes), session time zone pinned, UI off.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings recommended for the 100 TB cluster run (pass to the session
# builder; nothing in the library sets them).  AQE sizes reducers from
# measured map output, splits skewed join partitions, and converts joins to
# broadcast only below the threshold; scans read ~256 MB splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfscope", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or one
    set on the context before), if any."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir")
            or spark.sparkContext.getCheckpointDir())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.

    Only a ``local*`` master may go without one: a machine-local folder holds
    only a part of the data on a cluster, so there the setting is required.
    """
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="shelfscope-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a
    cluster): used for written intermediate tables and stream checkpoints."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes made within drop their shuffle files as they end.  Else these stay until the driver happens to collect its
    garbage, so a job of several writes holds the shuffles of all.  A write plans its own query: nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
