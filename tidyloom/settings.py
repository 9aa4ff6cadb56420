"""Session set-up, the shared folder, and the number of borders that split an order.

``spark.tidyloom.bordersPerPartition``, a Spark SQL setting, is the number of
borders of an order for each shuffle partition. Rows of a group between two
borders are sorted in one task.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BORDERS_PER_PARTITION = "spark.tidyloom.bordersPerPartition"
DEFAULTS = {BORDERS_PER_PARTITION: 16}


def build_session(app_name: str = "tidyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split skewed join partitions even when that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # What was stored between steps goes when its frame is no longer used.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def borders_of(spark: SparkSession) -> int:
    """How many borders split the rows of one order; at most 2 ** 16, since each task holds them."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = int(spark.conf.get(BORDERS_PER_PARTITION, str(DEFAULTS[BORDERS_PER_PARTITION])))
    return min(max(partitions * each, 1), 1 << 16)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent, only a local session gets a temporary folder:
    on a cluster a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidyloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tidyloom-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder once and read it from there on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
