"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# All calendar logic is UTC, so a TIMESTAMP column must be shown and cut in UTC.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Where a local session without a checkpoint folder keeps its private one.
PRIVATE_FOLDER = "telepulse.private.folder"

# Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Window state of a large fleet outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Call sites of every column expression are only of use in debugging.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "telepulse", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``conf`` overrides win over the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the settings that results depend on in a session made elsewhere."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can write to, as named by the cluster.

    Only where the cluster names none (a local run) is a private one made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(PRIVATE_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="telepulse-")
    spark.conf.set(PRIVATE_FOLDER, folder)  # the cluster's own setting can't be changed in a session
    return folder
