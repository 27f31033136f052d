"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the package relies on.
_REQUIRED = {
    # Operation times are wall-clock (timestamp_ntz); pin the zone so any
    # timestamp (LTZ) literal or cast behaves the same on every node.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcasts only on proven sizes: no broadcast from the planner's file-size
    # estimates; AQE may still convert a join at runtime from *measured* shuffle
    # sizes, and the package's own broadcasts are size-checked (operators/sizing).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def get_session(master: str | None = None, app: str = "cardsentry",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's required settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Fill in the runtime SQL settings on an existing session (e.g. the driver's).

    Only keys not set explicitly are filled, so a caller's own choice (say, no
    broadcasting at all) is kept.
    """
    for k, v in _REQUIRED.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. Only in local mode (tests) a folder of our own is
    created and registered where it is unset; a cluster must name one.
    """
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not context.getCheckpointDir():
        if not root and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="cardsentry-ckpt-"))
    return (root or context.getCheckpointDir()).rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{checkpoint_root(spark)}/cardsentry/{name}-{uuid.uuid4().hex[:12]}"
