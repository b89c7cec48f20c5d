"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "rotorlake", cores: str = "8", memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own session.

    Where the installation names no shared folder, this one machine's temporary folder serves.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "256m")
        .config("spark.driver.memory", memory)
        # The JVM does not compile methods above 8000 bytes; beyond that split projections are faster.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Saves a stack walk per column call; plans here have some hundred.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    if not _shared_base(spark):
        # The setting is read when a session starts.
        spark.stop()
        spark = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="rotorlake-")).getOrCreate()
    return spark


def _shared_base(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names."""
    base = _shared_base(spark)
    if not base:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
