"""Session settings. A cluster's own settings always win; ours only fill gaps."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "folioscope", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FOLIOSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """The cluster's shared checkpoint folder; ``fallback`` only where none is set (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
