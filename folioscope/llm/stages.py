"""Stages written to the folder all executors share, and the tables the queries read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in a local session that sets none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.conf.get("spark.master", "local").startswith("local["):
        folder = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="folioscope-llm-")
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage, survives lost executors, gives exact sizes to the planner."""
    path = f"{shared_folder(df.sparkSession)}/llm-stages/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
