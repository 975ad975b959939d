"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share.

    The cluster names its folder in spark.checkpoint.dir. Only a local master, whose driver and
    executors are one machine, has a default; nothing here is removed, the cluster clears its folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(root or 'file:/tmp/sigtrack-checkpoints').rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows written to the shared folder and read back: what follows has no lineage before it,
    so a lost executor costs its running tasks only."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
