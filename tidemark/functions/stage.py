"""Tables written between two steps of a job.

A step whose result is read more than once, or whose rows must not change
between two readings, is written as parquet under the folder the cluster names
in ``spark.checkpoint.dir``. That survives lost executors, cuts the lineage,
and lets Catalyst see the true size of the table, so a small one is broadcast
below ``spark.sql.autoBroadcastJoinThreshold`` and a large one is shuffled.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a fresh one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, least: int = 5_000, most: int = 500_000) -> DataFrame:
    """``df``, which has ``rows`` rows, in three parts a core, of ``least`` to ``most`` rows: a written table has as many as its writer."""
    parts = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(parts, rows // least), -(-rows // most)))
