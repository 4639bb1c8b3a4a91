"""Where lineage is cut and where jobs may keep shared files."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    A folder of our own is used only where the session names none and runs in one process (tests,
    one machine); it goes when the process ends. On a cluster that is an error, as no folder of one
    machine is seen by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        current = sc.getCheckpointDir()
    return current


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for stream checkpoints and written tables."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes the rows to a table in the shared folder and reads them back.

    What follows starts from files any executor can read, so lost executors cost one stage
    and nothing upstream runs again. Unlike a checkpointed RDD the table has a known size,
    so Spark can still choose its joins, and unread columns stay on disk.
    """
    path = run_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over at least as many tasks as there are cores, for work that bytes do not show.

    Long texts and fan-out joins cost far more than reading their input. A large input has
    tasks enough and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def tasks_for(rows: int | None, each: int = 250_000) -> int:
    """How many tasks ``rows`` are dealt over where their bytes in a shuffle say little of the work."""
    return (rows or 0) // each + 1
