"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch milliseconds and wall-clock columns only agree in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session whose driver is its only executor gets a folder of its own, for tests; anywhere else
    a missing setting is an error, because executors could not see a driver-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="streamfuse-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute a small table once; kept in the shared folder it survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed here."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def use_keyed_state(spark: SparkSession) -> None:
    """Choose the state store that keeps an entry for each key, for stream queries started from now on.

    A query that goes on from a checkpoint keeps the store it was started with.
    """
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write a table once below the shared folder and read it back, with its own schema."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
