"""Outputs of a deduplicated feed, safe to repeat after a failure."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_sink(df: DataFrame, path: str, checkpoint: str):
    """Write unique rows and duplicates of a judged stream to the two parts of a table, by one write of each micro-batch.

    The parts are the folders ``is_duplicate=false`` and ``is_duplicate=true``, each with one for every micro-batch. A repeated
    batch overwrites its own folders, so it leaves no second copy. Returns the writer; set its trigger and start it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").partitionBy("is_duplicate", "batch_id").parquet(path)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_part(spark: SparkSession, path: str, duplicates: bool) -> DataFrame:
    """The unique rows or the duplicates of such a table, without reading the other part."""
    return read_flagged(spark, path).filter(F.col("is_duplicate") == duplicates).drop("is_duplicate", "batch_id")


def flagged_sink(df: DataFrame, path: str, checkpoint: str):
    """One table with a partition each for unique rows and duplicates."""
    return (
        df.writeStream.format("parquet")
        .partitionBy("is_duplicate")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def read_flagged(spark: SparkSession, path: str) -> DataFrame:
    """Read such a table; folder names are text, so the flag is made a boolean again."""
    flag = F.col("is_duplicate").cast("boolean")
    return spark.read.parquet(path).withColumn("is_duplicate", flag)


def split_write(df: DataFrame, path: str) -> None:
    """The stored form: one pass, one folder per flag, each writable and prunable on its own."""
    df.write.mode("overwrite").partitionBy("is_duplicate").parquet(path)


def on_events(
    df: DataFrame, handlers: Mapping[str, Callable[[DataFrame, int], None]], checkpoint: str
):
    """Call user functions on every micro-batch, one per event family of column ``type``.

    A handler gets the rows of its family as a DataFrame; it may be called again for the same batch
    id after a failure.
    """

    def dispatch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for family, handler in handlers.items():
                handler(batch.filter(F.col("type") == family), batch_id)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(dispatch).option("checkpointLocation", checkpoint)
