"""An event-time watermark that follows the whole feed and drops no row."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bucket of clock rows.
CLOCK = -1


def _newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest time of each task's rows."""
    newest = None
    for batch in batches:
        found = pc.max(batch.column(0)).as_py()
        if found is not None:
            newest = found if newest is None else max(newest, found)
    if newest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([newest], pa.int64())], ["at_ms"])


def with_clock(rows: DataFrame, ts: str, marks: dict[str, Column], whole: DataFrame | None = None) -> DataFrame:
    """The rows, and for each task one clock row that has the columns ``marks`` and nulls, with a watermark at its time.

    Only clock rows have an event time, so a row that comes late is not dropped as the engine drops rows older than the
    watermark. The clock reads the time column of ``whole`` (the rows themselves by default), a second, narrow scan.
    """
    times = (rows if whole is None else whole).select(F.col(ts).cast("bigint").alias("at_ms"))
    clock = times.mapInArrow(_newest, "at_ms bigint").select(
        *[
            (marks[f.name] if f.name in marks else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in rows.schema.fields
        ],
        F.timestamp_millis("at_ms").alias("_clock"),
    )
    timed = rows.withColumn("_clock", F.lit(None).cast("timestamp")).unionByName(clock)
    return timed.withWatermark("_clock", "0 seconds")
