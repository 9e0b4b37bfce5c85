"""Merging redundant endpoints into one stream of deliveries."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse import schemas
from streamfuse.config import Endpoint


def client_id(ordinal: int) -> str:
    """Clients are numbered from 1; the same URL twice is two clients."""
    return f"client-{ordinal}"


def endpoints_table(spark: SparkSession, endpoints: Sequence[Endpoint]) -> DataFrame:
    """The configured endpoints as a small dimension, one row per client."""
    rows = [(client_id(i), i, e.url, e.ping) for i, e in enumerate(endpoints, start=1)]
    return spark.createDataFrame(rows, schemas.ENDPOINTS)


def fan_in(
    sources: Sequence[tuple[Endpoint, DataFrame | str]],
    spark: SparkSession | None = None,
    require_any: bool = False,
    skip_broken: bool = False,
) -> DataFrame:
    """Union of all sources, every row tagged with its client and endpoint; no row is dropped.

    Works on stored and streaming DataFrames alike. A source may be given as a Parquet path or the
    name of a table. With ``require_any`` one that is missing is skipped with a warning, and only a feed
    without any readable source is an error; clients keep their numbers either way. With ``skip_broken`` files of a path that
    break or vanish while they are read are left out as well, and the feed goes on; ``lost_files`` lists them.
    """
    tagged, missing = [], []
    for ordinal, (endpoint, source) in enumerate(sources, start=1):
        if isinstance(source, str):
            try:
                source = _stored(source, spark, skip_broken)
            except AnalysisException as problem:
                if not require_any:
                    raise
                missing.append(endpoint.url)
                warnings.warn(f"{endpoint.url} skipped: {problem.getCondition()}", stacklevel=2)
                continue
        tagged.append(
            source.withColumns(
                {
                    "client_id": F.lit(client_id(ordinal)),
                    "endpoint": F.lit(endpoint.url),
                    "ordinal": F.lit(ordinal),
                }
            )
        )
    if not tagged:
        raise ValueError(f"no usable source: {', '.join(missing) or 'none given'}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _session(spark: SparkSession | None) -> SparkSession:
    session = spark or SparkSession.getActiveSession()
    if session is None:
        raise ValueError("a source given by name needs a session")
    return session


def _stored(name: str, spark: SparkSession | None, skip_broken: bool = False) -> DataFrame:
    session = _session(spark)
    if "/" not in name:
        return session.read.table(name)
    reader = session.read
    if skip_broken:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        try:
            return reader.parquet(name)
        except AnalysisException as problem:
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            # The one file that was asked for the schema is broken: ask all.
            reader = reader.option("mergeSchema", "true")
    return reader.parquet(name)


LOST = "client_id string, endpoint string, file string, bytes bigint"


def lost_files(
    sources: Sequence[tuple[Endpoint, DataFrame | str]], spark: SparkSession | None = None
) -> DataFrame:
    """(client_id, endpoint, file, bytes): files of the sources given by path that give no row to a tolerant read.

    A source whose path is missing or has no readable file at all has one line with a null file. Files without a row are
    opened once more, to leave out those that have none. A file that breaks after its first rows is not told: the engine keeps
    what it has read of it.
    """
    session = _session(spark)
    parts = [session.createDataFrame([], LOST)]
    for ordinal, (endpoint, source) in enumerate(sources, start=1):
        if not isinstance(source, str) or "/" not in source:
            continue
        named = [F.lit(client_id(ordinal)).alias("client_id"), F.lit(endpoint.url).alias("endpoint")]
        try:
            read = _stored(source, session, skip_broken=True)
            there = session.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            gone = session.range(1).select(*named, F.lit(None).cast("string").alias("file"), F.lit(None).cast("bigint").alias("bytes"))
            parts.append(gone)
            continue
        told = read.select(F.col("_metadata.file_path").alias("file")).distinct()
        files = there.select(F.col("_metadata.file_path").alias("file"))
        # Names only, of files without a row; the driver lists all of a source's names anyway.
        silent = [r["file"] for r in files.join(told, "file", "left_anti").collect()]
        if silent:
            held = session.read.format("binaryFile").option("ignoreMissingFiles", "true").load(silent)
            named_files = held.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"), "content")
            lost = named_files.mapInArrow(_not_empty, "file string, bytes bigint")
            parts.append(lost.select(*named, "file", "bytes"))
    return reduce(DataFrame.unionByName, parts)


def _not_empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of files that gave no row those that are not simply empty."""

    def rows(content: bytes) -> int | None:
        try:
            return pq.read_metadata(pa.BufferReader(content)).num_rows
        except (pa.ArrowException, OSError):
            return None

    for batch in batches:
        lost = [rows(c.as_py()) != 0 for c in batch.column(2)]
        yield batch.select([0, 1]).filter(pa.array(lost, pa.bool_()))


def read_deliveries(
    spark: SparkSession,
    path: str | None = None,
    *,
    schema=schemas.DELIVERY,
    streaming: bool = False,
    max_files_per_trigger: int = 1000,
    kafka_options: dict[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Stored deliveries (Parquet) or a Kafka topic of JSON deliveries, as a batch or a stream.

    The schema is stated, so no file is opened for inference. A stream is rate-limited, which also
    bounds the rows of one key a micro-batch can hold.
    """
    if kafka_options is not None:
        reader = spark.readStream if streaming else spark.read
        raw = reader.format("kafka").options(**kafka_options).load()
        parsed = F.from_json(F.col("value").cast("string"), schema)
        return raw.select(parsed.alias("d")).select("d.*")
    if path is None:
        raise ValueError("give a path or Kafka options")
    if streaming:
        reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read
    return reader.schema(schema).options(**options).parquet(path)
