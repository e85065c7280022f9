"""Unbounded sources. Both give frames that the same parsing and sinks accept."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one topic.

    ``starting_offsets`` only matters until the checkpoint exists. ``min_partitions`` splits
    topic partitions into more tasks, so one hot or single partition is read in parallel;
    ``max_offsets_per_trigger`` bounds a micro-batch after a long stop.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **(extra or {})}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream over a topic; needs the Kafka connector package on the class path."""
    return (
        spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    )


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, **options
) -> DataFrame:
    """Stream over a stored table: a folder of part files, or one file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(place).isDirectory():
        return file_stream(spark, path, schema, **options)
    parent = place.getParent().toString()
    return file_stream(spark, parent, schema, pattern=place.getName(), **options)


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Stream over the files of a folder, new ones becoming new micro-batches.

    ``max_files`` or ``max_bytes`` (not both) bounds what one micro-batch takes.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(folder)
