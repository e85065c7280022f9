"""Bounded tables stored as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def parquet_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Whole-table scan; filters and unused columns never leave the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
