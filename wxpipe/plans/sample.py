"""Weather-shaped raw observations derived from the order tables of the test data.

One observation per order, then made dirty: NULLs in three columns, exact copies, and copies
that differ by less than the stored precision. FIXTURES.md lists the rules and row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import parquet_table


def _blank(value: str, every: int) -> F.Column:
    return F.when(F.col("o_orderkey") % every != 0, F.col(value))


def base_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its customer and nation. Join strategy is left to the optimizer."""
    orders, customer, nation = (
        parquet_table(spark, f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation")
    )
    key = F.col("o_orderkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("int").alias("id"),
            F.col("o_orderdate").alias("date_time"),
            _blank("n_name", 97).alias("city"),
            _blank("o_totalprice", 89).alias("temperature"),
            F.col("c_acctbal").alias("humidity"),
            F.col("o_custkey").cast("double").alias("pressure"),
            ((key % 1000) / F.lit(8.0)).alias("wind_speed"),
            F.col("o_orderpriority").alias("wind_direction"),
            _blank("c_mktsegment", 83).alias("precipitation"),
            (key % 101).cast("double").alias("cloud_cover"),
        )
    )


def dirty_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base`` plus the copies, from one pass over the joined orders."""
    base = base_observations(spark, sf_dir)
    shifts = (
        F.when(F.col("id") % 50 == 0, F.array(F.lit(0.0), F.lit(0.0)))
        .when(F.col("id") % 50 == 1, F.array(F.lit(0.0), F.lit(0.001)))
        .otherwise(F.array(F.lit(0.0)))
    )
    copies = base.select("*", F.explode(shifts).alias("__shift"))
    return copies.withColumn("temperature", F.col("temperature") + F.col("__shift")).drop(
        "__shift"
    )
