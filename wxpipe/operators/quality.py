"""Key integrity audits: primary and foreign keys that no engine enforces for us."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import column
from ..schemas import StarSpec


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys that break PRIMARY KEY: held by several rows, or NULL. Empty when sound."""
    absent = reduce(lambda a, b: a | b, [column(k).isNull() for k in keys])
    return (
        df.groupBy(*[column(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(count))
        .where((column(count) > 1) | absent)
    )


def orphan_keys(
    child: DataFrame, foreign_key: str, parent: DataFrame, key: str, count: str = "n_rows"
) -> DataFrame:
    """Foreign key values with no parent, and how many rows hold each. Empty when sound.

    NULL refers to nothing and is allowed. The child is counted per key before the join, so a
    key held by a third of the rows reaches it as one row.
    """
    used = (
        child.where(column(foreign_key).isNotNull())
        .groupBy(column(foreign_key))
        .agg(F.count(F.lit(1)).alias(count))
    )
    known = parent.select(column(key).alias(foreign_key))
    return used.join(known, foreign_key, "left_anti")


def audit_star(fact: DataFrame, dimensions: Mapping[str, DataFrame], star: StarSpec) -> DataFrame:
    """Every broken key of a star: ``audit`` (kind and table), ``key``, ``n_rows``.

    The fact is scanned once for all its foreign keys, and only those columns are read.
    """
    specs = star.dimensions
    used = (
        fact.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(s.table).alias("table"), column(s.key).alias("key"))
                        for s in specs
                    ]
                )
            )
        )
        .where(F.col("key").isNotNull())
        .groupBy("table", "key")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dimensions[s.table].select(F.lit(s.table).alias("table"), column(s.key).alias("key"))
            for s in specs
        ],
    )
    orphans = used.join(known, ["table", "key"], "left_anti")
    repeated = duplicate_keys(known, ["table", "key"])
    return reduce(
        DataFrame.unionByName,
        [
            broken.select(F.concat(F.lit(f"{kind} "), "table").alias("audit"), "key", "n_rows")
            for kind, broken in (("fk", orphans), ("pk", repeated))
        ],
    )
