"""Dense surrogate keys without a single-task window over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.names import column
from ..staging import Staging

MARK = "__mark"
_SLICE = "__slice"
MOST_GROUPS_TO_BROADCAST = 10_000
# monotonically_increasing_id() keeps the partition number above this bit.
_SLICE_BIT = 33


def store_ranged(
    df: DataFrame, group: str, order: str, staging: Staging, name: str, *measures: Column
) -> tuple[DataFrame, dict]:
    """Store rows in global order of ``(group, order)``, NULL last, each with its ``MARK``.

    All tasks take part: rows are range-partitioned, then sorted in place. A mark is the slice
    (partition) and the position in it, so marks ascend in global order, without gaps inside a
    slice. Returned with the table: ``slices``, how many there are, and ``measures``, both
    taken while writing.
    """
    by = [column(group).asc_nulls_last(), column(order).asc_nulls_last()]
    marked = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(MARK, F.monotonically_increasing_id())
    )
    seen = Observation(name)
    slices = F.coalesce(F.max(F.shiftright(MARK, _SLICE_BIT)) + 1, F.lit(0)).alias("slices")
    stored = staging.write(marked.observe(seen, slices, *measures), name)
    return stored, seen.get


def number_marked(
    marked: DataFrame, group: str, key: str, groups: int | None = None
) -> DataFrame:
    """Turn marks into ``key``: 1..N inside each ``group``.

    The offsets come from a window over slice counts: a row per slice and group, not per value.
    Slices follow one another, so there are fewer offsets than slices plus groups. Where the
    caller knows the number of ``groups`` to be small they are broadcast. Otherwise they are
    joined by slice, which range partitioning has made about equal.
    """
    sliced = marked.withColumn(_SLICE, F.shiftright(MARK, _SLICE_BIT))
    before = (
        Window.partitionBy(column(group))
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy(column(group), _SLICE)
        .agg(F.min(MARK).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .select(
            column(group),
            _SLICE,
            (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias(
                "__shift"
            ),
        )
    )
    if groups is not None and groups <= MOST_GROUPS_TO_BROADCAST:
        offsets = F.broadcast(offsets)
    return (
        sliced.join(offsets, [group, _SLICE])
        .withColumn(key, F.col(MARK) + F.col("__shift"))
        .drop(MARK, _SLICE, "__shift")
    )


def number_within(
    df: DataFrame,
    group: str,
    order: str,
    key: str,
    staging: Staging,
    name: str = "ranged",
    groups: int | None = None,
) -> DataFrame:
    """Add ``key``: 1..N inside each ``group``, by ``order`` ascending, NULL last.

    ``(group, order)`` must be unique and ``group`` not NULL. The numbering does not depend on
    how many partitions there are. ``groups`` says how many groups there can be, if known.
    """
    marked, _ = store_ranged(df, group, order, staging, name)
    return number_marked(marked, group, key, groups)
