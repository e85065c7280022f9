"""Small helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import in_own_session, ship_package, sized

#: Rows handled at once inside a Python task; bounds its memory beside the Arrow batch.
CHUNK_ROWS = 512
#: Data sent whole to every executor is measured first and must stay below this.
BROADCAST_BYTES = 8 << 20

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
#: Lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(_UPPER, _LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; the workers that will compute on it get this package."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores before it until no column in ``taken`` has that name."""
    used = {name.lower() for name in taken}
    while base.lower() in used:
        base = f"_{base}"
    return base


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str) -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def give_back() -> None:
    """Return freed memory to the system, at the end of a task.

    A Python worker serves the tasks of one operator after another; what the allocators keep for
    themselves would add up over the stages of a pipeline.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def with_columns_by(
    df: DataFrame,
    fields: list[T.StructField],
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """``df`` with ``fields`` appended; ``compute`` gets slices of a few hundred rows."""
    schema = T.StructType([*df.schema.fields, *fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part)], names=names)
        give_back()

    return df.mapInArrow(run, schema)


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


#: Rows are worked on in small slices, so texts and sets, which are wide, travel in small batches.
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(2 * CHUNK_ROWS)}


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs`` in a session of its own that hands rows to Python in small batches."""
    return in_own_session(docs, _SMALL_BATCHES)


def sized_for(docs: DataFrame, text: str, times: float) -> DataFrame:
    """As :func:`in_small_batches`, and with shuffles cut for ``times`` the bytes of the texts.

    Measured by a scan of the one column.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return sized(docs, int(times * size), settings=_SMALL_BATCHES)


def is_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df``, at ``row_bytes`` a row, may be sent whole to every executor."""
    return df.limit(limit // row_bytes + 1).count() <= limit // row_bytes


def matching(df: DataFrame, keys: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """Semi or anti join with narrow ``keys`` (two words a row): broadcast if counted small.

    Otherwise a shuffle join, whose hot keys the adaptive planner splits.
    """
    return df.join(F.broadcast(keys) if is_small(keys, 32) else keys, on, how)
