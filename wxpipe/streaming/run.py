"""From message stream to running query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.parse import decode, parse_json
from ..operators.metrics import preview
from .metrics import BatchMetrics


def observations(
    messages: DataFrame, schema: T.StructType, value: str = "value", rejected: str | None = None
) -> DataFrame:
    """Typed columns of a message stream (or of stored messages).

    ``rejected`` names a last column for the text of messages that gave no field.
    """
    return parse_json(decode(messages, value), schema, value, bad_record=rejected)


def _writer(df: DataFrame, checkpoint: str, every: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def start_stream(
    df: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    metrics: BatchMetrics | None = None,
    rejected: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``store``.

    The checkpoint is mandatory: without one a restart loses what arrived meanwhile. By default
    the query takes what is there and ends, so a scheduler can run it; ``every`` (such as
    ``"10 seconds"``) keeps it running. ``metrics`` hears of the rows of each batch, and of those
    with a value in the column ``rejected``.
    """
    if metrics:
        df = metrics.watch(df, rejected)
    return _writer(df, checkpoint, every).foreachBatch(store).start()


def start_console(
    df: DataFrame,
    checkpoint: str,
    every: str | None = None,
    rows: int = 20,
    received: Callable[[int, int], None] | None = None,
) -> StreamingQuery:
    """Print the size of each micro-batch and ``rows`` of its rows, in full width.

    No more than ``rows`` rows of a batch reach the driver. ``received`` is told the number of
    each batch and how many rows it had.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        n_rows = batch.count()
        print(f"batch {batch_id}: {n_rows} rows")
        preview(batch, rows).show(rows, truncate=False)
        if received:
            received(batch_id, n_rows)

    return start_stream(df, show, checkpoint, every)
