"""Rows and seconds of every micro-batch, taken while the batch is stored."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.names import column


@dataclass(frozen=True)
class BatchMetric:
    batch: int
    rows: int
    rejected: int
    seconds: float


class BatchMetrics(StreamingQueryListener):
    """Listens to one stream; no job of its own and nothing read twice.

    Counts are taken in the job that stores a batch, so they are exact where the sink reads the
    batch once. A batch delivered again replaces its entry. ``report`` is called for each.
    """

    def __init__(self, report: Callable[[BatchMetric], None] | None = None):
        self._name = f"batch_{uuid.uuid4().hex}"
        self._report = report
        self._seen: dict[int, BatchMetric] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._spark: SparkSession | None = None

    def watch(self, df: DataFrame, rejected: str | None = None) -> DataFrame:
        """The stream to store instead of ``df``; starts listening."""
        self._spark = df.sparkSession
        self._spark.streams.addListener(self)
        bad = column(rejected).isNotNull() if rejected else F.lit(False)
        return df.observe(
            self._name, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")
        )

    def wait(self, query: StreamingQuery, seconds: float = 60) -> list[BatchMetric]:
        """All batches of a query that has ended, in order.

        News reach a listener after the query itself is done, so this waits for the last of it.
        """
        query.awaitTermination()
        run = str(query.runId)
        with self._news:
            if not self._news.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no word of the end of {run} in {seconds} seconds")
        self._spark.streams.removeListener(self)
        return self.batches()

    def batches(self) -> list[BatchMetric]:
        with self._news:
            return [self._seen[n] for n in sorted(self._seen)]

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = progress.observedMetrics.get(self._name)
        if counts is None:
            return
        metric = BatchMetric(
            progress.batchId, counts["rows"], counts["rejected"], progress.batchDuration / 1000
        )
        with self._news:
            self._seen[metric.batch] = metric
        if self._report:
            self._report(metric)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()
