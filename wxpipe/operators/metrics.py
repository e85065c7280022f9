"""Inspection and load metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.names import column


def preview(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows: the first by ``order``, NULL last, or whichever come first without one.

    Without an order only as much is read as it takes to find ``n`` rows. With one, each task
    keeps its own best ``n`` and nothing is sorted whole.
    """
    if order:
        df = df.orderBy(*[column(c).asc_nulls_last() for c in order])
    return df.limit(n)


@dataclass(frozen=True)
class LoadMetrics:
    rows: int
    nulls: dict[str, int]
    flagged: int = 0
    seconds: float | None = field(default=None, compare=False)


class observed:  # noqa: N801 - used like a function
    """Count rows and NULLs per column while another action runs; no job of its own.

    ``watch = observed(df, "load"); watch.frame.write...; watch.metrics()``

    Write ``frame`` as it is: counts are exact in the last stage of a job, while a stage that
    feeds a shuffle may run again and count twice. ``flag`` is a boolean column whose true rows
    are counted and which ``frame`` then leaves out.
    """

    def __init__(self, df: DataFrame, name: str, flag: str | None = None):
        self._columns = [c for c in df.columns if c != flag]
        self._observation = Observation(name)
        self.frame = df.observe(
            self._observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(column(flag) if flag else F.lit(False)).alias("flagged"),
            *[
                F.count_if(column(c).isNull()).alias(f"nulls{i}")
                for i, c in enumerate(self._columns)
            ],
        ).select(*[column(c) for c in self._columns])

    def metrics(self) -> LoadMetrics:
        """What the first action on ``frame`` saw; waits for that action."""
        seen = self._observation.get
        return LoadMetrics(
            int(seen["rows"]),
            {c: int(seen[f"nulls{i}"]) for i, c in enumerate(self._columns)},
            int(seen["flagged"]),
        )
