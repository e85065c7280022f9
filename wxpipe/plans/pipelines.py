"""The user-level jobs: three streams and the batch load."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean
from ..operators.conform import conform
from ..operators.metrics import LoadMetrics, observed
from ..operators.quality import audit_star
from ..operators.star import Dimension, build_dimensions, build_fact
from ..schemas import SENSOR_MESSAGE, WEATHER_MESSAGE, WEATHER_STAR, StarSpec, TableContract
from ..session import require_utc, row_bytes, sized
from ..sinks.tables import current, recover, swap_in
from ..staging import Staging
from ..storage import names_in
from ..streaming.metrics import BatchMetrics
from ..streaming.run import observations, start_console, start_stream

_CHANGED = "__changed"
BatchStore = Callable[[DataFrame, int], None]


def sensor_to_console(
    messages: DataFrame, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    return start_console(observations(messages, SENSOR_MESSAGE), checkpoint, every, **options)


def sensor_to_table(
    messages: DataFrame,
    store: BatchStore,
    checkpoint: str,
    every: str | None = None,
    rejected: str | None = None,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    """Sensor messages to a table; with ``rejected``, unreadable ones have their text there.

    Give :func:`~wxpipe.streaming.landing` the same name to store them apart. Each message is
    parsed once either way.
    """
    rows = observations(messages, SENSOR_MESSAGE, rejected=rejected)
    return start_stream(rows, store, checkpoint, every, metrics, rejected)


def weather_to_table(
    messages: DataFrame,
    store: BatchStore,
    checkpoint: str,
    every: str | None = None,
    rejected: str | None = None,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    """Weather messages to a table, as :func:`sensor_to_table`."""
    require_utc(messages.sparkSession)
    rows = observations(messages, WEATHER_MESSAGE, rejected=rejected)
    return start_stream(rows, store, checkpoint, every, metrics, rejected)


class IntegrityError(ValueError):
    """A primary or foreign key of a freshly built star does not hold."""


@dataclass(frozen=True)
class StarTables:
    cleaned: DataFrame
    dimensions: dict[str, DataFrame]
    fact: DataFrame
    metrics: dict[str, LoadMetrics]


def _own_session(raw: DataFrame) -> DataFrame:
    """``raw`` in a session of this load's own, its shuffles cut for all of it."""
    require_utc(raw.sparkSession)
    # On a stored table the count comes from file footers.
    return sized(raw, raw.count() * row_bytes(raw.schema))


def _load_cleaned(
    raw: DataFrame, star: StarSpec, staging: Staging, protect: Collection[str]
) -> tuple[DataFrame, LoadMetrics]:
    typed = conform(clean(raw, protect), star.cleaned, changed=_CHANGED)
    return _store(typed, star.cleaned.name, staging, _CHANGED)


def _store(
    df: DataFrame, name: str, staging: Staging, flag: str | None = None
) -> tuple[DataFrame, LoadMetrics]:
    """Stage a table, with its row and NULL counts and the seconds it took."""
    watch = observed(df, name, flag)
    start = time.perf_counter()
    stored = staging.write(watch.frame, name)
    return stored, replace(watch.metrics(), seconds=time.perf_counter() - start)


def star_frames(
    raw: DataFrame,
    staging: Staging,
    star: StarSpec = WEATHER_STAR,
    protect: Collection[str] = (),
) -> tuple[DataFrame, dict[str, Dimension], DataFrame]:
    """Cleaned table, dimensions and fact as frames over ``staging``; the fact is not stored.

    The cleaned table is stored once; the dimensions scan its attribute columns and the fact
    scans it whole. All frames belong to a session whose shuffles are sized for ``raw``, so the
    fact keeps that size whenever it is evaluated.
    """
    raw = _own_session(raw)
    staging = staging.within(raw.sparkSession)
    cleaned, seen = _load_cleaned(raw, star, staging, protect)
    dimensions = build_dimensions(cleaned, star.dimensions, staging)
    return cleaned, dimensions, _fact(cleaned, star, dimensions, seen)


def _fact(
    cleaned: DataFrame, star: StarSpec, dimensions: dict[str, Dimension], seen: LoadMetrics
) -> DataFrame:
    """Cleaned rows were distinct before they were stored; if storing changed no value they
    still are."""
    return build_fact(cleaned, star, dimensions, distinct=seen.flagged == 0)


def _refuse_strangers(spark: SparkSession, folder: str, star: StarSpec) -> None:
    """A star replaces its folder as a whole, so nothing else may lie there."""
    own = {star.cleaned.name, star.fact.name, *(d.table for d in star.dimensions)}
    found = set(names_in(spark, folder))
    strangers = sorted(n for n in found - own if not n.startswith(("_", ".")))
    if strangers:
        raise ValueError(f"{folder} holds other tables: {strangers}")


def read_star(spark: SparkSession, folder: str, star: StarSpec = WEATHER_STAR) -> StarTables:
    """The star stored at ``folder``: one load's tables, also in the middle of a swap."""
    place = current(spark, folder)

    def stored(contract: TableContract) -> DataFrame:
        return spark.read.schema(contract.struct()).parquet(f"{place}/{contract.name}")

    dimensions = {d.table: stored(star.dimension_contract(d)) for d in star.dimensions}
    return StarTables(stored(star.cleaned), dimensions, stored(star.fact), {})


def load_star(
    raw: DataFrame,
    folder: str,
    star: StarSpec = WEATHER_STAR,
    protect: Collection[str] = (),
    audit: bool = False,
) -> StarTables:
    """Clean ``raw`` and refresh cleaned table, dimensions and fact below ``folder``.

    ``raw`` is read for its size, for the column decisions and for its rows, so it should be a
    stored table.
    All tables are written below one folder beside ``folder``, which then takes its place as a
    whole: :func:`read_star` sees the old star or the new one, never keys of one with facts of
    the other, and readers of the plain paths see none for the time between two renames. On any
    error the old star stays; should the process die in the swap, the next load finishes it.
    ``folder`` is the star's alone; other tables in it are refused. ``protect`` keeps columns the
    cleaners would drop, such as an attribute with one value only, without which the fact would
    be empty. ``audit`` checks all keys before the swap, which costs a scan of the fact's key
    columns.
    """
    spark: SparkSession = raw.sparkSession
    folder = folder.rstrip("/")
    recover(spark, [folder])
    _refuse_strangers(spark, folder, star)
    beside = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent().toString()
    # What will be swapped in is staged beside its target; the rest in the shared folder.
    own = _own_session(raw)
    with Staging(own.sparkSession, beside) as staging, Staging(own.sparkSession) as scratch:
        metrics = {}
        cleaned, metrics[star.cleaned.name] = _load_cleaned(own, star, staging, protect)
        seen, tables = metrics[star.cleaned.name], {}
        dimensions = build_dimensions(cleaned, star.dimensions, scratch)
        frames = {table: d.frame for table, d in dimensions.items()}
        frames[star.fact.name] = _fact(cleaned, star, dimensions, seen)
        # Side by side: the dimensions' small jobs fill gaps the fact's tasks leave.
        with ThreadPoolExecutor(len(frames)) as pool:
            # Each thread gets its own copy of the caller's job group, pool and tags: wrapped
            # once for all, they would share one and overwrite each other's query ids.
            runs = {
                table: pool.submit(inheritable_thread_target(spark)(_store), df, table, staging)
                for table, df in frames.items()
            }
            for table, run in runs.items():
                tables[table], metrics[table] = run.result()
        if audit:
            broken = audit_star(tables[star.fact.name], tables, star).limit(5).collect()
            if broken:
                raise IntegrityError(f"keys broken, such as {broken}")
        swap_in(spark, staging.path(""), folder)

    def stored(table: str, like: DataFrame) -> DataFrame:
        return spark.read.schema(like.schema).parquet(f"{folder}/{table}")

    return StarTables(
        stored(star.cleaned.name, cleaned),
        {table: stored(table, d.frame) for table, d in dimensions.items()},
        stored(star.fact.name, tables[star.fact.name]),
        metrics,
    )
