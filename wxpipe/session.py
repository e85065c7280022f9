"""Session settings and shuffle sizing."""

from __future__ import annotations

import atexit
import contextlib
import math
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MIB = 1024 * 1024
MOST_PARTITIONS = 32_768
_SHUFFLES = "spark.sql.shuffle.partitions"
_SHIPPED: set[str] = set()

# What the operators count on: zone-free timestamps round-trip, casts that do not fit raise,
# and the runtime re-planner may merge small shuffle partitions and split skewed ones.
DEFAULTS: Mapping[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Beyond this many scan tasks, tasks grow instead: a shuffle keeps a block per pair of tasks.
    "spark.sql.files.maxPartitionNum": "50000",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "wxpipe",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with :data:`DEFAULTS`; ``conf`` wins, ``master`` only where not submitted."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    They need it for functions that run in tasks, and find it by themselves only if it is
    installed on every machine or the driver was started beside it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    # The driver serves this file to the executors, as long as it runs.
    folder = tempfile.mkdtemp(prefix="wxpipe-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{home.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for file in sorted(home.rglob("*.py")):
            packed.write(file, f"{home.name}/{file.relative_to(home)}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def require_utc(spark: SparkSession) -> None:
    """Refuse a session zone with clock changes or an offset, in which zone-free times move."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    time = spark._jvm.java.time
    rules = time.ZoneId.of(zone).getRules()
    if not rules.isFixedOffset() or rules.getOffset(time.Instant.EPOCH).getTotalSeconds():
        raise ValueError(f"spark.sql.session.timeZone is {zone}; weather times need UTC")


def partitions_for(n_bytes: int, target_mb: int = 128, most: int = MOST_PARTITIONS) -> int:
    """Shuffle partitions of about ``target_mb``.

    Past ``most`` of them partitions grow, and spill: a shuffle keeps a block for each pair of
    tasks, so their number cannot follow the data for ever. Raise it with the cluster.
    """
    return min(most, max(1, math.ceil(n_bytes / (target_mb * MIB))))


def row_bytes(schema: T.StructType, text_bytes: int = 24) -> int:
    """Rough width of a shuffled row: a word per field, and the text of text fields."""
    texts = sum(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in schema.fields)
    return 8 * (len(schema.fields) + 1) + text_bytes * texts


def in_own_session(df: DataFrame, settings: Mapping[str, str]) -> DataFrame:
    """``df`` in a session of its own: the settings of the frame's session, and these on top.

    Settings of the frame's session are not touched, so jobs that run at the same time do not see
    each other's, and a frame evaluated later keeps its own.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.get(key, None) != value:
            with contextlib.suppress(AnalysisException):  # fixed when the application started
                own.conf.set(key, value)
    # A global view is how one session hands a frame to another.
    name = f"own_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return own.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def sized(
    df: DataFrame, n_bytes: int, target_mb: int = 128, settings: Mapping[str, str] | None = None
) -> DataFrame:
    """``df`` in a session of its own, whose shuffles are cut for ``n_bytes``.

    The number of shuffle partitions is raised where it is too low and never lowered: merging
    small partitions is the re-planner's job, but it cannot cut an aggregation into more pieces
    than the shuffle started with. (A repartition with a number of its own would do the same, but
    shuffles all rows, where an aggregation shuffles what each task has already merged.)
    """
    before = int(df.sparkSession.conf.get(_SHUFFLES))
    count = max(before, partitions_for(n_bytes, target_mb))
    return in_own_session(df, {**(settings or {}), _SHUFFLES: str(count)})
