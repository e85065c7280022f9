"""Micro-batches appended to a stored table, each exactly once in effect.

Layout of a table's folder:

* ``ingest_stream=S/ingest_batch=N``: the rows of batch N of stream S, moved in whole. A batch
  with rejected messages set apart has the two below it, as ``ingest_bad=false`` and ``=true``;
* ``_compacted/<id>``: many batches rewritten as few files (:func:`compact`), good rows and
  rejected ones side by side;
* ``_manifest/<version>``: which compacted folders count, and which batches they hold. Batches
  held are no longer read from their own folders, and a replay of one is not stored again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.names import column
from ..session import partitions_for
from ..sinks.tables import swap_in
from ..storage import add_text, delete, exists, make_folder, names_in, read_text, size_of

_STREAM, _BATCH, _BAD = "ingest_stream", "ingest_batch", "ingest_bad"
_QUERY_ID = "sql.streaming.queryId"
_COMPACTED, _MANIFEST = "_compacted", "_manifest"
_GOOD_PART, _BAD_PART = f"{_BAD}=false", f"{_BAD}=true"
#: Compacted folders beside each other before they are rewritten as one.
MERGE_AT = 8


@dataclass(frozen=True)
class Manifest:
    """One state of a landed table's compaction."""

    version: int = 0
    #: Compacted folders that are read, and those that the last compaction stopped reading.
    folders: tuple[str, ...] = ()
    stale: tuple[str, ...] = ()
    #: Batches they hold: per stream, first and last of each run of ids.
    holds: dict[str, list[list[int]]] = field(default_factory=dict)

    def has(self, stream: str, batch: int) -> bool:
        return any(first <= batch <= last for first, last in self.holds.get(stream, []))

    def holding(self, batches: Iterable[tuple[str, int]]) -> dict[str, list[list[int]]]:
        """``holds`` with more batches in it."""
        ids: dict[str, set[int]] = {}
        for stream, batch in batches:
            ids.setdefault(stream, set()).add(batch)
        out = {stream: [list(run) for run in runs] for stream, runs in self.holds.items()}
        for stream, more in ids.items():
            runs = sorted(out.get(stream, []) + [[n, n] for n in more])
            joined: list[list[int]] = []
            for first, last in runs:
                if joined and first <= joined[-1][1] + 1:
                    joined[-1][1] = max(joined[-1][1], last)
                else:
                    joined.append([first, last])
            out[stream] = joined
        return out


def manifest(spark: SparkSession, folder: str) -> Manifest:
    """The newest manifest of a landed table; an empty one before the first compaction."""
    names = [n for n in names_in(spark, f"{folder}/{_MANIFEST}") if n.isdigit()]
    if not names:
        return Manifest()
    newest = max(names, key=int)
    said = json.loads(read_text(spark, f"{folder}/{_MANIFEST}/{newest}"))
    return Manifest(int(newest), tuple(said["folders"]), tuple(said["stale"]), said["holds"])


def landing(
    folder: str, stream: str | None = None, rejected: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores batch N of a stream in a folder of its own.

    A batch replayed after a failure replaces its folder instead of adding to the table, or adds
    nothing if it has been compacted meanwhile. The folder is named by the checkpoint's query id
    (or ``stream``) and the batch id, so a fresh checkpoint, which counts from 0 again, cannot
    overwrite what an older one stored. A batch is written out of readers' sight and moved in
    whole.

    ``rejected`` names a column that holds the payload of a message that could not be read, and
    NULL in all other rows. Good rows and rejected payloads are then written apart, by one job
    and in one move, so a batch shows both or neither.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not name:
            raise RuntimeError("no stream name: call from foreachBatch or pass one")
        target = f"{folder}/{_STREAM}={name}/{_BATCH}={batch_id}"
        if manifest(spark, folder).has(name, batch_id):
            return
        hidden = f"{folder}/_inflight/{name}-{batch_id}"
        if rejected is None:
            batch.write.mode("overwrite").parquet(hidden)
        else:
            apart = batch.withColumn(_BAD, column(rejected).isNotNull())
            apart.write.mode("overwrite").partitionBy(_BAD).parquet(hidden)
            for part in (_GOOD_PART, _BAD_PART):
                make_folder(spark, f"{hidden}/{part}")
        swap_in(spark, hidden, target)

    return store


def _batches(spark: SparkSession, folder: str, held: Manifest) -> list[tuple[str, int, str]]:
    """Stream, id and folder of every batch that has not been compacted."""
    found = []
    for outer in names_in(spark, folder):
        if not outer.startswith(f"{_STREAM}="):
            continue
        stream = outer.split("=", 1)[1]
        for inner in names_in(spark, f"{folder}/{outer}"):
            if inner.startswith(f"{_BATCH}="):
                batch = int(inner.split("=", 1)[1])
                if not held.has(stream, batch):
                    found.append((stream, batch, f"{folder}/{outer}/{inner}"))
    return found


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _places(spark: SparkSession, folder: str, held: Manifest, bad: bool) -> list[str]:
    """Folders that hold the good rows, or the rejected ones."""
    part = _BAD_PART if bad else _GOOD_PART
    places = []
    for _, _, path in _batches(spark, folder, held):
        apart = part in names_in(spark, path)
        if apart or not bad:
            places.append(f"{path}/{part}" if apart else path)
    compacted = [f"{folder}/{_COMPACTED}/{name}/{part}" for name in held.folders]
    return places + [path for path in compacted if exists(spark, path)]


def landed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table all batches add up to, without rejected messages that were set apart."""
    held = manifest(spark, folder)
    return _read(spark, _places(spark, folder, held, bad=False), schema)


def rejected_messages(spark: SparkSession, folder: str, payload: str = "payload") -> DataFrame:
    """Payloads of the messages that could not be read, where a stream sets them apart."""
    held = manifest(spark, folder)
    schema = T.StructType([T.StructField(payload, T.StringType())])
    return _read(spark, _places(spark, folder, held, bad=True), schema)


def compact(
    spark: SparkSession, folder: str, schema: T.StructType, payload: str = "payload",
    file_mb: int = 256,
) -> Manifest:
    """Rewrite all landed batches as few files; readers see the same rows before and after.

    Takes every batch that is in place: a batch that the stream delivers again is known to be
    held and is not stored twice. Once :data:`MERGE_AT` compacted folders lie beside each other
    they are rewritten along with the batches. The new manifest counts from the moment its file
    appears; what it no longer names is kept until the next compaction, so that readers that
    began before can finish. Stopped at any point, it leaves the old state or the new one. Of two
    at once, the one that publishes second raises and changes nothing.
    """
    folder = folder.rstrip("/")
    held = manifest(spark, folder)
    _clean_up(spark, folder, held)
    batches = _batches(spark, folder, held)
    merged = held.folders if len(held.folders) >= MERGE_AT else ()
    if not batches and not merged:
        return held
    part = Manifest(held.version, merged, (), held.holds)
    name = uuid.uuid4().hex
    target = f"{folder}/{_COMPACTED}/{name}"
    for bad in (False, True):
        places = _places(spark, folder, part, bad)
        if places:
            rows = T.StructType([T.StructField(payload, T.StringType())]) if bad else schema
            n_files = partitions_for(sum(size_of(spark, p) for p in places), file_mb)
            # Whole input partitions are put together: no row is shuffled.
            _read(spark, places, rows).coalesce(n_files).write.parquet(
                f"{target}/{_BAD_PART if bad else _GOOD_PART}"
            )
    new = Manifest(
        held.version + 1,
        (*(f for f in held.folders if f not in merged), name),
        merged,
        held.holding((stream, batch) for stream, batch, _ in batches),
    )
    text = json.dumps({"folders": new.folders, "stale": new.stale, "holds": new.holds})
    make_folder(spark, f"{folder}/{_MANIFEST}")
    if not add_text(spark, f"{folder}/{_MANIFEST}/{new.version}", text):
        delete(spark, target)
        raise RuntimeError(f"{folder} was compacted by another job at the same time")
    return new


def _clean_up(spark: SparkSession, folder: str, held: Manifest) -> None:
    """Remove what the newest manifest, as of the last compaction, made superfluous."""
    for name in held.stale:
        delete(spark, f"{folder}/{_COMPACTED}/{name}")
    for stream, _, path in _batches(spark, folder, Manifest()):
        batch = int(path.rsplit("=", 1)[1])
        if held.has(stream, batch):
            delete(spark, path)
    for name in names_in(spark, f"{folder}/{_MANIFEST}"):
        if name.isdigit() and int(name) < held.version:
            delete(spark, f"{folder}/{_MANIFEST}/{name}")
