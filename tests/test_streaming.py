import importlib
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from wxpipe.plans import sensor_to_console, sensor_to_table, weather_to_table
from wxpipe.schemas import SENSOR_MESSAGE, WEATHER_MESSAGE
from wxpipe.sources import file_stream, kafka_options, kafka_stream, table_stream
from wxpipe.streaming import (
    BatchMetrics,
    compact,
    landed,
    landing,
    manifest,
    rejected_messages,
    start_stream,
)
from wxpipe.streaming.landing import MERGE_AT

PAYLOAD = "value binary"


def send(spark, topic, *ids):
    """Add one file with a message per id."""
    texts = [
        json.dumps({"id": i, "date": "2031/07/09", "temperature": 11.25, "humidity": 47})
        for i in ids
    ]
    df = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], PAYLOAD)
    df.coalesce(1).write.mode("append").parquet(topic)


def messages(spark, topic, **options):
    schema = spark.createDataFrame([], PAYLOAD).schema
    return file_stream(spark, topic, schema, **options)


@pytest.fixture
def place(tmp_path):
    return {n: str(tmp_path / n) for n in ("topic", "table", "checkpoint", "other")}


def ids(spark, place):
    return sorted(int(r.id) for r in landed(spark, place["table"], SENSOR_MESSAGE).collect())


def ingest(spark, place, checkpoint="checkpoint", **options):
    query = sensor_to_table(
        messages(spark, place["topic"], **options), landing(place["table"]), place[checkpoint]
    )
    query.awaitTermination()
    return query


def test_several_batches_add_up(spark, place, tmp_path):
    for batch in ((1, 2), (3,), (4, 5)):
        send(spark, place["topic"], *batch)
    ingest(spark, place, max_files=1)
    assert ids(spark, place) == [1, 2, 3, 4, 5]
    assert len(list((tmp_path / "table").glob("ingest_stream=*/ingest_batch=*"))) == 3
    assert landed(spark, place["table"], SENSOR_MESSAGE).schema == SENSOR_MESSAGE


def test_restart_takes_only_what_is_new(spark, place):
    send(spark, place["topic"], 1, 2)
    ingest(spark, place)
    ingest(spark, place)
    send(spark, place["topic"], 3)
    ingest(spark, place)
    assert ids(spark, place) == [1, 2, 3]


def test_replayed_batch_replaces_itself(spark, place):
    schema = SENSOR_MESSAGE
    batch = spark.createDataFrame([("1", None, 1.0, None), ("2", None, 2.0, None)], schema)
    store = landing(place["table"], stream="s")
    store(batch, 0)
    store(batch, 1)
    store(batch, 0)
    assert ids(spark, place) == [1, 1, 2, 2]


def test_batch_that_failed_after_its_write_is_not_doubled(spark, place):
    send(spark, place["topic"], 1, 2)
    store = landing(place["table"])
    failures = [True]

    def fragile(batch, batch_id):
        store(batch, batch_id)
        if failures:
            failures.pop()
            raise RuntimeError("lost after the write")

    stream = messages(spark, place["topic"])
    with pytest.raises(Exception, match="lost after the write"):
        sensor_to_table(stream, fragile, place["checkpoint"]).awaitTermination()
    sensor_to_table(stream, fragile, place["checkpoint"]).awaitTermination()
    assert ids(spark, place) == [1, 2]


def test_half_written_batch_is_not_read(spark, place):
    batch = spark.createDataFrame([("1", None, 1.0, None)], SENSOR_MESSAGE)
    landing(place["table"], stream="s")(batch, 0)
    batch.write.parquet(place["table"] + "/_inflight/s-1")
    assert ids(spark, place) == [1]


def test_leftover_of_a_crashed_swap_is_not_read(spark, place, monkeypatch):
    """Dying between the swap and its clean-up must not double the batch."""
    batch = spark.createDataFrame([("1", None, 1.0, None)], SENSOR_MESSAGE)
    store = landing(place["table"], stream="s")
    store(batch, 0)
    monkeypatch.setattr("wxpipe.sinks.tables.delete", lambda *_: None)
    store(batch, 0)
    assert list(Path(place["table"]).glob("ingest_stream=s/_old-*"))
    assert ids(spark, place) == [1]


def batch_of(spark, *numbers):
    return spark.createDataFrame([(str(n), None, 1.0, None) for n in numbers], SENSOR_MESSAGE)


def test_compaction_keeps_the_rows_and_knows_its_batches(spark, place):
    store, folder = landing(place["table"], stream="s"), place["table"]
    for n in range(4):
        store(batch_of(spark, 2 * n, 2 * n + 1), n)
    first = compact(spark, folder, SENSOR_MESSAGE)
    assert first.holds == {"s": [[0, 3]]} and len(first.folders) == 1
    assert ids(spark, place) == list(range(8))
    store(batch_of(spark, 2, 3), 1)  # delivered again
    assert ids(spark, place) == list(range(8))
    store(batch_of(spark, 12), 6)
    landing(folder, stream="t")(batch_of(spark, 20), 0)
    assert ids(spark, place) == [*range(8), 12, 20]
    second = compact(spark, folder, SENSOR_MESSAGE)
    assert second.holds == {"s": [[0, 3], [6, 6]], "t": [[0, 0]]}
    assert ids(spark, place) == [*range(8), 12, 20]
    # Nothing new: nothing written, and folders of held batches are gone by now.
    assert compact(spark, folder, SENSOR_MESSAGE) == second
    assert not list(Path(folder).glob("ingest_stream=*/ingest_batch=*"))
    assert landed(spark, folder, SENSOR_MESSAGE).inputFiles()
    assert ids(spark, place) == [*range(8), 12, 20]


def test_many_compactions_are_merged(spark, place):
    store, folder = landing(place["table"], stream="s"), place["table"]
    for n in range(MERGE_AT + 3):
        store(batch_of(spark, n), n)
        state = compact(spark, folder, SENSOR_MESSAGE)
        assert len(state.folders) <= MERGE_AT
        assert ids(spark, place) == list(range(n + 1))
    assert state.holds == {"s": [[0, MERGE_AT + 2]]}
    compact(spark, folder, SENSOR_MESSAGE)
    kept = {p.name for p in Path(folder, "_compacted").iterdir()}
    assert kept == set(manifest(spark, folder).folders)


@pytest.mark.parametrize("stopped", ["write", "publish", "clean"])
def test_a_compaction_stopped_anywhere_changes_no_rows(spark, place, monkeypatch, stopped):
    module = importlib.import_module("wxpipe.streaming.landing")
    store, folder = landing(place["table"], stream="s"), place["table"]
    for n in range(3):
        store(batch_of(spark, n), n)
    if stopped == "clean":
        compact(spark, folder, SENSOR_MESSAGE)
        store(batch_of(spark, 3), 3)

    def stop(*_):
        raise KeyboardInterrupt

    before = ids(spark, place)
    with monkeypatch.context() as patch:
        name = {"write": "make_folder", "publish": "add_text", "clean": "delete"}[stopped]
        patch.setattr(module, name, stop)
        with pytest.raises(KeyboardInterrupt):
            compact(spark, folder, SENSOR_MESSAGE)
    assert ids(spark, place) == before
    compact(spark, folder, SENSOR_MESSAGE)
    assert ids(spark, place) == before
    store(batch_of(spark, 0), 0)
    assert ids(spark, place) == before


def test_the_later_of_two_compactions_gives_way(spark, place, monkeypatch):
    module = importlib.import_module("wxpipe.streaming.landing")
    store, folder = landing(place["table"], stream="s"), place["table"]
    store(batch_of(spark, 1), 0)
    real = module.add_text

    def overtaken(spark, path, text):
        real(spark, path, json.dumps({"folders": [], "stale": [], "holds": {}}))
        return real(spark, path, text)

    monkeypatch.setattr(module, "add_text", overtaken)
    with pytest.raises(RuntimeError, match="at the same time"):
        compact(spark, folder, SENSOR_MESSAGE)
    assert ids(spark, place) == [1]
    assert not list(Path(folder, "_compacted").iterdir())


def test_rejected_messages_are_stored_apart(spark, place):
    send(spark, place["topic"], 1, 2)
    bad = spark.createDataFrame([(bytearray(b"junk"),), (bytearray(b"[]"),), (None,)], PAYLOAD)
    bad.coalesce(1).write.mode("append").parquet(place["topic"])
    send(spark, place["topic"], 3)
    store, stops = landing(place["table"], rejected="payload"), [1]
    metrics = BatchMetrics()

    def fragile(batch, batch_id):
        store(batch, batch_id)
        if batch_id in stops:
            stops.remove(batch_id)
            raise RuntimeError("lost after the write")

    def run(**more):
        source = messages(spark, place["topic"], max_files=1)
        return sensor_to_table(
            source, fragile, place["checkpoint"], rejected="payload", **more
        )

    with pytest.raises(Exception, match="lost after the write"):
        run().awaitTermination()
    seen = metrics.wait(run(metrics=metrics))
    for _ in range(2):
        assert ids(spark, place) == [1, 2, 3]
        assert rows(rejected_messages(spark, place["table"])) == [("",), ("[]",), ("junk",)]
        compact(spark, place["table"], SENSOR_MESSAGE)
    assert [(m.batch, m.rows, m.rejected) for m in seen] == [(1, 3, 3), (2, 1, 0)]
    assert all(m.seconds >= 0 for m in seen)


def test_a_table_may_set_rejects_apart_later(spark, place):
    """Batches stored before and after are read alike."""
    landing(place["table"], stream="a")(batch_of(spark, 1), 0)
    apart = batch_of(spark, 2).selectExpr("*", "CAST(NULL AS STRING) AS payload")
    landing(place["table"], stream="b", rejected="payload")(apart, 0)
    assert ids(spark, place) == [1, 2]
    assert rows(rejected_messages(spark, place["table"])) == []
    compact(spark, place["table"], SENSOR_MESSAGE)
    assert ids(spark, place) == [1, 2]


def test_new_checkpoint_does_not_overwrite(spark, place):
    send(spark, place["topic"], 1, 2)
    ingest(spark, place)
    ingest(spark, place, checkpoint="other")
    assert ids(spark, place) == [1, 1, 2, 2]


def test_landing_outside_a_stream_needs_a_name(spark, place):
    with pytest.raises(RuntimeError, match="stream name"):
        landing(place["table"])(spark.createDataFrame([], SENSOR_MESSAGE), 0)


def test_bad_messages_reach_the_table_as_null_rows(spark, place):
    df = spark.createDataFrame([(bytearray(b"junk"),), (None,)], PAYLOAD)
    df.write.parquet(place["topic"])
    query = weather_to_table(
        messages(spark, place["topic"]), landing(place["table"]), place["checkpoint"]
    )
    query.awaitTermination()
    out = landed(spark, place["table"], WEATHER_MESSAGE)
    assert rows(out) == [(None,) * 10] * 2


def test_console(spark, place):
    send(spark, place["topic"], 1, 2)
    sizes = []
    query = sensor_to_console(
        messages(spark, place["topic"]),
        place["checkpoint"],
        received=lambda _, n_rows: sizes.append(n_rows),
    )
    query.awaitTermination()
    assert query.exception() is None
    assert sum(sizes) == 2


def test_byte_bound_cuts_batches(spark, place):
    for i in range(3):
        send(spark, place["topic"], i)
    query = ingest(spark, place, max_bytes=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert ids(spark, place) == [0, 1, 2]


def test_streams_refuse_batch_actions(spark, place):
    send(spark, place["topic"], 1)
    with pytest.raises(AnalysisException, match="writeStream"):
        messages(spark, place["topic"]).collect()


def test_pattern(spark, place):
    send(spark, place["topic"], 1)
    stream = messages(spark, place["topic"], pattern="nothing-*")
    start_stream(stream, landing(place["table"]), place["checkpoint"]).awaitTermination()


def test_kafka_options():
    assert kafka_options("h:9092", "weather_data") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "weather_data",
        "startingOffsets": "latest",
    }
    more = kafka_options(
        "h:9092", "t", "earliest", 1000, 32, extra={"kafka.security.protocol": "SSL"}
    )
    assert more["maxOffsetsPerTrigger"] == "1000" and more["minPartitions"] == "32"
    assert more["startingOffsets"] == "earliest"
    assert more["kafka.security.protocol"] == "SSL"


def test_missing_connector_is_reported(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9", "sensor_data")


def test_console_prints_few_rows_and_counts_all(spark, place, capsys):
    send(spark, place["topic"], *range(50))
    sizes = {}
    job = sensor_to_console(
        messages(spark, place["topic"]), place["checkpoint"], rows=3, received=sizes.__setitem__
    )
    job.awaitTermination()
    printed = capsys.readouterr().out
    assert sizes == {0: 50}
    assert "batch 0: 50 rows" in printed and printed.count("2031/07/09") == 3


def test_stream_over_a_table_of_one_file_or_of_many(spark, tmp_path, place):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "parts/events.parquet"))
    for name, path in (("a", "/root/testdata/sf0.001"), ("b", str(tmp_path / "parts"))):
        stream = table_stream(spark, f"{path}/events.parquet", events.schema)
        start_stream(stream, landing(str(tmp_path / name)), str(tmp_path / f"ck-{name}")).awaitTermination()
        assert landed(spark, str(tmp_path / name), events.schema).count() == events.count()


def test_no_batch_yet_is_an_empty_table(spark, tmp_path):
    assert landed(spark, str(tmp_path / "none"), SENSOR_MESSAGE).count() == 0
