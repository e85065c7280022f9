"""

Decimal columns leave the registered queries as text or as doubles so that any checker reads
them alike; the declared types themselves are asserted in tests/.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The package lies beside this file, wherever the driver is started.
if str(Path(__file__).resolve().parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import ORACLES
from wxpipe import operators as ops
from wxpipe.functions import parse_json
from wxpipe.plans import (
    load_star,
    sensor_to_console,
    sensor_to_table,
    star_frames,
    weather_to_table,
)
from wxpipe.plans.sample import base_observations, dirty_observations
from wxpipe.schemas import (
    SENSOR_MESSAGE,
    TRANSFORMED_WEATHER,
    WEATHER_MESSAGE,
    WEATHER_STAR,
)
from wxpipe.sinks import publish
from wxpipe.sources import file_stream, parquet_table, table_stream
from wxpipe.staging import Staging
from wxpipe.streaming import (
    BatchMetrics,
    compact,
    landed,
    landing,
    observations,
    rejected_messages,
    start_stream,
)

Query = Callable[[SparkSession, str], DataFrame]


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where these are not installed."""
    try:
        import corpus_pipeline
        from wxpipe.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "wxpipe.llm", "wxpipe.llm.queries"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, llm.ORACLES | sql


_LLM_QUERIES, _LLM_SQL = _training_data()

# A micro-batch takes files up to this size together, so a long backlog is cut into batches.
BATCH_BYTES = 1 << 40


# ---- helpers ----------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, f"{sf_dir}/{name}.parquet")


def _staging(spark: SparkSession) -> Staging:
    """Results are evaluated after the query function returns, so staged tables outlive it."""
    return Staging(spark, until_exit=True)


def _raw(spark: SparkSession, sf_dir: str, staging: Staging) -> DataFrame:
    """The dirty observations as a stored raw table, which the cleaners read twice."""
    return staging.write(dirty_observations(spark, sf_dir), "weather_info")


def _amounts(df: DataFrame, to: str = "double") -> DataFrame:
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({n: F.col(n).cast(to) for n in decimals})


def _zone_free(df: DataFrame) -> DataFrame:
    return df.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


def _messages(df: DataFrame) -> DataFrame:
    """Rows as JSON payloads in the binary form a topic delivers."""
    return df.select(F.to_json(F.struct(*df.columns)).cast("binary").alias("value"))


# ---- scan and parse ---------------------------------------------------------------------


def scan_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_observations(spark, sf_dir)


def _sensor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy/MM/dd").alias("date"),
        F.col("value").alias("temperature"),
        F.col("user_id").alias("humidity"),
    )


def json_parse_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(_messages(_sensor_rows(spark, sf_dir)), SENSOR_MESSAGE)


def json_parse_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_free(parse_json(_messages(base_observations(spark, sf_dir)), WEATHER_MESSAGE))


_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def _props_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` with the closing brace lost in every tenth message."""
    cut = F.expr("CASE WHEN event_id % 10 = 0 THEN left(props, length(props) - 1) ELSE props END")
    return _table(spark, sf_dir, "events").select("event_id", cut.alias("value"))


def json_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(_props_cut(spark, sf_dir), _PROPS, keep=["event_id"])


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(
        _props_cut(spark, sf_dir), _PROPS, keep=["event_id"], bad_record="payload"
    )


# ---- cleaning ---------------------------------------------------------------------------


def clean_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_null_rows(dirty_observations(spark, sf_dir))


def clean_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_duplicate_rows(dirty_observations(spark, sf_dir))


def _complete(spark: SparkSession, sf_dir: str, staging: Staging, **extra) -> DataFrame:
    rows = ops.drop_duplicate_rows(ops.drop_null_rows(dirty_observations(spark, sf_dir)))
    return staging.write(rows.withColumns(extra), "complete")


def clean_dup_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _complete(
        spark,
        sf_dir,
        _staging(spark),
        city_copy=F.col("city"),
        id_dbl=F.col("id").cast("double"),
        id_text=F.col("id").cast("string"),
    )
    return ops.drop_duplicate_columns(rows)


def clean_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_constant_columns(
        _complete(spark, sf_dir, _staging(spark), station=F.lit("S1"))
    )


def clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dirty_observations(spark, sf_dir).withColumns(
        {
            "city_copy": F.col("city"),
            "id_dbl": F.col("id").cast("double"),
            "station": F.lit("S1"),
        }
    )
    return ops.clean(_staging(spark).write(raw, "weather_info"))


# ---- typed load and star ----------------------------------------------------------------


def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    cleaned = ops.clean(_raw(spark, sf_dir, staging)).drop("cloud_cover")
    typed = ops.conform(cleaned, TRANSFORMED_WEATHER)
    publish(spark, {TRANSFORMED_WEATHER.name: typed}, staging.path("tables"))
    stored = parquet_table(
        spark, staging.path(f"tables/{TRANSFORMED_WEATHER.name}"), TRANSFORMED_WEATHER.struct()
    )
    return _amounts(stored, "string")


def _dimension(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staging = _staging(spark)
        spec = [d for d in WEATHER_STAR.dimensions if d.table == table]
        cleaned = ops.conform(ops.clean(_raw(spark, sf_dir, staging)), TRANSFORMED_WEATHER)
        return ops.build_dimensions(cleaned, spec, staging)[table].frame

    return query


def surrogate_key_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for every part name and every customer name, numbered apart in one job."""
    names = (
        _table(spark, sf_dir, "part")
        .select(F.lit("part").alias("slot"), F.col("p_name").alias("member"))
        .unionByName(
            _table(spark, sf_dir, "customer").select(
                F.lit("customer").alias("slot"), F.col("c_name").alias("member")
            )
        )
        .distinct()
    )
    return ops.number_within(names, "slot", "member", "key", _staging(spark), groups=2)


def fact_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    cleaned, dimensions, _ = star_frames(_raw(spark, sf_dir, staging), staging)
    return _amounts(reduce(ops.lookup_join, dimensions.values(), cleaned))


def fact_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact through the shuffled, salted lookups that large dimensions get."""
    staging = _staging(spark)
    cleaned, dimensions, _ = star_frames(_raw(spark, sf_dir, staging), staging)
    fact = ops.build_fact(
        cleaned, WEATHER_STAR, dimensions, broadcast_bytes=0, rows_per_task=1000
    )
    return _amounts(fact)


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    return _amounts(star_frames(_raw(spark, sf_dir, staging), staging)[2])


def star_fact_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations that fit their stored types: the fact needs no second comparison."""
    staging = _staging(spark)
    exact = {
        "temperature": F.round("temperature", 2),
        "wind_speed": F.col("wind_speed") * 8,
    }
    raw = staging.write(dirty_observations(spark, sf_dir).withColumns(exact), "weather_info")
    return _amounts(star_frames(raw, staging)[2])


def star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job with all its tables written; the stored fact read back."""
    staging = _staging(spark)
    return _amounts(load_star(_raw(spark, sf_dir, staging), staging.path("star")).fact)


def star_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fact joined to its dimensions again, keys replaced by text."""
    staging = _staging(spark)
    star = load_star(_raw(spark, sf_dir, staging), staging.path("star"))
    wide = star.fact
    for spec in WEATHER_STAR.dimensions:
        wide = wide.join(star.dimensions[spec.table], spec.key).drop(spec.key)
    return _amounts(wide)


def _one_city(spark: SparkSession, sf_dir: str, staging: Staging) -> DataFrame:
    """Every known city reported as the same one; missing ones stay missing."""
    same = F.when(F.col("city").isNotNull(), F.lit("osto"))
    return staging.write(
        dirty_observations(spark, sf_dir).withColumn("city", same), "weather_info"
    )


def star_empty_on_constant_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    return _amounts(star_frames(_one_city(spark, sf_dir, staging), staging)[2])


def star_protected_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    raw = _one_city(spark, sf_dir, staging)
    return _amounts(star_frames(raw, staging, protect=["city"])[2])


# ---- audits and metrics -----------------------------------------------------------------


def audit_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_keys(dirty_observations(spark, sf_dir), ["id"])


def audit_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as the parent table: unlabelled documents are orphans."""
    return ops.orphan_keys(
        _table(spark, sf_dir, "documents"), "doc_id", _table(spark, sf_dir, "labels"), "doc_id"
    )


def audit_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key audits of a loaded star in which some facts point at an unknown city."""
    staging = _staging(spark)
    star = load_star(_raw(spark, sf_dir, staging), staging.path("star"), audit=True)
    broken = star.fact.withColumn(
        "city_id", F.when(F.col("id") % 7 == 0, F.col("city_id") + 1000).otherwise(F.col("city_id"))
    )
    return ops.audit_star(broken, star.dimensions, WEATHER_STAR)


def preview_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dirty_observations(spark, sf_dir)
    return ops.preview(rows, 5, order=rows.columns)


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and NULL counts seen while the raw table was being written."""
    watch = ops.observed(dirty_observations(spark, sf_dir), "weather_info")
    _staging(spark).write(watch.frame, "weather_info")
    seen = watch.metrics()
    rows = [(seen.rows, name, nulls) for name, nulls in seen.nulls.items()]
    return spark.createDataFrame(rows, "n_rows long, column_name string, n_nulls long")


# ---- streams ----------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    return table_stream(spark, f"{sf_dir}/events.parquet", schema)


def stream_ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    events = _event_stream(spark, sf_dir)
    query = start_stream(events, landing(staging.path("events")), staging.path("checkpoint"))
    query.awaitTermination()
    return landed(spark, staging.path("events"), events.schema)


def stream_sensor_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sensor payloads through the sensor stream job."""
    staging = _staging(spark)
    messages = staging.write(_messages(_sensor_rows(spark, sf_dir)), "topic")
    stream = file_stream(spark, staging.path("topic"), messages.schema, max_bytes=BATCH_BYTES)
    table = staging.path("temperature_info")
    sensor_to_table(stream, landing(table), staging.path("checkpoint")).awaitTermination()
    return landed(spark, table, SENSOR_MESSAGE)


def stream_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches, one of which fails after its write and is delivered again."""
    staging = _staging(spark)
    topic = staging.write(_table(spark, sf_dir, "events").repartition(4), "topic")
    events = file_stream(spark, staging.path("topic"), topic.schema, max_files=1)
    store = landing(staging.path("events"), stream="events")

    def store_and_stop(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("stopped after the write")

    with contextlib.suppress(StreamingQueryException):
        start_stream(events, store_and_stop, staging.path("checkpoint")).awaitTermination()
        raise AssertionError("the stream did not reach its second batch")
    start_stream(events, store, staging.path("checkpoint")).awaitTermination()
    return landed(spark, staging.path("events"), events.schema)


def stream_console(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the console job received in all, from a stored topic."""
    staging = _staging(spark)
    messages = staging.write(_messages(_sensor_rows(spark, sf_dir)).repartition(3), "topic")
    stream = file_stream(spark, staging.path("topic"), messages.schema, max_files=1)
    sizes: dict[int, int] = {}
    job = sensor_to_console(stream, staging.path("checkpoint"), rows=2, received=sizes.__setitem__)
    job.awaitTermination()
    return spark.createDataFrame([(sum(sizes.values()),)], "n_rows long")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches rewritten as few files while the stream goes on; a batch among them comes again."""
    staging = _staging(spark)
    topic = staging.write(_table(spark, sf_dir, "events").repartition(5), "topic")
    events = file_stream(spark, staging.path("topic"), topic.schema, max_files=1)
    folder = staging.path("events")
    store = landing(folder, stream="events")

    def compact_and_stop(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id in (1, 2):
            compact(spark, folder, topic.schema)
        if batch_id == 2:
            raise RuntimeError("stopped after the compaction")

    with contextlib.suppress(StreamingQueryException):
        start_stream(events, compact_and_stop, staging.path("checkpoint")).awaitTermination()
        raise AssertionError("the stream did not reach its third batch")
    start_stream(events, store, staging.path("checkpoint")).awaitTermination()
    return landed(spark, folder, topic.schema)


def _props_topic(spark: SparkSession, sf_dir: str, staging: Staging) -> DataFrame:
    """Payloads, one in ten of them cut short, stored as four files by event number."""
    for n in range(4):
        mine = _props_cut(spark, sf_dir).where(F.col("event_id") % 4 == n).select("value")
        mine.coalesce(1).write.mode("append").parquet(staging.path("topic"))
    schema = T.StructType([T.StructField("value", T.StringType())])
    return file_stream(spark, staging.path("topic"), schema, max_files=1)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and unreadable payloads, stored apart by one job per batch; both read back."""
    staging = _staging(spark)
    rows = observations(_props_topic(spark, sf_dir, staging), _PROPS, rejected="payload")
    store = landing(staging.path("props"), rejected="payload")
    start_stream(rows, store, staging.path("checkpoint")).awaitTermination()
    good = landed(spark, staging.path("props"), _PROPS)
    bad = rejected_messages(spark, staging.path("props"))
    return good.unionByName(bad, allowMissingColumns=True)


def stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and unreadable messages of every micro-batch, counted while it was stored."""
    staging = _staging(spark)
    rows = observations(_props_topic(spark, sf_dir, staging), _PROPS, rejected="payload")
    store = landing(staging.path("props"), rejected="payload")
    metrics = BatchMetrics()
    query = start_stream(
        rows, store, staging.path("checkpoint"), metrics=metrics, rejected="payload"
    )
    seen = [(m.batch, m.rows, m.rejected) for m in metrics.wait(query)]
    return spark.createDataFrame(seen, "batch_id long, n_rows long, n_rejected long")


def stream_to_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weather payloads through the weather stream job, then the batch load."""
    staging = _staging(spark)
    messages = staging.write(_messages(dirty_observations(spark, sf_dir)), "topic")
    stream = file_stream(spark, staging.path("topic"), messages.schema, max_bytes=BATCH_BYTES)
    table = staging.path("weather_info")
    weather_to_table(stream, landing(table), staging.path("checkpoint")).awaitTermination()
    raw = landed(spark, table, WEATHER_MESSAGE)
    return _amounts(load_star(raw, staging.path("star")).fact)


# ---- driver functions -------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: dirty observations to the star schema's fact."""
    return star_fact(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "scan_wide": scan_wide,
        "json_parse_sensor": json_parse_sensor,
        "json_parse_weather": json_parse_weather,
        "json_bad_records": json_bad_records,
        "json_quarantine": json_quarantine,
        "clean_dropna": clean_dropna,
        "clean_dedup": clean_dedup,
        "clean_dup_columns": clean_dup_columns,
        "clean_constant_columns": clean_constant_columns,
        "clean_all": clean_all,
        "typed_load": typed_load,
        "dim_city": _dimension("dim_city"),
        "dim_wind_direction": _dimension("dim_wind_direction"),
        "dim_precipitation": _dimension("dim_precipitation"),
        "surrogate_key_large": surrogate_key_large,
        "fact_lookup_join": fact_lookup_join,
        "fact_lookup_shuffled": fact_lookup_shuffled,
        "star_fact": star_fact,
        "star_fact_exact": star_fact_exact,
        "star_load": star_load,
        "star_join_back": star_join_back,
        "star_empty_on_constant_key": star_empty_on_constant_key,
        "star_protected_key": star_protected_key,
        "audit_pk": audit_pk,
        "audit_fk": audit_fk,
        "audit_star": audit_star,
        "preview_topk": preview_topk,
        "load_metrics": load_metrics,
        "stream_ingest_events": stream_ingest_events,
        "stream_sensor_to_table": stream_sensor_to_table,
        "stream_idempotent": stream_idempotent,
        "stream_console": stream_console,
        "stream_compacted": stream_compacted,
        "stream_quarantine": stream_quarantine,
        "stream_batch_metrics": stream_batch_metrics,
        "stream_to_star": stream_to_star,
        **_LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES | _LLM_SQL
