"""Jobs for spark-submit or any scheduler.

    python -m wxpipe sensor-console --servers host:9092 --checkpoint /shared/ck/sensor
    python -m wxpipe sensor-table   --servers host:9092 --checkpoint ... --folder /shared/raw
    python -m wxpipe weather-table  --servers host:9092 --checkpoint ... --folder /shared/raw
    python -m wxpipe weather-star   --folder /shared/raw --target /shared/star
    python -m wxpipe compact        --folder /shared/raw

``--files`` reads messages from text files instead, one per line. With ``--jdbc`` tables are in
the database named by WXPIPE_JDBC_URL, _USER, _PASSWORD and _DRIVER instead of below
``--folder`` / ``--target``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .operators.metrics import preview
from .plans import load_star, sensor_to_console, sensor_to_table, weather_to_table
from .schemas import (
    SENSOR_MESSAGE,
    SENSOR_TABLE,
    SENSOR_TOPIC,
    TRANSFORMED_WEATHER,
    WEATHER_MESSAGE,
    WEATHER_STAR,
    WEATHER_TABLE,
    WEATHER_TOPIC,
)
from .session import build_session
from .sinks import jdbc_landing, jdbc_refresh_all
from .sources import JdbcEndpoint, file_stream, jdbc_table, kafka_stream
from .staging import Staging
from .streaming import BatchMetrics, compact, landed, landing
from .streaming.metrics import BatchMetric


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wxpipe")
    jobs = top.add_subparsers(dest="job", required=True)
    topics = {
        "sensor-console": SENSOR_TOPIC,
        "sensor-table": SENSOR_TOPIC,
        "weather-table": WEATHER_TOPIC,
    }
    for name, topic in topics.items():
        job = jobs.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="brokers of the topic")
        source.add_argument("--files", help="folder of text files, a message per line")
        job.add_argument("--topic", default=topic)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--starting-offsets", default="latest")
        job.add_argument("--max-offsets", type=int)
        job.add_argument("--min-partitions", type=int)
        job.add_argument("--every", help="keep running, one batch per interval")
        if name != "sensor-console":
            target = job.add_mutually_exclusive_group(required=True)
            target.add_argument("--folder")
            target.add_argument("--jdbc", action="store_true")
            job.add_argument(
                "--set-apart", action="store_true",
                help="store unreadable messages apart instead of as rows of NULLs",
            )
    job = jobs.add_parser("compact", help="rewrite landed batches as few files")
    job.add_argument("--folder", required=True)
    job.add_argument("--table", choices=[SENSOR_TABLE, WEATHER_TABLE])
    job = jobs.add_parser("weather-star")
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--folder")
    source.add_argument("--jdbc", action="store_true")
    job.add_argument("--target", help="folder for the loaded tables")
    job.add_argument("--protect", nargs="*", default=[])
    job.add_argument("--audit", action="store_true", help="check all keys before the swap")
    job.add_argument("--split-column", default="id", help="cuts the reads into ranges")
    job.add_argument(
        "--slice-by", help="SQL expression of whole numbers that cuts rows without --split-column"
    )
    job.add_argument("--readers", type=int, default=64, help="parallel database reads")
    return top


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.files:
        lines = T.StructType([T.StructField("value", T.StringType())])
        messages = file_stream(spark, args.files, lines, file_format="text")
    else:
        messages = kafka_stream(
            spark,
            args.servers,
            args.topic,
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets,
            min_partitions=args.min_partitions,
        )
    if args.job == "sensor-console":
        query = sensor_to_console(messages, args.checkpoint, args.every)
    else:
        sensor = args.job == "sensor-table"
        table = SENSOR_TABLE if sensor else WEATHER_TABLE
        rejected = "payload" if args.set_apart else None
        if args.jdbc:
            endpoint = JdbcEndpoint.from_env()
            store = jdbc_landing(endpoint, table, rejected=rejected)
        else:
            store = landing(f"{args.folder.rstrip('/')}/{table}", rejected=rejected)
        job = sensor_to_table if sensor else weather_to_table
        metrics = BatchMetrics(report=_tell)
        query = job(messages, store, args.checkpoint, args.every, rejected, metrics)
        metrics.wait(query)
    query.awaitTermination()


def _tell(seen: BatchMetric) -> None:
    print(f"batch {seen.batch}: {seen.rows} rows in {seen.seconds:.2f} seconds", flush=True)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    for table, schema in ((SENSOR_TABLE, SENSOR_MESSAGE), (WEATHER_TABLE, WEATHER_MESSAGE)):
        if args.table in (None, table):
            done = compact(spark, f"{args.folder.rstrip('/')}/{table}", schema)
            print(f"{table}: compaction {done.version}, {len(done.folders)} folders")


def _star(spark: SparkSession, args: argparse.Namespace) -> None:
    with Staging(spark) as staging:
        if args.jdbc:
            endpoint = JdbcEndpoint.from_env()
            table = jdbc_table(
                spark,
                endpoint,
                WEATHER_TABLE,
                partition_column=args.split_column,
                num_partitions=args.readers,
                slice_by=args.slice_by,
            )
            # Read the database once; the load evaluates its input twice.
            raw = staging.write(table, WEATHER_TABLE)
        else:
            folder = args.folder.rstrip("/")
            raw = landed(spark, f"{folder}/{WEATHER_TABLE}", WEATHER_MESSAGE)
        preview(raw, 5).show()
        target = args.target or staging.path("star")
        star = load_star(raw, target, protect=args.protect, audit=args.audit)
        for name, seen in star.metrics.items():
            print(f"{name}: {seen.rows} rows in {seen.seconds:.2f} seconds")
        if args.jdbc:
            # In the order of their references, the fact last.
            tables = [(TRANSFORMED_WEATHER, star.cleaned)]
            for spec in WEATHER_STAR.dimensions:
                contract = WEATHER_STAR.dimension_contract(spec)
                tables.append((contract, star.dimensions[spec.table]))
            jdbc_refresh_all([*tables, (WEATHER_STAR.fact, star.fact)], endpoint)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    {"weather-star": _star, "compact": _compact}.get(args.job, _stream)(spark, args)


def main(argv: list[str] | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    if args.job == "weather-star" and not (args.jdbc or args.target):
        top.error("weather-star needs --target unless --jdbc is given")
    spark = build_session(f"wxpipe-{args.job}")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
