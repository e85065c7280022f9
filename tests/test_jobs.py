"""The command-line jobs from messages to loaded tables."""

import json

from wxpipe.__main__ import parser, run
from wxpipe.schemas import SENSOR_MESSAGE
from wxpipe.streaming import landed, rejected_messages


def job(spark, *words):
    run(spark, parser().parse_args([str(w) for w in words]))


def test_sensor_lines_to_table_and_console(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    sample = '{"id": 8, "date": "2031/07/09", "temperature": 11.25, "humidity": 47}'
    (lines / "a.txt").write_text(f"{sample}\nnot json\n")
    words = ("--files", lines, "--checkpoint")
    for _ in range(2):
        job(spark, "sensor-table", *words, tmp_path / "ck", "--folder", tmp_path / "raw")
    out = landed(spark, str(tmp_path / "raw/temperature_info"), SENSOR_MESSAGE)
    assert {tuple(r) for r in out.collect()} == {
        ("8", "2031/07/09", 11.25, 47.0),
        (None, None, None, None),
    }
    assert out.count() == 2
    job(spark, "sensor-console", *words, tmp_path / "ck2")


def test_sensor_lines_set_apart_and_compacted(spark, tmp_path, capsys):
    lines = tmp_path / "lines"
    lines.mkdir()
    sample = '{"id": 8, "date": "2031/07/09", "temperature": 11.25, "humidity": 47}'
    (lines / "a.txt").write_text(f"{sample}\nnot json\n")
    table = str(tmp_path / "raw/temperature_info")
    words = ("--files", lines, "--checkpoint", tmp_path / "ck", "--folder", tmp_path / "raw")
    job(spark, "sensor-table", *words, "--set-apart")
    for _ in range(2):
        good, bad = landed(spark, table, SENSOR_MESSAGE), rejected_messages(spark, table)
        assert [tuple(r) for r in good.collect()] == [("8", "2031/07/09", 11.25, 47.0)]
        assert [r.payload for r in bad.collect()] == ["not json"]
        job(spark, "compact", "--folder", tmp_path / "raw", "--table", "temperature_info")
    printed = capsys.readouterr().out
    assert "batch 0: 2 rows in " in printed and "temperature_info: compaction 1, 1 folders" in printed


def test_weather_lines_to_star(spark, tmp_path, capsys):
    """Five readings, three cities."""
    readings = [
        ("2031-05-03 04:10:00", "osto", "east", "dew", 41),
        ("2031-05-03 04:20:00", "vell", "west", "fog", 7),
        ("2031-05-03 05:30:00", "brae", "south", "clear", 63),
        ("2031-05-04 04:10:00", "osto", "east", "clear", 18),
        ("2031-05-04 09:40:00", "osto", "south", "clear", 30),
    ]
    messages = [
        {
            "id": i,
            "date_time": moment,
            "city": city,
            "temperature": 10.125 + i,
            "humidity": 50 + 2 * i,
            "pressure": 1000 + 3 * i,
            "wind_speed": 5 * i,
            "wind_direction": wind,
            "precipitation": rain,
            "cloud_cover": cloud,
        }
        for i, (moment, city, wind, rain, cloud) in enumerate(readings, start=1)
    ]
    lines = tmp_path / "lines"
    lines.mkdir()
    texts = [json.dumps(m) for m in messages]
    (lines / "a.txt").write_text("\n".join([*texts, texts[0], "{broken"]))
    job(
        spark, "weather-table", "--files", lines, "--checkpoint", tmp_path / "ck",
        "--folder", tmp_path / "raw",
    )
    job(spark, "weather-star", "--folder", tmp_path / "raw", "--target", tmp_path / "s", "--audit")
    printed = capsys.readouterr().out
    assert "fact_weather: 5 rows" in printed and "dim_city: 3 rows" in printed
    fact = spark.read.parquet(str(tmp_path / "s/fact_weather")).orderBy("id").collect()
    assert [(r.city_id, r.wind_dir_id, r.precipitation_id) for r in fact] == [
        (2, 1, 2),
        (3, 3, 3),
        (1, 2, 1),
        (2, 1, 1),
        (2, 2, 1),
    ]
    assert [str(r.temperature) for r in fact] == ["11.13", "12.13", "13.13", "14.13", "15.13"]
