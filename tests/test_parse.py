import datetime
import math

import pytest
from conftest import rows

from wxpipe.functions import decode, parse_json, split_bad_records
from wxpipe.schemas import SENSOR_MESSAGE, WEATHER_MESSAGE
from wxpipe.streaming import observations

NOTHING = (None,) * len(WEATHER_MESSAGE.fields)


def payloads(spark, *texts):
    return spark.createDataFrame(
        [(None if t is None else bytearray(t.encode()),) for t in texts], "value binary"
    )


def weather(spark, text):
    out = parse_json(payloads(spark, text), WEATHER_MESSAGE).collect()
    assert len(out) == 1
    return out[0]


def test_decode_drops_the_envelope(spark):
    df = spark.sql("SELECT cast('k' AS binary) key, cast('é' AS binary) value, 7L offset")
    assert decode(df).collect()[0].asDict() == {"value": "é"}


def test_sensor_sample_message(spark):
    df = payloads(spark, '{"id": 8, "date": "2031/07/09", "temperature": 11.25, "humidity": 47}')
    out = observations(df, SENSOR_MESSAGE)
    assert out.schema == SENSOR_MESSAGE
    assert rows(out) == [("8", "2031/07/09", 11.25, 47.0)]


@pytest.mark.parametrize("text", ["2024-01-01 06:00:00", "2024-01-01T06:00:00"])
def test_both_timestamp_forms(spark, text):
    row = weather(spark, f'{{"id": 3, "date_time": "{text}", "city": "osto"}}')
    assert row.date_time == datetime.datetime.fromtimestamp(1704088800)
    assert (row.id, row.city, row.precipitation) == (3, "osto", None)


@pytest.mark.parametrize(
    ("text", "field", "value"),
    [
        ('{"id": 1, "date_time": "2024/01/01 06:00:00"}', "date_time", None),
        ('{"id": 1.0, "city": "x"}', "id", None),
        ('{"id": 3000000000, "city": "x"}', "id", None),
        ('{"id": 1, "humidity": "60"}', "humidity", None),
        ('{"ID": 1, "city": "x"}', "id", None),
        ('{"city": {"a": 1}}', "city", '{"a":1}'),
        ('{"city": "x", "other": 5}', "city", "x"),
        ('{"city": "x"} trailing', "city", "x"),
        ('{"city": ""}', "city", ""),
    ],
)
def test_odd_fields_leave_the_others(spark, text, field, value):
    assert weather(spark, text)[field] == value


def test_bare_nan(spark):
    assert math.isnan(weather(spark, '{"humidity": NaN}').humidity)


@pytest.mark.parametrize(
    "text", ['{"id": 1, "city": "x"', "plain text", "[]", '[{"id": 1}]', "{}", "", None]
)
def test_bad_messages_become_null_rows(spark, text):
    assert tuple(weather(spark, text)) == NOTHING


def test_no_row_is_lost_and_kept_columns_stay(spark):
    texts = ['{"id": 1}', "junk", None, "", "{}", '{"id": 1}']
    df = payloads(spark, *texts).selectExpr("monotonically_increasing_id() AS n", "value")
    assert parse_json(df, WEATHER_MESSAGE, keep=["n"]).count() == len(texts)


def test_bad_records_beside_the_parsed_ones(spark):
    out = parse_json(payloads(spark, '{"id": 1}', "junk", None), WEATHER_MESSAGE, bad_record="bad")
    assert {(r.id, r.bad) for r in out.collect()} == {(1, None), (None, "junk"), (None, "")}


def test_quarantine_holds_every_row_once(spark):
    texts = ['{"id": 1}', "junk", None, "{}", '{"id": 2, "city": "x"}']
    good, bad = split_bad_records(payloads(spark, *texts), WEATHER_MESSAGE)
    assert [r.id for r in good.orderBy("id").collect()] == [1, 2]
    assert rows(bad) == sorted([("junk",), ("",), ("{}",)], key=repr)
