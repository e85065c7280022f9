import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from wxpipe.operators import conform
from wxpipe.schemas import (
    TEMPERATURE_DETAILS,
    TRANSFORMED_WEATHER,
    WEATHER_STAR,
    Column,
    ContractError,
    DimensionSpec,
    StarSpec,
    TableContract,
)

AMOUNT = TableContract("t", (Column("x", T.DecimalType(10, 2)),))
WHOLE = TableContract("t", (Column("x", T.IntegerType()),))
NAME = TableContract("t", (Column("x", T.StringType(), 100),))


def store(spark, contract, value, type_):
    return conform(spark.createDataFrame([(value,)], f"x {type_}"), contract).collect()[0].x


@pytest.mark.parametrize(
    ("value", "stored"),
    [
        (24.555, "24.56"),
        (1.005, "1.01"),
        (-2.675, "-2.68"),
        (0.125, "0.13"),
        (-0.125, "-0.13"),
        (99999999.99, "99999999.99"),
        (None, None),
    ],
)
def test_amounts_round_half_away_from_zero(spark, value, stored):
    got = store(spark, AMOUNT, value, "double")
    assert got == (None if stored is None else Decimal(stored))


@pytest.mark.parametrize("value", [1e8, -1e8, 99999999.995, float("inf"), float("nan")])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_that_do_not_fit_raise(spark, value, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="t.x"):
            store(spark, AMOUNT, value, "double")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(("value", "stored"), [(1.5, 2), (2.5, 3), (-1.5, -2), (7.0, 7)])
def test_whole_numbers_round(spark, value, stored):
    assert store(spark, WHOLE, value, "double") == stored


def test_whole_number_out_of_range(spark):
    with pytest.raises(PySparkException, match="cannot store as int"):
        store(spark, WHOLE, 2**31, "long")


def test_text_length(spark):
    assert store(spark, NAME, "é" * 100, "string") == "é" * 100
    assert store(spark, NAME, "a" * 100 + "  ", "string") == "a" * 100
    assert store(spark, NAME, None, "string") is None
    with pytest.raises(PySparkException, match="longer than 100"):
        store(spark, NAME, "a" * 101, "string")


def test_text_that_is_no_number(spark):
    assert store(spark, AMOUNT, "12.345", "string") == Decimal("12.35")
    with pytest.raises(PySparkException, match="abc"):
        store(spark, AMOUNT, "abc", "string")


def test_moment_loses_its_zone(spark):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-01-01 06:00:00' AS date_time")
    out = conform(df, TRANSFORMED_WEATHER)
    assert out.schema.simpleString() == TRANSFORMED_WEATHER.struct().simpleString()
    row = out.collect()[0]
    assert row.date_time == datetime.datetime(2024, 1, 1, 6)
    assert row.city is None and row.cloud_cover is None


def test_second_contract(spark):
    df = spark.createDataFrame(
        [("8", "2031/07/09", 11.25, 47.0)],
        "id string, date string, temperature double, humidity double",
    )
    out = conform(df, TEMPERATURE_DETAILS)
    assert out.schema.simpleString() == TEMPERATURE_DETAILS.struct().simpleString()
    assert tuple(out.collect()[0]) == (8, "2031/07/09", Decimal("11.25"), Decimal("47.00"))


def test_unknown_column_is_refused_before_anything_runs(spark):
    with pytest.raises(ContractError, match="preipitation"):
        conform(spark.createDataFrame([("x",)], "preipitation string"), TRANSFORMED_WEATHER)


def test_misspelt_names_are_refused_when_declared():
    with pytest.raises(ContractError, match="preipitation"):
        StarSpec(
            TRANSFORMED_WEATHER,
            WEATHER_STAR.fact,
            (DimensionSpec("dim_precipitation", "preipitation", "precipitation_id"),),
        )
    with pytest.raises(ContractError, match="date"):
        StarSpec(TRANSFORMED_WEATHER, TableContract("f", (Column("date", T.StringType()),)))
    with pytest.raises(ContractError, match="repeated"):
        TableContract("t", (Column("a", T.StringType()), Column("a", T.StringType())))


@pytest.mark.parametrize(
    ("contract", "type_", "value", "changed"),
    [
        (AMOUNT, "double", 24.56, False),
        (AMOUNT, "double", 24.561, True),
        (AMOUNT, "double", -0.0, False),
        (AMOUNT, "double", None, False),
        (AMOUNT, "decimal(12,3)", Decimal("1.230"), False),
        (AMOUNT, "decimal(12,3)", Decimal("1.231"), True),
        (AMOUNT, "string", "12.345", True),
        (WHOLE, "double", 7.0, False),
        (WHOLE, "double", 7.5, True),
        (WHOLE, "long", 7, False),
        (WHOLE, "string", "07", True),
        (NAME, "string", "a", False),
        (NAME, "string", "a" * 100 + " ", True),
        (NAME, "int", 7, False),
    ],
)
def test_changed_values_are_marked(spark, contract, type_, value, changed):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    assert conform(df, contract, changed="c").collect()[0].c is changed


def test_moments_that_fall_together_are_marked(spark):
    """Where clocks go back, two instants have one local time."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT timestamp_seconds(s) AS date_time FROM VALUES (1699162200L), (1699165800L) t(s)"
        )
        out = conform(df, TRANSFORMED_WEATHER, changed="c").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out[0].date_time == out[1].date_time
    assert {r.c for r in out} == {False, True}
