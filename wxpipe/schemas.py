"""Message schemas and table contracts.

The field names, types and lengths below are fixed values: they are the data model the
loaded tables must have.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---- fixed values: message schemas ------------------------------------------------------

SENSOR_MESSAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

WEATHER_MESSAGE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("city", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.StringType()),
        T.StructField("precipitation", T.StringType()),
        T.StructField("cloud_cover", T.DoubleType()),
    ]
)


# ---- table contracts --------------------------------------------------------------------


class ContractError(ValueError):
    """A frame or a table definition does not fit its contract."""


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    max_length: int | None = None


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Column, ...]

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.name}: repeated column name in {names}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    def __getitem__(self, name: str) -> Column:
        for column in self.columns:
            if column.name == name:
                return column
        raise ContractError(f"{self.name} has no column {name!r}; it has {self.names}")


@dataclass(frozen=True)
class DimensionSpec:
    """One dimension: the attribute text and the key that replaces it in the fact."""

    table: str
    attribute: str
    key: str


@dataclass(frozen=True)
class StarSpec:
    """A cleaned table, the dimensions cut from it, and the fact that refers to them."""

    cleaned: TableContract
    fact: TableContract
    dimensions: tuple[DimensionSpec, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        # Checked before anything is written: a misspelt name must not surface at load time.
        for dim in self.dimensions:
            self.cleaned[dim.attribute]
            self.fact[dim.key]
        keys = {d.key for d in self.dimensions}
        for name in self.fact.names:
            if name not in keys:
                self.cleaned[name]

    def dimension_contract(self, dim: DimensionSpec) -> TableContract:
        return TableContract(
            dim.table, (Column(dim.key, T.IntegerType()), self.cleaned[dim.attribute])
        )


# ---- fixed values: loaded tables --------------------------------------------------------

_INT = T.IntegerType()
_AMOUNT = T.DecimalType(10, 2)
_MOMENT = T.TimestampNTZType()
_NAME_LENGTH = 100

TRANSFORMED_WEATHER = TableContract(
    "transformed_weather_info",
    (
        Column("id", _INT),
        Column("date_time", _MOMENT),
        Column("city", T.StringType(), _NAME_LENGTH),
        Column("temperature", _AMOUNT),
        Column("humidity", _AMOUNT),
        Column("pressure", _AMOUNT),
        Column("wind_speed", _AMOUNT),
        Column("wind_direction", T.StringType(), _NAME_LENGTH),
        Column("precipitation", T.StringType(), _NAME_LENGTH),
        Column("cloud_cover", _AMOUNT),
    ),
)

FACT_WEATHER = TableContract(
    "fact_weather",
    (
        Column("id", _INT),
        Column("date_time", _MOMENT),
        Column("city_id", _INT),
        Column("wind_dir_id", _INT),
        Column("precipitation_id", _INT),
        Column("temperature", _AMOUNT),
        Column("humidity", _AMOUNT),
        Column("pressure", _AMOUNT),
        Column("wind_speed", _AMOUNT),
        Column("cloud_cover", _AMOUNT),
    ),
)

TEMPERATURE_DETAILS = TableContract(
    "temperature_details",
    (
        Column("id", _INT),
        Column("date", T.StringType(), _NAME_LENGTH),
        Column("temperature", _AMOUNT),
        Column("humidity", _AMOUNT),
    ),
)

WEATHER_STAR = StarSpec(
    TRANSFORMED_WEATHER,
    FACT_WEATHER,
    (
        DimensionSpec("dim_city", "city", "city_id"),
        DimensionSpec("dim_wind_direction", "wind_direction", "wind_dir_id"),
        DimensionSpec("dim_precipitation", "precipitation", "precipitation_id"),
    ),
)

# Raw tables the streams append to, and the topics they read.
SENSOR_TOPIC, SENSOR_TABLE = "sensor_data", "temperature_info"
WEATHER_TOPIC, WEATHER_TABLE = "weather_data", "weather_info"
