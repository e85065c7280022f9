from .pipelines import (
    IntegrityError,
    StarTables,
    load_star,
    read_star,
    sensor_to_console,
    sensor_to_table,
    star_frames,
    weather_to_table,
)

__all__ = [
    "IntegrityError",
    "StarTables",
    "load_star",
    "read_star",
    "sensor_to_console",
    "sensor_to_table",
    "star_frames",
    "weather_to_table",
]
