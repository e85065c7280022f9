"""Column references that survive dots and backticks in names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))
