"""Relational tables over JDBC, read and written by many tasks at once."""

from __future__ import annotations

import datetime
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcEndpoint:
    """Where the database is. Credentials come from the caller or the environment."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    @classmethod
    def from_env(cls, prefix: str = "WXPIPE_JDBC_") -> JdbcEndpoint:
        def read(name: str) -> str | None:
            return os.environ.get(prefix + name)

        url = read("URL")
        if not url:
            raise KeyError(f"set {prefix}URL")
        return cls(url, read("USER"), read("PASSWORD"), read("DRIVER"))

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {k: v for k, v in given.items() if v is not None}


def _literal(value: object) -> str:
    """A bound as SQL text."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def _cuts(lower, upper, parts: int) -> list:
    """Values at which ``parts`` ranges from ``lower`` to ``upper`` meet, ascending, all different."""
    if isinstance(lower, int) and isinstance(upper, int):
        cuts = [lower + (upper - lower) * n // parts for n in range(1, parts)]
    else:
        cuts = [lower + (upper - lower) / parts * n for n in range(1, parts)]
    return [c for c in dict.fromkeys(cuts) if lower < c <= upper]


def split_predicates(
    column: str,
    lower: object,
    upper: object,
    parts: int,
    null_parts: int = 0,
    slice_by: str | None = None,
) -> list[str]:
    """Conditions that together hold for each row of a table once.

    Ranges of ``column``, open at both ends, so rows that appear outside the bounds in the meantime
    are read too; then the rows without a value, in ``null_parts`` slices (none if there were no
    such rows: the last range takes any that appear). A slice is the remainder of ``slice_by``, an
    SQL expression of whole numbers in the database's own words, such as a hash of another
    column; without one the rows without a value are a single slice.
    """
    cuts = [_literal(c) for c in _cuts(lower, upper, parts)]
    ends = [None, *cuts, None]
    out = []
    for low, high in zip(ends, ends[1:], strict=False):
        bounds = [f"{column} >= {low}"] if low else []
        bounds += [f"{column} < {high}"] if high else []
        out.append(" AND ".join(bounds) or f"{column} IS NOT NULL")
    if not null_parts:
        out[-1] = f"({out[-1]}) OR {column} IS NULL"
    elif null_parts == 1 or slice_by is None:
        out.append(f"{column} IS NULL")
    else:
        # Remainders are negative for negative numbers, and NULL for none.
        place = f"COALESCE(ABS(MOD({slice_by}, {null_parts})), 0)"
        out += [f"{column} IS NULL AND {place} = {n}" for n in range(null_parts)]
    return out


def jdbc_table(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    slice_by: str | None = None,
) -> DataFrame:
    """Whole-table scan, cut into ranges of ``partition_column`` read in parallel.

    One query asks the database for the bounds and for how many rows have no value there; those
    are cut into slices of about a range's size by ``slice_by`` (see :func:`split_predicates`).
    Two evaluations of the frame are two reads of a table that may have changed in between: stage
    it when a plan needs it twice.
    """
    reader = spark.read.format("jdbc").options(**endpoint.options())
    reader = reader.option("fetchsize", fetch_size)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    lower, upper, rows, filled = (
        reader.option(
            "query",
            f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi, "
            f"count(*) AS n_rows, count({partition_column}) AS n_filled FROM {table}",
        )
        .load()
        .first()
    )
    if not rows:
        return reader.option("dbtable", table).load()
    null_parts = -(-(rows - filled) * num_partitions // rows)
    if lower is None:
        conditions = split_predicates(partition_column, 0, 0, 1, null_parts, slice_by)
    else:
        conditions = split_predicates(
            partition_column, lower, upper, max(1, num_partitions - null_parts), null_parts, slice_by
        )
    options = endpoint.options()
    url = options.pop("url")
    properties = {**options, "fetchsize": str(fetch_size)}
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties)
