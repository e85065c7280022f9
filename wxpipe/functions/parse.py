"""Message payloads to typed columns."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import column

_DATA, _TEXT, _BAD = "__data", "__text", "__bad"


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Binary payload as text; the other envelope columns are dropped."""
    return df.select(column(value).cast("string").alias(value))


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: Sequence[str] = (),
    bad_record: str | None = None,
) -> DataFrame:
    """One output row per message, one column per field of ``schema``.

    Permissive: a message that is not a JSON object becomes a row of NULLs, so no row is lost
    here. ``keep`` carries columns of the input (keys, offsets) in front of the fields;
    ``bad_record`` names a last column with the text of messages that gave no field at all.
    """
    kept = [column(name) for name in keep]
    text = column(value).cast("string")
    parsed = df.select(*kept, text.alias(_TEXT), F.from_json(text, schema).alias(_DATA))
    fields = [F.col(_DATA).getField(f.name) for f in schema.fields]
    rows = [*kept, *[x.alias(f.name) for x, f in zip(fields, schema.fields, strict=True)]]
    if bad_record:
        nothing = reduce(operator.and_, [x.isNull() for x in fields])
        rows.append(F.when(nothing, F.coalesce(F.col(_TEXT), F.lit(""))).alias(bad_record))
    return parsed.select(*rows)


def split_bad_records(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows with at least one field, and the payload text of those with none.

    Together they hold every input row once; a missing payload counts as empty text. Each
    parses the input: to get both from one pass, use ``bad_record`` of :func:`parse_json`.
    """
    marked = parse_json(df, schema, value, keep, bad_record=_BAD)
    good = marked.where(F.col(_BAD).isNull()).drop(_BAD)
    kept = [column(name) for name in keep]
    return good, marked.where(F.col(_BAD).isNotNull()).select(*kept, F.col(_BAD).alias(value))
