"""Assignment casts: a value is stored as the declared type or the load fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def assign(
    value: Column,
    source: T.DataType,
    target: T.DataType,
    label: str,
    max_length: int | None = None,
) -> Column:
    """``value`` stored into a column of type ``target``.

    Fractions round half away from zero, both to an integer and to a decimal's scale. A value
    that does not fit raises an error naming ``label``, whatever the session's ANSI setting.
    Text longer than ``max_length`` raises unless the excess is blanks, which are cut.
    """
    if isinstance(target, T.IntegralType) and isinstance(source, _FRACTIONAL):
        stored = F.round(value).try_cast(target)
    else:
        stored = value.try_cast(target)
    if source != target and not isinstance(target, T.StringType):
        # coalesce: the cast runs once, and the check only where it gave nothing.
        stored = F.coalesce(
            stored,
            F.when(
                value.isNotNull(),
                F.raise_error(
                    F.concat(
                        F.lit(f"{label}: cannot store as {target.simpleString()}: "),
                        value.cast("string"),
                    )
                ).cast(target),
            ),
        )
    if max_length is not None:
        stored = (
            F.when(F.length(stored) <= max_length, stored)
            .when(F.length(F.rtrim(stored)) <= max_length, F.substring(stored, 1, max_length))
            .when(
                stored.isNotNull(),
                F.raise_error(F.lit(f"{label}: text longer than {max_length} characters")).cast(
                    "string"
                ),
            )
        )
    return stored
