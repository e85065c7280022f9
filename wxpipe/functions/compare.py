"""Value equality across column types, with every missing value alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import column

_FLOATS = (T.FloatType, T.DoubleType)
_WHOLE = (T.IntegralType, T.BooleanType)
_LONG_LIMIT = float(2**63)


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def _family(dtype: T.DataType) -> str:
    if _is_number(dtype):
        return "number"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return dtype.simpleString()


def comparable(a: T.DataType, b: T.DataType) -> bool:
    """Whether values of the two types can ever be equal."""
    return _family(a) == _family(b)


def present(field: T.StructField) -> Column:
    """The column with NaN read as missing."""
    value = column(field.name)
    if isinstance(field.dataType, _FLOATS):
        return F.when(~F.isnan(value), value)
    return value


def canonical(field: T.StructField) -> Column:
    """A form in which equal values of comparable types are equal; it may merge unequal ones."""
    value = present(field)
    return value.cast("double") if _is_number(field.dataType) else value


def _whole(field: T.StructField) -> Column:
    value = column(field.name)
    if isinstance(field.dataType, T.BooleanType):
        value = value.cast("int")
    return value.cast("long")


def identical(a: T.StructField, b: T.StructField) -> Column:
    """True where the two columns hold the same value, or both hold none. Never NULL.

    Whole numbers are matched to floating ones without losing digits; a decimal is matched to a
    floating number as a double, since table readers hand decimals over that way.
    """
    floating = [isinstance(f.dataType, _FLOATS) for f in (a, b)]
    whole = [isinstance(f.dataType, _WHOLE) for f in (a, b)]
    if any(floating) and any(whole):
        return _whole_is_real(*((a, b) if whole[0] else (b, a)))
    if any(floating):
        return canonical(a).eqNullSafe(canonical(b))
    return _exact(a).eqNullSafe(_exact(b))


def _exact(field: T.StructField) -> Column:
    return _whole(field) if isinstance(field.dataType, _WHOLE) else column(field.name)


def _whole_is_real(whole_field: T.StructField, real_field: T.StructField) -> Column:
    whole, real = _whole(whole_field), canonical(real_field)
    in_range = (real >= -_LONG_LIMIT) & (real < _LONG_LIMIT)
    truncated = F.when(in_range, real).try_cast("long")
    return F.when(
        real.isNotNull() & whole.isNotNull(),
        F.coalesce((truncated == whole) & (truncated.cast("double") == real), F.lit(False)),
    ).otherwise(real.isNull() & whole.isNull())
