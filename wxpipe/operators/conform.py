"""Typed loading under a table contract."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import assign
from ..functions.names import column
from ..schemas import ContractError, TableContract


def conform(df: DataFrame, contract: TableContract, changed: str | None = None) -> DataFrame:
    """The contract's columns, in its order and types.

    Columns the frame lacks become typed NULLs; columns the contract lacks are an error, raised
    before anything runs. ``changed`` names an extra column, true where storing altered some
    value of the row, that is where reading it back does not give what was handed in.
    """
    unknown = [n for n in df.columns if n not in contract.names]
    if unknown:
        raise ContractError(f"{contract.name} has no column {unknown}; it has {contract.names}")
    given = {f.name: f.dataType for f in df.schema.fields}
    stored, altered = [], []
    for c in contract.columns:
        if c.name not in given:
            stored.append(F.lit(None).cast(c.type).alias(c.name))
            continue
        value, source = column(c.name), given[c.name]
        kept = assign(value, source, c.type, f"{contract.name}.{c.name}", c.max_length)
        stored.append(kept.alias(c.name))
        if source != c.type or c.max_length is not None:
            altered.append(~kept.try_cast(source).eqNullSafe(value))
    if changed:
        stored.append(reduce(operator.or_, altered, F.lit(False)).alias(changed))
    return df.select(*stored)
