"""Table cleaning: null rows, duplicate rows, duplicate columns, constant columns."""

from __future__ import annotations

import operator
from collections.abc import Collection, Hashable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.compare import canonical, comparable, identical, present
from ..functions.names import column


class NoColumnsLeft(ValueError):
    """Every column is constant or repeats another one."""


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Keep rows with a value in every column. NaN counts as missing, empty text does not."""
    # One condition per column, not na.drop: these reach the file scan.
    tests = []
    for f in df.schema.fields:
        tests.append(column(f.name).isNotNull())
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(column(f.name)))
    return df.where(reduce(operator.and_, tests, F.lit(True)))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows.

    Equal rows meet in each task first, so a row repeated millions of times crosses the
    shuffle once per task.
    """
    return df.dropDuplicates()


# Rows whose hashes the driver looks at for counterexamples: 8 bytes per value.
PROBE_ROWS = 1000
# Columns that look alike, up to which each is compared with each.
ALL_PAIRS = 8


@dataclass(frozen=True)
class ColumnProfile:
    """What the column cleaners need to know about a frame."""

    empty: bool
    duplicate_of: dict[str, str] = field(default_factory=dict)
    constant: frozenset[str] = frozenset()

    def keep(self, names: list[str], protect: Collection[str] = ()) -> list[str]:
        kept = [
            n
            for n in names
            if n in protect or not (n in self.duplicate_of or n in self.constant)
        ]
        if names and not kept:
            raise NoColumnsLeft(f"each of {names} is constant or repeats another column")
        return kept


def profile_columns(
    df: DataFrame, duplicates: bool = True, constants: bool = True
) -> ColumnProfile:
    """Find duplicate and constant columns, leftmost of equal columns kept.

    Both are claims about every row, so rows that contradict one settle it. Hashes of the first
    rows clear most columns, as a rule all, without a scan; one aggregate over the columns left
    (:func:`_settle`) decides the others on their values.

    The answer is exact, and nothing here shuffles rows. Repeated rows change nothing, so this
    may run before de-duplication.
    """
    fields = df.schema.fields
    if not fields:
        return ColumnProfile(empty=True)
    first = _hashes(df, fields).take(PROBE_ROWS)
    if not first:
        return ColumnProfile(empty=True)

    seen = list(zip(*first, strict=True))
    flat = [
        f
        for f, values in zip(fields, seen, strict=True)
        if constants and len(set(values) - {None}) < 2
    ]
    groups = _alike(fields, seen) if duplicates else []
    constant: set[str] = set()
    duplicate_of: dict[str, str] = {}
    while flat or groups:
        found, pairs, groups = _settle(df, flat, groups)
        constant |= found
        duplicate_of |= pairs
        flat = []
    return ColumnProfile(False, duplicate_of, frozenset(constant))


def _hashes(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """A long per value, NULL where it is missing; equal values have equal hashes."""
    return df.select(
        *[
            F.when(canonical(f).isNotNull(), F.xxhash64(canonical(f))).alias(f"h{i}")
            for i, f in enumerate(fields)
        ]
    )


def _alike(fields: list[T.StructField], marks: Sequence[Hashable]) -> list[list[T.StructField]]:
    """Columns with the same mark, where there are several, each group in column order."""
    groups: dict[Hashable, list[T.StructField]] = {}
    for f, mark in zip(fields, marks, strict=True):
        groups.setdefault(mark, []).append(f)
    return [g for g in groups.values() if len(g) > 1]


def _settle(
    df: DataFrame, flat: list[T.StructField], groups: list[list[T.StructField]]
) -> tuple[set[str], dict[str, str], list[list[T.StructField]]]:
    """Decide suspects by one scan: constant columns, duplicates, and groups still in doubt.

    The aggregate holds the extremes of the columns that look constant and, for columns that look
    equal, exact comparisons: of all pairs in a small group, else of each with its leftmost.
    Beside them goes a signature per column, each value hashed together with its row, which
    differs between columns that differ in a single row. In doubt, and for another scan, are only
    columns of a large group that differ from its leftmost and have one signature.
    """
    pairs = [
        (a, b)
        for g in groups
        for n, a in enumerate(g if len(g) <= ALL_PAIRS else g[:1])
        for b in g[n + 1 :]
        if comparable(a.dataType, b.dataType)
    ]
    large = [f for g in groups if len(g) > ALL_PAIRS for f in g]
    checks = [
        F.coalesce(F.min(present(f)) < F.max(present(f)), F.lit(False)).alias(f"v{i}")
        for i, f in enumerate(flat)
    ]
    checks += [F.bool_and(identical(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    if large:
        hashes = [F.xxhash64(canonical(f)) for f in large]
        row = F.xxhash64(*hashes)
        checks += [F.bit_xor(F.xxhash64(row, h)).alias(f"s{i}") for i, h in enumerate(hashes)]
    if not checks:
        return set(), {}, []
    said = df.agg(*checks).first()

    constant = {f.name for i, f in enumerate(flat) if not said[f"v{i}"]}
    duplicate_of: dict[str, str] = {}
    for i, (a, b) in enumerate(pairs):
        if said[f"p{i}"] and a.name not in duplicate_of:
            duplicate_of.setdefault(b.name, a.name)
    signs = {f.name: said[f"s{i}"] for i, f in enumerate(large)}
    doubtful = []
    for g in groups:
        if len(g) > ALL_PAIRS:
            rest = [f for f in g[1:] if f.name not in duplicate_of]
            doubtful += _alike(rest, [signs[f.name] for f in rest])
    return constant, duplicate_of, doubtful


def _project(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[column(n) for n in names])


def drop_duplicate_columns(df: DataFrame, protect: Collection[str] = ()) -> DataFrame:
    """Drop each column equal in every row to one left of it; names do not matter.

    Numbers of different types are equal when their values are; text never equals a number.
    ``protect`` names columns that stay whatever they hold.
    """
    profile = profile_columns(df, constants=False)
    return _project(df, profile.keep(df.columns, protect))


def drop_constant_columns(df: DataFrame, protect: Collection[str] = ()) -> DataFrame:
    """Keep columns with at least two different values; missing is not a value.

    A frame without rows keeps its columns; one in which no column varies is an error.
    """
    profile = profile_columns(df, duplicates=False)
    return _project(df, profile.keep(df.columns, protect))


def clean(df: DataFrame, protect: Collection[str] = ()) -> DataFrame:
    """Drop null rows, duplicate rows, duplicate columns, constant columns.

    The column decisions do not depend on repeated rows, and a dropped column is a function of
    the kept ones, so columns go first and the row shuffle carries only what survives. The
    column decisions may read the input once or twice before the result does: hand in a stored
    table, or stage an expensive frame.
    """
    complete = drop_null_rows(df)
    kept = profile_columns(complete).keep(df.columns, protect)
    return drop_duplicate_rows(_project(complete, kept))
