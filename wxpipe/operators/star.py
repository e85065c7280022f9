"""Dimensions, surrogate keys, lookups and facts, for any list of attributes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import column
from ..schemas import DimensionSpec, StarSpec
from ..staging import Staging
from .keys import MARK, number_marked, store_ranged

_SLOT, _MEMBER, _COUNT, _KEY = "slot", "member", "n_rows", "key"

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 2_000_000
HOT_BYTES = BROADCAST_BYTES
_ROW_OVERHEAD = 64
_INT_MAX = 2**31 - 1


def attribute_members(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Distinct values of every attribute with their row counts, from one scan.

    Columns: ``slot`` (position in ``attributes``), ``member``, ``n_rows``. NULL is a member.
    Values are counted in each task before the shuffle, so hot ones cost nothing extra.
    """
    slots = F.array(
        *[
            F.struct(F.lit(i).alias(_SLOT), column(a).alias(_MEMBER))
            for i, a in enumerate(attributes)
        ]
    )
    return (
        df.select(F.inline(slots)).groupBy(_SLOT, _MEMBER).agg(F.count(F.lit(1)).alias(_COUNT))
    )


def _width(member: Column, dtype: T.DataType) -> Column:
    """Bytes of a broadcast row with this member, of any type."""
    overhead = F.lit(_ROW_OVERHEAD).cast("long")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return overhead + F.coalesce(F.octet_length(member), F.lit(0))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return overhead + F.octet_length(F.to_json(F.struct(member.alias(_MEMBER))))
    return overhead


@dataclass(frozen=True)
class Dimension:
    """A numbered dimension and the sizes that decide how to join it."""

    spec: DimensionSpec
    members: DataFrame  # key, attribute, n_rows
    rows: int
    n_bytes: int
    fact_rows: int
    widest: int
    most_rows: int
    hot_seen: int

    @property
    def frame(self) -> DataFrame:
        return self.members.select(column(self.spec.key), column(self.spec.attribute))

    def fits_broadcast(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.n_bytes <= limit

    def hot_bytes(self, rows_per_task: int) -> int:
        """At most so many bytes have the members that more than ``rows_per_task`` rows hold.

        From what was seen while the members were stored, so asking starts no job.
        """
        if self.most_rows <= rows_per_task:
            return 0
        if rows_per_task >= ROWS_PER_TASK:
            return self.hot_seen
        # No more members than this can each hold so many of the rows.
        return min(self.n_bytes, self.fact_rows // rows_per_task * self.widest)


def build_dimensions(
    df: DataFrame, specs: Sequence[DimensionSpec], staging: Staging, name: str = "dimensions"
) -> dict[str, Dimension]:
    """One numbered dimension per spec, keyed 1..N by value, NULL last.

    Attributes of one type (all of them, as a rule) share one scan of ``df`` and one numbering
    job.
    """
    by_type: dict[T.DataType, list[DimensionSpec]] = {}
    for spec in specs:
        by_type.setdefault(df.schema[spec.attribute].dataType, []).append(spec)
    built = {}
    for i, (dtype, alike) in enumerate(by_type.items()):
        built.update(_build_alike(df, alike, dtype, staging, f"{name}-{i}"))
    return {spec.table: built[spec.table] for spec in specs}


def _build_alike(
    df: DataFrame, specs: list[DimensionSpec], dtype: T.DataType, staging: Staging, name: str
) -> dict[str, Dimension]:
    # Sizes are taken while the members are stored, in the last stage: no job of their own.
    width = _width(F.col(_MEMBER), dtype)
    measures = []
    for i in range(len(specs)):
        mine = F.col(_SLOT) == i
        measures += [
            F.count_if(mine).alias(f"rows{i}"),
            F.sum(F.when(mine, width)).alias(f"bytes{i}"),
            F.sum(F.when(mine, F.col(_COUNT))).alias(f"fact_rows{i}"),
            F.max(F.when(mine, width)).alias(f"widest{i}"),
            F.max(F.when(mine, F.col(_COUNT))).alias(f"most_rows{i}"),
            F.sum(F.when(mine & (F.col(_COUNT) > ROWS_PER_TASK), width)).alias(f"hot{i}"),
        ]
    members = attribute_members(df, [s.attribute for s in specs])
    marked, size = store_ranged(members, _SLOT, _MEMBER, staging, f"{name}-ranged", *measures)
    one_slice = size["slices"] <= 1
    if one_slice:
        numbered = marked
    else:
        numbered = staging.write(number_marked(marked, _SLOT, _KEY, groups=len(specs)), name)

    dimensions, start = {}, 0
    for i, spec in enumerate(specs):
        rows = size[f"rows{i}"]
        if rows > _INT_MAX:
            raise OverflowError(f"{spec.table}: {rows} members do not fit an integer key")
        # In a single slice marks count from 0 without gaps, one slot after the other.
        key = F.col(MARK) - start + 1 if one_slice else F.col(_KEY)
        dimensions[spec.table] = Dimension(
            spec,
            numbered.where(F.col(_SLOT) == i).select(
                key.cast("int").alias(spec.key),
                F.col(_MEMBER).alias(spec.attribute),
                F.col(_COUNT),
            ),
            rows,
            *(
                size[f"{name}{i}"] or 0
                for name in ("bytes", "fact_rows", "widest", "most_rows", "hot")
            ),
        )
        start += rows
    return dimensions


def lookup_join(
    df: DataFrame,
    dimension: Dimension,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join on the attribute text, adding the key. NULL matches nothing.

    A dimension whose measured size is within ``broadcast_bytes`` is broadcast. A larger one is
    joined through a shuffle in which members held by more than ``rows_per_task`` rows are
    spread over several tasks; the member counts taken while the dimension was built say which.
    """
    attribute, key = dimension.spec.attribute, dimension.spec.key
    filled = df.where(column(attribute).isNotNull())
    if dimension.fits_broadcast(broadcast_bytes):
        return filled.join(F.broadcast(dimension.frame), attribute)

    # What counts as hot does not depend on the size of the fact. The list of hot members is
    # broadcast if its size, bounded when they were stored, allows it; a longer one is joined by
    # a shuffle, whose hot keys the re-planner splits.
    salts = F.ceil(F.col(_COUNT) / rows_per_task).cast("int")
    salted = F.when(F.col(_COUNT) > rows_per_task, salts).otherwise(1)
    hot = dimension.members.where(F.col(_COUNT) > rows_per_task).select(
        column(attribute), salts.alias("__salts")
    )
    if dimension.hot_bytes(rows_per_task) <= HOT_BYTES:
        hot = F.broadcast(hot)
    # The salt is a hash of the row, not a random number: a re-run task sends each row to the
    # same place.
    spread = (
        filled.join(hot, attribute, "left")
        .withColumn(
            "__salt",
            F.coalesce(
                F.pmod(F.xxhash64(*[column(c) for c in df.columns]), F.col("__salts")), F.lit(0)
            ).cast("int"),
        )
        .drop("__salts")
    )
    copies = dimension.members.where(column(attribute).isNotNull()).select(
        column(key),
        column(attribute),
        F.explode(F.sequence(F.lit(0), salted - 1)).alias("__salt"),
    )
    return spread.join(copies.hint("shuffle_merge"), [attribute, "__salt"]).drop("__salt")


def build_fact(
    typed: DataFrame,
    star: StarSpec,
    dimensions: dict[str, Dimension],
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    distinct: bool = False,
) -> DataFrame:
    """Distinct fact rows: attributes replaced by keys, the whole row compared.

    ``distinct`` states that no two rows of ``typed`` are equal. Swapping members for keys
    keeps it so, and if the fact also uses every column the de-duplication has nothing to do
    and is left out, with its shuffle.

    Keys and members are one to one, so rows may be compared by either. Broadcast lookups run
    first, in the scan; the de-duplication then shuffles rows narrowed to integer keys; lookups
    too large to broadcast come last and see no repeated rows.
    """
    used = [dimensions[s.table] for s in star.dimensions]
    small = [d for d in used if d.fits_broadcast(broadcast_bytes)]
    large = [d for d in used if not d.fits_broadcast(broadcast_bytes)]
    keys = {d.spec.key for d in used}

    def lookup(df: DataFrame, dimension: Dimension) -> DataFrame:
        return lookup_join(df, dimension, broadcast_bytes, rows_per_task)

    plain = [n for n in star.fact.names if n not in keys]
    attributes = [d.spec.attribute for d in used if d.spec.attribute not in plain]
    rows = typed.select(*[column(n) for n in plain + attributes])
    narrow = plain + [d.spec.key for d in small]
    narrow += [d.spec.attribute for d in large if d.spec.attribute not in plain]
    keyed = reduce(lookup, small, rows).select(*[column(n) for n in narrow])
    if not (distinct and set(typed.columns) <= set(plain + attributes)):
        keyed = keyed.dropDuplicates()
    return reduce(lookup, large, keyed).select(*[column(n) for n in star.fact.names])
