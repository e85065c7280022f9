"""Vector codes: k-means per part of the vector, over metric trees built middle-out.

Vectors are cut into equal parts; every part position has a codebook of its own. Rows are dealt
into blocks of a bounded number of rows, and a block gets one tree per part, built once:

* *middle-out*: about sqrt(n) anchors are placed, each at the point farthest from its anchor so
  far; a new anchor takes over the points nearer to it, and the triangle inequality says which
  points need no look (those nearer to their anchor than half the way between the anchors).
  Anchors that own many points are divided in the same way; then the anchors are merged, the
  pair with the smallest common ball first, up to one root;
* every ball caches the sum and the number of its points;
* in a round, a ball inherits from its parent the entries that may still own any of its points.
  An entry goes if the ball lies wholly on the other side of the plane halfway to the entry
  nearest to the ball's centre. If one entry is left it owns the ball, whose cached sum and count
  are added; else the children are visited, and in a leaf points are compared one by one.

The trees are stored in the shared folder, so the rounds read them and never rebuild them. What a
round gives back is one sum per entry and component, added in each task, then over tasks: entries
times components numbers, however many rows there are. All arithmetic that decides is on
integers, so results depend neither on the blocks nor on the order of rows.

Defined cases: rows whose vector is null or has a null or non-finite component are left out; a
null id is kept and comes last; rows that repeat an id are separate rows, ordered by their
vectors; vectors of different lengths (empty ones too) end in zeros up to a multiple of the
number of parts; fewer rows than entries give as many entries; ties go to the lower entry; an
empty table gives no rows; other columns are ignored, whatever their names; very long vectors
make smaller blocks; components too large for exact sums raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..staging import Staging
from .common import BROADCAST_BYTES
from .vectors import longest, matrix, whole_components

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components in a block of rows; bounds a task's memory.
BLOCK_CELLS = 1 << 18
#: A ball of so many points or fewer is not divided.
LEAF = 48
#: Relative slack of the plane test, far above rounding and far below one unit of distance.
_SLACK = 1e-9


def _node_type(width: int) -> np.dtype:
    return np.dtype(
        [
            ("start", "<i4"),
            ("end", "<i4"),
            ("left", "<i4"),
            ("right", "<i4"),
            ("radius", "<f8"),
            ("centre", "<f8", (width,)),
            ("sums", "<i8", (width,)),
        ]
    )


# ---- building ---------------------------------------------------------------------------


def place_anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor that owns each point, 0-based; anchors are points, each owns its nearest."""
    own = np.zeros(len(points), np.int64)
    pivots = points[:1]
    far = np.sqrt(((points - pivots[0]) ** 2).sum(1))
    while len(pivots) < wanted:
        new = int(far.argmax())
        if far[new] == 0:
            break
        half = np.sqrt(((pivots - points[new]) ** 2).sum(1)) / 2
        rivals = np.flatnonzero(far > half[own])
        gap = np.sqrt(((points[rivals] - points[new]) ** 2).sum(1))
        nearer = gap < far[rivals]
        own[rivals[nearer]], far[rivals[nearer]] = len(pivots), gap[nearer]
        pivots = np.vstack((pivots, points[new]))
    return own


class _Builder:
    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.order: list[np.ndarray] = []
        self.placed = 0
        self.nodes: list[tuple] = []

    def _ball(self, rows: np.ndarray, start: int) -> int:
        mine = self.points[rows]
        sums = mine.sum(0)
        centre = sums / len(rows)
        radius = float(np.sqrt(((mine - centre) ** 2).sum(1).max()))
        self.nodes.append((start, start + len(rows), -1, -1, radius, centre, sums))
        return len(self.nodes) - 1

    def grow(self, rows: np.ndarray) -> int:
        """The node over ``rows``, whose subtree covers consecutive places of the order."""
        own = place_anchors(self.points[rows], int(np.sqrt(len(rows)))) if len(rows) > LEAF else None
        if own is None or not own.any():  # few points, or all of them alike
            start = self.placed
            self.order.append(rows)
            self.placed += len(rows)
            return self._ball(rows, start)
        by = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[by])) + 1
        return self._merge(np.split(rows[by], cuts))

    def _merge(self, groups: list[np.ndarray]) -> int:
        """Merge groups pairwise, the pair with the smallest common ball first."""
        sums = np.array([self.points[g].sum(0) for g in groups])
        sizes = np.array([len(g) for g in groups], float)
        centres = sums / sizes[:, None]
        radii = np.array(
            [np.sqrt(((self.points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centres, strict=True)]
        )
        tree: list = list(range(len(groups)))
        cost = np.full((len(groups),) * 2, np.inf)

        def renew(i: int) -> None:
            both = sizes + sizes[i]
            middle = (sums + sums[i]) / both[:, None]
            reach = np.maximum(
                np.sqrt(((centres - middle) ** 2).sum(1)) + radii,
                np.sqrt(((centres[i] - middle) ** 2).sum(1)) + radii[i],
            )
            reach[(radii < 0) | (np.arange(len(radii)) == i)] = np.inf
            cost[i, :] = cost[:, i] = reach

        for i in range(len(groups)):
            renew(i)
        for _ in range(len(groups) - 1):
            i, j = divmod(int(cost.argmin()), len(groups))
            radii[i] = cost[i, j]
            sums[i], sizes[i] = sums[i] + sums[j], sizes[i] + sizes[j]
            centres[i] = sums[i] / sizes[i]
            tree[i], tree[j], radii[j] = (tree[i], tree[j]), None, -1
            cost[j, :] = cost[:, j] = np.inf
            renew(i)
        root = next(t for t in tree if t is not None)
        return self._lay(root, groups)

    def _lay(self, root, groups: list[np.ndarray]) -> int:
        """Write a merged tree's nodes, children first, without recursion over its depth."""
        done: list[int] = []
        todo = [(root, False)]
        while todo:
            part, seen = todo.pop()
            if isinstance(part, int):
                done.append(self.grow(groups[part]))
            elif not seen:
                todo += [(part, True), (part[1], False), (part[0], False)]
            else:
                right, left = done.pop(), done.pop()
                a, b = self.nodes[left], self.nodes[right]
                sums = a[6] + b[6]
                centre = sums / (b[1] - a[0])
                radius = max(
                    float(np.sqrt(((n[5] - centre) ** 2).sum())) + n[4] for n in (a, b)
                )
                self.nodes.append((a[0], b[1], left, right, radius, centre, sums))
                done.append(len(self.nodes) - 1)
        return done[0]


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and the nodes over it; the root comes last."""
    builder = _Builder(points)
    builder.grow(np.arange(len(points)))
    nodes = np.zeros(len(builder.nodes), _node_type(points.shape[1]))
    for name, values in zip(nodes.dtype.names, zip(*builder.nodes, strict=True), strict=True):
        nodes[name] = values
    return np.concatenate(builder.order).astype("<i4"), nodes


# ---- descending -------------------------------------------------------------------------


def assign(
    points: np.ndarray, order: np.ndarray, nodes: np.ndarray, book: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry of each point, and per entry the sum and the number of its points."""
    entry = np.zeros(len(points), np.int64)
    sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
    places = book.astype(np.float64)
    start, end, left, right = (nodes[c].tolist() for c in ("start", "end", "left", "right"))
    radius, centre = nodes["radius"], nodes["centre"]
    todo = [(len(nodes) - 1, np.arange(len(book)))]
    while todo:
        at, held = todo.pop()
        if len(held) > 1:
            held = _possible(places, held, centre[at], radius[at])
        rows = order[start[at] : end[at]]
        if len(held) == 1:
            entry[rows] = held[0]
            sums[held[0]] += nodes["sums"][at]
            counts[held[0]] += len(rows)
        elif left[at] >= 0:
            todo += [(left[at], held), (right[at], held)]
        else:
            mine = points[rows].astype(np.int64)
            gaps = ((mine[:, None, :] - book[held][None]) ** 2).sum(2)
            best = held[gaps.argmin(1)]
            entry[rows] = best
            np.add.at(sums, best, mine)
            counts += np.bincount(best, minlength=len(book))
    return entry, sums, counts


def _possible(places: np.ndarray, held: np.ndarray, centre: np.ndarray, radius: float) -> np.ndarray:
    """The entries of ``held`` that may own a point of the ball."""
    mine = places[held]
    gaps = ((mine - centre) ** 2).sum(1)
    near = int(gaps.argmin())
    apart = np.sqrt(((mine - mine[near]) ** 2).sum(1))
    # Distance of the centre from the plane halfway between an entry and the nearest one.
    beyond = (gaps - gaps[near]) > 2 * apart * (radius * (1 + _SLACK) + _SLACK * (1 + np.sqrt(gaps)))
    twin = apart == 0
    twin[np.flatnonzero(twin)[0]] = False  # of equal entries the first one wins every tie
    return held[~(beyond | twin)]


# ---- on Spark ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _trees(kept: DataFrame, label_type, parts: int, width: int) -> DataFrame:
    """One row per block: ids, labels, vectors, and per part the tree over them."""
    dims = parts * width
    size = max(LEAF, BLOCK_CELLS // max(1, dims))

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        points = matrix(table["vec"], dims)
        built = [build_tree(points[:, p * width : (p + 1) * width]) for p in range(parts)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table["id"].to_pylist()], pa.list_(pa.int64())),
                pa.array([table["label"].to_pylist()], pa.list_(table["label"].type)),
                pa.array([points.astype("<i4").tobytes()], pa.binary()),
                pa.array([b"".join(o.tobytes() for o, _ in built)], pa.binary()),
                pa.array([[n.tobytes() for _, n in built]], pa.list_(pa.binary())),
            ],
            names=["id", "label", "points", "orders", "nodes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - rows)
                held.append(part)
                rows, at = rows + part.num_rows, at + part.num_rows
                if rows == size:
                    yield pack(held)
                    held, rows = [], 0
        if rows:
            yield pack(held)

    schema = (
        f"id array<bigint>, label array<{label_type}>, points binary, orders binary, "
        "nodes array<binary>"
    )
    return kept.mapInArrow(run, schema)


def _blocks(batch: pa.RecordBatch, parts: int, width: int):
    """Points and trees of the blocks in a batch, one at a time."""
    for row in range(batch.num_rows):
        points = np.frombuffer(batch["points"][row].as_py(), "<i4").reshape(-1, parts * width)
        orders = np.frombuffer(batch["orders"][row].as_py(), "<i4").reshape(parts, -1)
        nodes = [np.frombuffer(n, _node_type(width)) for n in batch["nodes"][row].as_py()]
        cuts = [points[:, p * width : (p + 1) * width] for p in range(parts)]
        yield row, cuts, orders, nodes


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries after one round: floor of the mean of their points; unused ones stay."""
    parts, entries, width = books.shape
    sent = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for _, cuts, orders, nodes in _blocks(batch, parts, width):
                for p in range(parts):
                    _, sums, counts = assign(cuts[p], orders[p], nodes[p], sent.value[p])
                    totals[p, :, :width] += sums
                    totals[p, :, width] += counts
        flat = totals.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "total"])

    totals = np.zeros(parts * entries * (width + 1), np.int64)
    summed = trees.mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum("total"))
    for at, total in summed.collect():  # a number per entry and component
        totals[at] = total
    totals = totals.reshape(parts, entries, width + 1)
    used = totals[:, :, width:] > 0
    return np.where(used, totals[:, :, :width] // np.maximum(1, totals[:, :, width:]), books)


def _codes(trees: DataFrame, books: np.ndarray, label_type) -> DataFrame:
    parts, _, width = books.shape
    sent = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, cuts, orders, nodes in _blocks(batch, parts, width):
                codes = np.empty((len(cuts[0]), parts), np.uint8)
                error = np.zeros(len(cuts[0]), np.int64)
                for p in range(parts):
                    book = sent.value[p]
                    codes[:, p], _, _ = assign(cuts[p], orders[p], nodes[p], book)
                    error += ((cuts[p].astype(np.int64) - book[codes[:, p]]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"][row].values,
                        batch["label"][row].values,
                        pa.array([c.tobytes().hex() for c in codes], pa.string()),
                        pa.array(error),
                    ],
                    names=["id", "label", "code", "error"],
                )

    return trees.mapInArrow(run, f"id long, label {label_type}, code string, error long")


def encode(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks they refer to.

    Columns: ``id``, ``label``, ``code`` (two hex digits per part), ``error`` (squared distance
    to the coded vector) and ``label_error`` (the errors of all rows of that label; null labels
    together). At most 256 ``entries``.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    spark = df.sparkSession
    staging = Staging(spark, until_exit=True)
    label_type = df.schema[label].dataType.simpleString()
    kept = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").alias("label"),
        whole_components(vector).alias("vec"),
    ).where(F.col("vec").isNotNull())

    seen = Observation()
    first = (
        kept.observe(seen, longest(kept, "vec").alias("dims"))
        .orderBy(F.col("id").asc_nulls_last(), "vec")
        .limit(entries)
        .select("vec")
        .collect()
    )
    width = max(1, -(-int(seen.get["dims"]) // parts))
    books = np.zeros((parts, len(first), width), np.int64)
    for n, row in enumerate(first):
        whole = np.zeros(parts * width, np.int64)
        whole[: len(row.vec)] = row.vec
        books[:, n] = whole.reshape(parts, width)

    trees = staging.write(_trees(kept, label_type, parts, width), "trees")
    for _ in range(rounds if len(first) else 0):
        books = _round(trees, books)
    coded = staging.write(_codes(trees, books, label_type), "codes")
    # Errors are added in each task first: a hot label is one row per task by then.
    totals = staging.write(
        coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels"
    )
    right = totals.select(F.col("label").alias("__label"), "label_error")
    width_of = F.octet_length(F.coalesce(F.col("label").cast("string"), F.lit(""))) + 64
    if (totals.agg(F.sum(width_of)).first()[0] or 0) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    joined = coded.join(right, coded["label"].eqNullSafe(F.col("__label"))).drop("__label")
    return joined, Codebooks(books)
