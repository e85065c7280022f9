"""Hard negatives of anchor vectors: threshold joins over norm-bounded inverted indexes.

An anchor's positives are its best rows of the same label; each positive opens a window of scores
in which the best rows of other labels are its hard negatives. Both are found by threshold joins
of the anchors (a stated query set) with all rows, in blocks:

* rows lie in blocks of a bounded number. A block's *inverted index* holds, per group of
  dimensions, the rows that have postings there. Dimensions of a row whose norm, times the longest
  anchor's, cannot reach the threshold by themselves are omitted: a row that shares no indexed
  dimension with an anchor is below the threshold. Dimensions with little energy come first, so
  they are the ones omitted, and rows are sorted by how much is omitted, so every posting list is
  the front part of the block;
* an anchor's scores are *accumulated* from the last group of dimensions to the first, and a pair
  is *pruned* as soon as its partial score plus the product of the norms that remain is below the
  threshold. What survives is scored exactly, in integers;
* *thresholds are lowered until windows fill*: the first comes from how the anchor scores in its own
  block, as the score that about twice the wanted rows of the whole table should reach. Anchors
  (or windows) that found too few go on with a lower threshold, and at last with one at which
  nothing can be missed: for positives the score that enough rows of the anchor's own block
  reach, for negatives the window's lower end.

A task gives back at most the wanted number of rows per anchor or window and block, so a hot
label or a large group of copies adds work in proportion to its rows, but no pairs. Anchors reach
the tasks in parts of at most about :data:`PART_ANCHORS` rows; rows are stored once in the shared
folder, in blocks, and are not shuffled again.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part;
of rows that repeat an id the one least by label, then vector, takes part; shorter vectors (empty
ones too) end in zeros; ties go to the smaller id; an anchor without positives, and a window
without negatives, gives no rows, as does an empty table; a positive with a score below zero has
an empty window; other columns are ignored, whatever their names; very long vectors make smaller
blocks; vectors too long for exact scores raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .vectors import longest, matrix, whole_components

#: Components in a block of rows, and anchors in a part; both bound a task's memory.
BLOCK_CELLS = 1 << 20
PART_ANCHORS = 8192
#: Anchors whose scores are accumulated together.
CHUNK = 128
#: Groups of dimensions, the unit in which an index omits them.
GROUPS = 8
#: A threshold aims at so many times the wanted rows; the next one at more of them.
AIMS = (2, 32)
#: Pairs are followed one by one once fewer than this share is left.
SPARSE = 0.1
_SLACK = 1 + 1e-9
_TAIL = NormalDist()


# ---- index and search -------------------------------------------------------------------


@dataclass(frozen=True)
class NormIndex:
    """Rows of a block by how many groups of dimensions their postings leave out."""

    rows: np.ndarray  # places in the block, those with the longest posting lists first
    values: np.ndarray  # their vectors, dimensions from little to much energy
    norms: np.ndarray  # norms[g]: of the dimensions before group g
    omitted: np.ndarray  # groups without postings, ascending
    order: np.ndarray  # of the dimensions
    cuts: np.ndarray  # where groups begin and end


def build_index(vectors: np.ndarray, threshold: float) -> NormIndex:
    """Index for anchors of length 1 and scores from ``threshold`` up."""
    energy = (vectors.astype(np.float64) ** 2).sum(0)
    order = np.argsort(energy, kind="stable")
    cuts = np.unique(np.linspace(0, vectors.shape[1], GROUPS + 1).astype(int))
    values = vectors[:, order].astype(np.float64)
    squares = np.concatenate((np.zeros((len(values), 1)), np.cumsum(values**2, 1)), 1)
    norms = np.sqrt(squares[:, cuts]) * _SLACK
    # The longest front part that cannot reach the threshold alone.
    omitted = (norms < threshold).sum(1) - 1 if threshold > 0 else np.zeros(len(values), int)
    omitted = np.maximum(0, omitted)
    rows = np.argsort(omitted, kind="stable")
    return NormIndex(rows, values[rows], norms[rows].T, omitted[rows], order, cuts)


def search(
    index: NormIndex, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, place in the block) with a score from ``low`` to ``high``, and the score.

    ``allowed`` says, per anchor and place, which pairs may be returned.
    """
    mine = anchors[:, index.order].astype(np.float64)
    squares = np.concatenate((np.zeros((len(mine), 1)), np.cumsum(mine**2, 1)), 1)
    remain = np.sqrt(squares[:, index.cuts]) * _SLACK
    partial = np.zeros((len(mine), len(index.rows)))
    limit = low - 1e-6 * (1 + np.abs(low))
    every = np.arange(len(index.rows))
    i = j = score = None
    for g in range(len(index.cuts) - 2, -1, -1):
        # Postings of this group: the rows that omit no more than the groups before it.
        posted = int(np.searchsorted(index.omitted, g, side="right"))
        span = slice(index.cuts[g], index.cuts[g + 1])
        # What is not accumulated yet, or never will be, is bounded by its norms.
        left = np.maximum(g, index.omitted)
        if i is None:
            partial[:, :posted] += mine[:, span] @ index.values[:posted, span].T
            alive = partial + remain[:, left] * index.norms[left, every] >= limit[:, None]
            alive &= allowed[:, index.rows]
            if g == 0 or np.count_nonzero(alive) <= SPARSE * partial.size:
                i, j = np.nonzero(alive)
                score = partial[i, j]
        else:
            has = np.flatnonzero(j < posted)
            score[has] += _products(mine[:, span], index.values[:, span], i[has], j[has])
            keep = score + remain[i, left[j]] * index.norms[left[j], j] >= limit[i]
            i, j, score = i[keep], j[keep], score[keep]
    exact = _products(mine, index.values, i, j).astype(np.int64)
    keep = (exact >= low[i]) & (exact <= high[i])
    return i[keep], index.rows[j[keep]], exact[keep]


def _products(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of listed pairs, a slice at a time."""
    step = max(1, BLOCK_CELLS // max(1, left.shape[1]))
    out = np.empty(len(i))
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        out[part] = np.einsum("pd,pd->p", left[i[part]], right[j[part]])
    return out


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, wanted: int) -> np.ndarray:
    """Places of the first ``wanted`` of each group, by score, then by smaller id."""
    by = np.lexsort((ids, -score, group))
    ordered = group[by]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return by[rank < wanted] if len(by) else by


def _reaching(mean: float, spread: float, share: float, above: float = math.inf) -> float:
    """The score that ``share`` of rows reach without passing ``above``, were scores normal."""
    spread = max(spread, 1e-9)
    tail = share + (1 - _TAIL.cdf((above - mean) / spread) if above < math.inf else 0)
    return -math.inf if tail >= 1 else mean + spread * _TAIL.inv_cdf(1 - max(tail, 1e-15))


# ---- blocks -----------------------------------------------------------------------------


def _rows_in(dims: int) -> int:
    return max(64, BLOCK_CELLS // max(1, dims))


def _blocks(kept: DataFrame, dims: int, count: int) -> DataFrame:
    """One row per block; of rows that repeat an id, one."""
    blocks = max(1, -(-count // _rows_in(dims)))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        frame = table.select(["id", "label", "anchor"]).to_pandas()
        vectors = matrix(table["vec"], dims)
        frame["row"] = np.arange(len(frame))
        if frame["id"].duplicated().any():
            again = frame["id"].duplicated(keep=False)
            frame["by"] = [tuple(vectors[r].tolist()) if a else () for r, a in zip(frame["row"], again, strict=True)]
            frame = frame.sort_values(["id", "label", "by"], kind="stable").drop_duplicates("id")
        frame = frame.sort_values("id")
        rows = vectors[frame["row"].to_numpy()]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int64()),
                "id": pa.array([frame["id"].tolist()], pa.list_(pa.int64())),
                "label": pa.array([frame["label"].tolist()], pa.list_(pa.string())),
                "anchor": pa.array([frame["anchor"].tolist()], pa.list_(pa.bool_())),
                "points": pa.array([rows.astype("<i4").tobytes()], pa.binary()),
            }
        )

    schema = (
        "block long, id array<bigint>, label array<string>, anchor array<boolean>, points binary"
    )
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(pack, schema)


def _opened(batch: pa.RecordBatch, dims: int):
    """Ids, labels, anchor marks and vectors of each block in a batch."""
    for row in range(batch.num_rows):
        ids = batch["id"][row].values.to_numpy(zero_copy_only=False)
        labels = np.array(batch["label"][row].values.to_pylist(), object)
        marks = batch["anchor"][row].values.to_numpy(zero_copy_only=False).astype(bool)
        points = np.frombuffer(batch["points"][row].as_py(), "<i4").reshape(len(ids), dims)
        yield ids, labels, marks, points


def _chunks(ids, labels, marks, points):
    """Anchors of a block with their scores against the whole block."""
    wide = points.astype(np.float64)
    where = np.flatnonzero(marks)
    for at in range(0, len(where), CHUNK):
        part = where[at : at + CHUNK]
        yield part, (wide[part] @ wide.T).astype(np.int64)


def _openings(blocks: DataFrame, dims: int, count: int, wanted: int) -> DataFrame:
    """Every anchor, the thresholds for its positives, and how it scores with other labels.

    All from the anchor's own block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, marks, points in _opened(batch, dims):
                times = count / max(1, len(ids))
                wide = points.astype(np.float64)
                where = np.flatnonzero(marks)
                for at in range(0, len(where), CHUNK):
                    part = where[at : at + CHUNK]
                    steps, others = [], []
                    for place, mine in zip(part, wide[part] @ wide.T, strict=True):
                        same = labels == labels[place]
                        other = mine[~same]
                        same[place] = False
                        steps.append(_positive_steps(mine[same], times, wanted))
                        others.append((other.mean(), other.std(), len(other) * times) if len(other) else (0, 0, 0))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[part]),
                            pa.array(labels[part].tolist(), pa.string()),
                            pa.array([points[p].astype("<i4").tobytes() for p in part], pa.binary()),
                            pa.array(steps, pa.list_(pa.float64())),
                            *(pa.array(x, pa.float64()) for x in zip(*others, strict=True)),
                        ],
                        names=["id", "label", "point", "steps", "mean", "spread", "others"],
                    )

    return blocks.mapInArrow(
        run,
        "id long, label string, point binary, steps array<double>, mean double, spread double, "
        "others double",
    )


def _positive_steps(scores: np.ndarray, times: float, wanted: int) -> list[float]:
    """Falling thresholds; at the last one ``wanted`` rows of the own block alone suffice."""
    last = -math.inf if len(scores) < wanted else float(np.partition(scores, -wanted)[-wanted])
    if not len(scores):
        return [last] * (len(AIMS) + 1)
    mean, spread, rows = float(scores.mean()), float(scores.std()), len(scores) * times
    return [max(last, _reaching(mean, spread, min(1.0, a * wanted / rows))) for a in AIMS] + [last]


def _negative_windows(found: DataFrame, openings: DataFrame, wanted: int, percent: int) -> DataFrame:
    """A window per anchor and positive: from ``percent`` of the positive's score up to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, steps = [], []
            for n, row in enumerate(batch.to_pylist()):
                high = row["score"]
                low = -(-percent * high // 100)
                if low > high:  # a score below zero
                    continue
                shares = [min(1.0, a * wanted / max(1.0, row["others"])) for a in AIMS]
                falling = [_reaching(row["mean"], row["spread"], s, high) for s in shares]
                rows.append(n)
                steps.append([float(min(high, max(low, x))) for x in falling] + [float(low)])
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    kept["id"],
                    kept["other"],
                    pa.array(steps, pa.list_(pa.float64())),
                    kept["score"].cast(pa.float64()),
                ],
                names=["id", "window", "steps", "high"],
            )

    pairs = found.join(openings.select("id", "mean", "spread", "others"), "id")
    columns = ["id", "other", "score", "mean", "spread", "others"]
    return pairs.select(columns).mapInArrow(
        run, "id long, window long, steps array<double>, high double"
    )


# ---- threshold joins --------------------------------------------------------------------


def _in_parts(anchors: DataFrame, count: int):
    """The rows of ``anchors`` in parts of about ``PART_ANCHORS``, one at a time."""
    parts = max(1, -(-count // PART_ANCHORS))
    for part in range(parts):
        mine = anchors.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part) if parts > 1 else anchors
        yield part, mine.toArrow()


def _joined(blocks: DataFrame, queries: pa.Table, dims: int, wanted: int, same: bool) -> DataFrame:
    """Best rows per query in each block: ``id``, ``window``, ``other``, ``score``.

    ``queries`` holds per anchor its point and label and the ``lows`` and ``highs`` of its
    windows, which are named by ``windows``.
    """
    most = max(map(len, queries["windows"].to_pylist()))

    def padded(column: str, fill) -> np.ndarray:
        return np.array([x + [fill] * (most - len(x)) for x in queries[column].to_pylist()])

    sent = blocks.sparkSession.sparkContext.broadcast(
        (
            queries["id"].to_numpy(),
            np.array(queries["label"].to_pylist(), object),
            np.frombuffer(b"".join(queries["point"].to_pylist()), "<i4").reshape(-1, dims),
            padded("windows", 0),
            padded("lows", math.inf),
            padded("highs", -math.inf),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, label, points, windows, lows, highs = sent.value
        low, high = lows.min(1), highs.max(1)
        length = np.maximum(np.sqrt((points.astype(np.float64) ** 2).sum(1)), 1e-9)
        # Anchors of like thresholds share an index.
        by = np.argsort(-(low / length), kind="stable")
        for batch in batches:
            for ids, labels, _, rows in _opened(batch, dims):
                for at in range(0, len(by), CHUNK):
                    part = by[at : at + CHUNK]
                    index = build_index(rows, float((low[part] / length[part]).min()) / _SLACK)
                    allowed = (label[part][:, None] == labels) == same
                    i, j, score = search(index, points[part], low[part], high[part], allowed)
                    strange = ids[j] != own[part[i]]
                    query, place, score = part[i[strange]], j[strange], score[strange]
                    for w in range(windows.shape[1]):
                        inside = np.flatnonzero((score >= lows[query, w]) & (score <= highs[query, w]))
                        if not len(inside):
                            continue
                        q, o = query[inside], ids[place[inside]]
                        best = _best(q, score[inside], o, wanted)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(own[q[best]]),
                                pa.array(windows[q[best], w]),
                                pa.array(o[best]),
                                pa.array(score[inside][best]),
                            ],
                            names=["id", "window", "other", "score"],
                        )

    return blocks.mapInArrow(run, "id long, window long, other long, score long")


def _first(found: DataFrame, wanted: int) -> DataFrame:
    """The best ``wanted`` rows of each window, ranked; a task keeps its own best first."""
    ranks = Window.partitionBy("id", "window").orderBy(F.col("score").desc(), "other")
    ranked = found.withColumn("rank", F.row_number().over(ranks))
    return ranked.where(F.col("rank") <= wanted)


def _fill(
    staging: Staging,
    name: str,
    blocks: DataFrame,
    anchors: DataFrame,
    windows: DataFrame,
    dims: int,
    wanted: int,
    same: bool,
) -> DataFrame:
    """The first ``wanted`` rows of each window, its threshold lowered until it is full.

    ``windows``: ``id``, ``window``, falling ``steps`` (the last one misses nothing) and ``high``.
    """
    filled = None
    last = len(AIMS)
    for step in range(last + 1):
        open_now = windows.groupBy("id").agg(
            F.collect_list("window").alias("windows"),
            F.collect_list(F.col("steps")[step]).alias("lows"),
            F.collect_list("high").alias("highs"),
        )
        queries = staging.write(open_now.join(anchors, "id"), f"{name}-queries-{step}")
        count = queries.count()  # from the files' footers
        if not count:
            break
        hits = None
        for part, table in _in_parts(queries, count):
            found = staging.write(
                _joined(blocks, table, dims, wanted, same), f"{name}-found-{step}-{part}"
            )
            hits = found if hits is None else hits.union(found)
        best = staging.write(_first(hits, wanted), f"{name}-best-{step}")
        sizes = best.groupBy("id", "window").agg(F.count(F.lit(1)).alias("n"))
        state = windows.join(sizes, ["id", "window"], "left")
        short = (F.coalesce(F.col("n"), F.lit(0)) < wanted) & (
            F.col("steps")[step] > F.col("steps")[last]
        )
        windows = staging.write(state.where(short).drop("n"), f"{name}-open-{step}")
        # What an unfilled window found so far is found again at its next threshold.
        done = best.join(windows.select("id", "window"), ["id", "window"], "left_anti")
        filled = done if filled is None else filled.union(done)
    if filled is None:
        return blocks.sparkSession.createDataFrame(
            [], "id long, window long, other long, score long, rank int"
        )
    return staging.write(filled, f"{name}-filled")


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` (over ``df``'s columns) holds.

    Columns: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``.
    """
    spark = df.sparkSession
    staging = Staging(spark, until_exit=True)
    labels = F.col(f"`{label}`") if isinstance(label, str) else label
    kept = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        labels.cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        whole_components(vector).alias("vec"),
    ).dropna(subset=["id", "label", "vec"])
    sizes = kept.agg(longest(kept, "vec").alias("dims"), F.count(F.lit(1)).alias("rows")).first()
    dims, count = max(1, sizes["dims"]), sizes["rows"]
    blocks = staging.write(_blocks(kept, dims, count), "blocks")
    openings = staging.write(_openings(blocks, dims, count, positives), "openings")
    points = openings.select("id", "label", "point")

    wanted = openings.select("id", F.col("id").alias("window"), "steps", F.lit(math.inf).alias("high"))
    found = _fill(staging, "positives", blocks, points, wanted, dims, positives, same=True)
    windows = staging.write(_negative_windows(found, openings, negatives, percent), "windows")
    mined = _fill(staging, "negatives", blocks, points, windows, dims, negatives, same=False)
    scores = found.select("id", F.col("other").alias("window"), F.col("score").alias("positive"))
    return mined.join(scores, ["id", "window"]).select(
        F.col("id").alias("anchor_id"),
        F.col("window").alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        F.col("positive").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
