"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a text: its words, hashed (log counts, unit length); structure statistics such as
symbols per word or the share of distinct words, each as one of a few bins; numeric metadata
columns, binned alike. The score is the logistic of

    bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which has all pairwise interactions of rank k in time linear in the features (the last sum is
the sum-of-squares identity).

Fitting uses at most ``sample_rows`` labelled rows, the smallest by a hash of their key: their
features, a few MB, come to the driver, where AdaGrad runs in a fixed order. Scoring reads every
text once, inside its partition, with the model of under 1 MB sent to the executors.

Defined cases: null texts are empty and get a score like any other; null metadata counts as 0;
labels that are null are skipped, and a key labelled twice takes its smallest label; repeated
rows score alike; ties in the sample's order go to the smaller key, then text; very long texts are
read whole, one at a time; without labels every score is 0.5, with one class only it is that
class's smoothed rate; an empty table gives no rows; extra columns are passed through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, fresh, with_columns_by

WORD_BUCKETS = 1 << 14
BINS = 12
RANK = 8
#: Labelled rows used for fitting, at most.
SAMPLE_ROWS = 6000
THRESHOLD = 0.7

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_STOPS = b".!?"
_HIGH = bytes(range(128, 256))


@dataclass(frozen=True)
class FitParams:
    epochs: int = 6
    batch: int = 128
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7
    rank: int = RANK


@dataclass(frozen=True)
class FactorMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    #: Upper bin edges of each statistic, one row per statistic.
    edges: np.ndarray
    metadata: tuple[str, ...] = field(default=())

    def index(self, words: np.ndarray, values: np.ndarray, stats: np.ndarray):
        return _join_features(words, values, stats, self.edges)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        scaled = self.factors[index] * value[:, None]
        pairs = 0.5 * float((scaled.sum(0) ** 2 - (scaled**2).sum(0)).sum())
        z = self.bias + float(self.weights[index] @ value) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def word_features(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word buckets, their values, and the structure statistics of a text."""
    words = text.split()
    counts = Counter(words)
    n, size = max(1, len(words)), max(1, len(text))

    def share(chars: bytes, of: int) -> float:
        return (len(text) - len(text.translate(None, chars))) / of

    buckets = np.fromiter(map(zlib.crc32, counts), np.uint32, len(counts)).astype(np.int64)
    values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    values /= max(1e-9, float(np.sqrt((values**2).sum())))
    lines = [x for x in text.split(b"\n") if x.strip()]
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    stats = np.array(
        [
            np.log1p(len(words)),
            sum(map(len, words)) / n,
            len(counts) / n,
            max(counts.values(), default=0) / n,
            again / n,
            share(_SYMBOLS, n),
            share(b"|", n),
            share(b"!", n),
            share(_STOPS, n),
            share(_UPPER, size),
            share(_LOWER, size),
            share(_DIGITS, size),
            share(_HIGH, size),
            (len(lines) - len(set(lines))) / max(1, len(lines)),
            np.log1p(size / max(1, len(lines))),
        ]
    )
    return buckets % WORD_BUCKETS, values, stats


def _join_features(words, values, stats, edges) -> tuple[np.ndarray, np.ndarray]:
    """Word buckets, then one bin of each statistic."""
    bins = (stats[:, None] > edges).sum(1)
    index = WORD_BUCKETS + np.arange(len(stats)) * (BINS + 1) + bins
    value = np.full(len(stats), 1 / np.sqrt(len(stats)))
    return np.concatenate((words, index)), np.concatenate((values, value))


def _metadata_of(batch: pa.RecordBatch, names: Sequence[str]) -> list[list[float]]:
    columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
    return [[np.log1p(max(0.0, float(x or 0))) for x in row] for row in zip(*columns, strict=True)]


def _all_features(batch: pa.RecordBatch, text: str, metadata: Sequence[str]):
    more = _metadata_of(batch, metadata) if metadata else [[]] * batch.num_rows
    for body, extra in zip(byte_texts(batch, text), more, strict=True):
        words, values, stats = word_features(body)
        yield words, values, np.concatenate((stats, extra))


def is_held_out(key: str) -> Column:
    """The fold that labels are never learned from: crc32 of the key as text, modulo 4, is 2."""
    crc = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def _sample(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    metadata: Sequence[str],
    sample_rows: int,
) -> list[tuple]:
    """Features of the labelled rows to fit on, as bytes."""
    order = F.xxhash64("__key")
    known = (
        labels.where(~is_held_out(key))
        .select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").cast("int").alias("__label"))
        .dropna()
        .groupBy("__key")
        .agg(F.min("__label").alias("__label"))
        .orderBy(order, "__key")
        .limit(sample_rows)
    )
    names = [f"__meta{n}" for n in range(len(metadata))]
    narrow = docs.select(
        F.col(f"`{key}`").alias("__key"),
        F.col(f"`{text}`").cast("string").alias("__text"),
        *[F.col(f"`{c}`").cast("double").alias(n) for n, c in zip(names, metadata, strict=True)],
    )

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = list(_all_features(batch, "__text", names))
        return [
            pa.array([w.astype("<i4").tobytes() for w, _, _ in rows], pa.binary()),
            pa.array([v.astype("<f4").tobytes() for _, v, _ in rows], pa.binary()),
            pa.array([s.astype("<f8").tobytes() for _, _, s in rows], pa.binary()),
        ]

    fields = [T.StructField(n, T.BinaryType()) for n in ("__words", "__values", "__stats")]
    # At most sample_rows keys. Features are taken where the texts lie; only they are put in order.
    shown = narrow.join(F.broadcast(known), "__key").withColumn("__tie", F.xxhash64("__text"))
    featured = with_columns_by(shown, fields, compute).drop("__text")
    chosen = featured.orderBy(order, "__key", "__tie").limit(sample_rows)
    return [
        tuple(r) for r in chosen.select("__label", "__words", "__values", "__stats").collect()
    ]


def _train(rows: list, y: np.ndarray, size: int, params: FitParams):
    """AdaGrad on the logistic loss, in mini-batches of a fixed order."""
    rng = np.random.default_rng(params.seed)
    weights, factors = np.zeros(size), rng.normal(0, 0.05, (size, params.rank))
    rate = y.mean()
    bias = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, params.rank), 1e-6), 1e-6
    for _ in range(params.epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // params.batch)):
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            own = np.repeat(np.arange(len(part)), sizes)
            scaled = factors[index] * value[:, None]
            sums = np.add.reduceat(scaled, starts)
            pairs = 0.5 * (sums**2 - np.add.reduceat(scaled**2, starts)).sum(1)
            z = bias + np.add.reduceat(weights[index] * value, starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]) / len(part)
            touched, place = np.unique(index, return_inverse=True)
            step = error[own] * value
            grad_w = np.bincount(place, step) + params.decay * weights[touched]
            grad_v = np.zeros((len(touched), params.rank))
            np.add.at(grad_v, place, step[:, None] * (sums[own] - scaled))
            grad_v += params.decay * factors[touched]
            seen_w[touched] += grad_w**2
            seen_v[touched] += grad_v**2
            seen_b += error.sum() ** 2
            weights[touched] -= params.rate * grad_w / np.sqrt(seen_w[touched])
            factors[touched] -= params.rate * grad_v / np.sqrt(seen_v[touched])
            bias -= params.rate * error.sum() / np.sqrt(seen_b)
    return bias, weights, factors


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    metadata: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
    params: FitParams | None = None,
) -> FactorMachine:
    """Fit on labelled rows outside the held-out fold, at most ``sample_rows`` of them."""
    params = params or FitParams()
    rows = _sample(docs, labels, key, text, label, metadata, sample_rows)
    if not rows:
        return FactorMachine(0.0, np.zeros(1), np.zeros((1, 1)), np.zeros((0, 0)), tuple(metadata))
    y = np.array([r[0] > 0 for r in rows], float)
    stats = np.stack([np.frombuffer(r[3], "<f8") for r in rows])
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T
    # The top edges set rare extremes apart from the bulk, most of which may share one value.
    edges[:, -1] = np.quantile(stats, 0.995, axis=0)
    features = [
        _join_features(np.frombuffer(r[1], "<i4").astype(np.int64), np.frombuffer(r[2], "<f4"), s, edges)
        for r, s in zip(rows, stats, strict=True)
    ]
    size = WORD_BUCKETS + stats.shape[1] * (BINS + 1)
    bias, weights, factors = _train(features, y, size, params)
    return FactorMachine(bias, weights, factors, edges, tuple(metadata))


def with_quality(
    docs: DataFrame, model: FactorMachine, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with the score of every text, 0 to 1; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    numbers = {fresh(docs.columns, f"__meta{n}"): c for n, c in enumerate(model.metadata)}
    names = list(numbers)
    body = fresh(docs.columns, "__text")
    wide = docs.withColumns(
        {n: F.col(f"`{c}`").cast("double") for n, c in numbers.items()}
        | {body: F.col(f"`{text}`").cast("string")}
    )

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        machine = sent.value
        if not len(machine.edges):
            return [pa.array([0.5] * batch.num_rows, pa.float64())]
        rows = _all_features(batch, body, names)
        return [pa.array([machine.score(*machine.index(*row)) for row in rows], pa.float64())]

    if score.lower() not in {c.lower() for c in (body, *names)}:
        wide = wide.drop(score)
    scored = with_columns_by(wide, [T.StructField(score, T.DoubleType())], compute)
    return scored.drop(body, *names)


def keep_quality(
    docs: DataFrame, model: FactorMachine, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs``, all columns, without those that score below ``threshold``."""
    score = fresh(docs.columns, "__score")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return with_quality(docs, model, text, score).where(F.col(score) >= threshold).select(columns)
