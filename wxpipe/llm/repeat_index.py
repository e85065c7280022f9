"""Exact removal of long byte strings that an earlier document already holds.

A byte goes if a ``size``-byte string that covers it also starts in a document with a smaller id.
Strings are judged on the input; matches never cross documents.

The method dealt for this operator, a run-length compressed Burrows-Wheeler index, is sequential
over the whole text and its matches do not tell which document came first; the README says why
it gave way to the following. In every ``size``-byte window the ``gram``-byte string with the
least hash is an anchor, so equal windows have an equal anchor. Anchors are dealt out by hash,
together with a hash of their context, which is all bytes that a window around the anchor can
reach:

* an anchor whose whole context occurs in a smaller document is covered with its context;
* where contexts of one anchor differ, as at the ends of a repeat, one occurrence of each context
  is sent with its bytes, and their windows are compared one offset at a time: in one task, or,
  for an anchor with more than ``hot`` contexts, as one row per window over all tasks.

Equal contexts are 128 bits of hash alike. Inside each task repeats of a context are settled
before the shuffle, so a passage that a third of all documents hold is a few rows a task.

Defined cases: null texts are empty; texts shorter than ``size`` lose nothing; rows without id
are not compared and lose nothing; rows that repeat an id are one document; of equal documents
the smallest id stays; very long texts are read whole, a few at a time; ids that are no whole numbers
raise; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staging
from .common import byte_texts, matching, sized_for, with_columns_by

SIZE = 50
GRAM = 20
#: An anchor with more contexts than this is compared window by window, over all tasks.
HOT_CONTEXTS = 200_000
#: Bytes of the largest shuffle, in bytes of text.
SHUFFLED = 3

_U = np.uint64
_RNG = np.random.default_rng(23)
_BYTES = _RNG.integers(0, 1 << 63, 256, _U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * n, base, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


class Hashes:
    """Hashes of any stretch of a byte string, from prefix sums."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers_to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTES[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours."""
    pick = np.minimum if least else np.maximum
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def anchor_places(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose gram is the least in some run of ``width`` grams, all of them in ties."""
    least = _sliding(grams, width, True)
    padded = np.concatenate((np.zeros(width - 1, _U), least, np.zeros(width - 1, _U)))
    return np.flatnonzero(_sliding(padded, width, False) == grams)


def _anchors(batch_keys: list[int], texts: list[bytes], size: int, gram: int) -> list[np.ndarray]:
    """Hash, context hash, key, place and reach of all anchors; a place is ~place once settled here.

    Successive anchors of one context, as in a periodic stretch, are one row: the first one's
    place and how far the last one is from it. Their contexts overlap or touch.
    """
    out: list[tuple] = []
    for key, text in zip(batch_keys, texts, strict=True):
        if len(text) < size:
            continue
        hashes = Hashes(np.frombuffer(text, np.uint8))
        grams = hashes.all(gram)
        places = anchor_places(grams, size - gram + 1)
        start, end = np.maximum(places - (size - gram), 0), np.minimum(places + size, len(text))
        shape = _mix(((places - start) * 4096 + (end - places)).astype(_U))
        g, c = grams[places], hashes.of(start, end) ^ shape
        head = np.ones(len(places), bool)
        head[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (np.diff(places) > size)
        heads = np.flatnonzero(head)
        reach = places[np.append(heads[1:], len(places)) - 1] - places[heads]
        out.append((g[heads], c[heads], np.full(len(heads), key), places[heads], reach))
    if not out:
        return [np.zeros(0, np.int64)] * 5
    g, c, keys, places, reach = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((keys, c, g))
    g, c, keys, places, reach = g[order], c[order], keys[order], places[order], reach[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    settled = keys > keys[first]
    alone = _mix(keys.astype(_U) * _U(_BASE) + places.astype(_U))
    return [
        np.where(settled, alone, g).view(np.int64),
        c.view(np.int64),
        keys,
        np.where(settled, ~places, places),
        reach,
    ]


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    )


def _marks(texts: DataFrame, size: int, gram: int) -> DataFrame:
    """(key, place, reach, g): ~place where the whole context is an earlier document's, else to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keys = part.column(0).to_pylist()
                with np.errstate(over="ignore"):
                    g, c, keys, places, reach = _anchors(keys, byte_texts(part, "text"), size, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (g, c, keys, places.astype(np.int32), reach.astype(np.int32))],
                    names=["g", "c", "key", "place", "reach"],
                )

    schema = "g bigint, c bigint, key bigint, place int, reach int"
    anchors = texts.where(F.col("key").isNotNull()).mapInArrow(run, schema)
    alike, same = Window.partitionBy("g"), Window.partitionBy("g", "c")
    seen = (
        anchors.withColumn("first", F.min("key").over(same))
        .withColumn("low", F.min("c").over(alike))
        .withColumn("high", F.max("c").over(alike))
    )
    covered = (F.col("place") < 0) | (F.col("key") > F.col("first"))
    place = F.when(covered & (F.col("place") >= 0), F.bitwise_not("place")).otherwise(F.col("place"))
    return seen.where(covered | (F.col("low") < F.col("high"))).select("key", place.alias("place"), "reach", "g")


def _contexts(texts: DataFrame, marks: DataFrame, size: int, gram: int) -> DataFrame:
    """(g, key, start, before, bytes, reach): contexts to compare; the anchor is ``before`` bytes in."""
    listed = (
        marks.where("place >= 0")
        .distinct()
        .groupBy("key")
        .agg(F.collect_list("place").alias("places"), F.collect_list("g").alias("gs"), F.collect_list("reach").alias("reaches"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "key", "start", "before", "context", "reach"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = [part.column(part.schema.get_field_index(n)).to_pylist() for n in ("key", "places", "gs", "reaches")]
                rows = []
                for key, places, gs, reaches, text in zip(*columns, byte_texts(part, "text"), strict=True):
                    for place, g, reach in zip(places, gs, reaches, strict=True):
                        start = max(0, place - (size - gram))
                        rows.append((g, key, start, place - start, text[start : place + size], reach))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
                lists = zip(*rows, strict=True) if rows else [[]] * 6
                arrays = [pa.array(x, k) for x, k in zip(lists, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    both = texts.join(listed, "key").dropDuplicates(["key"]).select("key", "places", "gs", "reaches", "text")
    return both.mapInArrow(run, "g bigint, key bigint, start int, before int, context binary, reach int")


def compare_contexts(g: np.ndarray, keys: np.ndarray, contexts: list[bytes], before: np.ndarray, size: int, gram: int):
    """For each window offset the rows whose window a smaller key of the same anchor holds.

    Yields (rows, starts of the windows in their contexts).
    """
    width = 2 * size - gram
    table = np.zeros((len(contexts), width), np.uint8)
    lead = size - gram
    for n, context in enumerate(contexts):
        at = lead - int(before[n])
        table[n, at : at + len(context)] = np.frombuffer(context, np.uint8)
    begin = lead - before
    end = begin + np.fromiter(map(len, contexts), np.int64, len(contexts))
    power, inverse = _powers_to(width + 1)
    sums = np.zeros((len(contexts), width + 1), _U)
    np.cumsum(_BYTES[table] * power[:width], axis=1, out=sums[:, 1:])
    for offset in range(lead + 1):
        rows = np.flatnonzero((begin <= offset) & (end >= offset + size))
        if len(rows) < 2:
            continue
        window = _mix((sums[rows, offset + size] - sums[rows, offset]) * inverse[offset])
        order = np.lexsort((keys[rows], window, g[rows]))
        a, b, own = g[rows][order], window[order], keys[rows][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        hit = rows[order[own > own[first]]]
        yield hit, offset - begin[hit]


#: Context rows compared at once; an anchor with more contexts is taken whole, up to HOT_CONTEXTS.
_ROWS = 20_000


def _partial(contexts: DataFrame, size: int, gram: int) -> DataFrame:
    """(key, start, end): windows that another context of their anchor holds in a smaller document."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        g, keys, start, before = (rows.column(n).to_numpy().astype(np.int64) for n in range(4))
        with np.errstate(over="ignore"):
            found = list(compare_contexts(g, keys, rows.column(4).to_pylist(), before, size, gram))
        hit = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        at = start[hit] + (np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64))
        reach = rows.column(5).to_numpy().astype(np.int64)
        # Windows of one row follow each other: one interval for each run of starts.
        order = np.lexsort((at, hit))
        hit, at = hit[order], at[order]
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1]) | (at[1:] > at[:-1] + size)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(hit)) - 1 if len(heads) else heads
        columns = [keys[hit[heads]], at[heads].astype(np.int32), (at[tails] + size + reach[hit[heads]]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                held.append(part)
                if sum(x.num_rows for x in held) < _ROWS:
                    continue
                last = part.column(0)[part.num_rows - 1].as_py()
                rows = pa.Table.from_batches(held)
                whole = int(np.searchsorted(rows.column(0).to_numpy(), last))
                if whole:
                    yield settle(rows.slice(0, whole))
                    held = rows.slice(whole).to_batches()
        if held:
            yield settle(pa.Table.from_batches(held))

    dealt = contexts.repartition("g").sortWithinPartitions("g")
    return dealt.mapInArrow(run, "key bigint, start int, end int")


def _hot_partial(contexts: DataFrame, size: int, gram: int) -> DataFrame:
    """(key, start, end) as :func:`_partial`, for anchors with more contexts than a task may hold.

    Each window around the anchor becomes a row, and the least key of equal windows is an
    aggregate, merged in every task first: no task holds an anchor's contexts together.
    """
    before, length = F.col("before"), F.octet_length("context")
    first = F.greatest(F.lit(0), before + gram - size)
    last = F.least(before, length - size)
    at = F.explode(F.when(last >= first, F.sequence(first, last)))
    window = F.expr(f"substring(context, at + 1, {size})")
    rows = contexts.select("key", "start", "reach", "context", at.alias("at")).select(
        "key",
        (F.col("start") + F.col("at")).alias("start"),
        "reach",
        F.xxhash64(window).alias("h"),
        F.xxhash64(F.lit(7), window).alias("h2"),
    )
    least = rows.groupBy("h", "h2").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    repeated = least.where("least < most").drop("most")
    hits = rows.join(repeated, ["h", "h2"]).where("key > least")
    return hits.select("key", "start", (F.col("start") + size + F.col("reach")).alias("end"))


def _compared(texts: DataFrame, marks: DataFrame, size: int, gram: int, hot: int) -> DataFrame:
    """(key, start, end) of the windows that only comparing contexts tells."""
    counts = marks.where("place >= 0").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    many = counts.where(F.col("n") > hot).select("g")
    if many.isEmpty():
        return _partial(_contexts(texts, marks, size, gram), size, gram)
    few = _contexts(texts, matching(marks, many, "g", "left_anti"), size, gram)
    rest = _contexts(texts, matching(marks, many, "g", "left_semi"), size, gram)
    return _partial(few, size, gram).union(_hot_partial(rest, size, gram))


def repeated_strings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    gram: int = GRAM,
    hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """``key``, n_bytes, n_removed, spans (start, end in bytes) and kept (bytes) of every document."""
    docs = sized_for(docs, text, SHUFFLED)
    staging = Staging(docs.sparkSession, until_exit=True)
    texts = _documents(docs, key, text)
    marks = staging.write(_marks(texts, size, gram), "marks")
    partial = _compared(texts, marks, size, gram, hot)
    place = F.bitwise_not("place")
    covered = marks.where("place < 0").select(
        "key", F.greatest(place - (size - gram), F.lit(0)).alias("start"), (place + size + F.col("reach")).alias("end")
    )
    removed = covered.union(partial).groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        starts, ends = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("starts", "ends"))
        n_bytes, n_removed, spans, kept = [], [], [], []
        for data, first, last in zip(byte_texts(batch, "text"), starts, ends, strict=True):
            runs: list[list[int]] = []
            for a, b in sorted(zip(first or [], last or [], strict=True)):
                b = min(b, len(data))
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            edges = [0, *(x for r in runs for x in r), len(data)]
            n_bytes.append(len(data))
            n_removed.append(sum(b - a for a, b in runs))
            spans.append([{"start": a, "end": b} for a, b in runs])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]

    fields = T.StructType.fromDDL(
        "n_bytes bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept binary"
    ).fields
    wide = with_columns_by(texts.join(removed, "key", "left"), list(fields), compute)
    return wide.select(F.col("key").alias(key), "n_bytes", "n_removed", "spans", "kept")

