"""Benchmark contamination: one automaton over normalised test items, one scan of each text.

Texts are lower-cased (A-Z only) and cut into words of ASCII letters, digits and all non-ASCII
characters. Every window of ``window`` consecutive words of an item (the whole item if it is
shorter) is a pattern of an Aho-Corasick automaton; a text is normalised to its words joined by
single spaces and scanned once. Matches are mapped to words, and words to code points of the
original text.

Defined cases: null or word-free texts have no words and are clean; null or word-free items
match nothing; equal items share their windows and are all reported; repeated documents are
reported once each; an item without id still marks words but is not listed; an empty table on
either side gives clean documents or no rows. Extra columns are ignored by
:func:`contamination` and passed through by :func:`decontaminate`.

The items are read shard by shard (``shard_bytes`` of normalised text each), and each shard is
sent to the executors on its own: a benchmark of any size costs one scan per shard, never more
memory. Test sets fit in one shard.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staging
from .common import byte_texts, fresh, with_columns_by

WINDOW = 13
SHARD_BYTES = 8 << 20

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

_HITS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("item", pa.string())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_HITS_TYPE = "array<struct<first:int,last:int,item:string>>"
_SPANS_TYPE = "array<struct<start:int,end:int>>"

Shard = list[tuple[str | None, list[bytes]]]
#: The last automaton that this worker built, by the name of its shard.
_automata: dict[str, tuple[ahocorasick.Automaton, list]] = {}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def _shards(
    items: DataFrame, key: str, text: str, shard_bytes: int
) -> Iterator[Shard]:
    """Items in shards of bounded size; only one is held at a time."""
    shard, held = [], 0
    rows = items.select(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`").cast("string"))
    for item, body in rows.toLocalIterator():
        if words := words_of((body or "").encode()):
            shard.append((item, words))
            held += sum(map(len, words))
            if held >= shard_bytes:
                yield shard
                shard, held = [], 0
    yield shard


def build_automaton(shard: Shard, window: int) -> tuple[ahocorasick.Automaton, list]:
    """Automaton over all windows, and for each pattern its word count and its items."""
    owners: dict[bytes, tuple[int, set]] = {}
    for item, words in shard:
        size = min(window, len(words))
        for at in range(len(words) - size + 1):
            pattern = b" " + b" ".join(words[at : at + size]) + b" "
            owners.setdefault(pattern, (size, set()))[1].add(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for n, pattern in enumerate(owners):
        automaton.add_word(pattern.decode("latin-1"), n)
    automaton.make_automaton()
    return automaton, list(owners.values())


def find_hits(text: bytes, automaton: ahocorasick.Automaton, owners: list) -> list[dict]:
    """Matches as (first word, last word, item), in the order in which they end."""
    words = words_of(text)
    if not words or not owners:
        return []
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(automaton.iter(joined))
    if not found:
        return []
    ends = np.fromiter(accumulate(len(w) + 1 for w in words), np.int64, len(words))
    last = np.searchsorted(ends, [at for at, _ in found])
    return [
        {"first": int(at) - owners[n][0] + 1, "last": int(at), "item": item}
        for at, (_, n) in zip(last, found, strict=True)
        for item in owners[n][1]
    ]


def merge_hits(text: bytes, hits: list[dict]) -> tuple[int, int, list[str], list[dict]]:
    """Words, hit words, items (sorted) and hit spans in code points of the original text."""
    n_words = len(words_of(text))
    if not hits:
        return n_words, 0, [], []
    steps = np.zeros(n_words + 1, np.int64)
    for hit in hits:
        steps[hit["first"]] += 1
        steps[hit["last"] + 1] -= 1
    marked = np.cumsum(steps[:-1]) > 0
    places = [m.span() for m in _WORD.finditer(text.decode("utf-8", "replace"))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
    spans = [
        {"start": places[a][0], "end": places[b - 1][1]}
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
    ]
    items = sorted({hit["item"] for hit in hits} - {None})
    return n_words, int(marked.sum()), items, spans


def _with_raw_hits(
    df: DataFrame, text: str, shard: Broadcast, window: int, column: str
) -> DataFrame:
    name = uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _automata:
            _automata.clear()
            _automata[name] = build_automaton(shard.value, window)
        automaton, owners = _automata[name]
        hits = [find_hits(x, automaton, owners) for x in byte_texts(batch, text)]
        return [pa.array(hits, _HITS)]

    field = T.StructField(column, T.ArrayType(T.StructType.fromDDL("first int, last int, item string")))
    return with_columns_by(df, [field], compute)


def _with_hits(
    docs: DataFrame,
    items: DataFrame,
    text: str,
    item_key: str,
    item_text: str,
    window: int,
    shard_bytes: int,
) -> tuple[DataFrame, list[str]]:
    """Documents with n_words, n_hit, items and spans under names that are free."""
    spark = docs.sparkSession
    raw: list[str] = []
    staging: Staging | None = None
    shards = _shards(items, item_key, item_text, shard_bytes)
    shard = next(shards)
    while shard is not None:
        following = next(shards, None)
        raw.append(fresh(docs.columns, f"__hits{len(raw)}"))
        sent = spark.sparkContext.broadcast(shard)
        docs = _with_raw_hits(docs, text, sent, window, raw[-1])
        if following is not None:  # one automaton at a time in an executor's memory
            staging = staging or Staging(spark, until_exit=True)
            docs = staging.write(docs, raw[-1])
        shard = following
    out = [fresh(docs.columns, n) for n in ("__n_words", "__n_hit", "__items", "__spans")]

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in raw]
        rows = [
            merge_hits(body, [hit for part in hits for hit in part])
            for body, hits in zip(byte_texts(batch, text), zip(*columns, strict=True), strict=True)
        ]
        n_words, n_hit, found, spans = zip(*rows, strict=True) if rows else ((), (), (), ())
        return [
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array(found, pa.list_(pa.string())),
            pa.array(spans, _SPANS),
        ]

    kinds = ("bigint", "bigint", "array<string>", _SPANS_TYPE)
    fields = [T.StructField(n, T.DataType.fromDDL(k)) for n, k in zip(out, kinds, strict=True)]
    return with_columns_by(docs, fields, compute).drop(*raw), out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``key``, n_words, n_hit, items (ids as text, sorted) and spans of every document.

    A word is hit if any occurrence of a window covers it; spans are runs of hit words as
    [start, end) code points of the original text.
    """
    narrow = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias(text))
    marked, (n_words, n_hit, found, spans) = _with_hits(
        narrow, items, text, item_key, item_text, window, shard_bytes
    )
    return marked.select(
        key,
        F.col(n_words).alias("n_words"),
        F.col(n_hit).alias("n_hit"),
        F.col(found).alias("items"),
        F.col(spans).alias("spans"),
    )


def is_contaminated(n_hit, n_words, one_in: int = 20):
    """At least one word hit, and at least one word in ``one_in``."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    one_in: int = 20,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs``, all columns, without the contaminated ones."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked, (n_words, n_hit, _, _) = _with_hits(
        docs, items, text, item_key, item_text, window, shard_bytes
    )
    clean = ~is_contaminated(F.col(n_hit), F.col(n_words), one_in)
    return marked.where(clean).select(columns)
