"""Token ids of documents, packed into rows of one length.

Each text becomes byte-pair token ids and an end id. Documents longer than a row are cut into
pieces, without loss; pieces are packed best-fit-decreasing: longest first, each into the row
with the least room that still holds it, found by a segment tree over the rooms that rows have
left. A packed row carries its ids as bytes (little endian, padded), the cumulative lengths of
its segments, the offsets at which positions start again at 0, and for each segment the
document, the piece's number and its offset in the document.

Packing works on blocks of about ``block_tokens`` tokens inside each partition: no shuffle, and
memory bounded by the block. A row's key (partition, block, row) is unique.

Defined cases: null and empty texts are their end id; repeated documents are packed as often as
they appear; documents of any length are cut; equal lengths keep their order; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_ROWS

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value that goes with the vocabulary: the stretches of a text that are merged on their own.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END_ID = 50256
ROW_TOKENS = 2048
BLOCK_TOKENS = 1 << 19

SCHEMA = (
    "partition int, block int, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, {key} array<{kind}>, pieces array<int>, offsets array<int>"
)

_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(vocabulary: str) -> tiktoken.Encoding:
    if vocabulary not in _encoders:
        lines = Path(vocabulary).read_bytes().splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[vocabulary] = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encoders[vocabulary]


class Rooms:
    """Segment tree over 0..largest: which rooms some row has left, smallest fitting first."""

    def __init__(self, largest: int):
        self.leaves = 1 << largest.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(largest + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``need``, and that room."""
        node = need + self.leaves
        while not self.some[node]:
            while node & 1:  # no right sibling: the search goes on above
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            while node and (node >= self.leaves or not (self.some[2 * node] or self.some[2 * node + 1])):
                self.some[node] = 0
                node >>= 1
        return row, room


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; every piece is in one row and no row exceeds ``size``."""
    rooms, rows = Rooms(size), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[piece])
        row, room = found or (len(rows), size)
        if found is None:
            rows.append([])
        rows[row].append(piece)
        rooms.put(room - lengths[piece], row)
    return rows


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    row_tokens: int = ROW_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """Packed rows; see the module's text for their columns."""
    narrow = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType.fromDDL(
        SCHEMA.format(key=f"`{key}s`", kind=narrow.schema[key].dataType.simpleString())
    )
    kind = "<u2" if end_id < 1 << 16 else "<u4"

    def packed(block: list, number: int, partition: int) -> pa.RecordBatch:
        pieces = [
            (doc, n, at, ids[at : at + row_tokens])
            for doc, ids in block
            for n, at in enumerate(range(0, len(ids), row_tokens))
        ]
        rows = best_fit([len(p[3]) for p in pieces], row_tokens)
        out: list[tuple] = []
        for row, members in enumerate(rows):
            own = [pieces[i] for i in members]
            ends = np.cumsum([0, *(len(p[3]) for p in own)])
            matrix = np.full(row_tokens, end_id, kind)
            matrix[: ends[-1]] = np.concatenate([p[3] for p in own])
            docs_, numbers, offsets, _ = zip(*own, strict=True)
            out.append(
                (partition, number, row, int(ends[-1]), matrix.tobytes(), ends.tolist(),
                 ends[:-1].tolist(), docs_, numbers, offsets)
            )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        codec = encoder(vocabulary)
        block, held, number, arrow = [], 0, 0, None

        def batch_of(block: list, number: int) -> pa.RecordBatch:
            rows = packed(block, number, partition)
            columns = [
                pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            kinds = pa.list_(batch.schema.field(0).type)
            ints = pa.list_(pa.int32())
            arrow = [pa.int32()] * 4 + [pa.binary(), ints, ints, kinds, ints, ints]
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                for doc, body in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ids = np.array([*codec.encode_ordinary(body or ""), end_id], kind)
                    block.append((doc, ids))
                    held += len(ids)
                    if held >= block_tokens:
                        yield batch_of(block, number)
                        block, held, number = [], 0, number + 1
        if block:
            yield batch_of(block, number)

    return narrow.mapInArrow(run, schema)


def unpack(packed: DataFrame, key: str = "doc_id", wide: bool = False) -> DataFrame:
    """``key``, piece, offset and ids of every packed segment."""
    kind = "<u4" if wide else "<u2"
    element = packed.schema[f"{key}s"].dataType.elementType
    schema = T.StructType(
        [T.StructField(key, element), *T.StructType.fromDDL("piece int, offset int, ids array<int>")]
    )
    narrow = packed.select(f"{key}s", "pieces", "offsets", "cu_seqlens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for docs, pieces, offsets, ends, ids in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                row = np.frombuffer(ids, kind).astype(np.int32)
                cuts = [row[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                rows += zip(docs, pieces, offsets, cuts, strict=True)
            kinds = (batch.schema.field(0).type.value_type, pa.int32(), pa.int32(), pa.list_(pa.int32()))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return narrow.mapInArrow(run, schema)
