"""Sampled subword segmentations without replacement, by a perturbed best-first lattice search.

A text's lattice holds all ways to write it in vocabulary pieces. A piece's log-probability
follows its rank by Zipf's law, times ``alpha``; a segmentation's is the sum, normalised over the
lattice by a backward pass. Gumbel top-k: if every segmentation got its log-probability plus a
Gumbel variate, the k largest would be a sample of k distinct ones without replacement. The
search finds those k and never lists the others. A node of the search stands for a set of
segmentations (one prefix, some first steps excluded) and carries the set's largest perturbed
value, which is exact: it is Gumbel about the set's log-mass, cut off at the value of the set it
was split from. Popping the largest node samples the segmentation that attains it and splits what
is left of the set into one node per step. The inclusion score of a sample is the probability
that its perturbed value exceeds the next one not taken.

Variates are hashes of the row's key, the place in the text and the sample's number, so a row
gives the same samples in any partition. Distinct stretches of a batch share one lattice (no
piece crosses a space or a line end), and all rows of a batch take their steps together.

Decoding restores the text exactly: characters without a piece are written in byte pieces, also
the one that stands for a space in the vocabulary.

Defined cases: null and empty texts have one segmentation without pieces; a text with fewer than
``samples`` segmentations gives them all, with inclusion 1; rows that repeat a key give the same
samples; rows without key share one seed; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.8
SEED = 17
#: Characters whose lattices are held at once.
BATCH_CHARS = 1 << 19

_SPACE = 0x2581  # stands for a space in pieces
_NO_PIECE = 0x110000  # beyond all code points: a literal U+2581, which only bytes can write
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Characters of a stretch whose masses are far from the least number above 0.
_PLAIN_CHARS = 40
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_UNIT = re.compile(r" *[^ \n]+| +|\n")


def _mixed(x: np.ndarray) -> np.ndarray:
    """Uniform 64-bit hashes of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _counted(seeds: np.ndarray, part) -> np.ndarray:
    """The seeds that a counter makes of ``seeds``."""
    return _mixed(seeds + (np.asarray(part).astype(np.uint64) + np.uint64(1)) * _BASE)


def _uniform(seeds: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1), a function of the seed and the counters."""
    x = seeds
    for part in parts:
        x = _counted(x, part)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class _Table:
    """Sorted hashes with their ids, found by the buckets of their leading bits."""

    BITS = 18

    def __init__(self, entries: dict[int, int]):
        hashes = np.array(sorted(entries, key=self._spread_one), np.uint64)
        self.hashes = np.append(hashes, np.uint64(0))
        self.ids = np.array([*(entries[int(h)] for h in hashes), -2], np.int64)
        bucket = self._bucket(hashes)
        self.first = np.searchsorted(bucket, np.arange(1 << self.BITS)).astype(np.int32)
        self.most = int(np.bincount(bucket).max())

    @classmethod
    def _spread_one(cls, value: int) -> int:
        return value * int(_SPREAD) & (1 << 64) - 1

    @classmethod
    def _bucket(cls, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _SPREAD) >> np.uint64(64 - cls.BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids; -1 for what only begins a piece, -2 for what is in none."""
        at = self.first[self._bucket(hashes)]
        found = np.full(len(hashes), -2, np.int64)
        for step in range(self.most):
            place = np.minimum(at + step, len(self.hashes) - 1)
            hit = self.hashes[place] == hashes
            found[hit] = self.ids[place[hit]]
        return found


class Vocabulary:
    """Pieces and their beginnings by length, with log-probabilities and bytes."""

    def __init__(self, path: str, alpha: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        rank = np.array([-model.get_score(i) for i in range(size)])
        self.weight = alpha * -np.log((rank + 10) * np.log(size))
        self.byte_weight = float(self.weight.min())
        self.bytes: list[bytes] = []
        self.byte_ids = np.zeros(256, np.int64)
        prefixes: dict[int, dict[int, int]] = {}  # by length: hash to id, or -1 inside a piece
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                if re.search("[^▁]▁|\n", piece):
                    raise ValueError(f"piece {piece!r} crosses a space or a line end")
                self.bytes.append(piece.replace("▁", " ").encode())
                value = 0
                for length, c in enumerate(piece, 1):
                    value = (value * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
                    known = prefixes.setdefault(length, {})
                    known[value] = i if length == len(piece) else known.get(value, -1)
        self.byte_array = np.array(self.bytes, object)
        self.tables = [_Table(prefixes[length]) for length in range(1, len(prefixes) + 1)]

    def byte_pieces(self, codes: np.ndarray) -> np.ndarray:
        """Ids of characters of one byte; ~code point of the others."""
        return np.where(codes < 128, self.byte_ids[np.minimum(codes, 127)], ~codes)

    def spells(self, ids: np.ndarray, text: str) -> bool:
        """Whether decoding the ids gives ``text``."""
        return b"".join(self.byte_array[ids].tolist())[1:] == text.encode("utf-8", "surrogatepass")

    def decode(self, ids: list[int]) -> str:
        """The text that the ids were made from."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


_vocabularies: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _vocabularies:
        with np.errstate(over="ignore"):
            _vocabularies[path, alpha] = Vocabulary(path, alpha)
    return _vocabularies[path, alpha]


@dataclass
class Lattice:
    """Lattices of several stretches side by side.

    Nodes are numbered by the characters left in their stretch, the last node is all stretches'
    end; edges are in order of their source.
    """

    start: np.ndarray  # node of each stretch
    end: int
    first_edge: np.ndarray  # by node, one more at the end
    best: np.ndarray  # likeliest edge of each node
    target: np.ndarray
    piece: np.ndarray  # id, or ~code point where several bytes stand for a character
    prob: np.ndarray  # of the edge, given its source
    log_prob: np.ndarray
    cumulative: np.ndarray  # source plus the running sum of prob without the best edge


def _matches(codes: np.ndarray, left: np.ndarray, vocab: Vocabulary) -> Iterator[tuple]:
    """(length, places, pieces) of all pieces in the text, one place at most once per length."""
    at = np.arange(len(codes), dtype=left.dtype)
    value = np.zeros(len(codes), np.uint64)
    for length, table in enumerate(vocab.tables, 1):
        value = value * _BASE + codes[at + length - 1] + np.uint64(1)
        found = table.find(value)
        pieces = found
        if length == 1:  # a character without piece is written in bytes
            plain = np.where(codes == _NO_PIECE, np.uint64(_SPACE), codes).astype(np.int64)
            pieces = np.where(found >= 0, found, vocab.byte_pieces(plain))
            yield length, at, pieces
        else:
            hit = found >= 0
            yield length, at[hit], pieces[hit]
        keep = (found >= -1) & (left[at] > length)
        at, value = at[keep], value[keep]
        if not len(at):
            return


def _backward(
    weight: np.ndarray, target: np.ndarray, first_edge: np.ndarray, levels: np.ndarray
) -> np.ndarray:
    """Log-mass of all ways from each node to the end; ``levels``: nodes by characters left.

    Stretches of usual length are summed in plain numbers, longer ones in logarithms.
    """
    size = len(first_edge) - 1
    plain, mass = np.ones(size + 1), np.zeros(size + 1)
    factor = np.exp(weight)
    shallow = min(len(levels) - 1, _PLAIN_CHARS)
    for a, b in zip(levels[:shallow], levels[1 : shallow + 1], strict=True):
        if a < b:
            x, y = first_edge[a], first_edge[b]
            plain[a:b] = np.add.reduceat(factor[x:y] * plain[target[x:y]], first_edge[a:b] - x)
    done = levels[shallow]
    mass[:done] = np.log(plain[:done])
    for a, b in zip(levels[shallow:], levels[shallow + 1 :], strict=False):
        if a < b:
            x, y = first_edge[a], first_edge[b]
            total, begins = weight[x:y] + mass[target[x:y]], first_edge[a:b] - x
            top = np.maximum.reduceat(total, begins)
            spread = np.exp(total - np.repeat(top, np.diff(first_edge[a : b + 1])))
            mass[a:b] = top + np.log(np.add.reduceat(spread, begins))
    return mass


def build_lattice(units: list[str], vocab: Vocabulary) -> Lattice:
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = np.where(codes == _SPACE, np.uint64(_NO_PIECE), codes)
    codes = np.where(codes == 32, np.uint64(_SPACE), codes)
    size = len(codes)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    offsets = np.cumsum(sizes) - sizes
    # Half as wide where places and edges, of which a place has one per piece length, fit.
    place = np.int32 if size * len(vocab.tables) < 1 << 31 else np.int64
    left = np.repeat((offsets + sizes).astype(place), sizes) - np.arange(size, dtype=place)
    small = left.astype(np.uint16) if int(sizes.max()) < 1 << 16 else left
    order = np.argsort(small, kind="stable")
    node = np.empty(size + 1, place)
    node[order] = np.arange(size)
    levels = np.concatenate(([0], np.cumsum(np.bincount(left)[1:])))
    found = list(_matches(codes, left, vocab))
    counts = np.zeros(size, place)
    for _, at, _ in found:
        counts[at] += 1
    first_edge = np.concatenate(([0], np.cumsum(counts[order])))
    free = first_edge[node[:size]]
    target = np.empty(first_edge[-1], place)
    piece = np.empty(first_edge[-1], np.int32)
    for length, at, pieces in found:
        slot = free[at]
        free[at] += 1
        piece[slot] = pieces
        target[slot] = np.where(left[at] == length, size, node[at + length])
    weight = vocab.weight[np.maximum(piece, 0)]
    weight[piece < 0] = vocab.byte_weight
    mass = _backward(weight, target, first_edge, levels)
    edges, begins = np.diff(first_edge), first_edge[:-1]
    source = np.repeat(np.arange(size, dtype=place), edges)
    log_prob = np.minimum(weight + mass[target] - np.repeat(mass[:size], edges), 0.0)
    log_prob[begins[edges == 1]] = 0.0
    prob = np.exp(log_prob)
    top = np.flatnonzero(prob == np.repeat(np.maximum.reduceat(prob, begins), edges))
    best = np.empty(size, np.int64)
    best[source[top][::-1]] = top[::-1]  # the first of equals
    others = prob.copy()
    others[best] = 0.0
    running = np.cumsum(others)
    inside = running - np.repeat(running[begins] - others[begins], edges)
    cumulative = source + np.minimum(inside, 1.0)
    return Lattice(node[offsets], size, first_edge, best, target, piece, prob, log_prob, cumulative)


def _walk(lattice: Lattice, nodes: np.ndarray, seeds: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of random paths from ``nodes`` to their stretches' ends, and where each path begins."""
    moving = np.flatnonzero(nodes != lattice.end)
    at, levels = nodes[moving], []
    seeds = _counted(seeds, sample)
    counts = np.zeros(len(nodes) + 1, np.int64)
    while len(at):
        draw = _uniform(seeds[moving], len(levels))
        edge = lattice.best[at]
        likeliest = lattice.prob[edge]
        other = np.flatnonzero(draw >= likeliest)
        if len(other):
            from_other = at[other]
            found = np.searchsorted(lattice.cumulative, from_other + (draw[other] - likeliest[other]))
            low, high = lattice.first_edge[from_other], lattice.first_edge[from_other + 1] - 1
            edge[other] = np.minimum(np.maximum(found, low), high)
        levels.append((moving, edge))
        counts[moving + 1] += 1
        at = lattice.target[edge]
        going = np.flatnonzero(at != lattice.end)
        moving, at = moving[going], at[going]
    begins = np.cumsum(counts)
    path = np.zeros(begins[-1], np.int64)
    for level, (who, edge) in enumerate(levels):
        path[begins[who] + level] = edge
    return path, begins


@dataclass
class _Open:
    """A set of segmentations: a path's first ``step`` steps, then any edge not excluded."""

    value: float
    path: int
    step: int
    excluded: list[int]
    prefix: float


def _cut_gumbel(location, bound, draw):
    """Gumbel variates about ``location`` that do not exceed ``bound``."""
    return location - np.log(np.exp(location - bound) - np.log(draw))


class _Search:
    """The search of one text: its paths so far, as edges with the stretch of each, and open sets."""

    def __init__(self, lattice: Lattice, seed: int, samples: int):
        self.lattice, self.seed, self.samples = lattice, np.array([seed], np.uint64), samples
        self.paths: list[np.ndarray] = []
        self.units: list[np.ndarray] = []
        self.values: list[float] = []
        self.log_probs: list[float] = []
        self.open: list[_Open] = []

    def pop(self, draws: np.ndarray) -> tuple[_Open, int] | None:
        """The open set with the largest value, and the edge that attains it, by two uniform draws."""
        if not self.open:
            return None
        top = max(self.open, key=lambda x: x.value)
        self.open.remove(top)
        lattice, first = self.lattice, top.excluded[0]
        source = int(np.searchsorted(lattice.first_edge, first, "right")) - 1
        edges = np.arange(lattice.first_edge[source], lattice.first_edge[source + 1])
        free = np.ones(len(edges), bool)
        free[np.array(top.excluded) - edges[0]] = False
        edges = edges[free]
        chances = lattice.prob[edges]
        edge = int(edges[min(int(np.searchsorted(np.cumsum(chances), draws[0] * chances.sum())), len(edges) - 1)])
        others = float(chances.sum() - lattice.prob[edge])
        if len(edges) > 1 and others > 1e-300:
            location = top.prefix + np.log(others)
            value = float(_cut_gumbel(location, top.value, draws[1]))
            self.open.append(_Open(value, top.path, top.step, [*top.excluded, edge], top.prefix))
        return top, edge


def _add(
    searches: list[_Search],
    paths: list[np.ndarray],
    units: list[np.ndarray],
    values: np.ndarray,
    begins: np.ndarray,
) -> None:
    """Give each search a path with its perturbed value; split off what its steps from ``begins`` leave.

    All searches have the same number of paths so far.
    """
    lattice, samples, number = searches[0].lattice, searches[0].samples, len(searches[0].paths)
    prefixes = []
    for search, path, unit, value, begin in zip(searches, paths, units, values.tolist(), begins.tolist(), strict=True):
        logs = lattice.log_prob[path]
        sums = np.cumsum(logs)
        search.paths.append(path)
        search.units.append(unit)
        search.values.append(value)
        search.log_probs.append(float(sums[-1]))
        prefixes.append(sums[begin:] - logs[begin:])
    sizes = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
    ends = np.cumsum(sizes)
    prefix = np.concatenate(prefixes)
    left = np.concatenate([p[begin:] for p, begin in zip(paths, begins.tolist(), strict=True)])
    # The log-mass of the other edges at each step.
    location = prefix + np.log1p(-lattice.prob[left])
    steps = np.arange(len(left)) + np.repeat(begins - (ends - sizes), sizes)
    seeds = np.repeat(np.concatenate([search.seed for search in searches]), sizes)
    draws = _uniform(seeds, 1000 + number, steps)
    found = np.where(location > -np.inf, _cut_gumbel(location, np.repeat(values, sizes), draws), -np.inf)
    for search, a, b in zip(searches, (ends - sizes).tolist(), ends.tolist(), strict=True):
        mine = found[a:b]
        best = np.argpartition(mine, -samples)[-samples:].tolist() if b - a > samples else range(b - a)
        for n in best:
            if mine[n] > -np.inf:
                excluded = [int(left[a + n])]
                search.open.append(_Open(float(mine[n]), number, int(steps[a + n]), excluded, float(prefix[a + n])))


def _ids(lattice: Lattice, path: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    pieces = lattice.piece[path]
    if (pieces >= 0).all():
        return pieces.astype(np.int32)
    out: list[int] = []
    for piece in pieces.tolist():
        if piece >= 0:
            out.append(piece)
        else:
            out += vocab.byte_ids[list(chr(~piece).encode("utf-8", "surrogatepass"))].tolist()
    return np.array(out, np.int32)


def sample_texts(texts: list[str], seeds: np.ndarray, vocab: Vocabulary, samples: int) -> list[list[tuple]]:
    """For each text up to ``samples`` of (ids, log_prob, perturbed, inclusion), largest first."""
    cut = [_UNIT.findall(" " + t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    if not sizes.any():
        return [[(np.zeros(0, np.int32), 0.0, 0.0, 1.0)] for _ in texts]
    every = np.empty(int(sizes.sum()), object)
    every[:] = list(chain.from_iterable(cut))
    units, distinct = pd.factorize(every)
    with np.errstate(over="ignore", divide="ignore"):
        lattice = build_lattice(distinct.tolist(), vocab)
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(units)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        unit_seeds = _mixed(seeds[doc] + place.astype(np.uint64) * _BASE)
        starts = lattice.start[units]
        path, begins = _walk(lattice, starts, unit_seeds, 0)
        ends = np.cumsum(sizes)
        step_unit = np.repeat(np.arange(len(units)), np.diff(begins))
        searches = [_Search(lattice, int(seed), samples) for seed in seeds]
        some = np.flatnonzero(sizes)
        spans = list(zip(begins[(ends - sizes)[some]].tolist(), begins[ends[some]].tolist(), strict=True))
        _add(
            [searches[n] for n in some],
            [path[a:b] for a, b in spans],
            [step_unit[a:b] for a, b in spans],
            -np.log(-np.log(_uniform(seeds[some], 999, 0))),
            np.zeros(len(some), np.int64),
        )
        for number in range(1, samples):
            # Two draws for each text; all that go on have as many paths.
            draws = _uniform(seeds[:, None], 2000 + number, np.arange(2))
            popped = [(n, found) for n, s in enumerate(searches) if sizes[n] and (found := s.pop(draws[n]))]
            if not popped:
                break
            # The stretches to walk: what is left of the branching one, then all later ones.
            whole, heads = [], []
            for n, (top, edge) in popped:
                unit = int(searches[n].units[top.path][top.step])
                whole.append(np.arange(unit, ends[n]))
                heads.append(int(lattice.target[edge]))
            who = np.concatenate(whole)
            nodes = starts[who]
            lead = np.cumsum([0, *(len(w) for w in whole[:-1])])
            nodes[lead] = heads
            walked, marks = _walk(lattice, nodes, unit_seeds[who], number)
            walked_unit = np.repeat(who, np.diff(marks))
            bounds = marks[np.append(lead, len(who))]
            paths, path_units = [], []
            for (n, (top, edge)), a, b in zip(popped, bounds, bounds[1:], strict=False):
                old, old_units = searches[n].paths[top.path], searches[n].units[top.path]
                paths.append(np.concatenate((old[: top.step], [edge], walked[a:b])))
                path_units.append(np.concatenate((old_units[: top.step + 1], walked_unit[a:b])))
            values = np.array([top.value for _, (top, _) in popped])
            _add([searches[n] for n, _ in popped], paths, path_units, values, np.array([top.step + 1 for _, (top, _) in popped]))
    out = []
    for search in searches:
        bar = max((x.value for x in search.open), default=-np.inf)
        rows = [
            (_ids(lattice, p, vocab), log_prob, value, float(-np.expm1(-np.exp(min(log_prob - bar, 50.0)))))
            for p, log_prob, value in zip(search.paths, search.log_probs, search.values, strict=True)
        ]
        out.append(rows or [(np.zeros(0, np.int32), 0.0, 0.0, 1.0)])
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_CHARS`` bytes of text; the text is the last column."""
    lengths = pa.compute.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(False)
    begin, held = 0, 0
    for n, size in enumerate(lengths.tolist()):
        if held and held + size > BATCH_CHARS:
            yield batch.slice(begin, n - begin)
            begin, held = n, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def sample_pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    alpha: float = ALPHA,
    model: str = MODEL,
    seed: int = SEED,
) -> DataFrame:
    """``key``, sample (0 is the largest), ids, log_prob, perturbed, inclusion and round_trip.

    Up to ``samples`` distinct segmentations of every text. round_trip: decoding the ids gives
    the text back.
    """
    narrow = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).alias("seed"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField(key, narrow.schema["key"].dataType),
            *T.StructType.fromDDL(
                "sample int, ids array<int>, log_prob double, perturbed double, inclusion double, "
                "round_trip boolean"
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, alpha)
        for batch in batches:
            for part in _slices(batch):
                keys, texts = part.column(0).to_pylist(), part.column(2).to_pylist()
                seeds = part.column(1).to_numpy(False).astype(np.int64).view(np.uint64)
                rows = [
                    (k, n, ids, log_prob, value, inclusion, vocab.spells(ids, t))
                    for k, t, found in zip(keys, texts, sample_texts(texts, seeds, vocab, samples), strict=True)
                    for n, (ids, log_prob, value, inclusion) in enumerate(found)
                ]
                columns = list(zip(*rows, strict=True))
                ids = columns[2]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                arrays = [
                    pa.array(columns[0], batch.schema.field(0).type),
                    pa.array(columns[1], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                    *[pa.array(c, pa.float64()) for c in columns[3:6]],
                    pa.array(columns[6], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        give_back()

    return narrow.mapInArrow(run, schema)


def decode_pieces(
    encoded: DataFrame, ids: str = "ids", text: str = "text", model: str = MODEL
) -> DataFrame:
    """``encoded`` with the text that each row's ids stand for, in place of such a column."""
    encoded = encoded.drop(text) if text.lower() != ids.lower() else encoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, 1.0)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([None if x is None else vocab.decode(x) for x in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))
