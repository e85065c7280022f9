"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document's set is its distinct ``shingle``-word shingles (A-Z lower-cased); documents whose
sets have a Jaccard similarity of at least ``percent`` per cent are linked, and each linked
component keeps its smallest id.

Documents with one set become one class, whose smallest id stands for it. Every class has a
signature of minwise tokens. A tree branches classes recursively by the tokens chosen for it:
classes that agree in the first tokens share a node, a node of more than ``leaf`` classes
branches on by its next token, and the classes of a small node are all compared. A pair of
similarity s stays together down to depth d with probability s^d, so ``trees`` trees that share no
token part it everywhere with (1 - s^d)^trees. Trees end where that would exceed ``MISS`` for the
wanted similarity (:func:`tree_plan`): at depth 4 with 16 trees, 7e-6 for s = 0.85, 2e-4 for s = 0.8.
Deeper nodes are not needed, as what is large there is compared exactly, see below. A node
that is large also pairs each of its classes with its smallest one; where a tree begins its
classes are compared in blocks of half a leaf's size as well, cut by a hash that differs from tree
to tree. These links come cheap but are not all: the classes of nodes that are large where a tree
ends are then joined by the rarest ids of their sets, which similar sets must share, and compared
exactly; classes that hold even their rarest ids in common with many others are compared in pairs
of blocks that are a group each, every pair that is not connected yet (:func:`_rest_links`).

A leaf is first cut, by signatures and sizes, into groups outside of which no pair is possible.
Groups of all trees that share classes become one cluster, or stay apart if that would exceed
``leaf`` classes. Their classes arrive with their full sets, and possible pairs are compared exactly,
most alike first, and only while they are not connected, so a group gives less links than it has
classes. All other steps are joins and groupings of narrow rows; hot classes and nodes are counted before they are
joined.

Defined cases: null texts and texts without words are linked with nothing; texts of fewer words
than a shingle are one shingle; very long texts are cut into shingles whole, one at a time; of equal
sets the smallest id stands for all; rows without id are reported with themselves alone; ids that are no
whole numbers raise; rows that repeat an id are one document and should have one text; extra columns are ignored by :func:`near_duplicates` and passed
through by :func:`drop_near_duplicates`; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staging
from .common import ASCII_LOWER, byte_texts, give_back, is_small, matching, sized_for, with_columns_by
from .components import components

TOKENS = 64
TREES = 16
FIRST = 2
DEPTH = 12
LEAF = 512
#: Bytes of the largest shuffle, in bytes of text.
SHUFFLED = 2
#: Classes, and bytes of their sets, in a block of the exact comparison; a group is two blocks.
BLOCK = 1024
BLOCK_BYTES = 16 << 20
#: Holders of an id up to which all of them are paired by it; and buckets by which ids are ordered.
COMMON = 100
BUCKETS = 1 << 18
#: Greatest probability with which the trees may part a pair of exactly the wanted similarity.
MISS = 1e-3
#: Tokens of 64 that a proposed pair shares: five standard deviations under what 0.85 gives.
_MARGIN = 5.0

_U = np.uint64
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.random.default_rng(11).integers(0, 1 << 63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)
MOST_TREES = 256
#: Below this similarity independent trees cannot keep to MISS with the tokens there are.
LEAST_PERCENT = 45


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit ids of the text's shingles."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(one) - shingle + 1
    ids = np.zeros(n, np.uint64)
    for k in range(shingle):
        ids = (ids ^ one[k : k + n]) * _MIX
        ids ^= ids >> np.uint64(29)
    return np.unique(ids)


def minwise(ids: np.ndarray) -> np.ndarray:
    """The least of the set under each of the salted orders, as 32-bit tokens."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(ids), 2048):
        np.minimum(least, (ids[None, at : at + 2048] * _SALTS[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _sketches(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """key, n_shingles, digest of the set and signature of every document."""
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        sets = [shingle_set(x, shingle) for x in byte_texts(batch, "text")]
        return [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([minwise(s).tobytes() if len(s) else None for s in sets], pa.binary()),
        ]

    fields = T.StructType.fromDDL("n_shingles bigint, digest binary, tokens binary").fields
    return with_columns_by(narrow, list(fields), compute).drop("text")


def _token(tokens: Column, place: Column) -> Column:
    return F.substr(tokens, 4 * place + 1, F.lit(4))


def tree_plan(percent: int, trees: int, depth: int) -> tuple[int, int]:
    """Number of trees, and the greatest depth up to ``depth``, that keep to ``MISS``.

    Trees that share no token are independent, so depth times trees is bounded by the tokens. If
    no depth will do, trees are added.
    """
    s = percent / 100
    for d in range(depth, FIRST, -1):
        if d * trees <= TOKENS and (1 - s**d) ** trees <= MISS:
            return trees, d
    while trees < MOST_TREES and (1 - s**FIRST) ** trees > MISS:
        trees += 1
    return trees, FIRST


def _path(tree: int, depth: int) -> list[int]:
    """The tokens that a tree branches by."""
    return [(tree * depth + level) % TOKENS for level in range(depth)]


def _branch(rows: DataFrame, level: int, trees: int, depth: int) -> DataFrame:
    """``node`` of every row moved to the child that its tree's next token names."""
    chosen = F.array(*[F.lit(_path(t, depth)[level]) for t in range(trees)])
    child = F.xxhash64("node", _token(F.col("tokens"), F.get(chosen, F.col("tree"))))
    return rows.withColumn("node", child)


def _with_sizes(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold two classes or more, with the node's size, smallest class and a mark of all."""
    mark = F.sum(F.xxhash64("rep") % (1 << 48))
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("pivot"), mark.alias("mark"))
    return rows.join(sizes.where("size > 1"), "node")


def _leaves(
    classes: DataFrame, staging: Staging, trees: int, depth: int, leaf: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows (node, rep) of all leaves, the pairs (a, b) of large nodes' stars, and the last level's large nodes.

    Leaves of the same classes, in whatever trees, are one: they are named by what they hold. The
    last are stars (a, b) too: who shares a large node at the last level hangs on one a.
    """
    roots = F.array(
        *[
            F.struct(
                F.lit(t).alias("tree"),
                F.xxhash64(F.lit(t), *[_token(F.col("tokens"), F.lit(c)) for c in _path(t, depth)[:FIRST]]).alias("node"),
            )
            for t in range(trees)
        ]
    )
    rows = classes.select("rep", F.explode(roots).alias("root")).select("rep", "root.tree", "root.node")
    found, stars, rest = [], [], None
    for level in range(FIRST, depth + 1):
        sized = staging.write(_with_sizes(rows), f"level-{level}")
        found.append(sized.where(F.col("size") <= leaf).select(F.xxhash64("size", "mark").alias("node"), "rep"))
        large = sized.where(F.col("size") > leaf)
        if large.isEmpty():
            break
        stars.append(large.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")))
        if level == depth:
            rest = stars[-1]
        if level == FIRST:
            block = F.pmod(F.xxhash64("rep", "tree"), F.ceil(2 * F.col("size") / leaf))
            found.append(large.select(F.xxhash64("node", block).alias("node"), "rep"))
        columns = ("tree", "node", "rep")
        if level == FIRST:
            large = large.select(*columns).join(classes.select("rep", "tokens"), "rep")
        else:
            large = large.select(*columns, "tokens")
        if level < depth:
            rows = _branch(large, level, trees, depth)
    leaves = reduce(DataFrame.union, found).distinct()
    return leaves, reduce(DataFrame.union, stars).distinct() if stars else None, rest


def _agreeing(percent: int) -> int:
    """Shared tokens below which a pair of the wanted similarity is out of reach."""
    s = percent / 100
    return int(TOKENS * s - _MARGIN * np.sqrt(TOKENS * s * (1 - s)))


class _Joined:
    """Which members are connected so far."""

    def __init__(self, size: int):
        self.root = list(range(size))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def join(self, a: int, b: int) -> None:
        self.root[self.find(b)] = self.find(a)


def _possible(tokens: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int, int]]:
    """(shared tokens, i, j) of the pairs that signatures and sizes do not rule out."""
    least = _agreeing(percent)
    for i in range(len(sizes) - 1):
        alike = (tokens[i + 1 :] == tokens[i]).sum(1)
        low, high = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
        for j in np.flatnonzero((alike >= least) & (100 * low >= percent * high)).tolist():
            yield int(alike[j]), i, i + 1 + j


def compare_leaf(reps: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the classes of a leaf as all their links would."""
    sizes, tokens = np.array([len(x) for x in sets]), np.stack([np.frombuffer(minwise(x), "<u4") for x in sets])
    joined, links = _Joined(len(reps)), []
    for _, i, j in sorted(_possible(tokens, sizes, percent), key=lambda x: (-x[0], x[1], x[2])):
        if joined.find(i) != joined.find(j) and _similar(sets[i], sets[j], percent):
            joined.join(i, j)
            links.append((reps[i], reps[j]))
    return links


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    if len(left) > len(right):
        left, right = right, left
    place = np.minimum(np.searchsorted(right, left), len(right) - 1)
    shared = int((right[place] == left).sum())
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def _by_leaf(leaves: DataFrame, columns: list[str], found, schema: str) -> DataFrame:
    """What ``found`` makes of each leaf's rows of ``columns``; one leaf is held at a time."""
    kinds = [pa.int64() for _ in schema.split(",")]
    names = [part.split()[0] for part in schema.split(",")]

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        node, members = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                values = (c.to_pylist() for c in batch.slice(at, 1024).columns)
                for own, *row in zip(*values, strict=True):
                    if own != node:
                        yield found(node, sorted(members)) if len(members) > 1 else []
                        node, members = own, []
                    members.append(tuple(row))
        yield found(node, sorted(members)) if len(members) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in results(batches):
            if rows:
                arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        give_back()

    dealt = leaves.select("node", *columns).repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(run, schema)


def _groups(leaves: DataFrame, percent: int) -> DataFrame:
    """Leaf rows (node, rep, tokens, n) cut into groups (node, rep, hub) that no possible pair leaves.

    A group is named by its classes, and its hub is one of them.
    """

    def found(_: int, members: list[tuple]) -> list[tuple[int, int, int]]:
        reps, tokens, sizes = zip(*members, strict=True)
        matrix = np.stack([np.frombuffer(t, "<u4") for t in tokens])
        joined = _Joined(len(reps))
        for _, i, j in _possible(matrix, np.array(sizes), percent):
            joined.join(i, j)
        groups: dict[int, list[int]] = {}
        for i, rep in enumerate(reps):
            groups.setdefault(joined.find(i), []).append(rep)
        names = {root: xxhash.xxh64_intdigest(np.array(x, np.int64).tobytes()) - (1 << 63) for root, x in groups.items()}
        return [(names[root], rep, x[0]) for root, x in groups.items() if len(x) > 1 for rep in x]

    return _by_leaf(leaves, ["rep", "tokens", "n"], found, "node bigint, rep bigint, hub bigint")


def _compare_leaves(leaves: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in leaves of (node, rep, ids) rows."""

    def found(_: int, members: list[tuple]) -> list[tuple[int, int]]:
        reps, sets = zip(*members, strict=True)
        return compare_leaf(list(reps), [np.frombuffer(s, _U) for s in sets], percent)

    return _by_leaf(leaves, ["rep", "ids"], found, "a bigint, b bigint")


def _clusters(groups: DataFrame, staging: Staging, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Groups that share classes as one, so that each set travels once, unless that is too large; and all classes."""
    member = components(groups.select(F.col("rep").alias("a"), F.col("hub").alias("b")), staging, "clusters")
    member = member.withColumnsRenamed({"node": "rep", "component": "cluster"})
    sizes = member.groupBy("cluster").agg(F.count("*").alias("size"))
    large = staging.write(sizes.where(F.col("size") > leaf).select("cluster"), "large-clusters")
    whole = member.select(F.col("cluster").alias("node"), "rep")
    if large.isEmpty():
        return whole, member.select("rep")
    large = matching(member, large, "cluster", "left_semi").select("rep")
    apart = matching(groups, large, "rep", "left_semi").select("node", "rep").distinct()
    whole = matching(member, large, "rep", "left_anti").select(F.col("cluster").alias("node"), "rep")
    return staging.write(whole.union(apart), "spots"), member.select("rep")


def _block_pairs(members: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """(node, block, rep, component) of the groups that hold every unconnected pair of a cluster.

    ``members`` has cluster, rep, component and n. The classes of a cluster's largest component
    meet all others of the cluster but not each other.
    """
    parts = members.groupBy("cluster", "component").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    wholes = parts.groupBy("cluster").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.max(F.struct("size", "component", "n")).alias("most"),
        F.sum("size").alias("size"),
        F.sum("n").alias("n"),
    )
    blocks = lambda size, n: F.greatest(F.ceil(size / block), F.ceil(8 * n / block_bytes), F.lit(1))
    wholes = wholes.where(F.col("size") > F.col("most.size")).select(
        "cluster",
        "main",
        blocks(F.col("most.size"), F.col("most.n")).alias("mains"),
        blocks(F.col("size") - F.col("most.size"), F.col("n") - F.col("most.n")).alias("others"),
    )
    is_main = F.col("component") == F.col("main")
    place = F.when(is_main, F.col("others") + F.pmod(F.xxhash64("rep"), "mains")).otherwise(
        F.pmod(F.xxhash64("rep"), "others")
    )
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    spread = members.join(wholes, "cluster").withColumn("block", place)
    spread = spread.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("partner"))
    node = F.xxhash64("cluster", F.least("block", "partner"), F.greatest("block", "partner"))
    return spread.select(node.alias("node"), "block", "rep", "component")


def compare_blocks(
    blocks: list[int], reps: list[int], roots: list[int], sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links between classes of two blocks, or inside one, whose ``roots`` are not connected yet.

    All pairs of fitting sizes are counted on full sets; nothing is left to signatures.
    """
    number = {root: n for n, root in enumerate(dict.fromkeys(roots))}
    own, joined, links = [number[root] for root in roots], _Joined(len(number)), []
    sizes = np.array([len(x) for x in sets])
    first = min(blocks)
    left = [n for n, b in enumerate(blocks) if b == first]
    right = [n for n, b in enumerate(blocks) if b != first] or left
    right = np.array(sorted(right, key=lambda n: sizes[n]))
    vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    held, ends = np.concatenate([codes[n] for n in right]), np.cumsum(sizes[right])
    starts = ends - sizes[right]
    marked = np.zeros(len(vocabulary), np.uint8)
    for i in left:
        low = np.searchsorted(100 * sizes[right], percent * sizes[i])
        high = np.searchsorted(percent * sizes[right], 100 * sizes[i], "right")
        if low >= high:
            continue
        marked[codes[i]] = 1
        at = starts[low]
        shared = np.add.reduceat(marked[held[at : ends[high - 1]]], starts[low:high] - at, dtype=np.int64)
        marked[codes[i]] = 0
        alike = 100 * shared >= percent * (sizes[i] + sizes[right[low:high]] - shared)
        for j in right[low:high][alike].tolist():
            if joined.find(own[i]) != joined.find(own[j]):
                joined.join(own[i], own[j])
                links.append((reps[i], reps[j]))
    return links


def prefix_of(ids: np.ndarray, spread: np.ndarray, percent: int) -> np.ndarray:
    """The rarest ids of a set, one more than a set as similar as wanted can lack.

    Sets of ``percent`` per cent similarity share at least that part of either, so they share an id
    of both their prefixes, whatever order of ids the prefixes are taken by, as long as it is one
    for all: here by how often an id's bucket occurs, then by id.
    """
    size = len(ids) - -(-percent * len(ids) // 100) + 1
    order = np.lexsort((ids, spread[(ids % _U(BUCKETS)).astype(np.int64)]))
    return ids[order[:size]]


def _bucket_counts(sets: DataFrame) -> np.ndarray:
    """How often ids of each bucket occur in stored sets: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for ids in batch["ids"].to_pylist():
                counts += np.bincount((np.frombuffer(ids, _U) % _U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    counts = np.zeros(BUCKETS, np.int64)
    summed = sets.select("ids").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n"))
    for at, n in summed.collect():
        counts[at] = n
    return counts


def _prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cluster, id, rep, component, n): the ids that similar classes of a cluster must share."""
    sent = sets.sparkSession.sparkContext.broadcast(_bucket_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [prefix_of(np.frombuffer(x, _U), sent.value, percent) for x in part["ids"].to_pylist()]
                places = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
                rows = part.take(pa.array(places))
                ids = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows["cluster"], pa.array(ids), rows["rep"], rows["component"], rows["n"]],
                    names=["cluster", "id", "rep", "component", "n"],
                )

    both = members.join(sets, "rep").select("cluster", "rep", "component", "n", "ids")
    return both.mapInArrow(run, "cluster bigint, id bigint, rep bigint, component bigint, n bigint")


def _rest_links(
    rest: DataFrame,
    joined: DataFrame,
    classes: DataFrame,
    sets: DataFrame,
    percent: int,
    staging: Staging,
    block: int,
    block_bytes: int,
    common: int = COMMON,
) -> DataFrame:
    """Links (a, b) that ``joined`` lacks between classes that share nodes of ``rest``, compared exactly.

    ``sets`` are the stored full sets of these classes, and maybe others.
    Similar classes share one of the rarest ids of their sets (:func:`prefix_of`). Classes that
    share one held by at most ``common`` of them are joined by it and confirmed. Where more hold an
    id even among the rarest, as in pages that are alike nearly as much as wanted, the cluster's
    holders of such ids are compared in blocks, every pair that is not connected yet.
    """
    cluster = components(rest, staging, "rest").withColumnsRenamed({"node": "rep", "component": "cluster"})
    members = (
        cluster.join(joined, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .join(classes.select("rep", "n"), "rep")
    )
    members = staging.write(members.select("cluster", "rep", "component", "n"), "rest-classes")
    prefixes = staging.write(_prefixes(members, sets, percent), "rest-prefixes")
    held = prefixes.groupBy("cluster", "id").agg(F.count("*").alias("holders"))
    held = staging.write(held.where("holders > 1"), "rest-held")

    shared = held.where(F.col("holders") <= common).select("cluster", "id")
    few = staging.write(matching(prefixes, shared, ["cluster", "id"], "left_semi"), "rest-few")
    left, right = few.alias("x"), few.alias("y")
    fits = (
        (F.col("x.cluster") == F.col("y.cluster"))
        & (F.col("x.id") == F.col("y.id"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
    )
    pairs = left.join(right, fits).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    links = staging.write(_confirm(staging.write(pairs, "rest-pairs"), sets, percent), "rest-few-links")

    many = held.where(F.col("holders") > common).select("cluster", "id")
    if many.isEmpty():
        return links
    holders = matching(prefixes, many, ["cluster", "id"], "left_semi").select("rep").distinct()
    members = staging.write(matching(members, holders, "rep", "left_semi"), "rest-many")
    spots = staging.write(_block_pairs(members, block, block_bytes), "rest-blocks")

    def found(_: int, members: list[tuple]) -> list[tuple[int, int]]:
        blocks, reps, roots, sets = zip(*members, strict=True)
        return compare_blocks(list(blocks), list(reps), list(roots), [np.frombuffer(s, _U) for s in sets], percent)

    rows = spots.join(sets, "rep")
    more = _by_leaf(rows, ["block", "rep", "component", "ids"], found, "a bigint, b bigint")
    return staging.write(links.union(more), "rest-links")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def similar(batch: pa.RecordBatch) -> list[pa.Array]:
        both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        return [pa.array([_similar(np.frombuffer(a, _U), np.frombuffer(b, _U), percent) for a, b in both], pa.bool_())]

    left = sets.select(F.col("rep").alias("a"), F.col("ids").alias("ids_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("ids").alias("ids_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ids_a", "ids_b")
    judged = with_columns_by(both, [T.StructField("similar", T.BooleanType())], similar)
    return judged.where("similar").select("a", "b")


def _sets(docs: DataFrame, reps: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(rep, ids): the full sets of the classes in ``reps``."""
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("rep"), F.col(f"`{text}`").cast("string").alias("text"))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([shingle_set(x, shingle).tobytes() for x in byte_texts(batch, "text")], pa.binary())]

    chosen = matching(narrow, reps, "rep", "left_semi")
    sets = with_columns_by(chosen, [T.StructField("ids", T.BinaryType())], compute)
    return sets.select("rep", "ids").dropDuplicates(["rep"])


def _links(
    classes: DataFrame,
    docs: DataFrame,
    key: str,
    text: str,
    shingle: int,
    percent: int,
    staging: Staging,
    trees: int,
    depth: int,
    leaf: int,
) -> DataFrame:
    """Component of every class that is linked to another."""
    trees, depth = tree_plan(percent, trees, depth)
    spots, stars, rest = _leaves(classes, staging, trees, depth, leaf)
    starred = None
    if stars is not None:
        stars = staging.write(stars, "stars")
        used = staging.write(stars.select("a").union(stars.select("b")).toDF("rep").distinct(), "star-classes")
        sets = staging.write(_sets(docs, used, key, text, shingle), "star-sets")
        starred = staging.write(_confirm(stars, sets, percent), "star-links")
    signed = spots.join(classes.select("rep", "tokens", "n"), "rep")
    spots, used = _clusters(staging.write(_groups(signed, percent), "groups"), staging, leaf)
    # Not stored: the sets' one shuffle serves both their de-duplication and this join.
    links = _compare_leaves(spots.join(_sets(docs, used, key, text, shingle), "rep"), percent)
    if starred is not None:
        links = links.union(starred)
    links = staging.write(links, "links")
    joined = components(links, staging, "components").withColumnsRenamed({"node": "rep"})
    if rest is None:
        return joined
    more = _rest_links(rest, joined, classes, sets, percent, staging, BLOCK, BLOCK_BYTES)
    if more.isEmpty():
        return joined
    links = links.select("a", "b").union(more)
    return components(links, staging, "all-components").withColumnsRenamed({"node": "rep"})


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    trees: int = TREES,
    depth: int = DEPTH,
    leaf: int = LEAF,
) -> DataFrame:
    """``key``, n_shingles, component_id (smallest id reachable) and kept of every document."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be {LEAST_PERCENT} to 100: below, trees would share tokens")
    docs = sized_for(docs, text, SHUFFLED)
    staging = Staging(docs.sparkSession, until_exit=True)
    sketches = _sketches(docs.withColumn(key, F.col(f"`{key}`").cast("long")), key, text, shingle)
    sketches = staging.write(sketches, "sketches")
    linkable = sketches.where(F.col("digest").isNotNull() & F.col("key").isNotNull())
    classes = linkable.groupBy("digest").agg(
        F.min("key").alias("rep"),
        F.max("key").alias("last"),
        F.any_value("n_shingles").alias("n"),
        F.any_value("tokens").alias("tokens"),
    )
    classes = staging.write(classes, "classes")
    joined = _links(classes, docs, key, text, shingle, percent, staging, trees, depth, leaf)
    # Classes of one document that are linked with nothing need no join back.
    marks = (
        classes.join(joined, "rep", "left")
        .withColumn("component_id", F.coalesce("component", "rep"))
        .where("last <> component_id")
        .select("digest", "component_id")
    )
    if is_small(marks, 48):
        marks = F.broadcast(marks)
    found = sketches.join(marks, "digest", "left").withColumn("component_id", F.coalesce("component_id", "key"))
    return found.select(
        F.col("key").alias(key),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    originals: DataFrame | None = None,
    **options,
) -> DataFrame:
    """``docs``, all columns, with one document of each group of near-duplicates: the smallest id.

    ``originals`` holds, under the same names, the texts to compare by instead: those the documents
    had before something was cut from them. Only the documents in ``docs`` take part.
    """
    staging = Staging(docs.sparkSession, until_exit=True)
    compared = docs
    if originals is not None:
        names = staging.write(docs.select(key).distinct(), "names")
        compared = matching(originals.select(key, text), names, key, "left_semi")
    dropped = near_duplicates(compared, key, text, **options).where("not kept").select(key).distinct()
    dropped = staging.write(dropped, "dropped")
    return matching(docs, dropped, key, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
