"""Vector codes, hard negatives and toxicity against brute force and held-out labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxpipe.llm import ball_codes, hard_negatives, toxic_votes
from wxpipe.llm.ball_codes import assign, build_tree, encode, place_anchors
from wxpipe.llm.hard_negatives import build_index, search
from wxpipe.llm.hard_negatives import hard_negatives as mine
from wxpipe.llm.label_model import fit_label_model
from wxpipe.llm.toxic_votes import VOTERS, fit_toxicity, is_unlearned, with_toxicity

SCHEMA = "vec_id long, embedding array<float>, label int, code string, anchor int, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "clash", 1, 2) for i, v, y in rows], SCHEMA)


def corpus(n, dims, seed, labels=3, copies=0.3):
    """Vectors in loose clusters; a third of them copies of a few, some with ties in score."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, dims))
    rows = []
    for i in range(n):
        base = centres[rng.integers(5)] + rng.normal(0, 0.4, dims)
        if i > 10 and rng.random() < copies:
            base = np.array(rows[rng.integers(3)][1])
        rows.append((int(i), [float(np.float32(x)) for x in base], int(rng.integers(labels))))
    return rows


ODD = [
    (None, [1.0, 2.0], 1),
    (9001, None, 1),
    (9002, [1.0, None], 1),
    (9003, [float("nan"), 1.0], 0),
    (9004, [float("inf"), 1.0], 0),
    (9005, [], 1),
    (9006, [0.5], None),
    (9007, [0.5, 0.25, 1.0], 0),
    (9100, [-1.0, -2.0], 1),
]


def whole(v, dims):
    out = [int(np.floor(float(np.float32(x)) * 256)) for x in v]
    return out + [0] * (dims - len(out))


# ---- vector codes -----------------------------------------------------------------------


def kept(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


def coded(rows, parts, entries, rounds):
    """Plain k-means per part: id -> codes, error."""
    rows = sorted(kept(rows), key=lambda r: (r[0] is None, r[0] or 0, [np.floor(x * 256) for x in r[1]]))
    dims = -(-max((len(r[1]) for r in rows), default=0) // parts) * parts or parts
    points = np.array([whole(v, dims) for _, v, _ in rows]).reshape(len(rows), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()

    def nearest():
        return ((points[:, :, None] - books[None]) ** 2).sum(3).argmin(2)

    for _ in range(rounds):
        own = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine_ = points[own[:, p] == e, p]
                if len(mine_):
                    books[p, e] = mine_.sum(0) // len(mine_)
    own = nearest()
    error = ((points - books[np.arange(parts), own]) ** 2).sum((1, 2))
    by_label = {}
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    return sorted(
        (
            (r[0], bytes(own[n].astype(np.uint8).tolist()).hex(), int(error[n]), by_label[r[2]])
            for n, r in enumerate(rows)
        ),
        key=repr,
    ), books


@pytest.mark.parametrize("n, dims, parts, cells", [(400, 8, 4, 1 << 18), (300, 6, 3, 600), (90, 5, 2, 1)])
def test_codes_equal_plain_k_means(spark, monkeypatch, n, dims, parts, cells):
    """In one block and in many, with odd rows, repeated ids and clashing names."""
    monkeypatch.setattr(ball_codes, "BLOCK_CELLS", cells)
    rows = corpus(n, dims, n) + ODD + [(5, [0.5] * dims, 1), (5, [0.25] * dims, None)]
    codes, books = encode(vectors(spark, rows).repartition(3), parts=parts, entries=16, rounds=2)
    expected, entries = coded(rows, parts, 16, 2)
    got = codes.select("id", "code", "error", "label_error").collect()
    assert sorted(map(tuple, got), key=repr) == expected
    assert (books.entries == entries).all()


def test_codes_of_few_rows_and_none(spark):
    rows = [(3, [1.0, -1.0], 1), (1, [0.5, 0.5], 1)]
    codes, books = encode(vectors(spark, rows), parts=2, entries=64)
    assert books.entries.shape == (2, 2, 1)
    assert {(r.id, r.code, r.error) for r in codes.collect()} == {(1, "0000", 0), (3, "0101", 0)}
    empty, books = encode(vectors(spark, []), parts=2)
    assert empty.count() == 0 and books.entries.size == 0
    with pytest.raises(Exception, match="too long"):
        encode(vectors(spark, [(1, [1e9], 1)]), parts=1)[0].count()
    with pytest.raises(ValueError, match="one byte"):
        encode(vectors(spark, rows), entries=300)


@pytest.mark.parametrize("spread", [0.0, 1.0, 30.0])
def test_trees_hold_every_point_once_and_cache_sums(spread):
    points = np.rint(np.random.default_rng(3).normal(0, spread, (700, 4))).astype(np.int64)
    order, nodes = build_tree(points)
    assert sorted(order) == list(range(700))
    for node in nodes:
        rows = points[order[node["start"] : node["end"]]]
        assert (rows.sum(0) == node["sums"]).all()
        assert np.sqrt(((rows - node["centre"]) ** 2).sum(1)).max() <= node["radius"] + 1e-6
        if node["left"] >= 0:
            left, right = nodes[node["left"]], nodes[node["right"]]
            assert (left["start"], left["end"], right["end"]) == (
                node["start"], right["start"], node["end"],
            )
    book = points[:9]
    entry, sums, counts = assign(points, order, nodes, book)
    assert (entry == ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)).all()
    assert (counts == np.bincount(entry, minlength=9)).all()
    assert (sums == [points[entry == e].sum(0) for e in range(9)]).all()


def test_anchors_own_what_is_nearest():
    points = np.random.default_rng(4).normal(0, 9, (300, 3))
    own = place_anchors(points, 12)
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    pivots = [0]
    while len(pivots) < 12:
        pivots.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((points - points[pivots[-1]]) ** 2).sum(1)))
    gaps = np.sqrt(((points[:, None] - points[pivots][None]) ** 2).sum(2))
    assert np.allclose(gaps[np.arange(300), own], gaps.min(1))


def test_wholly_owned_balls_are_not_opened(monkeypatch):
    """Well-parted clusters are assigned from cached sums: no point is compared with entries."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-9000, 9000, (6, 4))
    points = (centres[rng.integers(0, 6, 2000)] + rng.integers(-5, 5, (2000, 4))).astype(np.int64)
    order, nodes = build_tree(points)

    class Sealed(np.ndarray):
        def __getitem__(self, key):
            raise AssertionError("a point was looked at")

    entry, sums, counts = assign(points.view(Sealed), order, nodes, centres)
    assert (counts == np.bincount(entry, minlength=6)).all() and counts.sum() == 2000
    assert (sums.sum(0) == points.sum(0)).all()
    assert np.abs(points - centres[entry]).max() <= 5


# ---- hard negatives ---------------------------------------------------------------------


def mined(rows, every, n_pos, n_neg, percent=80):
    best = {}
    for r in kept(rows):
        if r[0] is not None and r[2] is not None:
            row = (str(r[2]), [int(np.floor(x * 256)) for x in r[1]])
            best[r[0]] = min(best.get(r[0], row), row)
    dims = max((len(v) for _, v in best.values()), default=1)
    vec = {i: np.array(v + [0] * (dims - len(v))) for i, (_, v) in best.items()}
    out = []
    for a in best:
        if a % every:
            continue
        score = {i: int(vec[a] @ vec[i]) for i in best if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        same = [i for i in order if best[i][0] == best[a][0]][:n_pos]
        other = [i for i in order if best[i][0] != best[a][0]]
        for p in same:
            inside = [i for i in other if percent * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(inside[:n_neg], 1)]
    return sorted(out)


@pytest.mark.parametrize("cells, part", [(1 << 20, 8192), (64 * 8, 7)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, cells, part):
    """In one block and in many, anchors in several parts, copies, ties and odd rows."""
    monkeypatch.setattr(hard_negatives, "BLOCK_CELLS", cells)
    monkeypatch.setattr(hard_negatives, "PART_ANCHORS", part)
    rows = corpus(420, 8, 7) + ODD + [(20, [9.0, 1.0], 0), (20, [0.1] * 8, 2), (20, [0.1] * 8, 2)]
    df = vectors(spark, rows).repartition(3)
    got = mine(df, F.col("vec_id") % 20 == 0, positives=3, negatives=4)
    assert got.columns[:4] == ["anchor_id", "positive_id", "rank", "negative_id"]
    assert sorted(map(tuple, got.collect())) == mined(rows, 20, 3, 4)


def test_hard_negatives_of_few_rows_and_none(spark):
    def run(rows):
        return sorted(map(tuple, mine(vectors(spark, rows), F.col("vec_id") % 2 == 0).collect()))

    assert run([]) == run([(2, [1.0], 1)]) == run([(2, [1.0], 1), (4, [1.0], 1)]) == []
    # A positive with a score below zero opens no window; one of zero takes zeros.
    assert run([(2, [1.0], 1), (3, [-1.0], 1), (5, [-1.0], 0)]) == []
    assert run([(2, [], 1), (3, [5.0], 1), (5, [7.0], 0)]) == [(2, 3, 1, 5, 0, 0)]


def test_pruned_search_misses_nothing():
    rng = random.Random(1)
    state = np.random.default_rng(1)
    for _ in range(60):
        n, dims = rng.randrange(1, 200), rng.randrange(1, 40)
        rows = state.integers(-300, 300, (n, dims)) * (state.random((n, dims)) < rng.random())
        anchors = state.integers(-300, 300, (5, dims))
        exact = anchors @ rows.T
        low = np.quantile(exact, state.random(5)).astype(float)
        high = low + state.integers(0, 90_000, 5)
        allowed = state.random((5, n)) < 0.9
        length = np.maximum(1e-9, np.sqrt((anchors**2).sum(1)))
        index = build_index(rows, float((low / length).min()) * 0.999)
        i, j, score = search(index, anchors, low, high, allowed)
        expected = {
            (a, b) for a in range(5) for b in range(n)
            if allowed[a, b] and low[a] <= exact[a, b] <= high[a]
        }
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == expected
        assert (score == exact[i, j]).all()


def test_an_index_omits_what_norms_cover():
    rows = np.random.default_rng(2).integers(-50, 50, (300, 32))
    index = build_index(rows, 200.0)
    assert index.omitted.max() > 0 and (np.diff(index.omitted) >= 0).all()
    for place, left in enumerate(index.omitted):
        assert index.norms[left, place] < 200.0 or left == 0


# ---- toxicity ---------------------------------------------------------------------------


def test_the_label_model_finds_accuracies_and_correlations(spark):
    """Six voters of known accuracy, one of them twice, and no label."""
    rng = np.random.default_rng(6)
    truth = rng.random(6000) < 0.3
    right, speaks = [0.95, 0.9, 0.85, 0.8, 0.7, 0.6], [0.9, 0.8, 0.7, 0.9, 0.8, 0.9]
    votes = np.zeros((6000, 7), int)
    for v, (p, s) in enumerate(zip(right, speaks, strict=True)):
        answer = np.where((rng.random(6000) < p) == truth, 1, -1)
        votes[:, v] = np.where(rng.random(6000) < s, answer, 0)
    votes[:, 6] = votes[:, 4]
    rows = [(row.tolist(), None) for row in votes]
    df = spark.createDataFrame(rows, "votes array<tinyint>, known int")
    model = fit_label_model(df.groupBy("votes", "known").agg(F.count("*").alias("n")), 7, 25)
    assert abs(model.prior - 0.3) < 0.05
    assert np.abs(model.accuracies[:6] - right).max() < 0.06
    assert model.correlations[4, 6] > 0.95
    assert np.abs(model.correlations[:4, :4] - np.eye(4)).max() < 0.15
    assert model.redundancy[4] > 1.9 > 1.3 > model.redundancy[0]
    # As right as one can be who knows the accuracies, and that the last voter is a copy.
    odds = np.log(np.array(right) / (1 - np.array(right)))
    ideal = np.log(0.3 / 0.7) + votes[:, :6] @ odds > 0
    said = model.posterior(votes) > 0.5
    assert (said == truth).mean() > (ideal == truth).mean() - 0.005


def toxic_corpus(spark, n=700):
    rng = random.Random(8)
    calm = [a + b for a in ("lar", "ten", "mi", "so", "ve") for b in ("do", "ran", "l", "ph", "ti")]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(3, 60))]
        bad = i % 7 == 0
        if bad:
            # Half of them only with words no list holds, but that begin alike.
            word = rng.choice(["idiot", "scum"]) if i % 2 else "grumv" + rng.choice(calm)
            words.insert(rng.randrange(len(words)), word)
        docs.append((i, " ".join(words), 1))
        if i % 3:
            labels.append((i, int(bad)))
    docs += [(n, None, 1), (n + 1, "", 1), (None, "idiot scum", 1), (3, docs[3][1], 1)]
    docs += [(n + 2, "scum " * 30_000, 1)]
    labels += [(n, None), (None, 1), (1, 1), (1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score int"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxicity_is_learned_from_votes(spark):
    docs, labels = toxic_corpus(spark)
    model = fit_toxicity(docs, labels)
    out = with_toxicity(docs, model)
    assert sorted(out.columns) == ["doc_id", "score", "text"]
    assert out.count() == docs.count()
    rows = out.withColumn("held", is_unlearned("doc_id")).collect()
    held = [(r.score >= 0.7) == (r.doc_id % 7 == 0) for r in rows if r.held and r.doc_id < 700]
    assert len(held) > 150 and sum(held) >= 0.97 * len(held)
    by_id = {r.doc_id: r.score for r in rows if r.doc_id is not None}
    assert 0 <= by_id[700] == by_id[701] < 0.7 <= by_id[702] <= 1
    again = {tuple(r) for r in with_toxicity(docs, fit_toxicity(docs.repartition(5), labels)).collect()}
    assert again == {tuple(r) for r in out.collect()}


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = toxic_corpus(spark, 60)
    scored = with_toxicity(docs, fit_toxicity(docs, labels.limit(0)), score="toxicity")
    assert scored.where("toxicity BETWEEN 0 AND 1").count() == docs.count()
    assert scored.columns == ["doc_id", "text", "score", "toxicity"]
    none = docs.limit(0)
    assert with_toxicity(none, fit_toxicity(none, labels)).count() == 0
    one_class = labels.where("toxic = 0")
    assert with_toxicity(docs, fit_toxicity(docs, one_class)).count() == docs.count()


def test_voters_speak_for_their_reasons():
    lexicons = toxic_votes.Lexicons({toxic_votes.word_features("grumv")[0]: 0})
    found = toxic_votes._voters_of(lexicons)
    names = [*toxic_votes.SEEDS, *["mined"] * (VOTERS - len(toxic_votes.SEEDS) - 8)]
    names += toxic_votes._PATTERNS

    def spoken(text):
        votes = toxic_votes.vote(text, found)
        assert len(votes) == VOTERS == len(names)
        return {n: v for n, v in zip(names, votes, strict=True) if v}

    assert spoken("") == {"unlisted": -1, "unmined": -1}
    assert spoken("you are an IDIOT")["addressed"] == 1
    assert spoken("grumv")["mined"] == 1 and "unmined" not in spoken("grumv")
    assert spoken("what a sc*m !!!! a!! b!!")["masked"] == 1
    assert spoken("ALL OF IT IS SHOUTED")["shouting"] == 1
    assert "exclaiming" in spoken("a!! b!! c!!")
