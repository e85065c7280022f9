"""Toxicity by weak supervision: many voters, a model of how good they are, a linear classifier.

1. *Voters.* Word lists written down here, by language; lists mined from labelled texts (words and
   beginnings of words much more frequent in toxic ones), each divided over a few voters; patterns
   such as repeated hits, insults near "you", shouting, masked letters; and voters for clean texts
   that name no listed word.
2. *Label model* (:mod:`.label_model`): votes on all texts are counted, and the voters'
   accuracies and correlations are estimated from all of them.
3. *Classifier.* Logistic regression on words, beginnings of words and structure, fitted by
   Newton's method on the label model's posterior labels, not on the labels themselves. It
   scores texts that no voter speaks on.

Labels are read from at most :data:`LABELLED_ROWS` rows outside the held-out fold, the classifier is
fitted on at most :data:`FIT_ROWS` texts, half of them likely toxic as far as there are enough,
weighted by how many each stands for; both are the first by a hash of their key. Everything else
covers all rows: two passes over the texts, one for votes and one for scores. No text reaches the
driver, only lists and sums whose size is a parameter.

Defined cases: null texts are empty, and empty texts get a score as any other; null labels and
null keys teach nothing; a key labelled twice takes its smallest label; repeated rows score alike;
in ties lists take the smaller hash; without labels the written lists remain; an empty table
gives no rows; extra columns are passed through, and one named like the score is replaced;
very long texts are read whole, a text at a time, and held once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staging
from .common import with_columns_by
from .label_model import LabelModel, fit_label_model, votes_of

#: Labelled rows that voters are mined from, at most.
LABELLED_ROWS = 6000
#: Texts that the classifier is fitted on, at most.
FIT_ROWS = 6000
#: Entries of the mined lists, and features of the classifier.
MINED, FEATURES = 4096, 768
THRESHOLD = 0.7

# Insults and contempt, by language.
SEEDS = {
    "en mind": "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile fool",
    "en scorn": "loser losers pathetic worthless disgusting scum trash clown garbage filth vermin",
    "en harm": "kys subhuman subhumans exterminate lynch",
    "de": "idiot idioten dumm dummkopf abschaum trottel versager widerlich wertlos arschloch dreck",
    "fr": "idiot idiote imbécile crétin débile ordure minable pathétique connard salaud racaille",
    "es": "idiota imbécil estúpido estúpida basura escoria patético patética asqueroso payaso inútil",
}
# Whom an insult is meant for.
ADDRESS = "you your youre u du dich ihr dein tu toi vous ton tú te usted vosotros"
#: Mined lists: whole words, and beginnings of so many letters; each is divided over voters.
BEGINNINGS = (4, 5, 6)
SPLITS = 2
_PATTERNS = ("hits", "dense", "addressed", "shouting", "exclaiming", "masked", "unlisted", "unmined")
VOTERS = len(SEEDS) + SPLITS * (1 + len(BEGINNINGS)) + len(_PATTERNS)

_WORD = re.compile(r"[^\W\d_]+")
_UPPER = bytes(range(65, 91))
_MASKED = re.compile(r"[^\W\d_][*@#$]+[^\W\d_]")
#: Words whose features a task remembers.
_CACHE = 200_000


def is_unlearned(key: str) -> Column:
    """The fold that labels are never learned from: crc32 of the key as text, modulo 3, is 1."""
    crc = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


# ---- features ---------------------------------------------------------------------------


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings; the kind is the hash's start value."""
    whole = zlib.crc32(word.encode())
    parts = [zlib.crc32(word[:n].encode(), n) for n in BEGINNINGS if len(word) >= n]
    return (whole, *parts)


class _Remembered(dict):
    """``make(word)``, kept for as many words as a task may hold."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, word):
        if len(self) >= _CACHE:
            self.clear()
        found = self[word] = self._make(word)
        return found


def text_statistics(text: str, words: int, different: int) -> tuple[float, ...]:
    """Structure of a text with so many words, each number from 0 to about 1."""
    raw = text.encode("utf-8", "replace")
    size, n = max(1, len(raw)), max(1, words)
    upper = (len(raw) - len(raw.translate(None, _UPPER))) / size
    marks = min(1.0, text.count("!") / n)
    masks = min(1.0, text.count("*") / n)
    lines = min(1.0, text.count("\n") * 20 / size)
    return (min(1.0, float(np.log1p(words)) / 10), upper, marks, masks, different / n, lines)


STATISTICS = 6


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


# ---- voters -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicons:
    """What the voters look for: hashes of mined features, by voter."""

    mined: dict[int, int] = field(default_factory=dict)


def _seed_voters() -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for voter, words in enumerate(SEEDS.values()):
        for word in words.split():
            out.setdefault(word, []).append(voter)
    return out


_SEEDED, _ADDRESSED = _seed_voters(), frozenset(ADDRESS.split())


def mined_voter(kind: int, feature: int) -> int:
    """The voter for a mined feature of a kind: 0 for words, then one per length of beginning."""
    return len(SEEDS) + kind * SPLITS + feature % SPLITS


def vote(text: str, found: _Remembered) -> list[int]:
    """The answers of all voters on one text; ``found`` gives the voters a word belongs to."""
    words = _WORD.findall(text.lower())
    counts = Counter(words)
    hits = [0] * VOTERS
    seeded = 0
    for word, n in counts.items():
        voters = found[word]
        if voters:
            for voter in voters:
                hits[voter] += n
            seeded += n if word in _SEEDED else 0
    votes = [1 if h else 0 for h in hits]
    first = len(SEEDS) + SPLITS * (1 + len(BEGINNINGS))
    mined = sum(hits[len(SEEDS) : first])
    total = seeded + mined
    near = False
    if seeded:
        for at, word in enumerate(words):
            if word in _SEEDED and not _ADDRESSED.isdisjoint(words[max(0, at - 3) : at + 4]):
                near = True
                break
    exclaimed = text.count("!!")
    answers = {
        "hits": 1 if total >= 3 else 0,
        "dense": 1 if total and total * 50 >= len(words) else 0,
        "addressed": 1 if near else 0,
        "shouting": 1 if len(words) >= 5 and text.isupper() else 0,
        "exclaiming": 1 if exclaimed >= 3 else 0,
        "masked": 1 if _MASKED.search(text) else 0,
        "unlisted": 0 if seeded else -1,
        "unmined": 0 if mined else -1,
    }
    votes[first:] = [answers[p] for p in _PATTERNS]
    return votes


def _voters_of(lexicons: Lexicons) -> _Remembered:
    def make(word: str) -> tuple[int, ...]:
        voters = list(_SEEDED.get(word, ()))
        whole, *parts = word_features(word)
        for kind, feature in enumerate((whole, *parts)):
            if lexicons.mined.get(feature) == kind:
                voters.append(mined_voter(kind, feature))
        return tuple(voters)

    return _Remembered(make)


# ---- fitting ----------------------------------------------------------------------------


def _first_keys(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows by a hash of their key: a fair sample that repeats itself."""
    return rows.orderBy(F.xxhash64("key"), "key").limit(limit)


def _known(labels: DataFrame, key: str, label: str, limit: int) -> DataFrame:
    rows = labels.where(~is_unlearned(key)).select(
        F.col(f"`{key}`").alias("key"), (F.col(f"`{label}`").cast("int") > 0).cast("int").alias("known")
    )
    return _first_keys(rows.dropna().groupBy("key").agg(F.min("known").alias("known")), limit)


def _feature_rows(texts: DataFrame, weights: list[str]) -> DataFrame:
    """``texts`` with their different features, whole words first, and statistics."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        cache = _Remembered(word_features)
        features, kinds, stats = [], [], []
        for text in _texts(batch, "text"):
            words = _WORD.findall(text.lower())
            different = set(words)
            found = {f: kind for w in different for kind, f in enumerate(cache[w])}
            features.append(list(found))
            kinds.append(list(found.values()))
            stats.append(text_statistics(text, len(words), len(different)))
        return [
            pa.array(features, pa.list_(pa.int64())),
            pa.array(kinds, pa.list_(pa.int32())),
            pa.array(stats, pa.list_(pa.float64())),
        ]

    fields = [
        T.StructField("features", T.ArrayType(T.LongType())),
        T.StructField("kinds", T.ArrayType(T.IntegerType())),
        T.StructField("stats", T.ArrayType(T.DoubleType())),
    ]
    return with_columns_by(texts, fields, compute).select(
        "key", *weights, "features", "kinds", "stats"
    )


def _marked(
    rows: DataFrame, chance: str, least: float, limit: int, sure: Column | None = None
) -> DataFrame:
    """Features that mark a class, most telling first."""
    all_rows = rows.agg(F.sum(F.col(chance) * F.col("weight")), F.sum("weight")).first()
    yes_all = float(all_rows[0] or 0)
    no_all = float(all_rows[1] or 0) - yes_all
    if not (yes_all > 0 and no_all > 0):
        rows = rows.limit(0)  # one class only: nothing marks it
        yes_all = no_all = 1.0
    listed = rows.select(
        (F.col(chance) * F.col("weight")).alias("yes"),
        ((1 - F.col(chance)) * F.col("weight")).alias("no"),
        F.explode(F.arrays_zip("features", "kinds")).alias("f"),
    )
    counted = listed.groupBy(
        F.col("f.features").alias("feature"), F.col("f.kinds").alias("kind")
    ).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))

    def surplus(seen: Column, expected: Column) -> Column:
        return F.when(seen > 1e-9, seen * F.log(seen / expected)).otherwise(0.0)

    # The root of the likelihood ratio statistic of (has the feature) by (class), whose sign says
    # which class it marks. Rounded: sums of weights may differ in their last digits.
    yes, no, total = F.col("yes"), F.col("no"), yes_all + no_all
    has, lacks = yes + no, F.lit(total) - yes - no
    ratio = (
        surplus(yes, has * yes_all / total)
        + surplus(no, has * no_all / total)
        + surplus(F.lit(yes_all) - yes, lacks * yes_all / total)
        + surplus(F.lit(no_all) - no, lacks * no_all / total)
    )
    z = F.round(F.signum(yes * no_all - no * yes_all) * F.sqrt(F.greatest(2 * ratio, F.lit(0.0))), 6)
    marked = counted.withColumn("z", z).where(F.abs("z") >= least)
    if sure is not None:
        marked = marked.where(sure)
    return marked.orderBy(F.abs("z").desc(), "feature", "kind").limit(limit)


@dataclass(frozen=True)
class ToxicityModel:
    """A linear classifier over hashed features, and the label model it was taught by."""

    weights: dict[int, float]
    bias: float
    stats: np.ndarray
    labels: LabelModel | None = None

    def score(self, hits: set[int], stats: tuple[float, ...]) -> float:
        z = self.bias + float(np.dot(self.stats, stats)) + sum(self.weights[h] for h in sorted(hits))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 12):
    """Logistic regression on soft labels; the last column is the bias, which is not shrunk."""
    beta = np.zeros(x.shape[1])
    rate = np.clip((weight @ y) / weight.sum(), 1e-3, 1 - 1e-3)
    beta[-1] = np.log(rate / (1 - rate))
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + shrink * beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        beta -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return beta


def _classifier(rows: DataFrame, limit: int, labels: LabelModel) -> ToxicityModel:
    """Fit on stored feature rows: ``chance`` (the posterior label) and ``weight``."""
    chosen = [r.feature for r in _marked(rows, "chance", 3.0, limit).collect()]
    at = {f: n for n, f in enumerate(dict.fromkeys(chosen))}
    sent = rows.sparkSession.sparkContext.broadcast(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted({sent.value[f] for f in fs if f in sent.value}) for fs in batch["features"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["chance"], batch["weight"], pa.array(held, pa.list_(pa.int32())), batch["stats"]],
                names=["key", "chance", "weight", "at", "stats"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    narrow = rows.mapInArrow(
        run, f"key {kind}, chance double, weight double, at array<int>, stats array<double>"
    )
    # At most FIT_ROWS rows of at most FEATURES numbers; sorted, so that sums repeat themselves.
    table = narrow.toPandas().sort_values("key", kind="stable")
    if not len(table):
        rate = labels.prior
        return ToxicityModel({}, float(np.log(rate / (1 - rate))), np.zeros(STATISTICS), labels)
    x = np.zeros((len(table), len(at) + STATISTICS + 1))
    for n, (held, stats) in enumerate(zip(table["at"], table["stats"], strict=True)):
        x[n, np.asarray(held, int)] = 1
        x[n, len(at) : -1] = stats
    x[:, -1] = 1
    y, weight = table["chance"].to_numpy(), table["weight"].to_numpy()
    weight = weight / weight.mean()
    beta = _newton(x, y, weight, ridge=0.1)
    named = {f: float(beta[n]) for f, n in at.items()}
    return ToxicityModel(named, float(beta[-1]), beta[len(at) : -1], labels)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    labelled_rows: int = LABELLED_ROWS,
    fit_rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Mine voters, model them over all texts, teach the classifier with the posterior labels."""
    spark = docs.sparkSession
    with Staging(spark) as staging:
        texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        known = staging.write(_known(labels, key, label, labelled_rows), "known")
        # At most labelled_rows keys.
        shown = texts.join(F.broadcast(known.withColumn("weight", F.lit(1.0))), "key")
        mined_from = staging.write(_feature_rows(shown, ["known", "weight"]), "labelled")
        # Lists must be right: of the texts that hold an entry, 19 in 20 are toxic.
        mined = _marked(mined_from, "known", 4.0, MINED, F.expr("yes >= 5 AND yes >= 19 * no"))
        lexicons = Lexicons({r.feature: r.kind for r in mined.collect()})

        sent = spark.sparkContext.broadcast(lexicons)

        def votes(batch: pa.RecordBatch) -> list[pa.Array]:
            found = _shared(_voters_of, sent)
            return [pa.array([vote(t, found) for t in _texts(batch, "text")], pa.list_(pa.int8()))]

        voted = with_columns_by(texts, [T.StructField("votes", T.ArrayType(T.ByteType()))], votes)
        stored = staging.write(voted.select("key", "votes"), "votes")
        patterns = (
            stored.join(F.broadcast(known), "key", "left")
            .groupBy("votes", "known")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        model = fit_label_model(staging.write(patterns, "patterns"), VOTERS)
        chosen = staging.write(_teaching(stored, model, fit_rows), "chosen")
        taught = texts.join(F.broadcast(chosen), "key")  # at most fit_rows keys
        rows = staging.write(_feature_rows(taught, ["chance", "weight"]), "taught")
        return _classifier(rows, FEATURES, model)


_HELD: dict[int, tuple] = {}


def _shared(make, sent):
    """``make(sent.value)``, once in a Python worker for as long as it serves that broadcast."""
    if _HELD.get(0, (None,))[0] != id(sent.value):
        _HELD[0] = (id(sent.value), sent.value, make(sent.value))
    return _HELD[0][2]


def _teaching(stored: DataFrame, model: LabelModel, fit_rows: int) -> DataFrame:
    """Keys to teach with: half of them likely toxic, weighted by how many each stands for."""
    sent = stored.sparkSession.sparkContext.broadcast(model)

    def chances(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(np.round(sent.value.posterior(votes_of(batch, VOTERS)), 9))]

    judged = with_columns_by(stored, [T.StructField("chance", T.DoubleType())], chances)
    open_rows = judged.where(F.col("key").isNotNull() & ~is_unlearned("key")).drop("votes")
    likely = F.col("chance") >= 0.5
    counts = open_rows.agg(F.count_if(likely).alias("yes"), F.count_if(~likely).alias("no")).first()
    halves = []
    for rows, total, share in (
        (open_rows.where(likely), counts["yes"], min(counts["yes"], fit_rows // 2)),
        (open_rows.where(~likely), counts["no"], fit_rows - min(counts["yes"], fit_rows // 2)),
    ):
        weight = max(1.0, total / max(1, share))
        # A repeated key counts once.
        once = _first_keys(rows, share).groupBy("key").agg(F.max("chance").alias("chance"))
        halves.append(once.withColumn("weight", F.lit(float(weight))))
    return halves[0].unionByName(halves[1])


# ---- scoring ----------------------------------------------------------------------------


def with_toxicity(
    docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with the score of every text, 0 to 1; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs if score.lower() == text.lower() else docs.drop(score)

    def known_features(machine: ToxicityModel) -> _Remembered:
        weights = machine.weights
        return _Remembered(lambda word: tuple(f for f in word_features(word) if f in weights))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        machine = sent.value
        cache = _shared(known_features, sent)
        scores = []
        for body in _texts(batch, text):
            words = _WORD.findall(body.lower())
            different = set(words)
            hits: set[int] = set()
            for word in different:
                found = cache[word]
                if found:
                    hits.update(found)
            stats = text_statistics(body, len(words), len(different))
            scores.append(machine.score(hits, stats))
        return [pa.array(scores, pa.float64())]

    return with_columns_by(kept, [T.StructField(score, T.DoubleType())], compute)
