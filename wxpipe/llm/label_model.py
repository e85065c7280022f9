"""A generative model of voters: their accuracies and correlations, without true labels.

Voters say toxic (1), clean (-1) or nothing (0). The model is a class per row, unseen but for a
few labelled rows, and for every voter the chances of its three answers in either class. It is
estimated by expectation maximisation over *all* rows, which are first counted by pattern (the
answers of all voters), so that an iteration reads one row per different pattern.

Voters that say the same for the same reason must not count twice. In every iteration the model
also takes the correlation of each pair of voters within the classes; a voter's evidence is divided
by one plus the sum of its correlations, so two identical voters weigh as much as one.

Sums are kept in whole 2^-20ths, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANSWERS = (-1, 0, 1)
ITERATIONS = 8
_UNIT = 1 << 20
#: Correlations up to this are taken for chance.
_NOISE = 0.1


@dataclass(frozen=True)
class LabelModel:
    prior: float
    #: chances[y, voter, answer + 1]
    chances: np.ndarray
    #: correlation of each pair of voters within the classes
    correlations: np.ndarray

    @property
    def redundancy(self) -> np.ndarray:
        """By how much each voter's evidence is divided."""
        over = np.clip(np.abs(self.correlations) - _NOISE, 0, None) / (1 - _NOISE)
        np.fill_diagonal(over, 0)
        return 1 + over.sum(1)

    @property
    def accuracies(self) -> np.ndarray:
        """How often each voter, if it answers, is right."""
        right = (1 - self.prior) * self.chances[0, :, 0] + self.prior * self.chances[1, :, 2]
        wrong = self.prior * self.chances[1, :, 0] + (1 - self.prior) * self.chances[0, :, 2]
        return right / (right + wrong)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of the class 1 for each row of answers."""
        evidence = np.log(self.chances[1] / self.chances[0]) / self.redundancy[:, None]
        total = evidence[np.arange(votes.shape[1]), votes.astype(int) + 1].sum(1)
        z = np.log(self.prior / (1 - self.prior)) + total
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def assumed(voters: int, prior: float = 0.1) -> LabelModel:
    """Where estimation begins: voters speak seldom and are right more often than not."""
    chances = np.empty((2, voters, 3))
    chances[0], chances[1] = (0.30, 0.67, 0.03), (0.10, 0.50, 0.40)
    return LabelModel(prior, chances, np.eye(voters))


def votes_of(batch: pa.RecordBatch, voters: int) -> np.ndarray:
    flat = batch["votes"].flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, voters)


def _sums(votes: np.ndarray, count: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Per class, in units: rows, answers of each voter, products and squares of answers."""
    out = []
    for share in (1 - chance, chance):
        weight = np.rint(share * _UNIT).astype(np.int64) * count
        numbers = votes.astype(np.int64)
        answers = np.stack([((numbers == a) * weight[:, None]).sum(0) for a in ANSWERS], 1)
        products = (numbers * weight[:, None]).T @ numbers
        out.append(np.concatenate(([weight.sum()], answers.reshape(-1), products.reshape(-1))))
    return np.concatenate(out)


def _update(totals: np.ndarray, voters: int) -> LabelModel:
    totals = totals.reshape(2, -1) / _UNIT
    rows = totals[:, 0]
    answers = totals[:, 1 : 1 + 3 * voters].reshape(2, voters, 3) + 0.5
    chances = answers / answers.sum(2, keepdims=True)
    products = totals[:, 1 + 3 * voters :].reshape(2, voters, voters)
    covariance = np.zeros((voters, voters))
    for y in (0, 1):
        if rows[y] > 0:
            mean = chances[y] @ np.array(ANSWERS)
            covariance += products[y] - rows[y] * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
    correlations = np.clip(covariance / np.outer(spread, spread), -1, 1)
    prior = float(np.clip((rows[1] + 1) / (rows.sum() + 2), 1e-4, 1 - 1e-4))
    return LabelModel(prior, chances, correlations)


def fit_label_model(patterns: DataFrame, voters: int, iterations: int = ITERATIONS) -> LabelModel:
    """Model of rows counted by pattern: ``votes``, ``known`` (0, 1 or null) and ``n``.

    Rows of a known class keep it, and together weigh as much as all others, at any size: without
    them the two classes could turn into any other division of the texts. An iteration is one
    aggregate over the patterns, of which only sums per voter and pair of voters reach the driver.
    """
    spark = patterns.sparkSession
    model = assumed(voters)
    n_known, n_all = patterns.agg(
        F.sum(F.when(F.col("known").isNotNull(), F.col("n"))), F.sum("n")
    ).first()
    anchor = max(1, ((n_all or 0) - (n_known or 0)) // n_known) if n_known else 1

    def totals_by(current: LabelModel | None) -> np.ndarray:
        sent = spark.sparkContext.broadcast(current)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                votes = votes_of(batch, voters)
                count = batch["n"].to_numpy(zero_copy_only=False).astype(np.int64)
                known = batch["known"].to_numpy(zero_copy_only=False).astype(float)
                count = np.where(np.isnan(known), count, count * anchor)
                chance = np.where(np.isnan(known), sent.value.posterior(votes), known)
                sums = _sums(votes, count, chance)
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(sums[at])], names=["at", "total"]
                )

        found = patterns.mapInArrow(run, "at long, total long").groupBy("at")
        totals = np.zeros(2 * (1 + 3 * voters + voters * voters), np.int64)
        for at, total in found.agg(F.sum("total")).collect():
            totals[at] = total
        return totals

    for _ in range(iterations):
        totals = totals_by(model)
        if not totals.any():
            break
        model = _update(totals, voters)
    return model
