"""Document rules, and verdicts on whole hosts from their documents' failures.

Base rules count words, symbols, repeated lines and repeated three-word windows of each text.
A host's failure rate is shrunk towards the rate of all hosts by a beta prior fitted to the
hosts' rates (method of moments). The prior also says which rates are out of the ordinary: a host
is rejected if its shrunk rate lies beyond an upper quantile of it (a half at most) and the odds of
failure are some multiple of the average's. So hosts that differ only by chance are never rejected, however many
there are. A document is kept if it passes the base rules and its host is not rejected.

Spark expressions only. Texts are read once; what they leave is a narrow table, stored in the
shared folder. Failures are summed per host inside each task before the shuffle, so a host with
a third of all documents is one row per task. Rejected hosts come back by broadcast if their
measured size allows it, else by a shuffle join whose hot hosts the adaptive planner splits.

Defined cases: null texts have no words and fail; documents without host are judged by the base
rules alone; repeated rows count as often as they appear; texts of any length are counted exactly, in one
row's memory; equal rates share a verdict; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import Staging
from .common import BROADCAST_BYTES, let, text_of

SPACES = "[\\x20\\x09-\\x0D]+"
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host goes if its shrunk rate lies beyond this quantile of the prior, and the odds that a
#: document of it fails are more than this multiple of those of all documents.
QUANTILE, TIMES_ODDS = 0.99, 3.0


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def repeated_words(words: Column) -> Column:
    """Words covered by three-word windows that the text holds twice or more.

    Windows are sorted, by a hash first so that words are seldom compared, then by their words and
    their place: equal ones stand beside each other whatever hashes collide and however long the
    text is.
    """

    def window(word: Column, i: Column) -> Column:
        second, third = words[i + 1], words[i + 2]
        return F.struct(
            F.xxhash64(word, second, third).alias("h"),
            word.alias("a"),
            second.alias("b"),
            third.alias("c"),
            i.alias("i"),
        )

    def covered(sorted_windows: Column) -> Column:
        def equals_next(i: Column) -> Column:
            here, there = sorted_windows[i], sorted_windows[i + 1]
            same = here["h"] == there["h"]
            for part in "abc":
                same = same & (here[part] == there[part])
            return same

        def places(i: Column) -> Column:
            p, q = sorted_windows[i]["i"], sorted_windows[i + 1]["i"]
            return F.array(p, p + 1, p + 2, q, q + 1, q + 2)

        found = F.filter(F.sequence(F.lit(0), F.size(sorted_windows) - 2), equals_next)
        return F.size(F.array_distinct(F.flatten(F.transform(found, places))))

    windows = F.slice(words, 1, F.size(words) - 2)
    # Two windows at least: sequence() would count down for fewer.
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(F.sort_array(F.transform(windows, window)), covered)
    )


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_CHAR))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_rules(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """``key``, host, the five counts and base_failed of every document."""
    body = F.col("text")
    narrow = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{host}`").cast("string").alias("host"),
        text_of(text).alias("text"),
    )
    counted = narrow.select(
        F.col("key").alias(key),
        F.col("host"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines(body).cast("long").alias("n_dup_lines"),
        let(
            words_of(body),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
            ),
        ).alias("words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counted.select(
        key,
        "host",
        "words.n_words",
        "words.word_chars",
        "n_symbols",
        "n_dup_lines",
        "words.n_repeat_words",
    ).withColumn("base_failed", failed)


@dataclass(frozen=True)
class BetaPrior:
    """Pseudo-counts of failed and passed documents."""

    failed: float
    passed: float


    def quantile(self, share: float) -> float:
        """The rate that ``share`` of hosts stay below, by numeric integration."""
        steps = 200_000
        at = (np.arange(steps) + 0.5) / steps
        height = (self.failed - 1) * np.log(at) + (self.passed - 1) * np.log1p(-at)
        mass = np.cumsum(np.exp(height - height.max()))
        return float(at[np.searchsorted(mass, share * mass[-1])])

    def limit(self) -> float:
        """The shrunk rate beyond which a host is rejected.

        Where hosts differ so much that the quantile says little, a host whose documents more
        often fail than pass is out of the ordinary.
        """
        odds = TIMES_ODDS * self.failed / self.passed
        return max(min(self.quantile(QUANTILE), 0.5), odds / (1 + odds))


def fit_prior(hosts: DataFrame) -> BetaPrior:
    """Beta prior of the hosts' failure rates by the method of moments.

    Hosts count by their documents. Where the rates spread no more than chance explains (or
    hosts are too few to tell) the prior is worth the mean host size, so no host strays far.
    """
    rate = F.col("failed") / F.col("docs")
    seen = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("docs").alias("docs"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("docs") * rate * rate).alias("squares"),
        F.sum(F.col("docs") * F.col("docs")).alias("sizes"),
    ).first()
    if not seen["docs"]:
        return BetaPrior(1.0, 1.0)
    docs, mean = float(seen["docs"]), float(seen["failed"]) / float(seen["docs"])
    chance = mean * (1 - mean)
    spread = seen["squares"] / docs - mean * mean
    # spread = chance * (rho + (1 - rho) * hosts / docs), rho the correlation within hosts
    share = seen["hosts"] / docs
    rho = (spread / chance - share) / (1 - share) if chance > 0 and share < 1 else 0.0
    strength = (1 - rho) / rho if 1e-6 < rho < 1 else docs / seen["hosts"]
    mean = min(max(mean, 1 / (docs + 2)), 1 - 1 / (docs + 2))
    return BetaPrior(mean * strength, (1 - mean) * strength)


def judge_hosts(rules: DataFrame, max_rate: float | None = None) -> DataFrame:
    """Documents, failures, shrunk failure rate and verdict of every host."""
    hosts = (
        rules.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    hosts = Staging(rules.sparkSession, until_exit=True).write(hosts, "hosts")
    prior = fit_prior(hosts)
    rate = (F.col("failed") + prior.failed) / (F.col("docs") + prior.failed + prior.passed)
    limit = prior.limit() if max_rate is None else max_rate
    return hosts.withColumn("host_rate", rate).withColumn("rejected", F.col("host_rate") > limit)


def host_rules(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    max_rate: float | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The base counts of every document, base_failed, host_rejected and kept.

    ``max_rate`` sets the limit for hosts in place of the prior's.
    """
    staging = Staging(docs.sparkSession, until_exit=True)
    rules = staging.write(base_rules(docs, key, host, text), "rules")
    rejected = judge_hosts(rules, max_rate).where("rejected").select("host")
    size = rejected.agg(F.sum(F.octet_length("host") + 64)).first()[0] or 0
    marks = rejected.withColumn("host_rejected", F.lit(True))
    if size <= broadcast_bytes:
        marks = F.broadcast(marks)
    judged = rules.join(marks, "host", "left").withColumn(
        "host_rejected", F.coalesce("host_rejected", F.lit(False))
    )
    kept = ~F.col("base_failed") & ~F.col("host_rejected")
    return judged.withColumn("kept", kept).drop("host")
